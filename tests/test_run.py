"""The staged run from raw inputs: what feeds what, resuming, changed inputs, crashes, reports and run control."""

import random
import time

import pytest
from pyspark.sql import functions as F

from helixframe.plans import checks, control, pipeline
from helixframe.plans.pipeline import Run, Step

SPECIES = {"human": "Primates", "little_brown_bat": "Bats", "bowhead_whale": "Cetaceans", "naked_mole_rat": "Rodents", "painted_turtle": "Reptiles"}
LETTERS = "ACDEFGHIKLMNPQRSTVWY"


def proteins(changed=()):
    """(gene, species, sequence): five genes; in gene i every species but human differs from human in a stretch, in `changed` genes in another one."""
    rng, out = random.Random(11), []
    for g in range(5):
        human = "".join(rng.choice(LETTERS) for _ in range(120))
        for k, s in enumerate(SPECIES):
            seq = list(human)
            for at in () if s == "human" else range(20 + 10 * k if g % 2 else 40, 75 if g in changed else 50 + 5 * g):
                seq[at] = LETTERS[(LETTERS.index(seq[at]) + (k if g % 2 else 3)) % 20]
            out.append((f"g{g}", s, "".join(seq)))
    return out


def land(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def land_aligned(spark, folder, changed=()):
    land(spark, folder, "aligned", [(f"og_{g}", f"{s}|{g}.{s}", seq) for g, s, seq in proteins(changed)], "og string, label string, seq string")


@pytest.fixture
def folder(spark, tmp_path):
    at, found = str(tmp_path / "store"), proteins()
    land_aligned(spark, at)
    land(spark, at, "species", [(s, lineage, [] if s == "human" else ["longevity"], False) for s, lineage in SPECIES.items()], "id string, lineage_group string, phenotypes array<string>, is_control boolean")
    land(spark, at, "gene", [(f"g{g}", f"SYM{g}_HUMAN", 0.2 if g % 2 else 1.5, [f"R-{g % 2}"], None) for g in range(5)], "id string, gene_symbol string, loeuf double, pathway_ids array<string>, go_terms array<string>")
    land(spark, at, "orthogroup_member", [(f"og_{g}", s, f"{g}.{s}", 0) for g, s, _ in found], "og_id string, species_id string, protein_id string, place int")
    land(spark, at, "protein", [(s, f"{g}.{s}", seq) for g, s, seq in found], "species_id string, protein_id string, sequence string")
    land(spark, at, "gene_protein", [(f"{g}.human", g) for g, s, _ in found if s == "human"], "protein_id string, gene_id string")
    land(spark, at, "accession", [(f"g{g}", f"P{g}") for g in range(5)], "gene_id string, accession string")
    land(spark, at, "pathogenicity", [(f"P{g}", at_, a, 0.9) for g in range(5) for at_ in range(1, 121) for a in LETTERS], "accession string, position int, alt string, score double")
    return at


def table(run, name):
    return run.store({name}).tables[name]


def test_scores_move_when_a_motif_changes(spark, folder):
    run = Run(spark, folder)
    done = run.go(until="step9")
    due = ("step3b", "step4", "step4_load", "step4_changes", "step4b", "step4d", "step6", "step7", "step7b", "step7c", "step7d", "step8", "step9")
    assert {k: done[k] for k in due} == dict.fromkeys(due, "done") and done["step3c"] == "lacks gff_feature, genome_block"
    motifs = table(run, "divergent_motif")
    assert motifs.where("consequence_score = 0.9 AND motif_direction IS NOT NULL AND convergent_aa_count IS NOT NULL").count() == motifs.count() > 0
    assert motifs.where("convergent_aa_count >= 2").count() > 0
    evolution = {r.gene_id: r for r in table(run, "evolution_score").collect()}
    assert all(r.selection_model == "protein_divergence_proxy" and r.dnds_pvalue > 0 for r in evolution.values()) and len(evolution) == 5
    seen = [r for r in evolution.values() if r.convergence_count is not None]
    assert all(r.convergence_count >= 1 and 0 <= r.convergence_pval <= 1 for r in seen) and len(seen) >= 3 and max(r.convergence_count for r in seen) >= 3 and max(r.convergence_weight for r in seen) > 0
    scores = {r.gene_id: (r.composite_score, r.convergence_score, r.selection_score) for r in table(run, "candidate_score").collect()}
    assert len(scores) == 5 and len(set(scores.values())) > 1

    assert set(Run(spark, folder).go(until="step9").values()) <= {"skipped", *(v for v in done.values() if v.startswith("lacks"))}
    before = run.manifest.state()
    land_aligned(spark, folder, changed=(0, 2))
    again = Run(spark, folder)
    done = again.go(until="step9")
    assert done["step3b"] == "skipped" and done["step4"] == done["step7"] == done["step9"] == "done"
    moved = {r.gene_id: (r.composite_score, r.convergence_score, r.selection_score) for r in table(again, "candidate_score").collect()}
    assert {g for g in scores if moved[g][2] != scores[g][2]} >= {"g0", "g2"} and moved["g1"][2] == scores["g1"][2]
    assert again.manifest.state()["step3b"] == before["step3b"]
    gone = again.manifest.vacuum()
    assert any("/scanned_motif/" in g for g in gone) and table(again, "scanned_motif").count() > 0 and not again.manifest.vacuum()


def test_a_changed_input_makes_its_dependants_due_alone(spark, folder):
    Run(spark, folder).go(until="step9")
    land(spark, folder, "pathogenicity", [("P1", 30, "A", 0.1)], "accession string, position int, alt string, score double")
    done = Run(spark, folder).go(until="step9")
    assert {k for k, v in done.items() if v == "done"} == {"step4b", "step4d", "step7c", "step9"}


def test_runs_go_on_after_crashes(spark, folder, monkeypatch):
    """A step that fails after its first table, writers that left their scraps, a table that has only them."""
    whole = pipeline.STEPS["step4"]

    def half(store):
        found = whole.f(store)
        broken = F.udf(lambda x: 1 // 0, "int")
        return {"scanned_motif": found["scanned_motif"], "ortholog_identity": found["ortholog_identity"].withColumn("identity", broken("identity"))}

    monkeypatch.setitem(pipeline.STEPS, "step4", Step(whole.reads, whole.writes, whole.uses, half))
    with pytest.raises(Exception, match="ZeroDivision"):
        Run(spark, folder).go(until="step4")
    run = Run(spark, folder)
    assert "step4" not in run.manifest.state() and run.version("scanned_motif", run.manifest.state()) is None
    assert not run.manifest.folder.names("_tables/scanned_motif") and not run.manifest.folder.names("_tables/ortholog_identity")
    monkeypatch.setitem(pipeline.STEPS, "step4", whole)
    jvm_folder = run.manifest.folder
    jvm_folder.write("domain/_temporary/0/part-0.parquet", "scrap")
    jvm_folder.write("_tables/scanned_motif/scrap/_temporary/part-0.parquet", "scrap")
    jvm_folder.write("_commits/scrap.tmp", "scrap")
    done = run.go(until="step9")
    assert done["step4"] == done["step9"] == "done" and done["step4b_domains"] == "lacks domain"
    assert "_tables/scanned_motif/scrap" in run.manifest.vacuum()


def test_two_runs_cannot_publish_over_each_other(spark, folder):
    run = Run(spark, folder)
    run.manifest.publish("a", {}, {}, {})
    with pytest.raises(FileExistsError):
        run.manifest.folder.write("_commits/00000001.json", "{}")
    assert run.manifest.state() == {"a": {"read": {}, "wrote": {}, "metrics": {}}}


def test_metrics_are_those_of_a_second_look(spark, folder):
    """Rules over what was observed while writing give what they give over the tables."""
    run = Run(spark, folder)
    run.go()
    names = {*checks.OBSERVED, *checks.GATHERED, "gene", "ortholog", "species", "nucleotide_region", "evolution_score"}
    rows = lambda df: {(r.step, r.name): (r.status, r.value) for r in df.collect()}
    report = rows(run.report())
    assert report == rows(checks.quality_report(run.store(names).tables))
    assert report["step4", "motifs"] == ("PASS", table(run, "divergent_motif").count()) and report["step3d", "all rules"][0] == "FAIL" and report["step3b", "gene coverage"] == ("PASS", 100.0)
    counted = {(r.table, r.metric): r.value for r in run.metrics().where("step = 'step7c'").collect()}
    assert counted["divergent_motif", "rows"] == table(run, "divergent_motif").count() and counted["divergent_motif", "null_domain_name"] == counted["divergent_motif", "rows"]
    texts = {r.step: r.markdown for r in run.step_reports().collect()}
    assert texts["step4"].startswith("# step4\n") and "| motifs | PASS |" in texts["step4"]


def test_rules_on_small_tables(spark):
    schema = "id string, ortholog_id string, divergence_score double, consequence_score double, esm1v_score double, domain_name string, motif_direction string, convergent_aa_count int"
    tables = {
        "gene": spark.createDataFrame([("a",), ("b",)], "id string"), "species": spark.createDataFrame([("x", False), ("c", True)], "id string, is_control boolean"),
        "ortholog": spark.createDataFrame([("1", "a", "x", 20.0), ("2", "a", "c", None), ("3", "b", "x", 50.0), ("4", "b", "y", 60.0)], "id string, gene_id string, species_id string, sequence_identity_pct double"),
        "divergent_motif": spark.createDataFrame([("m", "1", 0.2, 0.5, None, "D", "gain_of_function", 3), ("n", "1", 0.0, 0.9, -2.0, None, "loss_of_function", 0), ("o", "1", 0.4, None, None, None, "neutral", None)], schema),
        "evolution_score": spark.createDataFrame([("a", 0.01)], "gene_id string, convergence_pval double"),
        "candidate_score": spark.createDataFrame([("a", "Tier1", 0.0, 0.0, 0.05, 0.0), ("z", "Tier2", 0.9, 0.1, 0.5, 0.3)], "gene_id string, tier string, convergence_score double, selection_score double, composite_score double, expression_score double"),
    }
    got = {(r.step, r.name): (r.status, r.value) for r in checks.quality_report(tables).collect()}
    assert got["step3b", "gene coverage"] == ("PASS", 100.0) and got["step3b", "median species per gene"] == ("FAIL", 1.5)
    assert got["step3b", "low identity"] == ("FAIL", 25.0) and got["step3b", "missing identity"] == ("WARN", 25.0)
    assert got["step4", "genes without motifs"] == ("FAIL", 50.0) and got["step4", "divergence"] == ("FAIL", 0.2)
    assert got["step4b", "pathogenicity coverage"] == ("PASS", 66.7) and got["step4b", "pathogenicity spread"] == ("FAIL", 50.0) and got["step4b", "domain coverage"] == ("PASS", 33.3)
    assert got["step4d", "gain of function"] == ("FAIL", 0.5) and got["step4d", "loss of function"] == ("PASS", -2.0) and got["step4d", "functional shift"] == ("FAIL", 0.0)
    assert got["step7b", "convergent motifs in significant genes"] == ("PASS", 0.01)
    assert got["integrity", "orphan candidates"] == ("FAIL", 1.0) and got["integrity", "first tier without evidence"] == ("FAIL", 1.0) and got["integrity", "spread of convergence"][0] == "PASS" and got["integrity", "first tier with low scores"] == ("FAIL", 1.0)
    assert got["step8", "candidates without expression"] == ("FAIL", 50.0) and got["step3d", "cds conservation"] == ("FAIL", None) and got["integrity", "all rules"][0] == "FAIL"


def test_start_status_and_stop(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "runs")
    land(spark, folder, "gene", [("g",)], "id string")

    def slow(seconds):
        def wait(batches):
            for b in batches:
                time.sleep(seconds)
                yield b

        return lambda store: {"late": store.gene.mapInArrow(wait, "id string")}

    steps = {"first": Step(("gene",), ("early",), (), lambda store: {"early": store.gene}), "second": Step(("early", "gene"), ("late",), (), slow(120)), "third": Step(("late",), ("last",), (), lambda store: {"last": store.late})}
    monkeypatch.setattr(pipeline, "STEPS", steps)
    runs = control.Control(spark, folder)
    assert runs.status() == {}
    one = runs.start(species_ids=["human"])
    for _ in range(200):
        if runs.status(one)["steps"].get("second", {}).get("status") == "running":
            break
        time.sleep(0.1)
    time.sleep(1)
    assert runs.status()["status"] == "running" and runs.status()["steps"]["first"]["status"] == "done"
    with pytest.raises(control.AlreadyRunning):
        runs.start()
    assert runs.stop(one) == "stopped"
    run = Run(spark, folder)
    assert set(run.manifest.state()) == {"first"} and run.version("late", run.manifest.state()) is None
    monkeypatch.setitem(steps, "second", Step(("early", "gene"), ("late",), (), slow(0)))
    two = runs.start()
    state = runs.wait(two, 60)
    assert state["status"] == "done" and {k: v["status"] for k, v in state["steps"].items()} == {"first": "skipped", "second": "done", "third": "done"}
    assert [(r.id, r.status) for r in runs.runs().collect()] == [(two, "done"), (one, "stopped")]
    lost = control.Control(spark, folder)
    lost._write("lost", id="lost", status="running", started_at="2999", finished_at=None, species_ids=[], steps={}, notes=None)
    assert lost.status()["status"] == "failed"  # its driver is gone


def test_every_step_over_landed_tables(spark, folder):
    """Steps after scoring, up to compounds, over small landed tables; the genes' tiers land as well."""
    land(spark, folder, "candidate_score", [(f"g{g}", "", 0.5 * g) for g in range(5)], "gene_id string, trait_id string, expression_score double")
    run = Run(spark, folder)
    run.go(until="step9")
    land(spark, folder, "tier", [], "x int")
    rows = table(run, "candidate_score").withColumn("tier", F.when(F.col("gene_id") < "g3", "Tier1").otherwise("Tier3")).collect()
    schema = table(run, "candidate_score").schema
    other = folder + "2"
    for name in ("divergent_motif", "ortholog", "species", "gene", "evolution_score", "substitution"):
        table(run, name).write.parquet(f"{other}/{name}")
    spark.createDataFrame(rows, schema).write.parquet(f"{other}/candidate_score")
    whole = dict(pipeline.STEPS)
    print_ = [5, 3]
    landed = {
        "structure_feature": ([("g2", 45, "active_site", "x")], "gene_id string, position int, feature string, description string"), "structure_residue": ([("g2", i, float(i), 0.0, 0.0, 90.0) for i in range(1, 121)], "gene_id string, residue int, x double, y double, z double, plddt double"),
        "pocket_centroid": ([("g2", 45.0, 0.0, 0.0)], "gene_id string, px double, py double, pz double"), "promoter_pair": ([("g0", "little_brown_bat", 0.4)], "gene_id string, species_id string, promoter_divergence double"),
        "disease_source": ([("SYM0", 0.7, "D"), ("SYM4", 0.9, "E")], "symbol string, opentargets_score double, disease_name string"), "target_source": ([("sym1", ["drug"])], "symbol string, existing_drugs array<string>"), "gene_source": ([("SYM2", ["R-9"])], "symbol string, pathway_ids array<string>"),
        "known_drug": ([("g1", 0, "d", "PHASE_2", None, ["E1"])], "gene_id string, ordinal int, name string, stage string, drug_stage string, indications array<string>"), "protein_variant": ([("g0", "v", "p.Ala45Val")], "gene_id string, variant_id string, hgvsp string"),
        "abstract": ([("g0", "SYM0", "SYM0 is protective"), ("g0", "SYM0", "no")], "gene_id string, symbol string, text string"), "pocket": ([("g0", 1, 0.8), ("g0", 2, 0.3)], "gene_id string, rank int, score double"), "pocket_residue": ([("g2", 44)], "gene_id string, residue int"),
        "tractability_item": ([("g0", [("Approved Drug", "SM", True)])], "gene_id string, items array<struct<label:string,modality:string,value:boolean>>"), "predicted_pocket": ([("g1", 2, 0.9), ("g1", 1, 0.6)], "gene_id string, rank int, probability double"),
        "protein_length": ([("g0", 400)], "gene_id string, length int"), "coding_sequence": ([("g0", "ACGTACGTACGTACGTACGAGG")], "gene_id string, sequence string"), "network_degree": ([("g0", 60)], "gene_id string, degree int"), "constraint": ([("g1", 0.95)], "gene_id string, pli double"),
        "dependency": ([("g0", -0.5)], "gene_id string, chronos double"), "tissue_expression": ([("g0", {"liver": 3.0})], "gene_id string, tpm map<string,double>"), "clinical_trial": ([(g, n, t) for g in ("g0", "g1", "g2") for n, t in ((3, "t"), (1, "a"))], "gene_id string, phase int, trait string"),
        "ligand": ([("g0", f"l{i}", "C" * (i + 1), f"n{i}", print_) for i in range(12)], "gene_id string, id string, smiles string, name string, fingerprint array<long>"), "analog": ([("g0", "a1", "CC", "an", [5, 1]), ("g9", "a2", "CC", "an", [5, 1])], "gene_id string, id string, smiles string, name string, fingerprint array<long>"),
        "drug_fingerprint": ([("g0", "drug", [5, 3])], "gene_id string, name string, fingerprint array<long>"), "vendor": ([("a1",)], "id string"), "compound_property": ([("a1", 300.0, 2.0, 1, 2, 50.0, 3.0), ("l0", 900.0, 7.0, 9, 20, 50.0, None)], "id string, mw double, logp double, hbd int, hba int, tpsa double, sa_score double"),
        "compound_alert": ([("a1", 3, 1)], "id string, tox21_hits int, herg_hits int"), "off_target": ([([5, 1],)], "fingerprint array<long>"), "region_phylo": ([("g0", "cds", 1.0), ("g0", "cds", 2.0), ("g0", "promoter", 3.0)], "gene_id string, region_type string, score double"),
    }
    for name, (data, kind) in landed.items():
        land(spark, other, name, data, kind)
    late = Run(spark, other)
    done = late.go(first="step9b") | late.go(first="step3d", until="step3d")
    names = list(whole)
    assert {k: v for k, v in done.items() if v != "done"} == {} and set(names[names.index("step9b"):]) <= set(done)
    row = lambda name, key, value: {r[key]: r for r in table(late, name).collect()}[value]
    assert row("convergent_position_annotation", "gene_id", "g2").structural_context is not None and row("candidate_score", "gene_id", "g2").structural_score > 0
    d0, d1 = row("disease_annotation", "gene_id", "g0"), row("disease_annotation", "gene_id", "g1")
    upper = {r.gene_id for r in table(late, "candidate_score_final").where("tier IN ('Validated', 'Tier1', 'Tier2')").collect()}
    assert upper, table(late, "candidate_score_final").select("gene_id", "tier", "composite_score").collect()
    assert (d0.opentargets_score, d0.lit_score, d0.lit_pmid_count) == (0.7, 0.5, 2) and (d1.known_drug_name, d1.known_drug_phase, d1.best_protective_trait) == (("d", 3, "a") if "g1" in upper else ("d", 2, None))
    assert all((r.known_drug_phase, r.best_protective_trait) == (3, "a") for r in table(late, "disease_annotation").collect() if r.gene_id in upper)
    assert table(late, "disease_annotation").where("gene_id = 'g4'").count() == 0  # not an upper gene
    t0, t1 = row("drug_target", "gene_id", "g0"), row("drug_target", "gene_id", "g1")
    assert (t0.pocket_count, t0.top_pocket_score, t0.druggability_tier, t0.tractability_sm) == (2, 0.8, "A", True) and row("drug_target", "gene_id", "g2").convergent_pocket_proximal
    assert (t1.existing_drugs, t1.p2rank_score, t1.p2rank_pocket_count) == (["drug"], 0.6, 2)
    s0 = row("safety_flag", "gene_id", "g0")
    assert (s0.hub_risk, s0.depmap_score, s0.gtex_tissue_count) == (True, 0.5, 1) and row("safety_flag", "gene_id", "g1").is_essential
    assert row("annotated_gene", "id", "g2").pathway_ids == ["R-9"] and row("phylo_conservation_score", "gene_id", "g0").cds_phylo_score == 1.5
    assert {r.gene_id for r in table(late, "dossier").collect()} == upper and {r.gene_id for r in table(late, "preclinical_readiness").collect()} == upper
    if "g0" in upper:
        compounds = {r.id: r for r in table(late, "compound").collect()}
        assert len(compounds) == 11 and compounds["a1"].is_purchasable and compounds["l0"].nearest_known_drug == "drug" and all(c.hit_tier for c in compounds.values())
        a1 = row("compound_score", "compound_id", "a1")
        assert (a1.lipinski_pass, a1.tox21_score, a1.selectivity_score, a1.zinc_purchasable) == (True, 0.25, 0.0, True) and a1.compound_tier
