"""Annotation, scoring, query surface, gates and the staged run over small tables."""

import pytest
from pyspark.sql import functions as F

from helixframe import schemas
from helixframe.plans import annotate as A
from helixframe.plans import api, checks, scoring


def frame(spark, name, rows):
    fields = schemas.schema(name)
    return spark.createDataFrame([tuple(r.get(f.name) for f in fields) for r in rows], fields)


@pytest.fixture(scope="module")
def store(spark):
    genes = [{"id": f"g{i}", "human_gene_id": f"P{i}", "gene_symbol": f"SYM{i}_HUMAN", "human_protein": f"human|P{i}", "go_terms": ["GO:1"] if i % 2 else None, "pathway_ids": [f"R-{i % 2}"]} for i in range(5)]
    orthologs = [{"id": f"o{i}{s}", "gene_id": f"g{i}", "species_id": s, "protein_id": f"{s}|x", "sequence_identity_pct": 50.0} for i in range(5) for s in ("bat", "whale") if (i, s) != (4, "whale")]
    motifs = [{"id": f"m{i}", "ortholog_id": f"o{i}bat", "start_pos": 5 * i, "divergence_score": 0.5, "convergent_aa_count": i, "in_functional_domain": i == 2, "motif_direction": "gain_of_function" if i == 3 else "neutral", "human_seq": "ACDE", "animal_seq": "ACWE"} for i in range(4)]
    evolution = [{"gene_id": f"g{i}", "dnds_ratio": 2.0, "dnds_pvalue": 10.0 ** -(2 * i), "selection_model": "aBSREL", "convergence_count": i, "convergence_weight": float(i), "convergence_pval": None if i == 4 else 0.2} for i in range(5)]
    scores = [{"gene_id": f"g{i}", "trait_id": "", "composite_score": None if i == 4 else 0.2 * i, "tier": "Tier1" if i > 2 else "Tier3", "expression_score": 0.1 * i, "convergence_score": 0.5} for i in range(5)]
    disease = [{"gene_id": "g1", "opentargets_score": 0.5, "gwas_pvalue": 1e-9, "gnomad_pli": 0.9, "known_drug_phase": 4, "disease_name": "D"}]
    targets = [{"gene_id": "g1", "pocket_count": 2, "top_pocket_score": 0.7, "druggability_tier": "A", "existing_drugs": ["x", "y"]}]
    safety = [{"gene_id": "g1", "hub_risk": True, "is_essential": True, "family_size": 200, "depmap_score": 0.9, "gtex_tissue_count": 50}]
    species = [{"id": s, "lineage_group": g, "is_control": c} for s, g, c in (("bat", "Bats", False), ("whale", "Cetaceans", False), ("rat", "Rodents", True))]
    expression = [{"id": str(i), "gene_id": "g1", "geo_accession": f"G{i}", "comparison": "c", "padj": 0.01 * i} for i in range(3)]
    named = {"gene": genes, "ortholog": orthologs, "divergent_motif": motifs, "evolution_score": evolution, "candidate_score": scores, "disease_annotation": disease, "drug_target": targets, "safety_flag": safety, "species": species, "expression_result": expression}
    return api.Store({k: schemas.check_keys(frame(spark, k, v), k) for k, v in named.items()})


def ids(df):
    return [r.gene_id for r in df.collect()]


def test_candidates(store):
    assert ids(api.candidates(store)) == ["g4", "g3", "g2", "g1", "g0"]
    assert ids(api.candidates(store, tier="Tier1")) == ["g4", "g3"] and ids(api.candidates(store, limit=2, offset=1)) == ["g3", "g2"]
    assert ids(api.candidates(store, species_id="whale")) == ["g3", "g2", "g1", "g0"] and ids(api.candidates(store, pathway="GO:1")) == ["g3", "g1"] and ids(api.candidates(store, pathway="R-0")) == ["g4", "g2", "g0"]
    assert ids(api.candidates(store, in_functional_domain=True)) == ["g2"] and ids(api.candidates(store, variant_direction="gain_of_function")) == ["g3"]
    assert ids(api.candidates(store, min_score=0.4)) == ["g3", "g2"] and ids(api.candidates(store, trait_id="other")) == []
    assert api.candidates(store).first().composite_score == 0.0
    with pytest.raises(ValueError, match="limit"):
        api.candidates(store, limit=0)


def test_details_and_search(store):
    one = api.candidate_detail(store, "g1").first()
    assert len(one.orthologs) == 2 and one.motifs[0].start_pos == 5 and one.disease_annotation.opentargets_score == 0.5
    assert api.candidate_detail(store, "none").count() == 0
    assert ids(api.search(store, " sYm3 ")) == ["g3"] and api.search(store, " ").count() == 0
    assert [tuple(r) for r in api.pathways(store).collect()] == [("go_terms", "GO:1"), ("pathway_ids", "R-0"), ("pathway_ids", "R-1")]
    assert len(api.scores(store, "g1").first().evidence) == 3 and api.species(store, "rat").first().is_control


def test_export(spark, store, tmp_path):
    from helixframe.sources import sinks

    out = sinks.candidate_export(store.candidate_score, store.gene, store.disease_annotation, store.drug_target)
    row = {r.gene_id: r for r in out.collect()}["g1"]
    assert (row.composite_score, row.existing_drugs, row.opentargets_score, row.disease_score) == ("0.2000", "x;y", "0.5000", "0.0000")
    sinks.write_csv(out, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 5


def test_phase1(store):
    layers = {r.gene_id: r for r in scoring.evidence_layers(store).collect()}
    assert layers["g4"].selection == 1e-8 and layers["g4"].convergence == 4.0 and layers["g1"].convergence == pytest.approx(0.8) and layers["g3"].convergent_aa == 3.0
    rows = {r.gene_id: r for r in scoring.score_phase1(store).collect()}
    n = 5
    ranks = {"g4": (1, 1, 4.5, 1), "g0": (5, 3.5, 4.5, 5)}
    from math import erf, log, sqrt

    for gene, r in ranks.items():
        product = 1.0
        for x in r:
            product *= x / n
        assert layers[gene] is not None
        got = {x.gene_id: x.rank_p for x in scoring.rank_product_scores(scoring.evidence_layers(store)).collect()}[gene]
        assert got == pytest.approx(0.5 * (1 + erf((log(product) + 4) / 2 / sqrt(2))), abs=1e-6)
    assert rows["g4"].expression_score == pytest.approx(0.4) and rows["g0"].safety_score == 0.5 and rows["g2"].convergence_score == round(2 / 20.46, 4)


def test_phase2(store):
    rows = {r.gene_id: r for r in scoring.score_phase2(store).collect()}
    assert rows["g1"].safety_score == pytest.approx(0.0) and rows["g1"].composite_score == 0.0 and rows["g0"].safety_score == 0.5
    assert rows["g1"].disease_score == pytest.approx(0.30 * 0.5 + 0.20 * 9 / 15 + 0.15 * 0.9 + 0.20) and rows["g1"].druggability_score == pytest.approx(0.10 + 0.21 + 0.05 + 0.10)
    w, s = scoring.PHASE2_WEIGHTS, rows["g3"]
    want = (w["convergence"] * s.convergence_score + w["selection"] * s.selection_score + w["expression"] * s.expression_score) / (w["convergence"] + w["selection"] + w["expression"])
    assert s.composite_score == pytest.approx(want, abs=1e-4)
    plain = {r.gene_id: r for r in scoring.score_phase2(store, compat=False).collect()}
    assert plain["g3"].convergence_score == round(3 / 20.46, 4) != rows["g3"].convergence_score


def test_gates(store):
    orth = checks.run_gates(checks.ortholog_metrics(store.gene, store.ortholog, store.species), "step3b", checks.ORTHOLOG_GATES)
    assert {r.name: r.status for r in orth.collect()} == {"gene coverage": "PASS", "median species per gene": "FAIL", "low identity": "PASS", "missing identity": "PASS"}
    motif = checks.run_gates(checks.motif_metrics(store.gene, store.ortholog, store.divergent_motif), "step4", checks.MOTIF_GATES)
    assert {r.name: r.value for r in motif.collect()} == {"motifs": 4.0, "genes without motifs": 20.0}
    assert {r.step: r.status for r in checks.fold_status(orth.union(motif)).collect()} == {"step3b": "FAIL", "step4": "FAIL"}
    assert checks.orphans(store.divergent_motif, store.ortholog.where("id <> 'o1bat'"), "ortholog_id").count() == 1
    text = __import__("helixframe.sources.sinks", fromlist=["report"]).report("step4", checks.motif_metrics(store.gene, store.ortholog, store.divergent_motif), motif.withColumn("detail", F.col("value").cast("string"))).first()
    assert "genes_without" in text.json and "| motifs | PASS | 4.0 |" in text.markdown


ALIGNED = [
    ("og1", "human|P1", "MKTAYIAKQRQISFVKSHFSRQLEERLGLIEVQAPILSRVGDGTQDNLSGAEKAVQV"),
    ("og1", "bat|B1", "MKTAYIAKQRQISFVWWWWWRQLEERLGLIEVQAPILSRVGDGTQDNLSGAEKAVQV"),
    ("og1", "whale|W1", "MKTAYIAKQRQISFVKSHFSRQLEERLGLWWWWWPILSRVGDGTQDNLSGAEKAVQV"),
    ("og2", "human|P2", "ACDEFGHIKLMNPQRSTVWY"), ("og2", "bat|B2", "ACDEFGHIKLMNPQRSTVWY"),
]


def test_motif_scan(spark):
    aligned = spark.createDataFrame(ALIGNED, "og string, label string, seq string")
    got = {(r.label, r.start_pos): r.divergence_score for r in A.scan_motifs(aligned).collect()}
    human, bat = ALIGNED[0][2], ALIGNED[1][2]
    want = {}
    for start in range(0, len(human) - 14, 5):
        d = sum(a != b for a, b in zip(human[start : start + 15], bat[start : start + 15], strict=True)) / 15
        if d >= 0.15:
            want["bat|B1", start] = round(d, 4)
    assert {k: v for k, v in got.items() if k[0] == "bat|B1"} == want
    assert {r.og: r.motifs for r in A.motif_summary(A.scan_motifs(aligned)).collect()}.keys() == {"og1"}
    assert [r.og for r in A.identity_gate(aligned, 2, 85.0).collect()] == ["og1"]
    paralogs = spark.createDataFrame([("o", "human|1", "ACDEFGHIKL"), ("o", "bat|1", "WWWWWWWWWW"), ("o", "bat|2", "YYYYYYYYYY")], "og string, label string, seq string")
    assert [r.og for r in A.identity_gate(paralogs, 2, 85.0).collect()] == ["o"]  # sequences count, not species
    assert {r.label: r.identity for r in A.sequence_identities(aligned).collect()}["bat|B2"] == 100.0
    lineages = spark.createDataFrame([("bat", "Bats"), ("whale", "Cetaceans")], "species string, lineage string")
    assert A.lineage_gate(A.scan_motifs(aligned), lineages).count() == len(got)
    species = spark.createDataFrame([("human",), ("bat",), ("whale",)], "species string")
    matrix = {r.species: r.sequence for r in A.supermatrix(aligned, species, 0.6).collect()}
    assert len(set(map(len, matrix.values()))) == 1 and matrix["whale"].endswith("-" * 20)


def test_codons(spark):
    proteins = spark.createDataFrame([("o", "a", "MK-T"), ("o", "b", "MKAT"), ("o", "c", "M-AT"), ("o", "d", "MKAT"), ("o", "e", "MKAT")], "og string, label string, seq string")
    cds = spark.createDataFrame([("o", "a", "ATGAAAACT"), ("o", "b", "ATGAAAGCTACT"), ("o", "c", "ATGGCTACC"), ("o", "d", "ATGTAAGCTACT"), ("o", "e", "atgaaagctact")], "og string, label string, cds string")
    got = {r.label: r.codons for r in A.codon_alignments(proteins, cds).collect()}
    assert got == {"a": "ATGAAA---ACT", "b": "ATGAAAGCTACT", "c": "ATG---GCTACC"}
    assert A.codon_alignments_pass(A.codon_alignments(proteins, cds)).count() == 0


def test_regions_and_substitutions(spark):
    regions = spark.createDataFrame([("g", s, "promoter", q) for s, q in (("human", "AAAAAA"), ("b1", "CAACAA"), ("b2", "CAACAA"), ("b3", "CAACAT"), ("rat", "CAAAAA"))], "gene_id string, species_id string, region_type string, sequence string")
    species = spark.createDataFrame([("b1", False, "Bats"), ("b2", False, "Bats"), ("b3", None, "Birds"), ("rat", True, "Rodents")], "species_id string, is_control boolean, lineage string")
    assert tuple(A.regulatory_divergence(regions, species).first())[2:] == (1, 1)
    motifs = spark.createDataFrame([("m", "g", "C-DE", "CADW", "AACDEF")], "motif_id string, gene_id string, human_seq string, animal_seq string, human_protein string")
    changes = A.substitutions(motifs)
    assert [tuple(r) for r in changes.collect()] == [("m", "g", 5, "E", "W")]
    am = spark.createDataFrame([("P", 5, "W", 0.8), ("P", 5, "A", 0.1)], "accession string, position int, alt string, score double")
    accessions = spark.createDataFrame([("g", "P")], "gene_id string, accession string")
    assert A.motif_consequences(changes, accessions, am).first().consequence_score == 0.8
    lp = spark.createDataFrame([("g", 5, "E", -1.0), ("g", 5, "W", -4.0)], "gene_id string, position int, aa string, log_p double")
    assert A.motif_likelihoods(changes, lp).first().esm1v_score == -3.0


def test_gene_annotations(spark):
    variants = spark.createDataFrame([("g", "v1", "p.Ala10Val"), ("g", "v2", "p.Ala99Val"), ("g", "v3", "bad")], "gene_id string, variant_id string, hgvsp string")
    divergent = spark.createDataFrame([("g", 12, "L"), ("g", 8, "I")], "gene_id string, position int, animal_aa string")
    traits = spark.createDataFrame([("g", "t2", 1e-5), ("g", "t1", 1e-5), ("g", "t3", 1e-3)], "gene_id string, trait string, pvalue double")
    assert tuple(A.protective_variants(variants, divergent, traits).first()) == ("g", 1, "t1", 1e-5)
    positions = spark.createDataFrame([("g", 10), ("h", 10)], "gene_id string, position int")
    pockets = spark.createDataFrame([("g", 15), ("h", 16)], "gene_id string, residue int")
    assert {r.gene_id: r.proximal for r in A.pocket_proximity(positions, pockets).collect()} == {"g": True, "h": False}
    drugs = spark.createDataFrame([("g", 1, "a", "PHASE_2", None, ["E1"]), ("g", 2, "b", None, "APPROVED", ["E2"]), ("g", 3, "c", "PHASE_4", None, [])], "gene_id string, ordinal int, name string, stage string, drug_stage string, indications array<string>")
    assert tuple(A.best_known_drug(drugs).first())[1:3] == ("b", 4)
    items = spark.createDataFrame([([("High-Quality Pocket", "SM", True), ("Approved Drug", "SM", False)],), ([("Clinical Precedence", "AB", True)],)], "i array<struct<label:string,modality:string,value:boolean>>")
    assert [r[0] for r in items.select(A.tractability_tier(F.col("i"))).collect()] == ["C", "B"]
    compounds = spark.createDataFrame([("g", "a", 1.0, "vina", None, True), ("g", "b", 3.0, None, 0.5, None)], "gene_id string, id string, docking_score double, docking_method string, tanimoto_to_known double, is_purchasable boolean")
    ranked = {r.id: (r.hit_score, r.hit_tier) for r in A.rank_compounds(compounds).collect()}
    assert ranked == {"a": (1.0, "A"), "b": (0.22, "C")}
    calls = spark.createDataFrame([("g", "bat", 1, "whole liver", 1.0), ("g", "rat", 2, "Liver", 0.5), ("h", "bat", 1, "liver", 1.0)], "gene_id string, species_id string, ordinal int, tissue string, score double")
    assert A.conserved_expression(calls, ["liver"]).count() == 2


def test_selection_files(spark, tmp_path):
    from helixframe.plans import evolution as E

    results = [("a", "ok", "proxy", 1.0, 0.01), ("a", "ok", "paml_branch_site", 2.0, 0.5), ("b", "skipped", "proxy", 1.0, 0.1), ("c", None, "other", 3.0, 0.2), ("c", "ok", "paml_no_signal", 1.0, None)]
    E.write_selection(spark.createDataFrame(results, E.SELECTION_RESULT), str(tmp_path / "r"), 4)
    (tmp_path / "r" / "broken.json").write_text("{not json")
    for folder, text in (("OG7", '{"selection_model": "proxy", "dnds_ratio": 7.0}'), ("OG8", '{"og": "named", "dnds_ratio": 8.0}'), ("OG9", '{"og_id": "", "status": "meme_failed"}')):
        (tmp_path / "r" / folder).mkdir()
        (tmp_path / "r" / folder / "result.json").write_text(text)
    got = {r.og: (r.selection_model, r.dnds_ratio) for r in E.read_selection(spark, str(tmp_path / "r")).collect()}
    assert got == {"a": ("paml_branch_site", 2.0), "c": ("paml_no_signal", 1.0), "OG7": ("proxy", 7.0), "named": (None, 8.0)}
    assert api.traits(spark, str(tmp_path / "none.json"), "id string").count() == 0


def test_sequences_from_a_function(spark):
    """UDF2: a table or a function give the same guides; what a function gives is checked, and its failure names a gene."""
    genes = spark.createDataFrame([(f"g{i}",) for i in range(5)], "gene_id string").coalesce(1)
    known = {"g1": "ACGTACGTACGTACGTACGAGG", "g3": "TTTT"}
    table = spark.createDataFrame(list(known.items()), "gene_id string, sequence string")
    rows = lambda df: {r.gene_id: tuple(r)[1:] for r in df.collect()}
    assert rows(A.crispr_table(genes, lambda ids: [known.get(i) for i in ids.to_pylist()])) == rows(A.crispr_table(genes, table))
    for bad, why in ((lambda ids: 1 // 0, "ZeroDivision|division"), (lambda ids: ["A"], "5 texts or nulls expected, got 1"), (lambda ids: [1] * len(ids), "Expected")):
        with pytest.raises(Exception, match=f"(?s)from 'g0'.*({why})"):
            A.crispr_table(genes, bad).collect()


def test_table_function_of_an_orthogroup(spark):
    from helixframe.plans import evolution as E

    E.register_functions(spark)
    rows = spark.createDataFrame([("a", "human|1", "AC-DE"), ("a", "bat|1", "AW-DE"), ("a", "rat|1", "AC-D-"), ("b", "bat|1", "AAAA"), ("c", "human|1", "--"), ("c", "bat|1", "AA")], "og string, label string, seq string")
    rows.createOrReplaceTempView("aligned_rows")
    got = {r.og: (r.sequences, r.omega, r.p) for r in spark.sql("SELECT * FROM orthogroup_proxy(TABLE(aligned_rows))").collect()}
    human = A.human_sequence(rows)
    pairs = rows.where("NOT contains(label, 'human')").join(human, "og").select("og", F.col("human").alias("a"), F.col("seq").alias("b"))
    want = {r.og: (r.omega, r.p) for r in E.divergence_proxy(pairs).collect() if r.omega is not None}
    assert set(got) == set(want) == {"a"} and got["a"][0] == 3 and got["a"][1:] == pytest.approx(want["a"])
    with pytest.raises(Exception, match="a table with og"):
        spark.sql("SELECT * FROM orthogroup_proxy(TABLE(SELECT 1 AS x))").collect()


def test_guides_peptides_and_ligands(spark):
    genes = spark.createDataFrame([("a",), ("b",)], "gene_id string")
    sequences = spark.createDataFrame([("a", "ACGTACGTACGTACGTACGAGG")], "gene_id string, sequence string")
    got = {r.gene_id: r for r in A.crispr_table(genes, sequences).collect()}
    assert got["a"].crispr_sites == 1 and got["a"].offtarget_risk == "low" and got["b"].crispr_sites is None and got["b"].offtarget_risk is None
    motifs = spark.createDataFrame([("ACDEFGHIKL", ""), ("", "-")], "animal_seq string, human_seq string")
    rows = A.peptide_columns(motifs).collect()
    assert rows[0].synthesisable and rows[0].half_life_min > 0 and rows[1].half_life_min is None
    compounds = spark.createDataFrame([("g", "c", [0b1110]), ("h", "d", [1])], "gene_id string, id string, fingerprint array<long>")
    drugs = spark.createDataFrame([("g", "x", [0b0110]), ("g", "w", [0b0110]), ("g", "y", [0b1])], "gene_id string, name string, fingerprint array<long>")
    near = {r.id: (r.tanimoto_to_known, r.nearest_known_drug) for r in A.nearest_known_drug(compounds, drugs).collect()}
    assert near == {"c": (0.6667, "w"), "d": (None, None)}


def test_supermatrix_query_takes_all_parts(spark, tmp_path):
    from helixframe.plans import domain

    parts = {k: "x" * (k % 7 + 1) for k in range(1, 130) if k % 11 and k not in (80, 81, 82)}
    spark.createDataFrame(list(parts.items()), "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    groups = {}
    for k, name in parts.items():
        groups.setdefault(k // 4, {})[k % 4] = name
    groups = {g: have for g, have in groups.items() if len(have) >= 2}
    # groups join in the order of their number
    want = {str(s): "".join(groups[g].get(s, "-" * max(map(len, groups[g].values()))) for g in sorted(groups)) for s in range(4)}
    assert {r.species: r.sequence for r in domain.supermatrix(spark, str(tmp_path)).collect()} == want


def test_nearest_drug_over_blocks(spark, monkeypatch):
    import random

    monkeypatch.setattr(A, "COMPARED", (5, 7))
    rng = random.Random(3)
    prints = lambda: [rng.getrandbits(63) - (1 << 62), rng.getrandbits(9)]
    compounds = [("gh"[k % 2], f"c{k // 2}", prints()) for k in range(60)] + [("g", "short", [3]), ("g", "none", None), ("g", "zero", [0, 0]), ("i", "alone", [1, 1])]
    drugs = [("gh"[k % 2], f"d{k}", prints()) for k in range(60)] + [("g", "copy", [3, 3]), ("g", "a copy", [3, 3]), ("g", "null", None)]
    compounds.append(("g", "like", [3, 3]))
    got = A.nearest_known_drug(spark.createDataFrame(compounds, "gene_id string, id string, fingerprint array<long>"), spark.createDataFrame(drugs, "gene_id string, name string, fingerprint array<long>"))
    ones = lambda x, y, op: sum(bin(op(a, b) & (2**64 - 1)).count("1") for a, b in zip(x, y, strict=True))
    want = []
    for gene, key, x in compounds:
        t = [(-((20000 * ones(x, y, int.__and__) + ones(x, y, int.__or__)) // max(1, 2 * ones(x, y, int.__or__))) / 10000, n) for g, n, y in drugs if g == gene and x and y and len(x) == len(y)]
        want.append((key, -min(t)[0], min(t)[1]) if t else (key, None, None))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_protective_variants_broadcast_nothing(spark):
    variants = spark.createDataFrame([("g", "v", "x:p.Ala5Val")], "gene_id string, variant_id string, hgvsp string")
    divergent = spark.createDataFrame([("g", 4, "I")], "gene_id string, position int, animal_aa string")
    found = A.protective_variants(variants, divergent, spark.createDataFrame([("g", "t", 0.5)], "gene_id string, trait string, pvalue double"))
    assert [tuple(r) for r in found.collect()] == [("g", 1, "t", 0.5)]
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_positions_are_not_shuffled(spark, sf_dir):
    from helixframe.plans import relational

    # lines and domains are dealt by gene, then the results of motifs; no exchange by position
    plan = relational.position_feature(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3


def test_distinct_parts_are_dealt_by_both_keys(spark, sf_dir):
    from helixframe.plans import relational

    plan = relational.motif_per_species(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
