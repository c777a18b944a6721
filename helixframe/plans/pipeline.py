"""Steps as functions from tables to tables, run in order; each one's tables are published by a manifest.

A step reads the tables that the steps before it wrote, or that landed in the folder, and returns the tables that it
writes. It is done while the versions of what it read are those that are there now; a changed input makes the steps
that depend on it due again, and no others. Outputs of external tools (alignments, trees, selection tests,
structures, models) and of remote sources land in the folder beforehand.

Steps 4 to 7b write narrow tables by motif, orthogroup or gene; steps 7c and 7d put them into `divergent_motif` and
`evolution_score`, once, from which scoring reads.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from helixframe.functions import scores as S
from helixframe.functions import sequence as Q
from helixframe.functions.sequence import literal_map
from helixframe.operators.relational import dedup_first, update_columns, upsert
from helixframe.plans import annotate as A
from helixframe.plans import checks, scoring
from helixframe.plans import evolution as E
from helixframe.plans.api import Store
from helixframe.plans.manifest import Manifest
from helixframe.schemas import TABLES, conform
from helixframe.sources import genome, readers, sinks


@dataclass(frozen=True)
class Step:
    """What a step has to have, what else it looks at, and what it writes."""

    reads: tuple[str, ...]
    writes: tuple[str, ...]
    uses: tuple[str, ...]
    f: Callable[[Store], dict[str, DataFrame]]


STEPS: dict[str, Step] = {}


def step(name: str, reads: Iterable[str], writes: Iterable[str], uses: Iterable[str] = ()):
    def add(f):
        STEPS[name] = Step(tuple(reads), tuple(writes), tuple(uses), f)
        return f

    return add


def _or_empty(store: Store, name: str, schema: str | None = None) -> DataFrame:
    """A table that may be missing; without rows then."""
    return store.tables[name] if name in store.tables else store.spark.createDataFrame([], schema or TABLES[name][0])


def _gene_id(store: Store) -> DataFrame:
    return store.gene.select(F.col("id").alias("gene_id"), "gene_symbol")


def _upper(store: Store, *tiers: str) -> DataFrame:
    """Genes of some tiers, the ones that later annotation is worth."""
    return store.candidate_score.where(F.col("tier").isin(*tiers)).select("gene_id").distinct()


UPPER = ("Validated", "Tier1", "Tier2")


# --- sequences ---------------------------------------------------------------------------------


@step("step3b", ("orthogroup_member", "protein", "gene_protein"), ("ortholog",))
def orthologs(store: Store) -> dict[str, DataFrame]:
    """One protein of each species in a gene's orthogroup."""
    rows = A.load_orthologs(store.orthogroup_member, store.protein, store.gene_protein)
    return {"ortholog": conform(rows.withColumn("id", F.concat_ws("|", "gene_id", "species_id")), "ortholog")}


@step("step3c", ("ortholog", "gene", "gff_feature", "genome_block"), ("nucleotide_region",))
def nucleotide_regions(store: Store) -> dict[str, DataFrame]:
    """Coding span, promoter and downstream flank of each gene and species, cut from blocks of genome.WIDTH bases."""
    genes = store.ortholog.select("gene_id", "species_id", "protein_id").join(_gene_id(store), "gene_id")
    located = readers.gene_coordinates(genes, readers.gene_index(store.gff_feature, by=("species_id",)), by=("species_id",))
    rows = genome.regions(located, store.genome_block)
    return {"nucleotide_region": conform(rows.withColumn("id", F.concat_ws("|", "gene_id", "species_id", "region_type")), "nucleotide_region")}


@step("step3c_scores", ("nucleotide_region", "species"), ("nucleotide_score",), ("region_alignment",))
def nucleotide_scores(store: Store) -> dict[str, DataFrame]:
    """Conservation of each region over species, and divergent positions of promoters."""
    species = store.species.select(F.col("id").alias("species_id"), "is_control", F.col("lineage_group").alias("lineage"))
    alignments = _or_empty(store, "region_alignment", "gene_id string, region_type string, species_id string, percent_identity double, alignment_length int, region_length int, gap_fraction double")
    scores = A.region_scores(alignments, A.regulatory_divergence(store.nucleotide_region, species), species)
    return {"nucleotide_score": conform(scores.withColumn("id", F.concat_ws("|", "gene_id", "region_type")), "nucleotide_score")}


@step("step4", ("aligned",), ("scanned_motif", "ortholog_identity"))
def scan(store: Store) -> dict[str, DataFrame]:
    """Gate 1, identities, window scan."""
    kept = store.aligned.join(A.identity_gate(store.aligned), "og", "left_semi")
    return {"scanned_motif": A.scan_motifs(kept), "ortholog_identity": A.sequence_identities(kept)}


@step("step4_load", ("scanned_motif", "ortholog_identity", "ortholog"), ("ortholog_aligned", "motif"))
def motifs(store: Store) -> dict[str, DataFrame]:
    """Orthologs with their identity, and the most divergent motifs of those that are far enough from human."""
    label = F.concat_ws("|", "species_id", "protein_id")
    identity = store.ortholog_identity.select("label", F.col("identity").alias("sequence_identity_pct")).groupBy("label").agg(F.max("sequence_identity_pct").alias("sequence_identity_pct"))
    named = store.ortholog.select("id", label.alias("label")).join(identity, "label").select("id", "sequence_identity_pct")
    orthologs = update_columns(store.ortholog, named, ["id"])
    kept = A.persisted_motifs(store.scanned_motif, orthologs).drop("og")
    keys = orthologs.select(F.col("id").alias("ortholog_id"), "gene_id", "species_id")
    rows = kept.join(keys, "ortholog_id").withColumn("id", F.concat_ws("|", "ortholog_id", "start_pos"))
    return {"ortholog_aligned": orthologs, "motif": rows}


def _motifs(store: Store) -> DataFrame:
    """(id, ortholog_id, gene_id, species_id, start_pos, end_pos, human_seq, animal_seq): scanned motifs, else those that landed."""
    if "motif" in store.tables:
        return store.motif
    return store.divergent_motif.join(store.ortholog.select(F.col("id").alias("ortholog_id"), "gene_id", "species_id"), "ortholog_id")


@step("step4_changes", ("ortholog",), ("substitution",), ("motif", "divergent_motif"))
def changes(store: Store) -> dict[str, DataFrame]:
    """Substituted residues of each motif by their place in the gene's human protein."""
    human = dedup_first(store.ortholog.where("species_id = 'human'"), ["gene_id"], [F.col("protein_id")]).select("gene_id", F.col("protein_seq").alias("human_protein"))
    return {"substitution": A.substitutions(_motifs(store).select(F.col("id").alias("motif_id"), "gene_id", "human_seq", "animal_seq").join(human, "gene_id"))}


@step("step4b", ("substitution", "accession", "pathogenicity"), ("motif_consequence",))
def consequences(store: Store) -> dict[str, DataFrame]:
    return {"motif_consequence": A.motif_consequences(store.substitution, store.accession, store.pathogenicity)}


@step("step4b_domains", ("domain",), ("motif_domain",), ("motif", "divergent_motif", "ortholog", "domain_fallback"))
def domains(store: Store) -> dict[str, DataFrame]:
    """The domain that a motif lies in; genes without any in the first source take those of the second."""
    rows = _motifs(store).select(F.col("id").alias("motif_id"), "gene_id", "start_pos", "end_pos")
    return {"motif_domain": A.motif_domains(rows, store.domain, store.tables.get("domain_fallback", store.domain.limit(0)))}


@step("step4c", ("substitution", "log_prob"), ("motif_likelihood",))
def likelihoods(store: Store) -> dict[str, DataFrame]:
    return {"motif_likelihood": A.motif_likelihoods(store.substitution, store.log_prob)}


@step("step4d", ("substitution", "gene"), ("motif_direction",), ("motif_consequence", "motif_likelihood"))
def directions(store: Store) -> dict[str, DataFrame]:
    """Gain, loss or neutral, for motifs that both models have seen or only one."""
    seen = store.substitution.select("motif_id", "gene_id").distinct()
    seen = seen.join(_or_empty(store, "motif_consequence", "motif_id string, consequence_score double"), "motif_id", "left")
    seen = seen.join(_or_empty(store, "motif_likelihood", "motif_id string, esm1v_score double"), "motif_id", "left")
    return {"motif_direction": A.motif_directions(seen, store.gene.select(F.col("id").alias("gene_id"), "loeuf"))}


# --- evolution ---------------------------------------------------------------------------------


@step("step3d", ("region_phylo",), ("phylo_conservation_score",))
def phylo_conservation(store: Store) -> dict[str, DataFrame]:
    """Mean conservation of each kind of region, a column for each. region_phylo: (gene_id, region_type, score)."""
    of = lambda kind: F.round(F.avg(F.when(F.col("region_type") == kind, F.col("score"))), 4).alias(f"{kind}_phylo_score")
    return {"phylo_conservation_score": conform(store.region_phylo.groupBy("gene_id").agg(*map(of, ("cds", "promoter", "downstream"))), "phylo_conservation_score")}


@step("step6", ("aligned",), ("selection_proxy",))
def selection_proxy(store: Store) -> dict[str, DataFrame]:
    """Divergence from the human sequence, where no test of selection has run."""
    human = A.human_sequence(store.aligned)
    pairs = store.aligned.where(~F.contains(F.lower("label"), F.lit("human"))).join(human, "og").select("og", F.col("human").alias("a"), F.col("seq").alias("b"))
    return {"selection_proxy": A.selection_columns(E.divergence_proxy(pairs), "protein_divergence_proxy")}


ITERATIONS = 1000


@step("step7", ("ortholog", "species"), ("convergence", "convergence_p"), ("motif", "divergent_motif"))
def convergence(store: Store) -> dict[str, DataFrame]:
    """Best window and phylogenetic weight of each gene, and how often it is met when lineages are dealt anew."""
    lineage = F.try_element_at(literal_map(E.LINEAGES), F.col("species_id"))
    rows = _motifs(store)
    best = E.convergence(rows.select(F.col("gene_id").alias("gene"), F.col("start_pos").alias("start"), F.col("species_id").alias("species"), lineage.alias("lineage")))
    # a run has some twenty species
    lineages = {r.id: E.LINEAGES.get(r.id, "") for r in store.species.select("id").orderBy("id").collect()}
    return {"convergence": best, "convergence_p": E.permutation_p(best, E.shuffled_labels(store.spark, lineages, ITERATIONS))}


@step("step7b", ("ortholog", "species"), ("convergent_aa",), ("motif", "divergent_motif"))
def convergent_aa(store: Store) -> dict[str, DataFrame]:
    species = store.species.select(F.col("id").alias("species_id"), "lineage_group")
    rows = _motifs(store).join(species, "species_id")
    return {"convergent_aa": E.convergent_positions(rows.select(F.col("id").alias("motif"), F.col("gene_id").alias("gene"), F.col("start_pos").alias("start"), F.col("human_seq").alias("human"), F.col("animal_seq").alias("animal"), F.col("species_id").alias("species"), F.col("lineage_group").alias("lineage")))}


@step("step7c", ("convergent_aa",), ("divergent_motif",), ("motif", "divergent_motif", "ortholog", "motif_domain", "motif_consequence", "motif_likelihood", "motif_direction"))
def merged_motifs(store: Store) -> dict[str, DataFrame]:
    """Motifs with all that the steps since have found out about them, joined once by motif."""
    base = store.motif if "motif" in store.tables else store.divergent_motif
    found = store.convergent_aa.select(F.col("motif").alias("motif_id"), F.col("convergent_aa").alias("convergent_aa_count"))
    for name, columns in (("motif_domain", ("domain_name",)), ("motif_consequence", ("consequence_score",)), ("motif_likelihood", ("esm1v_score",)), ("motif_direction", ("motif_direction",))):
        if name in store.tables:
            found = found.join(store.tables[name].select("motif_id", *columns), "motif_id", "full_outer")
    found = found.withColumnRenamed("motif_id", "id")
    if "domain_name" in found.columns:
        found = found.withColumn("in_functional_domain", F.when(F.col("domain_name").isNotNull(), True))
    return {"divergent_motif": update_columns(conform(base, "divergent_motif"), conform(found, "divergent_motif").select(*found.columns), ["id"])}


@step("step7d", ("convergence", "convergence_p", "ortholog"), ("evolution_score",), ("evolution_score", "selection_proxy", "selection_result", "phylo_conservation_score"))
def merged_evolution(store: Store) -> dict[str, DataFrame]:
    """Selection by orthogroup, convergence and conservation of each gene, over what landed.

    A result of a test stands before the proxy; a gene in several orthogroups takes the smallest p.
    """
    rows, keys = _or_empty(store, "evolution_score"), ["gene_id"]
    og_of = store.ortholog.where(F.col("orthofinder_og").isNotNull()).select(F.col("orthofinder_og").alias("og"), "gene_id").distinct()
    for name, rank in (("selection_result", 0), ("selection_proxy", 1)):
        if name in store.tables:
            by_gene = store.tables[name].join(og_of, "og")
            best = dedup_first(by_gene, keys, [F.col("dnds_pvalue").asc_nulls_last(), F.col("og")]).select("gene_id", "selection_model", "dnds_ratio", "dnds_pvalue")
            have = rows.where(F.col("selection_model").isNotNull()).select("gene_id")
            rows = upsert(rows, best.join(have, "gene_id", "left_anti") if rank else best, keys)
    p = store.convergence_p.select(F.col("gene").alias("gene_id"), F.col("p").alias("convergence_pval"))
    found = store.convergence.select(F.col("gene").alias("gene_id"), F.col("n").cast("int").alias("convergence_count"), F.col("weight").alias("convergence_weight")).join(p, "gene_id", "left")
    rows = upsert(rows, found, keys)
    if "phylo_conservation_score" in store.tables:
        rows = A.seed_conservation(rows, store.phylo_conservation_score)
    return {"evolution_score": conform(rows, "evolution_score")}


# --- evidence and scores -----------------------------------------------------------------------

# Weights of the sources of functional evidence.
FUNCTIONAL_WEIGHTS = {"association": 0.5, "tissue": 0.3, "dependency": 0.2}


@step("step8", ("gene",), ("functional_evidence", "candidate_score"), ("candidate_score", "disease_association", "trait_disease", "tissue_level", "trait_tissue", "dependency_mean"))
def functional(store: Store) -> dict[str, DataFrame]:
    """Weighted mean of association, expression in the trait's tissues and dependency, over the sources a gene has."""
    number = "gene_id string, score double"
    # the trait's diseases and tissues are a handful
    words = lambda name, column: [r[0] for r in store.tables[name].select(column).distinct().collect()] if name in store.tables else []
    sources = {
        "association": A.association_scores(store.disease_association, words("trait_disease", "disease_id")) if "disease_association" in store.tables else None,
        "tissue": A.tissue_scores(store.tissue_level, words("trait_tissue", "tissue")) if "tissue_level" in store.tables else None,
        "dependency": A.dependency_scores(_gene_id(store), store.dependency_mean) if "dependency_mean" in store.tables else None,
    }
    rows = _gene_id(store).select("gene_id")
    for name, found in sources.items():
        found = store.spark.createDataFrame([], number) if found is None else found
        rows = rows.join(found.select("gene_id", F.col("score").alias(name)), "gene_id", "left")
    rows = rows.withColumn("expression_score", S.functional_evidence({k: F.col(k) for k in sources}, FUNCTIONAL_WEIGHTS))
    scored = rows.where("expression_score > 0").select("gene_id", F.lit("").alias("trait_id"), "expression_score")
    return {"functional_evidence": rows, "candidate_score": conform(upsert(_or_empty(store, "candidate_score"), scored, ["gene_id", "trait_id"]), "candidate_score")}


@step("step9", ("gene",), ("candidate_score",), ("candidate_score", "evolution_score", "divergent_motif", "ortholog"))
def score(store: Store) -> dict[str, DataFrame]:
    return {"candidate_score": conform(scoring.score_phase1(store), "candidate_score")}


@step("step9b", ("candidate_score", "divergent_motif", "ortholog", "structure_feature", "structure_residue", "pocket_centroid"), ("convergent_position_annotation", "candidate_score"))
def structural(store: Store) -> dict[str, DataFrame]:
    """Convergent motifs of upper genes with feature, pocket and context, and the genes' structural scores."""
    keys = store.ortholog.select(F.col("id").alias("ortholog_id"), "gene_id", "protein_seq", "species_id")
    human = dedup_first(keys.where("species_id = 'human'"), ["gene_id"], [F.col("ortholog_id")]).select("gene_id", F.col("protein_seq").alias("human_protein"))
    found = store.divergent_motif.join(keys.select("ortholog_id", "gene_id"), "ortholog_id").join(_upper(store, *UPPER), "gene_id", "left_semi").join(human, "gene_id")
    placed = found.withColumn("range", Q.protein_range(F.col("human_seq"), F.col("human_protein"))).where("range IS NOT NULL")
    rows = placed.select(F.col("id").alias("motif_id"), "gene_id", F.coalesce("convergent_aa_count", F.lit(0)).alias("convergent_aa_count"), F.col("range.start").alias("start"), F.col("range.end").alias("end"))
    scores = store.divergent_motif.select(F.col("id").alias("motif_id"), F.col("consequence_score").alias("am_score"))
    notes = A.structural_annotations(rows, store.structure_feature, store.structure_residue, store.pocket_centroid, scores).join(rows.select("motif_id", "start", "end", "convergent_aa_count"), "motif_id")
    out = notes.select(
        F.col("motif_id").alias("id"), "gene_id", F.col("motif_id").alias("divergent_motif_id"), F.col("start").alias("protein_start_pos"), F.col("end").alias("protein_end_pos"), F.col("convergent_aa_count").alias("convergent_lineage_count"),
        "am_score", "am_class", F.col("feature").alias("uniprot_feature"), F.col("description").alias("uniprot_feature_description"), "plddt_mean", "is_disordered", F.col("pocket_distance").alias("pocket_distance_angstrom"), "is_pocket_adjacent", "structural_context",
    )
    scored = A.structural_scores(notes).withColumn("trait_id", F.lit(""))
    return {"convergent_position_annotation": conform(out, "convergent_position_annotation"), "candidate_score": update_columns(store.candidate_score, scored, ["gene_id", "trait_id"])}


@step("step10b", ("candidate_score", "species", "promoter_pair"), ("regulatory_divergence",))
def regulatory(store: Store) -> dict[str, DataFrame]:
    """Promoter divergence of upper genes, per species."""
    species = store.species.select(F.col("id").alias("species_id"), F.col("lineage_group").alias("lineage"))
    rows = A.promoter_divergence(_upper(store, *UPPER), species, store.promoter_pair)
    return {"regulatory_divergence": conform(rows.withColumn("id", F.concat_ws("|", "gene_id", "species_id")), "regulatory_divergence")}


def _annotated(store: Store, name: str, landed: str) -> DataFrame:
    """A table by gene with what landed by symbol for upper genes; only columns of the table are taken."""
    table = _or_empty(store, name)
    if landed not in store.tables:
        return table
    symbols = _gene_id(store).join(_upper(store, *UPPER), "gene_id", "left_semi")
    return A.annotate_genes(table, store.tables[landed], symbols, [c for c in store.tables[landed].columns if c in table.columns and c != "gene_id"])


@step("step11", ("gene", "candidate_score"), ("disease_annotation", "drug_target", "annotated_gene"), ("disease_annotation", "drug_target", "disease_source", "target_source", "gene_source", "known_drug"))
def disease(store: Store) -> dict[str, DataFrame]:
    """Disease and target columns of upper genes from landed sources, their best known drug, and pathways of genes."""
    notes = _annotated(store, "disease_annotation", "disease_source")
    if "known_drug" in store.tables:
        best = A.best_known_drug(store.known_drug.join(_upper(store, *UPPER), "gene_id", "left_semi"))
        notes = upsert(notes, best.select("gene_id", F.col("name").alias("known_drug_name"), F.col("phase").alias("known_drug_phase"), F.col("indications").alias("known_drug_indication_ids")), ["gene_id"])
    genes = store.gene
    if "gene_source" in store.tables:
        columns = [c for c in store.gene_source.columns if c in genes.columns and c not in ("id", "gene_symbol")]
        genes = A.annotate_genes(genes.withColumnRenamed("id", "gene_id"), store.gene_source, _gene_id(store), columns).withColumnRenamed("gene_id", "id")
    return {"disease_annotation": conform(notes, "disease_annotation"), "drug_target": conform(_annotated(store, "drug_target", "target_source"), "drug_target"), "annotated_gene": conform(genes, "gene")}


@step("step11b", ("disease_annotation", "protein_variant", "substitution"), ("disease_annotation",), ("trait_association",))
def rare_variants(store: Store) -> dict[str, DataFrame]:
    """Variants close to a diverged residue that turn it into a similar one."""
    diverged = store.substitution.select("gene_id", "position", F.col("alt").alias("animal_aa"))
    traits = _or_empty(store, "trait_association", "gene_id string, trait string, pvalue double")
    return {"disease_annotation": conform(upsert(store.disease_annotation, A.protective_variants(store.protein_variant, diverged, traits), ["gene_id"]), "disease_annotation")}


@step("step11c", ("disease_annotation", "candidate_score", "abstract"), ("disease_annotation",), ("trait_term",))
def literature(store: Store) -> dict[str, DataFrame]:
    """Share and number of abstracts that speak of a gene and the trait."""
    terms = [r[0] for r in store.trait_term.select("term").distinct().collect()] if "trait_term" in store.tables else []  # a handful
    texts = store.abstract.join(_upper(store, *UPPER), "gene_id", "left_semi")
    counts = texts.groupBy("gene_id").agg(F.count("*").cast("int").alias("lit_pmid_count"))
    return {"disease_annotation": conform(upsert(store.disease_annotation, A.literature_scores(texts, terms).join(counts, "gene_id"), ["gene_id"]), "disease_annotation")}


@step("step11d", ("gene", "candidate_score"), ("pathway_convergence",), ("annotated_gene",))
def enrichment(store: Store) -> dict[str, DataFrame]:
    genes = store.tables.get("annotated_gene", store.gene)
    rows = genes.select(F.col("id").alias("gene_id"), "pathway_ids").join(store.candidate_score, "gene_id")
    genes = rows.select(F.col("gene_id").alias("gene"), F.coalesce("pathway_ids", F.array().cast("array<string>")).alias("pathways"), F.col("convergence_score").alias("convergence"), F.col("tier").isin("Tier1", "Tier2", "Validated").alias("is_candidate"))
    found = E.pathway_enrichment(genes)
    return {"pathway_convergence": conform(found.select(F.col("pathway").alias("pathway_id"), F.col("genes").cast("int").alias("candidate_count"), F.col("log_p").alias("log_pvalue"), F.col("q").alias("adjusted_pvalue"), F.col("score").alias("pathway_score")), "pathway_convergence")}


# --- targets -----------------------------------------------------------------------------------


def _pockets(pockets: DataFrame, names: dict[str, Column]) -> DataFrame:
    return pockets.groupBy("gene_id").agg(*[c.alias(k) for k, c in names.items()])


@step("step12", ("drug_target", "candidate_score", "pocket"), ("drug_target", "motif_peptide"), ("divergent_motif", "substitution", "pocket_residue", "tractability_item"))
def druggability(store: Store) -> dict[str, DataFrame]:
    """Pockets of upper genes, whether a diverged residue lies near one, tractability, and motifs as peptides."""
    upper = _upper(store, *UPPER)
    found = upper.join(_pockets(store.pocket, {"pocket_count": F.count("*").cast("int"), "top_pocket_score": F.max("score")}), "gene_id", "left")
    if {"substitution", "pocket_residue"} <= set(store.tables):
        near = A.pocket_proximity(store.substitution.select("gene_id", "position"), store.pocket_residue)
        found = found.join(near.withColumnRenamed("proximal", "convergent_pocket_proximal"), "gene_id", "left")
    if "tractability_item" in store.tables:
        items = store.tractability_item.select("gene_id", A.tractability_tier(F.col("items")).alias("druggability_tier"), S.tractability(F.col("items")).alias("t"))
        found = found.join(items.select("gene_id", "druggability_tier", *[F.col(f"t.{k}").alias(f"tractability_{k}") for k in ("sm", "ab", "protac")]), "gene_id", "left")
    peptides = A.peptide_columns(_or_empty(store, "divergent_motif")).select(F.col("id").alias("motif_id"), "half_life_min", "synthesisable")
    return {"drug_target": conform(upsert(store.drug_target, found, ["gene_id"]), "drug_target"), "motif_peptide": peptides}


@step("step12b", ("drug_target", "candidate_score", "predicted_pocket"), ("drug_target",))
def predicted_pockets(store: Store) -> dict[str, DataFrame]:
    """The first predicted pocket's probability, and how many there are."""
    rows = store.predicted_pocket.join(_upper(store, *UPPER), "gene_id", "left_semi")
    found = _pockets(rows, {"p2rank_score": F.min_by("probability", "rank"), "p2rank_pocket_count": F.count("*").cast("int")})
    return {"drug_target": conform(upsert(store.drug_target, found, ["gene_id"]), "drug_target")}


@step("step13", ("candidate_score", "protein_length", "coding_sequence"), ("gene_therapy_score",))
def gene_therapy(store: Store) -> dict[str, DataFrame]:
    """Vector size and guides of genes in the first tier."""
    genes = _upper(store, "Validated", "Tier1")
    sizes = A.aav_table(store.protein_length.join(genes, "gene_id", "left_semi"))
    return {"gene_therapy_score": conform(A.crispr_table(genes, store.coding_sequence).join(sizes, "gene_id", "left"), "gene_therapy_score")}


def _safety(store: Store, *tables: str) -> DataFrame:
    schemas = {"network_degree": "gene_id string, degree int", "constraint": "gene_id string, pli double", "dependency": "gene_id string, chronos double", "tissue_expression": "gene_id string, tpm map<string,double>"}
    return A.safety_flags(_upper(store, *UPPER), *[store.tables[n] if n in tables else store.spark.createDataFrame([], schema) for n, schema in schemas.items()])


@step("step14", ("candidate_score", "network_degree", "constraint"), ("safety_flag",))
def safety(store: Store) -> dict[str, DataFrame]:
    """Hubs and essential genes among the upper ones."""
    return {"safety_flag": conform(_safety(store, "network_degree", "constraint"), "safety_flag")}


@step("step14b", ("safety_flag", "candidate_score", "dependency", "tissue_expression"), ("safety_flag",))
def safety_expression(store: Store) -> dict[str, DataFrame]:
    """Dependency of cell lines and breadth of expression."""
    found = _safety(store, "dependency", "tissue_expression").select("gene_id", "depmap_score", "gtex_tissue_count", "gtex_max_tpm")
    return {"safety_flag": conform(update_columns(store.safety_flag, found, ["gene_id"]), "safety_flag")}


@step("step15", ("gene", "candidate_score"), ("candidate_score_final",), ("evolution_score", "disease_annotation", "drug_target", "safety_flag", "regulatory_divergence", "nucleotide_score", "phylo_conservation_score"))
def rescore(store: Store) -> dict[str, DataFrame]:
    """Phase 2 over whatever evidence is there; the scores of phase 1 stay in their own table."""
    return {"candidate_score_final": conform(scoring.score_phase2(store), "candidate_score")}


@step("step16", ("disease_annotation", "candidate_score_final", "clinical_trial"), ("disease_annotation",))
def translational(store: Store) -> dict[str, DataFrame]:
    """The larger of the phases, and the trait that was there first. clinical_trial: (gene_id, phase, trait)."""
    upper = store.candidate_score_final.where(F.col("tier").isin(*UPPER)).select("gene_id").distinct()
    trials = store.clinical_trial.join(upper, "gene_id", "left_semi").groupBy("gene_id").agg(F.max("phase").alias("phase"), F.min("trait").alias("trait"))
    old = store.disease_annotation.select("gene_id", F.col("known_drug_phase").alias("phase"), F.col("best_protective_trait").alias("trait"))
    found = A.translational_status(old, trials).select("gene_id", F.nullif("phase", F.lit(0)).alias("known_drug_phase"), F.col("trait").alias("best_protective_trait"))
    return {"disease_annotation": conform(upsert(store.disease_annotation, found, ["gene_id"]), "disease_annotation")}


@step("step17", ("candidate_score_final", "gene_therapy_score", "drug_target", "safety_flag", "disease_annotation"), ("preclinical_readiness",))
def readiness(store: Store) -> dict[str, DataFrame]:
    """Readiness of upper genes, from one struct of each table."""
    rows = store.candidate_score_final.where(F.col("tier").isin("Validated", "Tier1", "Tier2")).select("gene_id").distinct()
    for name, table in (("therapy", store.gene_therapy_score), ("target", store.drug_target), ("safety", store.safety_flag), ("disease", store.disease_annotation)):
        rows = rows.join(table.select("gene_id", F.struct("*").alias(name)), "gene_id", "left")
    parts = S.readiness_parts()
    scored = rows.select("gene_id", *[v.alias(k) for k, v in parts.items()])
    columns = [F.col(k) for k in parts]
    scored = scored.withColumn("overall_readiness_score", S.readiness_overall(*columns))
    out = scored.withColumn("readiness_tier", S.readiness_tier(F.col("overall_readiness_score"))).withColumn("notes", S.readiness_notes(*columns))
    return {"preclinical_readiness": conform(out, "preclinical_readiness")}


@step("step18", ("candidate_score_final", "gene"), ("dossier",), ("disease_annotation", "drug_target", "safety_flag", "gene_therapy_score", "preclinical_readiness", "divergent_motif", "ortholog"))
def dossier(store: Store) -> dict[str, DataFrame]:
    """A Markdown text for each upper gene, with a section for each table that has something on it."""
    final = store.candidate_score_final.where(F.col("tier").isin(*UPPER))
    rows = store.gene.select(F.col("id").alias("gene_id"), "gene_symbol").join(final.select("gene_id", F.struct("tier", "composite_score", "convergence_score", "selection_score", "safety_score").alias("scores")), "gene_id")
    sections = {"Scores": "scores"}
    for title, name in (("Disease", "disease_annotation"), ("Druggability", "drug_target"), ("Gene therapy", "gene_therapy_score"), ("Safety", "safety_flag"), ("Readiness", "preclinical_readiness")):
        if name in store.tables:
            fields = [c for c in store.tables[name].columns if c not in ("gene_id", "updated_at")]
            rows = rows.join(store.tables[name].select("gene_id", F.struct(*fields).alias(name)), "gene_id", "left")
            sections[title] = name
    if {"divergent_motif", "ortholog"} <= set(store.tables):
        motifs = store.divergent_motif.join(store.ortholog.select(F.col("id").alias("ortholog_id"), "gene_id"), "ortholog_id")
        rows = A.gene_context(rows, motifs.join(rows.select("gene_id"), "gene_id", "left_semi").select("gene_id", "start_pos", "divergence_score"))
        sections["Motifs"] = "motifs"
    texts = {title: F.to_json(c) for title, c in sections.items()}
    return {"dossier": sinks.dossiers(rows.withColumns({c: texts[t] for t, c in sections.items()}), sections)}


# --- compounds ---------------------------------------------------------------------------------


@step("step19", ("candidate_score_final", "drug_target", "ligand"), ("compound",))
def screening(store: Store) -> dict[str, DataFrame]:
    """The ten best ligands of each upper gene by estimated docking. ligand: (gene_id, id, smiles, name, fingerprint)."""
    upper = store.candidate_score_final.where(F.col("tier").isin(*UPPER)).select("gene_id").distinct()
    rows = store.ligand.join(upper, "gene_id", "left_semi").join(store.drug_target.select("gene_id", F.coalesce("top_pocket_score", F.lit(0.0)).alias("pocket_score")), "gene_id")
    best = A.screened(rows).withColumns({"docking_method": F.lit("estimated"), "source": F.lit("screen")})
    return {"compound": conform(best, "compound")}


@step("step20", ("compound", "analog"), ("compound", "compound_print"), ("ligand", "drug_fingerprint"))
def ligands(store: Store) -> dict[str, DataFrame]:
    """Analogs of known binders put behind the screened ligands, and each compound's nearest known drug."""
    genes = store.compound.select("gene_id").distinct()
    analogs = store.analog.join(genes, "gene_id", "left_semi").join(store.compound.select("id"), "id", "left_anti").withColumn("source", F.lit("analog"))
    prints = store.analog.select("id", "fingerprint")
    if "ligand" in store.tables:
        prints = prints.unionByName(store.ligand.select("id", "fingerprint"))
    rows = store.compound.unionByName(conform(dedup_first(analogs, ["id"], [F.col("gene_id")]), "compound"))
    prints = dedup_first(prints, ["id"], [F.col("fingerprint")]).join(rows.select("id", "gene_id"), "id")
    if "drug_fingerprint" in store.tables:
        rows = update_columns(rows, A.nearest_known_drug(prints, store.drug_fingerprint), ["id"])
    return {"compound": rows, "compound_print": prints}


@step("step21", ("compound",), ("compound",), ("vendor",))
def hits(store: Store) -> dict[str, DataFrame]:
    """Hit scores and tiers. vendor: (id) of compounds that can be bought."""
    rows = store.compound
    if "vendor" in store.tables:
        rows = update_columns(rows, store.vendor.select("id").distinct().withColumn("is_purchasable", F.lit(True)), ["id"])
    return {"compound": conform(A.rank_compounds(rows), "compound")}


def _scored(store: Store, found: DataFrame) -> dict[str, DataFrame]:
    return {"compound_score": conform(upsert(_or_empty(store, "compound_score"), found, ["compound_id"]), "compound_score")}


@step("step22", ("compound", "compound_property"), ("compound_score",), ("compound_score",))
def admet(store: Store) -> dict[str, DataFrame]:
    """Descriptors, and whether at most one of Lipinski's rules is broken. compound_property: (id, mw, logp, hbd, hba, tpsa, ...)."""
    c = F.col
    broken = sum((F.coalesce(x, F.lit(False)).cast("int") for x in (c("mw") > 500, c("logp") > 5, c("hbd") > 5, c("hba") > 10)), F.lit(0))
    rows = store.compound_property.join(store.compound.select("id"), "id", "left_semi").withColumn("lipinski_pass", broken <= 1)
    taken = [x for x in ("mw", "logp", "hbd", "hba", "tpsa", "lipinski_pass", "bbb_permeable", "cyp3a4_risk", "sa_score") if x in rows.columns]
    return _scored(store, rows.select(F.col("id").alias("compound_id"), *taken))


#: Alerts of the toxicity panel.
TOX_ALERTS = 12


@step("step23", ("compound", "compound_score", "compound_alert"), ("compound_score",))
def toxicity(store: Store) -> dict[str, DataFrame]:
    """Scores from counts of matched alerts. compound_alert: (id, tox21_hits, herg_hits)."""
    return _scored(store, A.alert_scores(store.compound_alert.join(store.compound.select("id"), "id", "left_semi"), TOX_ALERTS).withColumnRenamed("id", "compound_id"))


@step("step24", ("compound_print", "compound_score", "off_target"), ("compound_score",))
def selective(store: Store) -> dict[str, DataFrame]:
    """Similarity to a panel of ligands of other targets. off_target: (fingerprint), a few dozen rows."""
    return _scored(store, A.selectivity(store.compound_print, store.off_target).withColumnRenamed("id", "compound_id"))


@step("step25", ("compound", "compound_score"), ("compound_score",))
def synthesizability(store: Store) -> dict[str, DataFrame]:
    """Accessibility, purchasability and the overall score and tier."""
    bought = store.compound.select(F.col("id").alias("compound_id"), F.coalesce("is_purchasable", F.lit(False)).alias("zinc_purchasable"))
    overall = A.compound_scores(store.compound.select("id", "hit_score"), store.compound_score).where(F.col("compound_id").isNotNull())
    return _scored(store, overall.join(bought, "compound_id", "left"))


# --- runs --------------------------------------------------------------------------------------


def metric_columns(df: DataFrame, table: str) -> list[Column]:
    """What is counted of a table while it is written: rows, nulls of each column, and the rules' own metrics."""
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in df.columns]
    return [F.count(F.lit(1)).alias("rows"), *nulls, *[F.coalesce(m(), F.lit(0)).alias(k) for k, m in checks.OBSERVED.get(table, {}).items()]]


@dataclass
class Run:
    """Steps over a folder: landed tables as Parquet folders, written ones as the manifest names them."""

    spark: SparkSession
    folder: str
    done: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        self.manifest = Manifest(self.spark, self.folder)

    def version(self, table: str, state: dict, before: str | None = None) -> str | None:
        """What a step would read: the path that the last step before it wrote, else the fingerprint of what landed."""
        names = list(STEPS)
        for name in reversed(names[: names.index(before)] if before else names):
            if table in state.get(name, {}).get("wrote", {}):
                return state[name]["wrote"][table]
        return self.manifest.landed(table)

    def store(self, names: Iterable[str], before: str | None = None, state: dict | None = None) -> Store:
        state, found = self.manifest.state() if state is None else state, {}
        for n in names:
            if version := self.version(n, state, before):
                found[n] = self.manifest.table(version if version.startswith(f"{Manifest.TABLES}/") else n)
        return Store(found, self.spark)

    def due(self, name: str, state: dict) -> tuple[str, dict[str, str | None]]:
        """(what is to be done with a step, the versions that it reads)."""
        it = STEPS[name]
        read = {t: self.version(t, state, name) for t in dict.fromkeys((*it.reads, *it.uses))}
        if name in state:
            return ("skipped" if state[name]["read"] == read else "due"), read
        if all(self.manifest.landed(t) and t not in read for t in it.writes):
            return "skipped", read  # the tables came from outside
        missing = [t for t in it.reads if read[t] is None]
        return (f"lacks {', '.join(missing)}" if missing else "due"), read

    def go(self, first: str | None = None, until: str | None = None, force: bool = False, stopped: Callable[[], bool] = lambda: False, on_step: Callable[[str, str], None] = lambda name, status: None) -> dict[str, str]:
        """Run steps in order between two names; each is done, skipped as nothing that it reads has changed, or lacks what it reads."""
        names = list(STEPS)
        for name in names[names.index(first) if first else 0 : names.index(until) + 1 if until else None]:
            if stopped():
                self.done[name] = "stopped"
                on_step(name, "stopped")
                continue
            state = self.manifest.state()
            what, read = self.due(name, state)
            if what == "due" or force and what == "skipped":
                on_step(name, "running")
                self._do(name, state, read)
                what = "done"
            self.done[name] = what
            on_step(name, what)
        return self.done

    def _do(self, name: str, state: dict, read: dict[str, str | None]) -> None:
        wrote, observed = {}, {}
        try:
            for table, df in STEPS[name].f(self.store(read, name, state)).items():
                path, observed[table] = self.manifest.aside(table), Observation()
                wrote[table] = path
                df.observe(observed[table], *metric_columns(df, table)).write.parquet(f"{self.folder}/{path}")
        except BaseException:
            for path in wrote.values():
                self.manifest.folder.delete(path)
            raise
        self.manifest.publish(name, read, wrote, {t: {k: v for k, v in o.get.items()} for t, o in observed.items()})

    def metrics(self) -> DataFrame:
        """(step, table, metric, value) of everything written, as it was counted while writing."""
        rows = [(s, t, k, float(v)) for s, entry in self.manifest.state().items() for t, ms in entry["metrics"].items() for k, v in ms.items() if v is not None]
        return self.spark.createDataFrame(rows, "step string, table string, metric string, value double")

    def report(self) -> DataFrame:
        """DS36, SNK7: the verdicts of all rules over the newest tables. What was counted while they were written is not counted again."""
        state = self.manifest.state()
        names = {*checks.OBSERVED, *checks.GATHERED, "gene", "ortholog", "species", "nucleotide_region", "evolution_score"}
        last = {t: entry["metrics"][t] for name in STEPS if (entry := state.get(name)) for t in entry["wrote"]}
        known = {t: {k: v for k, v in last[t].items() if k == "rows" or k in checks.OBSERVED.get(t, {})} for t in names & set(last)}
        return checks.quality_report(self.store(names).tables, known)

    def step_reports(self) -> DataFrame:
        """SNK7: (step, json, markdown) of each step that has rules."""
        rows, metrics = self.report().where("name <> 'all rules'"), self.metrics()
        table = lambda step: metrics.where(F.col("step") == step).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.concat_ws(".", "table", "metric").alias("k"), "value")))).alias("metrics"))
        parts = [sinks.report(s, table(s), rows.where(F.col("step") == s).withColumn("detail", F.coalesce(F.col("value").cast("string"), F.lit("no value")))) for s in dict.fromkeys(r.step for r in checks.RULES)]
        return reduce(DataFrame.unionByName, parts)
