"""Candidate scoring: rank product over evidence layers (phase 1) and weighted composite (phase 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import scores as S
from helixframe.functions.stats import average_ranks, benjamini_hochberg, rank_product_p
from helixframe.operators.relational import upsert
from helixframe.plans.api import Store

# Models whose p value is taken as evidence of selection.
SELECTION_MODELS = ("paml_branch_site", "meme", "MEME_episodic", "busted_ph", "aBSREL", "protein_divergence_proxy")
# Weights of phase 2; the safety floor is a bound, not a score.
PHASE2_WEIGHTS = {"convergence": 0.25, "selection": 0.20, "disease": 0.22, "druggability": 0.13, "expression": 0.10, "safety": 0.00, "regulatory": 0.05, "structural": 0.05, "safety_floor": 0.20}
LAYERS = ("selection", "convergence", "convergent_aa", "functional")


def _table(store: Store, name: str, keys: DataFrame) -> DataFrame:
    """A table of the store, or an empty one with its schema."""
    from helixframe.schemas import TABLES

    return store.tables[name] if name in store.tables else keys.sparkSession.createDataFrame([], TABLES[name][0])


def convergence_signal() -> Column:
    """1 less the permutation p value, else the phylogenetic weight, else the conservation score."""
    return F.coalesce(1.0 - F.col("convergence_pval"), F.col("convergence_weight"), F.col("phylop_score"), F.lit(0.0))


def evidence_layers(store: Store, trait_id: str = "") -> DataFrame:
    """JN3, AG4: (gene_id, selection p, convergence, convergent_aa, functional), one row per gene."""
    genes = store.gene.select(F.col("id").alias("gene_id"))
    evolution = _table(store, "evolution_score", genes)
    usable = F.col("selection_model").isin(*SELECTION_MODELS) & (F.col("dnds_pvalue") > 0) & (F.col("dnds_pvalue") <= 1)
    ev = evolution.select("gene_id", F.when(usable, F.col("dnds_pvalue")).alias("selection"), convergence_signal().alias("convergence"))
    motifs, orthologs = _table(store, "divergent_motif", genes), _table(store, "ortholog", genes)
    aa = motifs.join(orthologs.select(F.col("id").alias("ortholog_id"), "gene_id"), "ortholog_id").groupBy("gene_id").agg(F.max("convergent_aa_count").cast("double").alias("convergent_aa"))
    func = _table(store, "candidate_score", genes).where((F.col("trait_id") == trait_id) & (F.col("expression_score") > 0)).select("gene_id", F.col("expression_score").alias("functional"))
    joined = genes.join(ev, "gene_id", "left").join(aa, "gene_id", "left").join(func, "gene_id", "left")
    return joined.select("gene_id", F.coalesce("selection", F.lit(1.0)).alias("selection"), *[F.coalesce(c, F.lit(0.0)).alias(c) for c in LAYERS[1:]])


def rank_product_scores(layers: DataFrame) -> DataFrame:
    """DS11: (gene_id, rank_p, q, active, tier, composite). Layers without any value above 0 are left out."""
    has = layers.agg(*[F.max((F.col(c) > 0).cast("int")).alias(c) for c in LAYERS[1:]]).first()
    used = ["selection", *[c for c in LAYERS[1:] if has[c]]]
    ranked, product = average_ranks(layers, {f"{c}_rank": (F.col(c), c != "selection") for c in used}, total="genes"), F.lit(1.0)
    for c in used:
        product = product * (F.col(f"{c}_rank") / F.col("genes"))
    active = (F.col("selection") < 0.1).cast("int")
    for c in LAYERS[1:]:
        active = active + (F.col(c) > 0).cast("int")
    ranked = ranked.select("gene_id", active.alias("active"), product.alias("rp")).withColumn("rank_p", rank_product_p(F.col("rp"), len(used)))
    q = benjamini_hochberg(ranked, "rank_p", "q")
    return q.select("gene_id", "rank_p", "q", "active", S.rank_product_tier(F.col("q"), F.col("active")).alias("tier"), F.round(1.0 - F.col("q"), 4).alias("composite_score"))


def _selection_score(test_species: list[str]) -> Column:
    c = F.col
    return S.selection(c("selection_model"), c("dnds_ratio"), c("dnds_pvalue"), c("fel_sites"), c("busted_pvalue"), c("relax_k"), c("relax_pvalue"), c("branches_under_selection"), F.array(*[F.lit(s) for s in test_species]).cast("array<string>"))


def score_phase1(store: Store, trait_id: str = "", test_species: tuple[str, ...] = ()) -> DataFrame:
    """candidate_score rows of phase 1 put over those that are there; expression scores stay."""
    ranked = rank_product_scores(evidence_layers(store, trait_id))
    evolution = _table(store, "evolution_score", ranked)
    ev = evolution.select("gene_id", S.convergence(F.col("convergence_count"), F.nullif("convergence_weight", F.lit(0.0))).alias("convergence_score"), _selection_score(list(test_species)).alias("selection_score"))
    zero = {"disease_score": 0.0, "druggability_score": 0.0, "safety_score": 0.5, "regulatory_score": 0.0}
    rows = ranked.join(ev, "gene_id", "left").select("gene_id", F.lit(trait_id).alias("trait_id"), *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("convergence_score", "selection_score")], "composite_score", "tier", *[F.lit(v).alias(k) for k, v in zero.items()])
    out = upsert(_table(store, "candidate_score", ranked), rows, ["gene_id", "trait_id"])
    return out.withColumn("expression_score", F.coalesce("expression_score", F.lit(0.0)))


def evolution_q_values(evolution: DataFrame) -> DataFrame:
    """WN6: q values of the p values of selection, to six places."""
    return benjamini_hochberg(evolution, "dnds_pvalue", "meme_qvalue").withColumn("meme_qvalue", F.round("meme_qvalue", 6))


def control_fractions(motifs: DataFrame, orthologs: DataFrame, controls: DataFrame) -> DataFrame:
    """AG18: (gene_id, control_divergence_fraction): share of control species with a motif."""
    total = controls.agg(F.count("*").alias("controls"))
    hits = orthologs.join(F.broadcast(controls.select(F.col("id").alias("species_id"))), "species_id").join(motifs.select(F.col("ortholog_id").alias("id")).distinct(), "id", "left_semi").groupBy("gene_id").agg(F.countDistinct("species_id").alias("n"))
    genes = orthologs.select("gene_id").distinct()
    return genes.join(hits, "gene_id", "left").crossJoin(F.broadcast(total)).select("gene_id", F.when(F.col("controls") > 0, F.round(F.coalesce("n", F.lit(0)) / F.col("controls"), 4)).alias("control_divergence_fraction"))


def expression_scores(scores: DataFrame, trait_id: str = "") -> DataFrame:
    """DS10: (gene_id, expression_score) of a trait as stored, 0 where it is unknown."""
    return scores.where(F.col("trait_id") == trait_id).select("gene_id", F.coalesce("expression_score", F.lit(0.0)).alias("expression_score"))


def trait_disease_ids(traits: DataFrame, trait_id: str) -> DataFrame:
    """DS13, SC4: one row with the ids of a trait's diseases, upper-case with a colon; none for an unknown trait. traits: (trait_id, disease_ids)."""
    ids = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("trait_id") == trait_id, F.col("disease_ids"))))))
    return traits.agg(F.transform(ids, S.disease_id).alias("phenotype_ids"))


def score_phase2(store: Store, weights: dict[str, float] = PHASE2_WEIGHTS, trait_id: str = "", first: float = 0.70, second: float = 0.40, phenotype_ids: tuple[str, ...] = (), test_species: tuple[str, ...] = (), compat: bool = True) -> DataFrame:
    """DS12: candidate_score rows of phase 2.

    compat keeps the scale of the original: 1 less the permutation p value is divided by the largest
    phylogenetic weight. Without it the phylogenetic weight itself is used.
    """
    genes = store.gene.select(F.col("id").alias("gene_id"))
    c = F.col
    old = _table(store, "candidate_score", genes).where(c("trait_id") == trait_id)
    tagged = lambda name: _table(store, name, genes).withColumn(f"has_{name}", F.lit(True))
    joined = genes.join(old.select("gene_id", "expression_score", "structural_score", "control_divergence_fraction"), "gene_id", "left")
    for name in ("evolution_score", "disease_annotation", "drug_target", "safety_flag"):
        joined = joined.join(tagged(name), "gene_id", "left")
    reg = _table(store, "regulatory_divergence", genes).groupBy("gene_id").agg(F.max("regulatory_score").alias("reg"), F.max(F.coalesce("lineage_count", F.lit(0))).alias("reg_lineages"))
    promoter = _table(store, "nucleotide_score", genes).where("region_type = 'promoter'").select("gene_id", "conservation_score", "regulatory_divergence_count", "regulatory_convergence_count")
    phylo = _table(store, "phylo_conservation_score", genes).select("gene_id", "promoter_phylo_score")
    joined = joined.join(reg, "gene_id", "left").join(promoter.withColumn("has_promoter", F.lit(True)), "gene_id", "left").join(phylo, "gene_id", "left")

    yes = lambda name: F.coalesce(c(f"has_{name}"), F.lit(False))
    signal = F.coalesce(1.0 - c("convergence_pval"), c("convergence_weight"), c("phylop_score")) if compat else F.coalesce("convergence_weight", "phylop_score")
    conv = S.convergence(c("convergence_count"), signal)
    fraction = c("control_divergence_fraction")
    conv = F.when(fraction > 0.5, F.round(F.greatest(F.lit(0.0), conv * (1 - 0.6 * fraction)), 4)).otherwise(conv)
    ids = F.array(*[F.lit(x) for x in phenotype_ids]).cast("array<string>")
    nucleotide = F.when(c("has_promoter"), S.nucleotide_divergence(F.coalesce("conservation_score", F.lit(0.0)), c("regulatory_divergence_count"), c("regulatory_convergence_count"), c("promoter_phylo_score"))).otherwise(0.0)
    none = F.lit(0.0)
    on = lambda key, x: x if weights.get(key, 0) > 0 else none
    sub = {
        "convergence": conv, "selection": _selection_score(list(test_species)), "expression": F.coalesce("expression_score", none),
        "disease": on("disease", S.disease(yes("disease_annotation"), c("opentargets_score"), c("gwas_pvalue"), c("gnomad_loeuf"), c("gnomad_pli"), c("known_drug_phase"), c("known_drug_indication_ids"), ids, c("protective_variant_count"), c("protective_variant_pvalue"))),
        "druggability": on("druggability", S.druggability(c("pocket_count"), c("top_pocket_score"), c("p2rank_score"), c("chembl_target_id"), c("existing_drugs"), c("druggability_tier"), c("tractability_sm"), c("tractability_ab"), c("tractability_protac"), c("convergent_pocket_proximal"))),
        "safety": S.safety(yes("safety_flag"), c("hub_risk"), c("is_essential"), c("family_size"), c("depmap_score"), c("gtex_tissue_count"), c("gtex_max_tpm"), c("phewas_hits")),
        "regulatory": on("regulatory", F.round(0.6 * S.regulatory(c("reg"), c("reg_lineages")) + 0.4 * nucleotide, 4)), "structural": on("structural", F.coalesce("structural_score", none)),
    }
    genetics = S.human_genetics(c("gwas_pvalue"), c("gnomad_pli"), c("opentargets_score"), c("protective_variant_count"), c("protective_variant_pvalue"))
    parts = joined.select("gene_id", *[v.alias(f"{k}_score") for k, v in sub.items()], F.coalesce(genetics, none).alias("genetics"))
    comp = S.composite({k: c(f"{k}_score") for k in sub}, weights)
    floor = weights.get("safety_floor", 0.0)
    scored = parts.withColumn("composite_score", F.when(c("safety_score") < floor, 0.0).otherwise(comp) if floor > 0 else comp)
    rows = scored.withColumn("tier", S.tier(c("composite_score"), c("genetics"), first, second)).withColumn("trait_id", F.lit(trait_id)).drop("genetics")
    return upsert(_table(store, "candidate_score", genes), rows, ["gene_id", "trait_id"])
