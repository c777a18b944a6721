"""The query surface: filters, paging, details, search and pathway lists as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators.relational import top_per_key


@dataclass
class Store:
    """The tables a query reads, by name of the table."""

    tables: dict[str, DataFrame]
    spark: SparkSession | None = None

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.__dict__["tables"][name]
        except KeyError:
            raise AttributeError(name) from None


def falsy(c: str, default) -> Column:
    """The default where a value is null, zero or empty."""
    zero = F.lit("") if isinstance(default, str) else F.lit(0)
    return F.when(F.col(c).isNull() | (F.col(c) == zero), F.lit(default)).otherwise(F.col(c))


def candidates(store: Store, tier: str | None = None, species_id: str | None = None, trait_id: str = "", pathway: str | None = None, in_functional_domain: bool | None = None, variant_direction: str | None = None, limit: int = 100, offset: int = 0, min_score: float | None = None) -> DataFrame:
    """GET /candidates (FLT1, FLT2, FLT13, JN1, JN4, TK2): ranked candidates; ties by gene."""
    if not 1 <= limit <= 1000 or offset < 0:
        raise ValueError("limit from 1 to 1000, offset from 0")
    genes = store.gene.withColumnRenamed("id", "gene_id")
    rows = store.candidate_score.where(F.col("trait_id") == trait_id).join(genes.select("gene_id", "gene_symbol", "human_protein", "go_terms", "pathway_ids"), "gene_id")
    having = lambda df, keys: df.join(keys.select("gene_id").distinct(), "gene_id", "left_semi")
    motifs = lambda: store.divergent_motif.join(store.ortholog.select(F.col("id").alias("ortholog_id"), "gene_id"), "ortholog_id")
    if species_id:
        rows = having(rows, store.ortholog.where(F.col("species_id") == species_id))
    if pathway:
        rows = rows.where(F.coalesce(F.array_contains("go_terms", pathway), F.lit(False)) | F.coalesce(F.array_contains("pathway_ids", pathway), F.lit(False)))
    if in_functional_domain:
        rows = having(rows, motifs().where("in_functional_domain"))
    if variant_direction:
        rows = having(rows, motifs().where(F.col("motif_direction") == variant_direction))
    if tier:
        rows = rows.where(F.col("tier") == tier)
    if min_score is not None:
        rows = rows.where(F.col("composite_score") >= min_score)
    page = rows.orderBy(F.col("composite_score").desc_nulls_first(), "gene_id").offset(offset).limit(limit)
    scores = [falsy(c, 0.0).alias(c) for c in ("composite_score", "convergence_score", "selection_score", "expression_score")]
    return page.select("gene_id", "gene_symbol", "human_protein", falsy("tier", "Tier3").alias("tier"), *scores, F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss").alias("updated_at"))


def candidate_detail(store: Store, gene_id: str, trait_id: str = "") -> DataFrame:
    """GET /candidates/{gene_id}: one row with nested tables; no row for an unknown gene."""
    one = store.candidate_score.where((F.col("gene_id") == gene_id) & (F.col("trait_id") == trait_id)).join(store.gene.where(F.col("id") == gene_id).withColumnRenamed("id", "gene_id"), "gene_id")
    for name in ("evolution_score", "disease_annotation", "drug_target", "gene_therapy_score", "safety_flag"):
        if name in store.tables:
            table = store.tables[name].where(F.col("gene_id") == gene_id)
            one = one.join(table.select("gene_id", F.struct("*").alias(name)), "gene_id", "left")
    orthologs = store.ortholog.where(F.col("gene_id") == gene_id)
    motifs = store.divergent_motif.join(orthologs.select(F.col("id").alias("ortholog_id"), "gene_id"), "ortholog_id")
    listed = motifs.groupBy("gene_id").agg(F.sort_array(F.collect_list(F.struct("ortholog_id", "start_pos", "divergence_score"))).alias("motifs"))
    related = orthologs.groupBy("gene_id").agg(F.sort_array(F.collect_list(F.struct("species_id", "protein_id", "sequence_identity_pct"))).alias("orthologs"))
    return one.join(related, "gene_id", "left").join(listed, "gene_id", "left")


def search(store: Store, text: str, limit: int = 50) -> DataFrame:
    """GET /research/search (FLT3)."""
    term = text.strip().lower()
    columns = ("gene_symbol", "human_gene_id", "human_protein")
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(c), F.lit(term)), F.lit(False))
    found = store.gene.where(hit if term else F.lit(False)).orderBy("id").limit(limit)
    return found.select(F.col("id").alias("gene_id"), *columns)


def pathways(store: Store, limit: int = 200, trait_id: str = "") -> DataFrame:
    """GET /research/pathways (AG22, FLT4): (kind, pathway), go_terms and pathway_ids of genes in Tier1 or Tier2, the first of each."""
    upper = store.candidate_score.where((F.col("trait_id") == trait_id) & F.col("tier").isin("Tier1", "Tier2")).select(F.col("gene_id").alias("id"))
    genes = store.gene.join(upper, "id", "left_semi")
    first = lambda kind: genes.select(F.explode(kind).alias("pathway")).distinct().orderBy("pathway").limit(limit).select(F.lit(kind).alias("kind"), "pathway")
    return first("go_terms").unionByName(first("pathway_ids"))


def traits(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """GET /research/traits (SRC3): presets of a JSON document that holds a list of objects; no rows where it is missing."""
    try:
        return spark.read.json(path, schema=fields, multiLine=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], fields)


def pathway_convergence(store: Store, top: int = 50, min_candidates: int = 2) -> DataFrame:
    """GET /research/pathway-convergence."""
    return store.pathway_convergence.where(F.col("candidate_count") >= min_candidates).orderBy(F.col("pathway_score").desc_nulls_first(), "pathway_id").limit(top)


def scores(store: Store, gene_id: str, trait_id: str = "", evidence: int = 50) -> DataFrame:
    """GET /scores/{gene_id}: scores with the first rows of expression evidence."""
    own = store.expression_result.where(F.col("gene_id") == gene_id)
    first = top_per_key(own, ["gene_id"], [F.col("padj").asc_nulls_last(), F.col("geo_accession"), F.col("comparison")], evidence)
    listed = first.groupBy("gene_id").agg(F.collect_list(F.struct("geo_accession", "comparison", "log2fc", "padj", "n_samples")).alias("evidence"))
    return store.candidate_score.where((F.col("gene_id") == gene_id) & (F.col("trait_id") == trait_id)).join(listed, "gene_id", "left")


def species(store: Store, species_id: str | None = None) -> DataFrame:
    """GET /species and /species/{id}."""
    rows = store.species if species_id is None else store.species.where(F.col("id") == species_id)
    return rows.orderBy("id")
