"""Writers: keyed tables as Parquet, ranked exports, reports, dossiers and padded alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def write_table(df: DataFrame, path: str, by: str | None = None, buckets: int = 16) -> None:
    """SNK1, SNK10: a stage's output, dealt by the hash of a key so that later joins on it read even files."""
    out = df if by is None else df.repartition(buckets, by).sortWithinPartitions(by)
    out.write.mode("overwrite").parquet(path)


def fixed4(c: Column) -> Column:
    return F.format_string("%.4f", F.coalesce(c.cast("double"), F.lit(0.0)))


def candidate_export(scores: DataFrame, genes: DataFrame, disease: DataFrame, targets: DataFrame, trait_id: str = "", tier: str | None = None, limit: int = 5000) -> DataFrame:
    """SNK6: the ranked export, text columns only. Two left joins in place of lookups for every row."""
    kept = scores.where(F.col("trait_id") == trait_id)
    kept = kept if tier is None else kept.where(F.col("tier") == tier)
    top = kept.orderBy(F.col("composite_score").desc_nulls_first(), "gene_id").limit(limit)
    numbers = ("composite_score", "convergence_score", "selection_score", "expression_score", "disease_score", "druggability_score", "safety_score", "regulatory_score")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    optional = lambda c: F.when(F.col(c).isNotNull(), F.format_string("%.4f", F.col(c))).otherwise("")
    joined = top.join(genes.withColumnRenamed("id", "gene_id"), "gene_id")
    joined = joined.join(disease.select("gene_id", "disease_name", "opentargets_score"), "gene_id", "left").join(targets.select("gene_id", "pocket_count", "top_pocket_score", "druggability_tier", "existing_drugs"), "gene_id", "left")
    return joined.select(
        "gene_id", "gene_symbol", text("human_protein").alias("human_protein"), text("tier").alias("tier"), *[fixed4(F.col(c)).alias(c) for c in numbers],
        text("disease_name").alias("disease_name"), optional("opentargets_score").alias("opentargets_score"), text("pocket_count").alias("pocket_count"), optional("top_pocket_score").alias("top_pocket_score"),
        text("druggability_tier").alias("druggability_tier"), F.coalesce(F.array_join("existing_drugs", ";"), F.lit("")).alias("existing_drugs"),
    ).orderBy(F.desc("composite_score"), "gene_id")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def report(step: str, metrics: DataFrame, checks: DataFrame) -> DataFrame:
    """SNK7: (step, json, markdown) from one row of metrics and the rows of checks."""
    lines = checks.agg(F.sort_array(F.collect_list(F.format_string("| %s | %s | %s |", F.col("name"), F.col("status"), F.col("detail")))).alias("lines"))
    one = metrics.select(F.to_json(F.struct("*")).alias("json")).crossJoin(F.broadcast(lines))
    head = F.lit(f"# {step}\n\n| check | status | detail |\n|---|---|---|\n")
    return one.select(F.lit(step).alias("step"), "json", F.concat(head, F.array_join("lines", "\n")).alias("markdown"))


def dossiers(genes: DataFrame, sections: dict[str, str]) -> DataFrame:
    """SNK8: (gene_id, markdown). sections maps a heading to a column; empty ones are left out."""
    parts = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"## {title}\n"), F.col(c).cast("string"), F.lit("\n"))) for title, c in sections.items()]
    return genes.select("gene_id", F.concat_ws("\n", F.concat(F.lit("# "), F.coalesce("gene_symbol", "gene_id")), *parts).alias("markdown"))


def fasta_lines(rows: DataFrame, name: str, sequence: str) -> DataFrame:
    """SNK9: (value) for write.text."""
    return rows.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col(sequence)).alias("value"))


def padded_msa(rows: DataFrame, group: str, name: str, sequence: str) -> DataFrame:
    """SNK9: sequences of a group padded with gaps to its longest."""
    longest = rows.groupBy(group).agg(F.max(F.length(sequence)).alias("longest"))
    return rows.join(longest, group).select(group, name, F.rpad(F.col(sequence), F.col("longest"), F.lit("-")).alias(sequence))


def phylip(rows: DataFrame, group: str, name: str, sequence: str) -> DataFrame:
    """SNK9: (group, value): one alignment as text, a header of counts and a line for each sequence. An alignment has one row per species."""
    line = F.concat(F.rpad(F.col(name), 30, " "), F.lit("  "), F.col(sequence))
    grouped = rows.groupBy(group).agg(F.sort_array(F.collect_list(line)).alias("lines"), F.count("*").alias("n"), F.max(F.length(sequence)).alias("length"))
    return grouped.select(group, F.concat(F.format_string(" %d %d\n", F.col("n"), F.col("length")), F.array_join("lines", "\n")).alias("value"))


def tissue_serotypes(tissues: Column, table: list[tuple[str, str]], top: int = 5, most: int = 3) -> Column:
    """TK5: serotypes of the most expressed tissues (a map of tissue to level), each once, null without any."""
    ranked = F.slice(F.sort_array(F.transform(F.map_entries(tissues), lambda e: F.struct(e["value"].alias("v"), e["key"].alias("k"))), asc=False), 1, top)
    match = lambda k: F.coalesce(*[F.when(F.contains(F.lower(k), F.lit(part.lower())), F.lit(s)) for part, s in table])
    found = F.slice(F.array_distinct(F.filter(F.transform(ranked, lambda r: match(r["k"])), lambda s: s.isNotNull())), 1, most)
    return F.when(F.size(found) > 0, found)


__all__ = ["candidate_export", "dossiers", "fasta_lines", "padded_msa", "phylip", "report", "tissue_serotypes", "write_csv", "write_table"]
