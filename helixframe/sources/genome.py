"""Genomes as blocks of fixed width, and windows cut from them.

A block is keyed by (species_id, chrom, block) and holds WIDTH bases, so a contig of any length is dealt to many
tasks, and a window meets only the blocks that it touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WIDTH = 1 << 16


def read_genome(spark: SparkSession, path: str, species_id: str, width: int = WIDTH) -> DataFrame:
    """SRC12: (species_id, chrom, block, bases) of the contigs of FASTA files, line by line; the id of a header is up to its first space.

    Each split of a file numbers its own lines. What a split goes on with, a contig and a place in it, follows from one
    row per split and contig. A contig lies in one file; of several contigs with one id the last counts. Bases keep their case.
    """
    meta = F.col("_metadata")
    lines = spark.read.text(path).select(meta["file_path"].alias("file"), meta["file_block_start"].alias("split"), F.monotonically_increasing_id().alias("n"), F.trim(F.regexp_replace("value", r"\s", " ")).alias("value"))
    is_header = F.startswith("value", F.lit(">"))
    lines = lines.select("file", "split", "n", F.when(is_header, F.substring_index(F.expr("substring(value, 2)"), " ", 1)).alias("name"), F.when(is_header, "").otherwise(F.regexp_replace("value", " ", "")).alias("bases"))
    by_split = Window.partitionBy("file", "split").orderBy("n")
    runs = lines.withColumn("run", F.count("name").over(by_split))
    placed = runs.withColumn("at", F.coalesce(F.sum(F.length("bases")).over(Window.partitionBy("file", "split", "run").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    # one row for each contig in each split: run 0 goes on with the contig of the split before
    parts = runs.groupBy("file", "split", "run").agg(F.max("name").alias("name"), F.sum(F.length("bases")).alias("size"))
    parts = parts.withColumn("contig", F.count("name").over(Window.partitionBy("file").orderBy("split", "run")))
    of_contig = Window.partitionBy("file", "contig").orderBy("split", "run")
    parts = parts.withColumns({"before": F.coalesce(F.sum("size").over(of_contig.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "chrom": F.first("name", ignorenulls=True).over(of_contig)})
    last = parts.where(F.col("name").isNotNull()).groupBy(F.col("name").alias("chrom")).agg(F.max(F.struct("file", "contig")).alias("last"))
    parts = parts.join(last, "chrom").where((F.col("file") == F.col("last.file")) & (F.col("contig") == F.col("last.contig")))

    start = F.col("before") + F.col("at")
    each = placed.where("bases <> ''").join(parts.select("file", "split", "run", "chrom", "before"), ["file", "split", "run"]).select("chrom", "bases", start.alias("start"))
    pieces = each.select("chrom", "bases", "start", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("start") + F.length("bases") - 1) / width))).alias("block"))
    first = F.greatest(F.col("block") * width - F.col("start"), F.lit(0)).cast("int")
    until = F.least((F.col("block") + 1) * width - F.col("start"), F.length("bases")).cast("int")
    pieces = pieces.select("chrom", "block", F.col("start").alias("at"), F.substring(F.col("bases"), first + 1, until - first).alias("piece"))
    return pieces.groupBy("chrom", "block").agg(_stitched("piece").alias("bases")).select(F.lit(species_id).alias("species_id"), "chrom", "block", "bases")


def _stitched(piece: str):
    """Pieces in the order of the column at; equal ones of a place once."""
    return F.array_join(F.array_sort(F.collect_set(F.struct("at", F.col(piece).alias("piece"))))["piece"], "")


def blocks_of(sequences: DataFrame, width: int = WIDTH) -> DataFrame:
    """Blocks of a table (species_id, chrom, sequence), for contigs that are short enough to be rows."""
    starts = F.sequence(F.lit(0), F.floor((F.length("sequence") - 1) / width))
    rows = sequences.where("sequence <> ''").select("species_id", "chrom", "sequence", F.explode(starts).alias("block"))
    return rows.select("species_id", "chrom", "block", F.substring(F.col("sequence"), (F.col("block") * width + 1).cast("int"), F.lit(width)).alias("bases"))


def write_genome(blocks: DataFrame, path: str) -> None:
    """SRC12: blocks in the order of their keys, so that statistics of row groups prune what a reader asks for."""
    blocks.repartitionByRange("species_id", "chrom", "block").sortWithinPartitions("species_id", "chrom", "block").write.mode("overwrite").parquet(path)


def cut_windows(windows: DataFrame, blocks: DataFrame, width: int = WIDTH) -> DataFrame:
    """SRC12: windows (species_id, chrom, start, end, ...; 1-based, both ends in it) with their sequence, clipped to the contig.

    A window with nothing left goes; windows that are alike in all columns are one.
    """
    first = F.greatest(F.col("start"), F.lit(1)).cast("long")
    asked = windows.where(first <= F.col("end")).withColumn("block", F.explode(F.sequence(F.floor((first - 1) / width), F.floor((F.col("end") - 1) / width))))
    met = asked.join(blocks, ["species_id", "chrom", "block"])
    lead = F.greatest(first - 1 - F.col("block") * width, F.lit(0)).cast("int")
    until = F.least(F.col("end") - F.col("block") * width, F.length("bases")).cast("int")
    pieces = met.where(lead < until).select(*windows.columns, F.col("block").alias("at"), F.substring(F.col("bases"), lead + 1, until - lead).alias("piece"))
    return pieces.groupBy(*windows.columns).agg(_stitched("piece").alias("sequence"))


def gene_windows(located: DataFrame, upstream: int = 5000, downstream: int = 2000) -> DataFrame:
    """SRC13: (gene_id, species_id, region_type, chrom, start, end) of coding span, promoter and downstream flank, by strand."""
    plus = F.col("strand") == "+"
    window = lambda kind, a, b: F.struct(F.lit(kind).alias("region_type"), a.alias("start"), b.alias("end"))
    three = F.array(
        window("cds", F.col("start"), F.col("end")),
        window("promoter", F.when(plus, F.col("tss") - upstream).otherwise(F.col("tss") + 1), F.when(plus, F.col("tss") - 1).otherwise(F.col("tss") + upstream)),
        window("downstream", F.when(plus, F.col("end") + 1).otherwise(F.col("start") - downstream), F.when(plus, F.col("end") + downstream).otherwise(F.col("start") - 1)),
    )
    return located.select("gene_id", "species_id", "chrom", F.explode(three).alias("w")).select("gene_id", "species_id", "w.region_type", "chrom", "w.start", "w.end")


def regions(located: DataFrame, blocks: DataFrame, upstream: int = 5000, downstream: int = 2000, width: int = WIDTH) -> DataFrame:
    """SRC13: gene_windows() with their sequences."""
    return cut_windows(gene_windows(located, upstream, downstream), blocks, width)
