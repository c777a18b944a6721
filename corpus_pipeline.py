"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs. All but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import cut, free_name, removed, written
from helixframe.llm.line_dedup import dedup_lines
from helixframe.llm.mixing import mixed
from helixframe.llm.near_dedup import BROADCAST_IDS, near_groups
from helixframe.llm.packing import pack_documents
from helixframe.llm.quality import good_documents

#: Shingle sets at least this alike, in percent, are near-duplicates here.
NEAR_PERCENT = 80
#: From here on near_dedup numbers rows whose doc_id is not theirs alone.
OWN_IDS = 1 << 62


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the perplexity band of their language keep.

    Null and empty texts fail the base rules; a null language is one of its own; repeated rows are judged one by one.
    """
    return good_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without chunks that another one keeps; n_chars counts what is left."""
    new: dict[str, Column] = {"text": F.col("text"), "n_chars": F.when(F.col("text").isNotNull(), F.length("text").cast("long"))}
    return dedup_lines(docs).select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id that is its own, else the first by doc_id and content.

    Of rows that are alike in all columns one stays. Rows that share a doc_id and differ are documents of their own, so
    each goes only if its text is near that of one that stays. Rows without a doc_id stay, and so do texts without a word.
    """
    side = lambda ids: F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids
    ids = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"))
    repeated = cut(ids.where((F.col("n") > 1) | (F.col("doc_id") >= OWN_IDS)).select("doc_id"))
    if not repeated.limit(1).count():
        gone = cut(near_groups(docs, NEAR_PERCENT).where("NOT kept").select("doc_id"))
        return docs.join(side(gone), "doc_id", "left_anti").select(*docs.columns)
    repeated = side(repeated)
    row, key, content = (free_name(x, docs.columns) for x in ("row", "key", "content"))
    shared = docs.join(repeated, "doc_id", "left_semi").select(*docs.columns).distinct()
    shared = cut(shared.withColumn(content, F.sha2(F.to_json(F.struct(*docs.columns)), 256)).repartitionByRange("doc_id", content).sortWithinPartitions("doc_id", content).drop(content))
    alone = shared.groupBy("doc_id").agg(F.count("*").alias("n")).where((F.col("n") == 1) & (F.col("doc_id") < OWN_IDS)).select("doc_id", F.lit(True).alias("alone"))
    as_row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row)
    placed = shared.select("doc_id", as_row, F.monotonically_increasing_id().alias(key)).join(alone, "doc_id", "left").select(F.when(F.col("alone"), F.col("doc_id")).otherwise(F.col(key) + OWN_IDS).alias(key), row)
    others = docs.join(repeated, "doc_id", "left_anti").select(F.col("doc_id").cast("long").alias(key), as_row)
    rows = written(others.unionByName(placed))
    gone = cut(near_groups(rows.select(F.col(key).alias("doc_id"), F.col(f"{row}.text").alias("text")), NEAR_PERCENT).where("NOT kept").select(F.col("doc_id").alias(key)))
    return rows.join(side(gone), key, "left_anti").select(f"{row}.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in the order of the mixture: each file holds a stretch of it.

    A null source counts as the empty one; null and empty texts and repeated rows have a place each.
    """
    placed = mixed(docs).select("row", "slot", "place")
    return placed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences. A null or empty text is the end id alone; a null doc_id stays null; repeated rows are packed one by one."""
    return pack_documents(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]
# Token ids and the language model are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
        if before is not None:
            removed(before)  # what the next stage was made from
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
