"""Relational building blocks that several plans share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def dedup_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order."""
    return top_per_key(df, keys, order, 1)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first n rows of each key; a bounded rank lets tasks drop rows before the shuffle."""
    name = rank or "row_in_key"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def tasks_for(df: DataFrame, rows: int, each: int = 250_000) -> int:
    """Tasks for so many rows, four for each core at least: adaptive execution would merge them by compressed bytes."""
    return max(4 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // each))


def dealt_once(df: DataFrame, tasks: int, key: str, by_number: bool = False) -> DataFrame:
    """df dealt to tasks by one key, which may be the task's number; joins and groups by that and further keys then need no shuffle of their own."""
    df.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return df.repartitionById(tasks, key) if by_number else df.repartition(tasks, key)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of more than one row, with their counts as n."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Raise where a key has several rows: the uniqueness contract of a table."""
    if found := duplicate_keys(df, keys).first():
        raise ValueError(f"duplicate key {found.asDict()}")
    return df


def half_open_bins(df: DataFrame, scaled: Column, n: int) -> DataFrame:
    """(bin, n) for values scaled to [0, n]; bins are half-open, the last one closed."""
    return df.groupBy(F.least(F.floor(scaled), F.lit(n - 1)).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def share_of_total(df: DataFrame, key: str, digits: int) -> DataFrame:
    """Percent of all rows that each key has."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    return counts.select(key, F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), digits).alias("share"))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], start: Column, end: Column, r_start: str, r_end: str, width: int = 64) -> DataFrame:
    """Pairs of one key whose closed intervals overlap.

    Both sides are dealt to bins of `width` positions, so a key with many intervals is not compared with
    itself in full; a pair is taken in the first bin that both cover.
    """
    bins = lambda a, b: F.explode(F.sequence(F.floor(a / width).cast("long"), F.greatest(F.floor(a / width), F.floor(b / width)).cast("long")))
    x = left.withColumns({"l_start": start, "l_end": end}).withColumn("bin", bins(F.col("l_start"), F.col("l_end")))
    y = right.withColumn("bin", bins(F.col(r_start), F.col(r_end)))
    hit = x.join(y, [*keys, "bin"]).where((F.col("l_start") <= F.col(r_end)) & (F.col("l_end") >= F.col(r_start)))
    first = F.greatest(F.floor(F.col("l_start") / width), F.floor(F.col(r_start) / width))
    return hit.where(F.col("bin") == first).drop("bin", "l_start", "l_end")


def symmetric_lookup(pairs: DataFrame, distances: list[tuple[str, str, int]], default: int) -> DataFrame:
    """(a, b, distance): 0 for equal names, the table's value in either order, else the default."""
    both = distances + [(b, a, d) for a, b, d in distances]
    known = pairs.sparkSession.createDataFrame(both, "a string, b string, known long")
    return pairs.join(F.broadcast(known), ["a", "b"], "left").select("a", "b", F.when(F.col("a") == F.col("b"), 0).otherwise(F.coalesce("known", F.lit(default))).cast("long").alias("distance"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both by key; where both have one, columns of `new` that aren't null win."""
    o, n = old.alias("o"), new.alias("n")
    values = [c for c in old.columns if c not in keys]
    fresh = lambda c: F.coalesce(f"n.{c}", f"o.{c}") if c in new.columns else F.col(f"o.{c}")
    return o.join(n, keys, "full_outer").select(*keys, *[fresh(c).alias(c) for c in values])


def update_columns(old: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `old` with the non-null columns of `changes`; other keys are ignored."""
    o, n = old.alias("o"), changes.alias("n")
    fresh = lambda c: F.coalesce(f"n.{c}", f"o.{c}") if c in changes.columns else F.col(f"o.{c}")
    return o.join(n, keys, "left").select(*[F.col(c) if c in keys else fresh(c).alias(c) for c in old.columns])


def replace_keys(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Delete the keys of `new` from `old`, then insert `new`."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Append the rows of `new` whose key `old` lacks."""
    return old.unionByName(new.join(old.select(*keys).distinct(), keys, "left_anti"))


def update_from_arrays(old: DataFrame, key: str, arrays: DataFrame) -> DataFrame:
    """Update from rows of parallel arrays, named as the columns of `old`."""
    return update_columns(old, arrays.select(F.inline(F.arrays_zip(*arrays.columns))), [key])
