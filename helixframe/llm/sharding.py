"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has `virtual` points on a ring of 64-bit hashes; a row's home is the shard of the first point
clockwise from the hash of its doc_id. A shard takes rows only up to its bound, and what overflows goes on
clockwise to the next shard with room. With the bounds used here, counts that differ by one at most, the
balance is exact, and most rows still keep their home when a shard is added.

Only the number of rows of each arc between two points leaves the executors: shards x virtual numbers,
whatever the size of the table. From them the driver works out which stretch of an arc's rows, in hash
order, goes where, and from which slot on; rows take their places by their rank in the arc.

Defined results: a null text has size 8; rows with a null doc_id share one place on the ring and fill
shards clockwise from there; repeated rows are placed one by one; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.llm.common import cut, documents, text_or_empty

SHARDS = 24
VIRTUAL = 256


def ring(shards: int, virtual: int = VIRTUAL) -> tuple[np.ndarray, np.ndarray]:
    """Points in order, and the shard of each. A shard's points don't depend on how many shards there are."""
    import xxhash

    points = sorted((xxhash.xxh64_intdigest(f"{s}:{v}"), s) for s in range(shards) for v in range(virtual))
    return np.array([p for p, _ in points], np.uint64), np.array([s for _, s in points])


def bounds(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def stretches(arcs: dict[int, int], owner: np.ndarray, most: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, from rank, to rank, shard, first slot). arcs: rows of each arc; owner: shard of the point that ends it."""
    left, slot = list(most), [0] * len(most)
    out: list[tuple[int, int, int, int, int]] = []

    def give(arc: int, start: int, n: int, shard: int) -> None:
        out.append((arc, start, start + n, shard, slot[shard]))
        left[shard] -= n
        slot[shard] += n

    over = []
    for arc in sorted(arcs):  # homes first
        shard = int(owner[arc])
        if n := min(arcs[arc], left[shard]):
            give(arc, 0, n, shard)
        if n < arcs[arc]:
            over.append((arc, n))
    points: dict[int, list[int]] = defaultdict(list)
    for at, shard in enumerate(owner.tolist()):
        points[shard].append(at)
    for arc, start in over:  # then clockwise, from point to point
        while start < arcs[arc]:
            ahead = lambda s: (p[i] if (i := bisect_left(p := points[s], arc)) < len(p) else p[0] + len(owner))
            shard = min((s for s in range(len(left)) if left[s]), key=ahead)
            n = min(arcs[arc] - start, left[shard])
            give(arc, start, n, shard)
            start += n
    return out


def assign_shards(docs: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law)."""
    points, owner = ring(shards, virtual)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column("h").to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array((np.searchsorted(points, h) % len(points)).astype(np.int32))], names=[*b.schema.names, "arc"])

    text = F.encode(text_or_empty(), "UTF-8")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64("doc_id").alias("h"))
    placed = cut(rows.mapInArrow(place, "doc_id long, size long, text_crc32 long, h long, arc int"))
    arcs = {r["arc"]: r["count"] for r in placed.groupBy("arc").count().collect()}  # shards x virtual rows at most
    table = stretches(arcs, owner, bounds(sum(arcs.values()), shards))
    pieces = docs.sparkSession.createDataFrame(table, "arc int, start long, stop long, shard int, first long").groupBy("arc").agg(F.collect_list(F.struct("start", "stop", "shard", "first")).alias("pieces"))
    ranked = placed.withColumn("rank", F.row_number().over(Window.partitionBy("arc").orderBy("h", "doc_id", "text_crc32", "size")).cast("long") - 1)
    at = F.filter("pieces", lambda x: (x["start"] <= F.col("rank")) & (F.col("rank") < x["stop"]))[0]
    found = ranked.join(F.broadcast(pieces), "arc").withColumn("at", at)  # a row for each arc
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("at.shard").alias("shard"), (F.col("at.first") + F.col("rank") - F.col("at.start")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op7_sharding_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(documents(spark, sf_dir))


QUERIES = {"op7_sharding_ring": op7_sharding_ring}
