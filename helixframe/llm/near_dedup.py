"""Near-duplicates: b-bit MinHash, bands for candidates, links confirmed on full shingle sets.

1. Each text gives its set of distinct five-word shingles as 64-bit hashes, and 160 minima of it. Of
   each minimum the low 4 bits are kept, packed as bit planes; 12 low bits of five minima each make
   the long that is a band's key.
2. Rows with the same set are one node, named by the smallest doc_id.
3. Nodes that share a band go to the smallest and the largest node of the bucket first. That is linear
   in the nodes however large a bucket is, and joins most of a group of copies.
4. In buckets that still hold several components, nodes of different components are compared inside
   the join, once for each pair (at its first common band): by their signatures, and by a bound on
   their similarity from the shingles that no other node with company has. The bound is exact, so it
   loses no link, and it spares most comparisons in a group of copies that are too far apart.
5. Where the similarity estimated by bit counts, corrected for minima whose low bits agree by chance,
   comes near the threshold, the link is confirmed on the full sets of both texts.
6. Components come from large-star and small-star rounds over the links.

At a similarity of 0.85 a link escapes all 32 bands with probability 7e-9 (0.80: 3e-6), and the bound
on the estimate lies 4.5 standard deviations below the threshold.

Defined results: null or empty texts, and texts of white space, have no shingles and no links; fewer
than five words are one shingle; rows with one doc_id are one document; a null doc_id takes no part and
has a null component; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import cut, documents, small_batches, tasks_for

BANDS, ROWS, LANE_BITS = 32, 5, 12
MINIMA = BANDS * ROWS
SIGN_BITS = 4
WORDS = -(-MINIMA // 64)
DEVIATIONS = 4.5
#: Up to so many ids (16 MB) are broadcast to pick out the texts they name; beyond, both sides are shuffled.
BROADCAST_IDS = 2_000_000
#: Rows that a task should have at least in steps over links, and over nodes with company and their texts.
LINKS_A_TASK = 100_000
MEMBERS_A_TASK = 1_000


class _Words(dict):
    """64-bit hashes of words, kept for the most recent ones."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 50_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_WORDS = _Words()
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles. bytes.lower() folds A-Z only and bytes.split() cuts at ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        out = _mix(out * _STEP + h[i : len(words) - n + 1 + i])
    return np.unique(out)


def _permutations(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 31, MINIMA, np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, MINIMA, np.uint32)


def signature(hashes: np.ndarray, times: np.ndarray, plus: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the bands, and bit planes of the minima's low bits: SIGN_BITS longs for every 64 minima."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        moved = np.multiply.outer(times, x[at : at + 2048])
        moved += plus[:, None]
        np.minimum(low, moved.min(axis=1), out=low)
    low = (low ^ (low >> np.uint32(15))).astype(np.int64)
    lanes = low.reshape(BANDS, ROWS) & ((1 << LANE_BITS) - 1)
    keys = reduce(lambda a, i: (a << LANE_BITS) | lanes[:, i], range(ROWS), np.zeros(BANDS, np.int64))
    bits = np.zeros((WORDS * 64, SIGN_BITS), np.uint8)
    bits[:MINIMA] = low[:, None] >> np.arange(SIGN_BITS) & 1
    return keys, np.packbits(bits.reshape(WORDS, 64, SIGN_BITS).transpose(0, 2, 1), axis=2).view(">i8").astype(np.int64).ravel()


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the set (two sums over it), keys of the bands, bit planes."""
    small_batches(docs.sparkSession)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, plus = _permutations()
        for b in batches:
            sizes, sums, mixed, bands, planes = [], [], [], [], []
            for text in b.column("text").to_pylist():
                h = shingles(text)
                sizes.append(len(h))
                sums.append(h.sum().view(np.int64) if len(h) else 0)
                mixed.append(_mix(h ^ _STEP).sum().view(np.int64) if len(h) else 0)
                keys, bits = signature(h, times, plus)
                bands.append(keys)
                planes.append(bits)
            lists = lambda x, n: pa.ListArray.from_arrays(pa.array(np.arange(0, n * len(x) + 1, n, dtype=np.int32)), pa.array(np.concatenate([*x, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(np.array(sums, np.int64)), pa.array(np.array(mixed, np.int64)), lists(bands, BANDS), lists(planes, SIGN_BITS * WORDS)],
                names=["doc_id", "n_shingles", "digest_a", "digest_b", "bands", "planes"],
            )

    return docs.select("doc_id", "text").mapInArrow(sketch, "doc_id long, n_shingles long, digest_a long, digest_b long, bands array<long>, planes array<long>")


def estimated_similarity(a: Column, b: Column) -> Column:
    """Similarity from the minima whose low bits all agree; different minima do so with probability 2^-SIGN_BITS."""
    differ = F.lit(0)
    for word in range(WORDS):
        planes = (a[SIGN_BITS * word + i].bitwiseXOR(b[SIGN_BITS * word + i]) for i in range(SIGN_BITS))
        differ = differ + F.bit_count(reduce(lambda x, y: x.bitwiseOR(y), planes))
    chance = 2.0**-SIGN_BITS
    return ((F.lit(MINIMA) - differ) / F.lit(float(MINIMA)) - F.lit(chance)) / F.lit(1 - chance)


def components(links: DataFrame) -> DataFrame:
    """(node, component): each node of a link with the smallest node that it can reach.

    Large-star and small-star rounds go on until every node has one link, to a node that has none itself.
    """
    links = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    while True:
        nodes = links.groupBy("a").agg(F.count("*").alias("n"))
        counts = nodes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("links"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
        few = tasks_for(counts["links"], LINKS_A_TASK)
        links = links.coalesce(few)
        if counts["most"] <= 1 and not links.join(links.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count():
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        both = links.union(links.select("b", "a").toDF("a", "b")).coalesce(few)
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")).coalesce(few)
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").coalesce(few).distinct().coalesce(few)
        least = large.groupBy("a").agg(F.min("b").alias("m")).coalesce(few)
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = cut(small.union(least.toDF("a", "b")).coalesce(few).distinct().coalesce(few))


def confirmed(texts: DataFrame, pairs: DataFrame, percent: int, tasks: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union. texts: (node, text)."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict = {}

        def of(text: str) -> np.ndarray:
            if text not in kept:
                if len(kept) >= 64:
                    kept.pop(next(iter(kept)))
                kept[text] = shingles(text)
            return kept[text]

        for batch in batches:
            ok = []
            for text_a, text_b in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True):
                x, y = of(text_b), of(text_a)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both) > 0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    with_a = pairs.join(texts.toDF("a", "text_a"), "a").coalesce(tasks)
    return with_a.join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b").coalesce(tasks).mapInArrow(confirm, "a long, b long").distinct().coalesce(tasks)


def unshared(texts: DataFrame) -> DataFrame:
    """(digest_a, alone): how many shingles of a set no other set of texts has.

    Shingles are compared by 44 bits; where two meet by chance, `alone` comes out too small, never too large.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [h for h in map(shingles, b.column("text").to_pylist()) if len(h)]
            if sets:
                owner = np.repeat(np.array([h.sum() for h in sets]).view(np.int64), [len(h) for h in sets])
                yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array((np.concatenate(sets) >> np.uint64(20)).astype(np.int64))], names=["digest_a", "shingle"])

    rows = texts.select("text").mapInArrow(explode, "digest_a long, shingle long")
    once = rows.groupBy("shingle").agg(F.count("*").alias("n"), F.min("digest_a").alias("digest_a")).where("n = 1")
    return once.groupBy("digest_a").agg(F.count("*").alias("alone"))


def near_groups(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs."""
    share, chance = percent / 100, 2.0**-SIGN_BITS
    agree = share + (1 - share) * chance
    least = share - DEVIATIONS * math.sqrt(agree * (1 - agree) / MINIMA) / (1 - chance)
    sketched = cut(sketches(docs))
    sets = ["n_shingles", "digest_a", "digest_b"]
    nodes = cut(sketched.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*sets).agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("planes").alias("planes")))

    rows = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = rows.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("node").alias("first"), F.max("node").alias("last")).where("n > 1 AND first <> last")
    shared = cut(rows.join(buckets.drop("n"), ["band", "key"]))

    # what follows needs the nodes with company only, and their texts
    members = cut(shared.select("node").distinct())
    n_members = members.count()
    few, tasks = n_members <= BROADCAST_IDS, tasks_for(n_members, MEMBERS_A_TASK)
    shared, members = shared.coalesce(tasks), members.coalesce(tasks)
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(F.broadcast(members) if few else members, "node")
    texts = cut(texts.distinct().coalesce(tasks))
    marks = nodes.join(members, "node").join(unshared(texts), "digest_a", "left").select("node", "n_shingles", (F.col("n_shingles") - F.coalesce("alone", F.lit(0))).alias("common"), "bands", "planes")
    marks = cut(marks.where(F.col("common") * 100 >= F.col("n_shingles") * percent).coalesce(tasks))

    # two sets have at most the smaller of their common parts in common
    most = F.least("x.common", "y.common")
    alike = most * 100 >= (F.col("x.n_shingles") + F.col("y.n_shingles") - most) * percent
    alike = alike & (estimated_similarity(F.col("x.planes"), F.col("y.planes")) >= F.lit(least))

    ends = shared.select("node", F.explode(F.array("first", "last")).alias("end")).where("node <> end")
    ends = ends.select(F.least("node", "end").alias("a"), F.greatest("node", "end").alias("b")).distinct().coalesce(tasks)
    ends = ends.join(marks.alias("x"), F.col("a") == F.col("x.node")).coalesce(tasks)
    ends = cut(ends.join(marks.alias("y"), (F.col("b") == F.col("y.node")) & alike).select("a", "b").coalesce(tasks).distinct().coalesce(tasks))
    links = confirmed(texts, ends, percent, tasks)
    labels = components(links)

    labelled = shared.select("band", "key", "node").join(marks.select("node").distinct(), "node", "left_semi").join(labels, "node", "left")
    labelled = cut(labelled.withColumn("component", F.coalesce("component", "node")).coalesce(tasks))
    mixed = labelled.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("band", "key")
    open_ = labelled.join(mixed, ["band", "key"], "left_semi").coalesce(tasks).join(marks, "node").coalesce(tasks)
    x, y = open_.alias("x"), open_.alias("y")
    first = reduce(lambda a, b: a & b, ((F.col("x.band") <= i) | (F.col("x.bands")[i] != F.col("y.bands")[i]) for i in range(BANDS - 1)))
    apart = (F.col("x.band") == F.col("y.band")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component"))
    others = x.join(y, apart & alike & first).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    others = cut(others.coalesce(tasks).distinct().join(ends, ["a", "b"], "left_anti").coalesce(tasks))
    joined = labels.toDF("a", "b")
    labels = components(joined.union(confirmed(texts, others, percent, tasks)))

    named = nodes.select(*sets, "node").join(labels, "node", "left").select(*sets, F.coalesce("component", "node").alias("component_id"))
    empty = F.col("n_shingles") == 0
    out = sketched.drop("bands", "planes").join(named, sets, "left").select("doc_id", "n_shingles", F.when(empty | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir))


QUERIES = {"op3_minhash_near_dedup": op3_minhash_near_dedup}

ORACLE = {
    "op3_minhash_near_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), flat AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM flat x JOIN flat y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON l.a = s.doc_id
""",
}
