"""Merkle manifest of a dataset: a digest for each row, tree roots for each source and for all, and proofs.

A row's leaf is the digest of its fields. Of each source, leaves in the order of doc_id are nodes; while there are
several, every FAN consecutive ones become their digest. The sources' roots are nodes of one more tree.

Trees are walked block by block: a block holds FAN^LEVELS nodes of a tree, aligned, and is one row. A task
goes through a block in postorder: each call returns the digest of its subtree, and on the way back up
appends the siblings of that subtree to the proofs of the leaves in it. The roots of the blocks are the nodes of the
next walk, until every tree has one node: each walk leaves a 4096th of the nodes. What is above a block then
goes back down in the same way, once a block, so the proofs of leaves are never shuffled.

Leaves get their places from a range partitioning by source, doc_id and leaf with counts per range, so a
source with a third of all rows is dealt to many tasks.

Defined results: a null source is a tree of its own and comes first; a null doc_id comes first in its source;
rows with one doc_id are ordered by their leaf; repeated rows are leaves of their own; null fields count as "-",
which differs from the empty text; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.llm.common import cut, documents, small_batches

FAN = 16
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Blocks in an Arrow batch, and leaves with their proofs in one: about 6 kB each.
BLOCKS_A_BATCH, LEAVES_A_BATCH = 8, 512


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: dict[str, Column] | None = None) -> Column:
    """Of a row: each field as "-" if null, else its UTF-8 byte count, a colon, and its value. `fields` replaces columns."""

    def part(name: str) -> Column:
        value = (fields or {}).get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(*map(part, FIELDS))


def folded_root(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda d, level: digest(level["left"], d, level["right"]))


def proof_text(proof: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda level: F.concat(level["left"], level["right"])), "")


# --- one block ---------------------------------------------------------------------------------


def walk(nodes: list[str], height: int, proofs: list[list] | None = None, fan: int = FAN) -> str:
    """The digest over all nodes, at most fan^height. If given, proofs[i] gets (left, right): the siblings of what holds node i, from the lowest level up."""

    def visit(first: int, height: int) -> str:
        if height == 0:
            return nodes[first]
        span = fan ** (height - 1)
        starts = range(first, min(first + fan * span, len(nodes)), span)
        children = [visit(at, height - 1) for at in starts]
        if proofs is not None:
            for k, at in enumerate(starts):
                siblings = ("".join(children[:k]), "".join(children[k + 1 :]))
                for own in proofs[at : at + span]:
                    own.append(siblings)
        return sha256("".join(children).encode()).hexdigest()

    return visit(0, height)


def _height(total: int, fan: int, levels: int) -> int:
    """Levels to climb in a block of a tree with so many nodes: until one is left, `levels` at most."""
    return next((h for h in range(levels) if fan**h >= total), levels)


# --- walks over all blocks ---------------------------------------------------------------------

_LEVEL = pa.struct([("left", pa.string()), ("right", pa.string())])
_PROOF = "array<struct<left:string,right:string>>"


def _numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Add pos (from 0 within tree, in that order) and total. The order has to be total, but for rows that are alike."""
    parts = cut(rows.repartitionByRange("tree", *order).withColumn("part", F.spark_partition_id()))
    by_tree = Window.partitionBy("tree")
    sizes = parts.groupBy("tree", "part").agg(F.count("*").alias("size"))  # as many rows as ranges and trees
    before = sizes.withColumns({"before": F.coalesce(F.sum("size").over(by_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "total": F.sum("size").over(by_tree)}).drop("size")
    placed = parts.withColumn("pos", F.row_number().over(Window.partitionBy("part", "tree").orderBy(*order))).join(before, ["tree", "part"])
    return placed.withColumn("pos", (F.col("before") + F.col("pos") - 1).cast("long")).drop("part", "before")


def _blocks(nodes: DataFrame, size: int) -> DataFrame:
    """(tree, block, total, nodes): rows of (tree, total, pos, digest, extra), `size` to a block, in order."""
    return cut(nodes.groupBy("tree", F.floor(F.col("pos") / size).alias("block"), "total").agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "extra"))).alias("nodes")))


def _roots(blocks: DataFrame, fan: int, levels: int) -> DataFrame:
    """(tree, total, pos, digest): the roots of the blocks as nodes of the next walk."""

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [walk(digests, _height(total, fan, levels), None, fan) for total, digests in zip(b.column("total").to_pylist(), b.column("digests").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("tree"), b.column("above"), b.column("block"), pa.array(out, pa.string())], names=["tree", "total", "pos", "digest"])

    above = F.ceil(F.col("total") / fan**levels).alias("above")
    return blocks.select("tree", "block", "total", above, F.col("nodes.digest").alias("digests")).mapInArrow(roots, "tree string, total long, pos long, digest string")


def climb(nodes: DataFrame, fan: int = FAN, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each walk, leaves first, and (tree, digest): the root of each tree. nodes has (tree, total, pos, digest, extra)."""
    walks = []
    while True:
        walks.append(_blocks(nodes, fan**levels))
        above = cut(_roots(walks[-1], fan, levels))
        if (above.agg(F.max("total")).first()[0] or 1) == 1:
            return walks, above.select("tree", "digest")
        nodes = above.withColumn("extra", F.lit(None).cast("string"))


def unwind(walks: list[DataFrame], above: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """(tree, pos, digest, extra, proof) of each node of the first walk. above has (tree, proof): what is above the roots."""
    above = above.withColumn("pos", F.lit(0).cast("long"))
    for blocks in reversed(walks):
        joined = blocks.join(above.select("tree", F.col("pos").alias("block"), F.col("proof").alias("above")), ["tree", "block"])

        def proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i, (total, above) in enumerate(zip(b.column("total").to_pylist(), b.column("above").to_pylist(), strict=True)):
                    nodes = b.column("nodes").slice(i, 1).flatten()
                    digests = nodes.field("digest").to_pylist()
                    own: list[list] = [[] for _ in digests]
                    walk(digests, _height(total, fan, levels), own, fan)
                    top = [(x["left"], x["right"]) for x in above]
                    for first in range(0, len(own), LEAVES_A_BATCH):
                        part, some = nodes.slice(first, LEAVES_A_BATCH), [p + top for p in own[first : first + LEAVES_A_BATCH]]
                        flat = [level for p in some for level in p]
                        ends = [0, *accumulate(map(len, some))]
                        pairs = pa.StructArray.from_arrays([pa.array([x[k] for x in flat], pa.string()) for k in (0, 1)], fields=list(_LEVEL))
                        columns = [pa.array([b.column("tree")[i].as_py()] * len(some), pa.string()), part.field("pos"), part.field("digest"), part.field("extra"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)]
                        yield pa.RecordBatch.from_arrays(columns, names=["tree", "pos", "digest", "extra", "proof"])

        extra = blocks.schema["nodes"].dataType.elementType["extra"].dataType.simpleString()
        above = joined.mapInArrow(proofs, f"tree string, pos long, digest string, extra {extra}, proof {_PROOF}")
    return above


def manifest(docs: DataFrame, carried: dict[str, Column] | None = None, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, proof) and the carried columns, worked out from the rows: one row for each row of docs.

    proof lists (left, right) for each level from the leaf's to the root's: the siblings before and behind, concatenated.
    """
    small_batches(docs.sparkSession, BLOCKS_A_BATCH)
    extra = F.struct("doc_id", "source", *[c.alias(name) for name, c in (carried or {}).items()])
    # the null source sorts before all others, whose names have a sign in front
    leaves = docs.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"), "doc_id", leaf_digest().alias("digest"), extra.alias("extra"), F.monotonically_increasing_id().alias("row"))
    placed = _numbered(leaves, "doc_id", "digest", "row").select("tree", "total", "pos", "digest", "extra")
    walks, subroots = climb(placed, fan, levels)
    tops = _numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("extra"), "digest"), "extra")
    top_walks, root = climb(tops.select("tree", "total", "pos", "digest", "extra"), fan, levels)
    none = root.select("tree", F.array().cast(_PROOF).alias("proof"))
    sources = cut(unwind(top_walks, none, fan, levels).select(F.col("extra").alias("tree"), F.col("digest").alias("subroot"), "proof"))
    found = unwind(walks, sources.select("tree", "proof"), fan, levels)
    names = sources.select("tree", "subroot")
    # a tree has one row here; hot trees are split by Spark, as the proofs' side is the one that is large
    named = found.join(F.broadcast(names) if names.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else names, "tree")
    return named.crossJoin(F.broadcast(root.select(F.col("digest").alias("root")))).select("extra.doc_id", "extra.source", F.col("digest").alias("leaf"), "subroot", "root", "proof", *[f"extra.{name}" for name in carried or {}])


#: Up to so many sources their roots are broadcast (a name and 64 bytes each).
BROADCAST_SOURCES = 20_000


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, leaf_digest({"text": F.translate("text", upper, lower)}))
    made = manifest(docs, {"tampered": tampered}).withColumn("folded_root", folded_root(F.coalesce("tampered", "leaf"), F.col("proof")))
    return made.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {"op12_merkle_manifest": op12_merkle_manifest}


def _crc32(text: str) -> str:
    """SQL of the checksum of an ASCII string, bit by bit: -1 stands for a shift, other entries are bytes."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform({steps}, lambda x: x::BIGINT)), lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"


def _leaf_sql(text: str) -> str:
    fields = [text if f == "text" else f"{f}::VARCHAR" for f in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({x})::VARCHAR || ':' || {x}, '-')" for x in fields) + ")"


def _tree_sql(name: str, first: str, depth: int) -> str:
    """Tables {name}0 to {name}{depth} of (tree, pos, digest, several, behind, ahead), each with the nodes of one level and their siblings."""
    run = f"PARTITION BY tree, pos // {FAN} ORDER BY pos ROWS BETWEEN"
    level = f"SELECT *, count(*) OVER (PARTITION BY tree) > 1 AS several, coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS behind, coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS ahead FROM"
    up = f"(SELECT tree, pos // {FAN} AS pos, CASE WHEN bool_and(several) THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE min(digest) END AS digest FROM {{}} GROUP BY 1, 2)"
    return ", ".join(f"{name}{k} AS ({level} {first if k == 0 else up.format(f'{name}{k - 1}')})" for k in range(depth + 1))


def _climb_sql(start: str, tables: list[tuple[str, str, str]]) -> str:
    """A query with proof and folded digest carried over all levels: (table, tree, pos) of each."""
    for table, tree, pos in tables:
        start = f"SELECT x.* EXCLUDE (proof, folded), x.proof || l.behind || l.ahead AS proof, CASE WHEN l.several THEN sha256(l.behind || x.folded || l.ahead) ELSE x.folded END AS folded FROM ({start}) x JOIN {table} l ON l.tree = {tree} AND l.pos = {pos}"
    return start


_DEPTH, _TOP = 5, 3  # 16^5 rows of a source, 16^3 sources

ORACLE = {
    "op12_merkle_manifest": f"""
WITH rows AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf_sql("text")} AS leaf, {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lowered, {_crc32("doc_id::VARCHAR")} % 5 = 0 AS picked FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM rows
), {_tree_sql("l", "(SELECT tree, pos, leaf AS digest FROM leaves)", _DEPTH)}, names AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos FROM l{_DEPTH}
), {_tree_sql("s", "(SELECT '' AS tree, pos, digest FROM names)", _TOP)}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM ({_climb_sql(
    "SELECT v.doc_id, v.leaf, v.tree, v.pos, n.digest AS subroot, n.pos AS place, t.digest AS root, '' AS proof, CASE WHEN v.picked THEN v.lowered ELSE v.leaf END AS folded FROM leaves v JOIN names n USING (tree), s" + str(_TOP) + " t",
    [(f"l{k}", "x.tree", f"x.pos // {FAN ** k}") for k in range(_DEPTH)] + [(f"s{k}", "''", f"x.place // {FAN ** k}") for k in range(_TOP)],
)})
""",
}
