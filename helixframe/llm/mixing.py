"""Mixing sources to target weights: Pfair windows, served earliest deadline first; DataFrame functions only.

Every source has an integer quota of the slots of a period, its target weight. Block j of a source with
quota q in a period of p slots is released at slot floor(j p / q) and due by slot ceil((j + 1) p / q); each
slot takes, of the released blocks, the one due first. Since the quotas fill the period, every block meets
its window, so after any number of slots a source is less than one block from its target.

Sources of equal quota have equal windows, so they form a class that serves its sources in turn; a period of
p slots has at most sqrt(2 p) classes. The schedule of one period is worked out over classes, a few hundred
numbers however many sources there are, and handed on to sources by their place in the class. A period
has at least a slot for each source, so the schedule takes about (sources)^1.5 steps: for 100,000 sources
a minute of one task. The period repeats, so its schedule places every block of any number of rows. Rows take their places within a source in the order of a hash of doc_id, a shuffle; the
ranks come from ranges of that hash of bounded size, so a source with a third of all rows is dealt to many
tasks. When a source runs out its slots stay empty and the others go on: every row has exactly one place.

Defined results: a null source counts as the empty one; rows with a null doc_id come first in their source;
repeated rows take one place each; an empty table gives an empty table; all other columns are kept by
mixed(), whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.llm.common import cut, documents

BLOCK = 8
PERIOD = 1000
ROWS_PER_RANGE = 4096
#: Up to so many sources their table is broadcast (about 100 bytes a row and a long for each slot).
BROADCAST_SOURCES = 5000
#: Beyond that, rows meet their source in so many parts, lest one with a third of all rows meets it in one task.
PARTS = 64
#: Slots that the schedule makes at a time.
STRETCH = 256


def _hash(name: str) -> Column:
    """Below 2^32; 0 for null."""
    return F.coalesce(F.conv(F.substring(F.md5(F.col(name).cast("string")), 1, 8), 16, 10).cast("long"), F.lit(0))


def _earliest_deadlines() -> Column:
    """(class, served) by slot of one period, from the columns quotas and sizes (of the classes) and period.

    served counts what the class had before; its block of number served div size is due first in the class.
    """
    q, m, p = F.col("quotas"), F.col("sizes"), F.col("period")
    number = lambda n, i: F.floor(n / m[i]).cast("long")

    def serve(state: Column, t: Column) -> Column:
        done = state["done"]
        due = lambda i: -F.floor(-((number(done[i], i) + 1) * p) / q[i]).cast("long")
        open_ = F.filter(F.sequence(F.lit(0), F.size(q) - 1), lambda i: number(done[i], i) * p < (t + 1) * q[i])
        first = F.array_min(F.transform(open_, lambda i: F.struct(due(i).alias("due"), i.alias("i"))))["i"]
        slot = F.struct(first.alias("class"), F.get(done, first).alias("served"))
        return F.struct(F.transform(done, lambda n, i: n + F.when(i == first, 1).otherwise(0)).alias("done"), F.concat(state["slots"], F.array(slot)).alias("slots"))

    none = F.array().cast("array<struct<class:int,served:long>>")
    start = F.struct(F.transform(q, lambda _: F.lit(0).cast("long")).alias("done"), none.alias("slots"))

    def stretch(state: Column, first: Column) -> Column:
        """The slots from `first` on, apart from those before: so long arrays are copied once a stretch only."""
        slots = F.sequence(first, F.least(first + STRETCH, p) - 1)
        own = F.aggregate(slots, F.struct(state["done"].alias("done"), none.alias("slots")), serve)
        return F.transform(F.array(own), lambda x: F.struct(x["done"].alias("done"), F.concat(state["slots"], x["slots"]).alias("slots")))[0]

    return F.aggregate(F.sequence(F.lit(0).cast("long"), p - 1, F.lit(STRETCH).cast("long")), start, stretch, lambda s: s["slots"])


def target_quotas(docs: DataFrame, weights: dict[str, int] | None = None, period: int = PERIOD) -> DataFrame:
    """(source, n, quota): the given weights, or shares of the square roots of the sources' rows, at least 1 of about `period`."""
    counts = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("n"))
    if weights:
        given = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        return counts.withColumn("quota", F.coalesce(given[F.col("source")], F.lit(1)).cast("long"))
    roots = cut(counts)
    total = roots.agg(F.sum(F.sqrt("n")).alias("roots"))
    return roots.crossJoin(F.broadcast(total)).select("source", "n", F.greatest(F.lit(1), F.floor(F.lit(period) * F.sqrt("n") / F.col("roots") + 0.5)).cast("long").alias("quota"))


def source_table(quotas: DataFrame) -> DataFrame:
    """(source, n, quota, period, slots): slots lists the source's slots in a period. One row per source."""
    # sources by quota, hash and name; the places come from counts of hash ranges, so a large class is no group of one task
    quotas = quotas.withColumn("part", _hash("source") % PARTS)
    parts = quotas.groupBy("quota", "part").agg(F.count("*").alias("size"))
    before = parts.withColumn("before", F.coalesce(F.sum("size").over(Window.partitionBy("quota").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("size")
    numbered = quotas.withColumn("rank", F.row_number().over(Window.partitionBy("quota", "part").orderBy("source"))).join(before, ["quota", "part"])
    numbered = numbered.select("source", "n", "quota", (F.col("before") + F.col("rank") - 1).cast("long").alias("turn"))
    classes = parts.groupBy("quota").agg(F.sum("size").alias("m"))
    listed = classes.agg(F.sort_array(F.collect_list(F.struct("quota", "m"))).alias("all")).where(F.size("all") > 0)  # sqrt(2 period) numbers at most
    one = listed.select(F.col("all.quota").alias("quotas"), F.col("all.m").alias("sizes"), F.aggregate("all", F.lit(0).cast("long"), lambda a, x: a + x["quota"] * x["m"]).alias("period"))
    served = one.select("period", "quotas", "sizes", F.posexplode(_earliest_deadlines()).alias("slot", "s"))
    size = F.get("sizes", F.col("s.class"))
    slots = served.select(F.get("quotas", F.col("s.class")).alias("quota"), (F.col("s.served") % size).alias("turn"), "period", F.col("slot").cast("long").alias("slot"))
    slots = slots.groupBy("quota", "turn", "period").agg(F.sort_array(F.collect_list("slot")).alias("slots"))
    return cut(numbered.join(slots, ["quota", "turn"]).select("source", "n", "quota", "period", "slots"))


def mixed(docs: DataFrame, weights: dict[str, int] | None = None, block: int = BLOCK, period: int = PERIOD) -> DataFrame:
    """(row, source, block, release, deadline, slot, place): the order of the mixture is that of slot and place."""
    sources = source_table(target_quotas(docs, weights, period))
    known = sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    each = F.array(*[F.lit(i).cast("long") for i in range(1 if known else PARTS)])
    side = lambda t: F.broadcast(t) if known else t
    facts = lambda *cols: side(sources.select("source", *cols, F.explode(each).alias("part")))
    h = _hash("doc_id")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce("source", F.lit("")).alias("source"), F.col("doc_id").alias("id"), h.alias("h"), (F.lit(0).cast("long") if known else h % PARTS).alias("part"))
    # h is below 2^32: ranges of equal width have about equal shares of a source's rows
    parts = rows.join(facts(F.ceil(F.col("n") / ROWS_PER_RANGE).alias("ranges")), ["source", "part"])
    parts = parts.withColumn("range", F.shiftright(F.col("h") * F.col("ranges"), 32)).drop("ranges")
    sizes = parts.groupBy("source", "range").agg(F.count("*").alias("size"))
    before = sizes.withColumn("before", F.coalesce(F.sum("size").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("size")
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("source", "range").orderBy("h", "id"))).join(before, ["source", "range"])
    rank = F.col("before") + F.col("rank") - 1
    placed = ranked.withColumn("place", rank % block).withColumn("block", F.floor(rank / block).cast("long")).join(facts("quota", "period", "slots"), ["source", "part"])
    k, q, p = F.col("block"), F.col("quota"), F.col("period")
    j, turn = k % q, F.floor(k / q).cast("long") * p
    return placed.select(
        "row", "source", "block", (turn + F.floor(j * p / q)).cast("long").alias("release"), (turn - F.floor(-((j + 1) * p) / q)).cast("long").alias("deadline"),
        (turn + F.element_at("slots", (j + 1).cast("int"))).alias("slot"), "place",
    )


def op5_mixing_pfair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(documents(spark, sf_dir).select("doc_id", "source")).select("row.doc_id", "source", "block", "release", "deadline", "slot", "place")


QUERIES = {"op5_mixing_pfair": op5_mixing_pfair}

ORACLE = {
    "op5_mixing_pfair": r"""
WITH RECURSIVE counts AS (
  SELECT coalesce(source, '') AS source, count(*) AS n FROM documents GROUP BY 1
), quotas AS (
  SELECT source, n, greatest(1, floor(1000 * sqrt(n) / sum(sqrt(n)) OVER () + 0.5))::BIGINT AS quota, ('0x' || substr(md5(source), 1, 8))::BIGINT % 64 AS part FROM counts
), listed AS (
  SELECT list(source ORDER BY quota, part, source) AS sources, list(quota ORDER BY quota, part, source) AS q, sum(quota)::BIGINT AS p FROM quotas
), edf AS (
  SELECT -1::BIGINT AS t, NULL::BIGINT AS pick, list_transform(q, lambda x: 0::BIGINT) AS done, q, p FROM listed
  UNION ALL
  SELECT t + 1, pick, list_transform(done, lambda x, i: x + (i = pick)::BIGINT), q, p
  FROM (
    SELECT t, done, q, p, list_min(list_transform(list_filter(generate_series(1, len(q)), lambda i: done[i] * p < (t + 2) * q[i]),
      lambda i: ((done[i] + 1) * p + q[i] - 1) // q[i] * 100000 + i)) % 100000 AS pick
    FROM edf WHERE t + 1 < p
  )
), slots AS (
  SELECT sources[pick] AS source, t AS slot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS j FROM edf, listed WHERE pick IS NOT NULL
), ranked AS (
  SELECT doc_id, coalesce(source, '') AS source, row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT, 0), doc_id NULLS FIRST) - 1 AS r FROM documents
), blocks AS (
  SELECT doc_id, source, r // 8 AS block, r % 8 AS place FROM ranked
)
SELECT b.doc_id, b.source, b.block, b.block // q.quota * p + (b.block % q.quota) * p // q.quota AS release,
  b.block // q.quota * p + ((b.block % q.quota + 1) * p + q.quota - 1) // q.quota AS deadline, b.block // q.quota * p + s.slot AS slot, b.place
FROM blocks b JOIN quotas q USING (source) JOIN slots s ON s.source = b.source AND s.j = b.block % q.quota, listed
""",
}
