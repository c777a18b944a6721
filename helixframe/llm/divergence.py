"""Source divergence audit: how far the term shares of each source lie from those of the other sources of its language.

Terms are counted in tasks first, then by (lang, source, term). A pair of sources is not compared term by
term: its joint histogram tallies the distinct combinations (count in one, count in the other) over all kept terms,
and the divergence f is worked out once for each combination and multiplied. Only cells where both counts are
above zero come from the terms; terms with the same counts in the same sources are merged before pairs are
formed. The cells with a zero are implied: a marginal histogram less the cells already tallied, and for (0, 0) the kept
terms that neither source has. Both directions of a pair come from one histogram.

All numbers are integers, exact: products that may pass 2^63 are decimals of 38 digits.

Defined results: a null text, lang or source counts as ''; a row is a document; a group without terms has only
counts of zero; a language without kept terms has pairs of value 0 and no term rows; a language with one
source has no pairs; ties are ranked by the item's bytes; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.llm.common import cut, documents, small_batches, text_or_empty

LEAST_DOCUMENTS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Terms of all groups that a task holds before it passes them on.
HELD_TERMS = 500_000
#: Up to so many groups their table is broadcast (two strings and three numbers each).
BROADCAST_GROUPS = 10_000
# Bytes that are no part of a term become spaces, A-Z becomes a-z; bytes of other characters are all above 7F.
_TERM_BYTES = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def count_terms(docs: DataFrame, held: int = HELD_TERMS) -> DataFrame:
    """(lang, source, term, n, docs): how often a group has a term, and in how many of its documents."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in own.items():
                terms = list(n)
                columns = [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in terms], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
            own.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                terms = text.translate(_TERM_BYTES).split()
                n, docs = own.setdefault((lang, source), (Counter(), Counter()))
                size -= len(docs)
                n.update(terms)
                docs.update(set(terms))
                size += len(docs)
            if size > held:
                yield from out()
                size = 0
        yield from out()

    rows = docs.select(*[text_or_empty(c).alias(c) for c in ("lang", "source", "text")])
    counted = rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, total, counts): the terms in enough documents of a language, with (source, n) of each source that has them."""
    listed = F.sort_array(F.collect_list(F.struct("source", "n")))
    return counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), listed.alias("counts")).where(F.col("docs") >= least).drop("docs")


def share(n: Column, terms: Column, total: Column) -> Column:
    """p of a term with count n, where a group has `total` occurrences of `terms` kept terms."""
    big = lambda c: c.cast("decimal(20,0)")
    return (1 + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * big(n + 1), big(total + terms))).cast("long")


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def joint_histograms(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, n_a, n_b, terms) for each pair of sources a < b of a language: how many kept terms have these two counts.

    groups has (lang, source, kept): every group, and the number of kept terms of its language.
    """
    profiles = terms.groupBy("lang", "counts").agg(F.count("*").alias("m"))
    several = profiles.where(F.size("counts") > 1)
    firsts = several.select("lang", "m", "counts", F.posexplode("counts").alias("i", "a"))
    both = firsts.select("lang", "m", "a", F.explode(F.slice("counts", F.col("i") + 2, F.size("counts"))).alias("b"))
    seen = both.groupBy("lang", F.col("a.source").alias("a"), F.col("b.source").alias("b"), F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b")).agg(F.sum("m").alias("m"))
    # a cell of two counts is missing in the two margins and is taken out of (0, 0) twice
    nought = F.lit(0).cast("long")
    cell = lambda n_a, n_b, m: F.struct(n_a.alias("n_a"), n_b.alias("n_b"), m.alias("m"))
    m = F.col("m")
    n_a, n_b = F.col("n_a"), F.col("n_b")
    seen = seen.select("lang", "a", "b", F.explode(F.array(cell(n_a, n_b, m), cell(n_a, nought, -m), cell(nought, n_b, -m), cell(nought, nought, m))).alias("c"))

    own = profiles.select("lang", "m", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source"), F.col("c.n").alias("n")).agg(F.sum("m").alias("m"))
    left = groups.select("lang", F.col("source").alias("a"), "kept")
    pairs = left.join(groups.select("lang", F.col("source").alias("b")), "lang").where("a < b")
    n = F.col("n")
    margin = lambda side, counts: pairs.drop("kept").join(own.withColumnRenamed("source", side), ["lang", side]).select("lang", "a", "b", F.explode(F.array(cell(*counts, m), cell(nought, nought, -m))).alias("c"))
    every = pairs.select("lang", "a", "b", cell(nought, nought, F.col("kept")).alias("c"))
    cells = seen.unionByName(margin("a", (n, nought))).unionByName(margin("b", (nought, n))).unionByName(every)
    return cells.groupBy("lang", "a", "b", "c.n_a", "c.n_b").agg(F.sum("c.m").alias("terms")).where("terms > 0")


def _ranked(values: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return values.withColumn("rank", F.row_number().over(order))


def source_divergences(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: every other source of a source's language, and the terms that a source has more of than its language."""
    terms = cut(kept_terms(count_terms(docs), least))
    langs = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_total"))
    totals = terms.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("source_total"))
    found = docs.select(*[text_or_empty(c).alias(c) for c in ("lang", "source")]).distinct()
    groups = found.join(langs, "lang", "left").join(totals, ["lang", "source"], "left").select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("kept", "lang_total", "source_total")])
    groups = cut(groups)

    side = lambda s: groups.select("lang", F.col("source").alias(s), "kept", F.col("source_total").alias(f"total_{s}"))
    cells = joint_histograms(terms, groups).join(side("a"), ["lang", "a"]).join(side("b").drop("kept"), ["lang", "b"])
    p, q = (share(F.col(f"n_{s}"), F.col("kept"), F.col(f"total_{s}")) for s in "ab")
    sums = cells.withColumns({"p": p, "q": q}).groupBy("lang", "a", "b").agg(*[F.sum(F.col("terms") * divergence(F.col(x), F.col(y))).alias(v) for x, y, v in (("p", "q", "ab"), ("q", "p", "ba"))])
    one_way = lambda source, item, value: F.struct(F.col(source).alias("source"), F.col(item).alias("item"), F.coalesce(value, F.lit(0)).alias("value"))
    # a pair of a language without kept terms has no cells
    pairs = groups.select("lang", F.col("source").alias("a"), "kept").where("kept = 0").join(groups.select("lang", F.col("source").alias("b")), "lang").where("a < b").select("lang", "a", "b", F.lit(0).cast("long").alias("ab"), F.lit(0).cast("long").alias("ba"))
    pair = sums.unionByName(pairs).select("lang", F.explode(F.array(one_way("a", "b", F.col("ab")), one_way("b", "a", F.col("ba")))).alias("v")).select("lang", "v.source", F.lit("pair").alias("part"), "v.item", "v.value")

    own = terms.select("lang", F.col("term").alias("item"), "total", F.explode("counts").alias("c")).select("lang", F.col("c.source").alias("source"), "item", "total", F.col("c.n").alias("n"))
    own = own.join(F.broadcast(groups) if groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS else groups, ["lang", "source"])
    p, q = share(F.col("n"), F.col("kept"), F.col("source_total")), share(F.col("total"), F.col("kept"), F.col("lang_total"))
    term = own.withColumns({"p": p, "q": q}).where("p > q").select("lang", "source", F.lit("term").alias("part"), "item", divergence(F.col("p"), F.col("q")).alias("value"))
    return _ranked(pair).unionByName(_ranked(term).where(F.col("rank") <= top)).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergences(documents(spark, sf_dir))


QUERIES = {"op13_source_divergence": op13_source_divergence}

ORACLE = {
    "op13_source_divergence": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), said AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS total FROM said GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3
), own AS (
  SELECT lang, source, term, count(*) AS n FROM said SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3
), grp AS (
  SELECT g.lang, g.source, (SELECT count(*) FROM kept k WHERE k.lang = g.lang) AS v, coalesce((SELECT sum(n) FROM own o WHERE o.lang = g.lang AND o.source = g.source), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS c, 1 + 1000000000 * (coalesce(o.n, 0)::HUGEINT + 1) // (g.n + g.v) AS p,
    1 + 1000000000 * (k.total::HUGEINT + 1) // (sum(k.total) OVER (PARTITION BY g.lang, g.source) + g.v) AS q
  FROM grp g JOIN kept k USING (lang) LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE c > 0 AND p > q
), ranked AS (
  SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM parts
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
""",
}
