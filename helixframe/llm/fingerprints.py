"""Homomorphic multiset fingerprints of documents, in DataFrame functions only.

A text is a multiset of paragraphs (lines, and sentences within them). Each paragraph is hashed to a wide
vector and the vectors are added modulo powers of two, so order does not matter, and a paragraph is put
in or taken out by adding or subtracting its vector:

- SUMS numbers from sha256, modulo 2^60: two texts agree in them only if their multisets agree;
- SIGNS numbers, the lengths of the paragraphs that have a given bit of the last hash set, and the length of all,
  modulo 2^32. Twice the former less the latter is a projection on random signs, so the cosine of
  two of them estimates how much text two documents share.

The next document, by descending doc_id, comes from a range partitioning of the ids alone with one
boundary row per partition; of texts, only the start that the edit needs is sent on.

Defined results: a null text counts as empty; two empty fingerprints are alike (1.0), an empty and
another one are not (0.0); a null doc_id comes last; of rows with one doc_id, the next document is the
one with the next smaller doc_id, and of several rows with that id the text that sorts first counts;
one document alone is its own next; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.llm.common import cut, documents, text_or_empty

SUMS, SUM_DIGITS = 4, 15
SIGNS = 60
#: Signs are added two at a time, HALF bits apart: the lengths of a text's paragraphs stay below 2^HALF.
HALF = SIGNS // 2
_LAST_KEY = -(1 << 63)


def _digits(digest: Column, start: int, n: int) -> Column:
    return F.conv(F.substring(digest, start, n), 16, 10).cast("long")


def vector(text: Column) -> Column:
    """(sums, signs, size) of a text."""
    paragraphs = F.filter(F.split(text, "\n|(?<=[.!?]) "), lambda p: p != "")

    def hashed(p: Column) -> Column:
        d = F.sha2(p, 256)
        return F.struct(
            F.length(p).cast("long").alias("w"), F.array(*[_digits(d, 1 + SUM_DIGITS * k, SUM_DIGITS) for k in range(SUMS)]).alias("e"),
        )

    zero = F.lit(0).cast("long")
    wide = 1 << (4 * SUM_DIGITS)

    def of(hs: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), F.lit(SUMS - 1)), lambda k: F.aggregate(hs, zero, lambda a, u: (a + u["e"][k]) % wide))
        pair = F.lit((1 << HALF) + 1)
        both = F.transform(F.sequence(F.lit(0), F.lit(HALF - 1)), lambda j: F.aggregate(hs, zero, lambda a, u: a + u["w"] * F.call_function("shiftright", u["e"][SUMS - 1], j).bitwiseAND(pair)))
        low = F.transform(both, lambda x: x.bitwiseAND(F.lit((1 << HALF) - 1)))
        high = F.transform(both, lambda x: F.shiftright(x, HALF))
        return F.struct(sums.alias("sums"), F.concat(low, high).alias("signs"), F.aggregate(hs, zero, lambda a, u: a + u["w"]).alias("size"))

    # the hashes go through a one-element array, so that they are worked out once
    return F.transform(F.array(F.transform(paragraphs, hashed)), of)[0]


def combined(a: Column, b: Column, by: int = 1) -> Column:
    """The vector of a with the paragraphs of b put in (by=1) or taken out (by=-1)."""
    add = lambda x, y, wide: F.zip_with(x, y, lambda p, q: F.pmod(p + q * by, F.lit(wide)))
    return F.struct(add(a["sums"], b["sums"], 1 << (4 * SUM_DIGITS)).alias("sums"), add(a["signs"], b["signs"], 1 << 32).alias("signs"), F.pmod(a["size"] + b["size"] * by, F.lit(1 << 32)).alias("size"))


def text_of(v: Column) -> Column:
    """A vector as hexadecimal digits."""
    digits = lambda x, n: F.lpad(F.lower(F.hex(x)), n, "0")
    return F.concat(F.array_join(F.transform(v["sums"], lambda x: digits(x, SUM_DIGITS)), ""), F.array_join(F.transform(v["signs"], lambda x: digits(x, 8)), ""), digits(v["size"], 8))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal sums, else the cosine of the signs, from 0 to 1, to six places."""
    centred = lambda v: F.transform(v["signs"], lambda x: (2 * x - v["size"]).cast("double"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, z: s + z)
    x, y = centred(a), centred(b)
    norm = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    return F.when(a["sums"] == b["sums"], 1.0).when(norm == 0, 0.0).otherwise(F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot(x, y) / norm)), 6))


def _successors(docs: DataFrame) -> DataFrame:
    """(key, before, wanted): a key's neighbour with the next larger id, and how much of this text it wants."""
    keys = docs.groupBy("key").agg(F.max(F.floor(F.length("text") / 2)).alias("half"))
    ranged = cut(keys.repartitionByRange(F.desc("key")).withColumn("part", F.spark_partition_id()))
    order = Window.partitionBy("part").orderBy(F.desc("key"))
    inside = ranged.withColumn("before", F.lag("key").over(order)).withColumn("wanted", F.lag("half").over(order))
    # one row for each partition
    last = ranged.groupBy("part").agg(F.min("key").alias("last"), F.min_by("half", "key").alias("last_half"))
    parts, every = Window.orderBy("part"), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = last.select("part", *[F.coalesce(F.lag(c).over(parts), F.last(c).over(every)).alias(f"edge_{c}") for c in ("last", "last_half")])
    joined = inside.join(edges, "part")
    return cut(joined.select("key", F.coalesce("before", "edge_last").alias("before"), F.when(F.col("before").isNull(), F.col("edge_last_half")).otherwise(F.col("wanted")).cast("int").alias("wanted")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    # both joins below take the same two columns, so that texts are shuffled once
    keyed = docs.select(text_or_empty().alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_KEY)).alias("key"))
    sent = keyed.join(_successors(keyed), "key").select(F.col("before").alias("key"), F.substring("text", F.lit(1), F.col("wanted")).alias("start"), vector(F.col("text")).alias("next"))
    sent = sent.groupBy("key").agg(F.min(F.struct("start", "next")).alias("sent"))
    both = keyed.join(sent, "key")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("sent.start"), F.lit(1), half))
    made = both.withColumn("edited", edited).withColumn("own", vector(F.col("text"))).withColumn("other", vector(F.col("edited")))
    return made.select(
        F.nullif("key", F.lit(_LAST_KEY)).alias("doc_id"), n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), text_of(F.col("own")).alias("fingerprint"), text_of(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("sent.next")).alias("near_next"),
    )


def op10_fingerprint_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


QUERIES = {"op10_fingerprint_multiset": op10_fingerprint_multiset}

_VECTOR = r"""
  SELECT doc_id, role, list_transform(generate_series(0, 3), lambda k: list_sum(list_transform(ds, lambda d: ('0x' || substr(d, 1 + 15 * k, 15))::BIGINT::HUGEINT)) % 1152921504606846976) AS sums,
    list_transform(generate_series(0, 59), lambda j: coalesce(list_sum(list_transform(generate_series(1, len(ds)), lambda i: ws[i] *
      ((('0x' || substr(ds[i], 46, 15))::BIGINT >> j) & 1))), 0)::BIGINT) AS signs,
    coalesce(list_sum(ws), 0)::BIGINT AS size
  FROM (
    SELECT doc_id, role, list_transform(p, lambda x: sha256(x)) AS ds, list_transform(p, lambda x: length(x)) AS ws
    FROM (SELECT doc_id, role, list_filter(string_split(regexp_replace(replace(text, chr(10), chr(1)), '([.!?]) ', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS p FROM roles)
  )
"""

ORACLE = {
    "op10_fingerprint_multiset": rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text,
    coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC), first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS next_text
  FROM documents
), roles AS (
  SELECT doc_id, 'own' AS role, text FROM docs
  UNION ALL SELECT doc_id, 'next', next_text FROM docs
  UNION ALL SELECT doc_id, 'edited', left(text, length(text) - length(text) // 2) || CASE WHEN length(text) < 2 THEN '' ELSE left(next_text, length(text) // 2) END FROM docs
), vectors AS ({_VECTOR}), filled AS (
  SELECT doc_id, role, list_transform(sums, lambda x: coalesce(x, 0)) AS sums, signs, size, list_transform(signs, lambda x: (2 * x - size)::DOUBLE) AS c FROM vectors
), hexed AS (
  SELECT *, array_to_string(list_transform(sums, lambda x: lpad(printf('%x', x::BIGINT), 15, '0')), '') || array_to_string(list_transform(signs, lambda x: lpad(printf('%x', x), 8, '0')), '') || lpad(printf('%x', size), 8, '0') AS fp,
    sqrt(list_sum(list_transform(c, lambda x: x * x))) AS norm
  FROM filled
), pairs AS (
  SELECT o.doc_id, o.fp AS fingerprint, e.role, e.fp,
    CASE WHEN o.sums = e.sums THEN 1.0 WHEN o.norm * e.norm = 0 THEN 0.0
      ELSE round(least(1.0, greatest(0.0, list_sum(list_transform(generate_series(1, 60), lambda i: o.c[i] * e.c[i])) / (o.norm * e.norm))), 6) END::DOUBLE AS near
  FROM hexed o JOIN hexed e ON o.doc_id = e.doc_id AND o.role = 'own' AND e.role <> 'own'
)
SELECT d.doc_id, length(d.text) AS n_chars, sha256(r.text) AS edited_sha256, e.fingerprint, e.fp AS edited_fingerprint, e.near AS near_edited, n.near AS near_next
FROM docs d JOIN roles r ON r.doc_id = d.doc_id AND r.role = 'edited' JOIN pairs e ON e.doc_id = d.doc_id AND e.role = 'edited' JOIN pairs n ON n.doc_id = d.doc_id AND n.role = 'next'
""",
}
