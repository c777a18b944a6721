"""Line dedup over content-defined chunks, in DataFrame functions only.

A text is cut into units: lines, and the sentences of lines of LONG characters or more, hashed without the
space or line feed between them. A long line is a block of its own, and so is a run of shorter lines. A
rolling hash (a polynomial modulo a prime) over WINDOW units starts anew with each block; a chunk ends with
its block, and where the hash is smaller than at the units on both sides. Boundaries depend on nearby text
alone, so an insertion moves no others; chunks have two units or more, but for blocks of one.

A chunk of several lines, of LEAST characters or more, that occurs in several documents stays in the one
with the smallest doc_id, at its first place, and goes elsewhere, once its bytes have been compared with
those of the chunk that stays. A sentence counts as a line here, and what an editor would wrap counts as
several: one unit of LONG characters or more. A paragraph on a line of its own has the same chunks wherever
it stands; what lies within a line, or in a run of short lines, may lose a chunk's length at either end.

Hashes travel without text: they are counted with map-side combining, and only chunks whose hash
repeats have their text compared, joined on the hash, so that Spark can split a very common one. The work
on a text grows with its size (times a logarithm), however many lines it has.

Defined results: a null text stays null and an empty one empty; a chunk repeated within one document
stays at its first place there; rows with one doc_id are one document and lose the same chunks; rows
with a null doc_id lose repeats within themselves only; a line that goes takes its line feed along; an
empty table gives an empty table; all other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import cut, documents, free_name, let

LONG = 160
LEAST = 60
WINDOW = 2
#: Of the rolling hash.
BASE, PRIME = 1103515245, (1 << 31) - 1


def _units(lines: Column) -> Column:
    """Array of (unit, line, first, h): with the line feed or space before it, the number of its line, whether it starts a block, and its own hash."""

    def of(line: Column, i: Column) -> Column:
        long_line = F.length(line) >= LONG
        after_long = F.coalesce(F.length(F.get(lines, i - 1)) >= LONG, F.lit(True))
        parts = F.when(long_line, F.split(line, " (?<=[.!?] )(?=.)")).otherwise(F.array(line))
        h = lambda p: F.conv(F.substring(F.md5(p), 1, 7), 16, 10).cast("long")
        return F.transform(parts, lambda p, j: F.struct(F.concat(F.when(j == 0, "\n").otherwise(" "), p).alias("unit"), i.alias("line"), ((j == 0) & (long_line | after_long)).alias("first"), h(p).alias("h")))

    return F.flatten(F.transform(lines, of))


def _rolled(units: Column) -> Column:
    """The units with the rolling hash r over WINDOW of them, or as many as their block has up to here."""
    first = lambda i: F.get(units, i)["first"]

    def at(u: Column, i: Column) -> Column:
        total, inside = u["h"], F.lit(True)
        for back in range(1, WINDOW):
            inside = inside & ~first(i - back + 1)
            total = total + F.when(inside, F.get(units, i - back)["h"] * pow(BASE, back, PRIME)).otherwise(0)
        return F.struct(u["unit"].alias("unit"), u["line"].alias("line"), u["first"].alias("first"), (total % PRIME).alias("r"))

    return F.transform(units, at)


def _cut(units: Column) -> Column:
    """Array of (chunk, hash, from_line, to_line, several_lines)."""
    first = lambda i: F.coalesce(F.get(units, i)["first"], F.lit(True))
    r = lambda i: F.get(units, i)["r"]

    def end(u: Column, i: Column) -> Column:
        least = ~u["first"] & ~first(i + 2) & (r(i - 1) > u["r"]) & (u["r"] < r(i + 1))
        return F.when(first(i + 1) | least, i + 1)

    def chunks(at: Column) -> Column:
        def one(stop: Column, k: Column) -> Column:
            start = F.get(at, k)
            text = F.substring(F.array_join(F.slice(units, start + 1, stop - start)["unit"], ""), 2, (1 << 31) - 1)
            return let(text, lambda c: F.struct(
                c.alias("chunk"), F.xxhash64(c).alias("hash"), F.get(units, start)["line"].alias("from_line"), F.get(units, stop - 1)["line"].alias("to_line"),
                ((F.length(c) >= LONG) | (stop - start >= 2) & (F.length(c) >= LEAST)).alias("several_lines"),
            ))

        return F.transform(F.slice(at, 2, F.size(at)), one)

    ends = F.filter(F.transform(units, end), lambda e: e.isNotNull())
    return let(F.concat(F.array(F.lit(0)), ends), chunks)


def chunks_of(text: Column) -> Column:
    """The chunks of a text in order, as (chunk, hash, from_line, to_line, several_lines); joined_text() makes the text again."""
    return let(F.split(F.coalesce(text, F.lit("")), "\n"), lambda lines: let(_units(lines), lambda units: let(_rolled(units), _cut)))


def joined_text(chunks: Column) -> Column:
    """Chunks with a line feed where a new line starts, else a space, between them."""
    lead = lambda c, i: F.when(i == 0, "").when(c["from_line"] > F.get(chunks, i - 1)["to_line"], "\n").otherwise(" ")
    return F.array_join(F.transform(chunks, lambda c, i: F.concat(lead(c, i), c["chunk"])), "")


def _several(chunks: Column) -> Column:
    return F.filter(chunks, lambda c: c["several_lines"])


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, hash): chunks that another document keeps, their bytes compared with its own; a null hash where a document repeats a chunk of its own."""
    twice = lambda own: F.when(F.size(F.array_distinct(own)) < F.size(own), F.concat(F.array_distinct(own), F.array(F.lit(None).cast("long")))).otherwise(own)
    own = let(F.transform(_several(chunks_of(F.col("text"))), lambda x: x["hash"]), twice)
    found = cut(docs.select("doc_id", F.explode(own).alias("hash")))
    keepers = found.where(F.col("hash").isNotNull()).groupBy("hash").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last")).where("keeper <> last").drop("last")
    marked = found.join(keepers, "hash").groupBy("doc_id").agg(F.collect_set(F.struct("hash", F.lit(-1).alias("k"), F.lit(None).cast("string").alias("chunk"), "keeper")).alias("marked"))

    # in the order of hashes a mark comes before the chunks with its hash, of which the first counts
    listed = F.transform(_several(chunks_of(F.col("text"))), lambda c, k: F.struct(c["hash"].alias("hash"), k.alias("k"), c["chunk"].alias("chunk"), F.lit(None).cast("long").alias("keeper")))
    before = lambda xs, i: F.get(xs, i - 1)
    behind = lambda xs: F.transform(xs, lambda x, i: F.when((x["k"] >= 0) & (before(xs, i)["k"] < 0) & (before(xs, i)["hash"] == x["hash"]), F.struct(x["hash"].alias("hash"), x["chunk"].alias("chunk"), before(xs, i)["keeper"].alias("keeper"))))
    wanted = F.filter(let(F.sort_array(F.concat("marked", listed)), behind), lambda x: x.isNotNull())
    texts = cut(docs.join(marked, "doc_id").select("doc_id", F.explode(wanted).alias("c")).select("doc_id", "c.*"))
    kept = texts.where("doc_id = keeper").groupBy("hash").agg(F.min("chunk").alias("kept_chunk"))
    removed = texts.where("doc_id <> keeper").join(kept, "hash").where("chunk = kept_chunk").select("doc_id", "hash").distinct()
    return removed.unionByName(found.where(F.col("hash").isNull()))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The rows of docs with repeated chunks gone from text, as (row, n_removed, text). Only texts that lose something are cut again."""
    named = docs.where(F.col("doc_id").isNotNull())
    key, removed = (free_name(x, docs.columns) for x in ("key", "removed"))
    gone = repeated_chunks(named.select("doc_id", "text")).groupBy("doc_id").agg(F.collect_list("hash").alias(removed)).withColumnRenamed("doc_id", key)
    rows = named.join(gone, F.col("doc_id") == F.col(key), "left").unionByName(docs.where(F.col("doc_id").isNull()).withColumns({key: F.lit(None).cast("long"), removed: F.array().cast("array<long>")}))

    def left(chunks: Column) -> Column:
        """Chunks that stay, in place of all. In the order of hashes, one goes behind a mark or behind an equal chunk."""
        marks = F.transform(F.col(removed), lambda h: F.struct(h.alias("hash"), F.lit(-1).alias("k")))
        own = F.transform(chunks, lambda c, k: F.struct(F.when(c["several_lines"], c["hash"]).alias("hash"), k.alias("k")))

        def goes(xs: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                last = F.get(xs, i - 1)
                same = (last["k"] < 0) | (F.get(chunks, last["k"])["chunk"] == F.get(chunks, x["k"])["chunk"])
                return F.struct(x["k"].alias("k"), F.coalesce((last["hash"] == x["hash"]) & same, F.lit(False)).alias("goes"))

            return F.sort_array(F.filter(F.transform(xs, one), lambda x: x["k"] >= 0))

        stay = let(let(F.sort_array(F.concat(marks, own)), goes), lambda flags: F.filter(chunks, lambda c, k: ~F.get(flags, k)["goes"]))
        return let(stay, lambda kept: F.struct((F.size(chunks) - F.size(kept)).cast("long").alias("n_removed"), joined_text(kept).alias("text")))

    same = F.col(removed).isNull() | F.col("text").isNull()
    done = F.when(same, F.struct(F.lit(0).cast("long").alias("n_removed"), F.col("text").alias("text"))).otherwise(let(chunks_of(F.col("text")), left))
    return rows.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), done.alias("done")).select("row", "done.n_removed", "done.text")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir).select("doc_id", "text")).select("row.doc_id", "n_removed", "text")


QUERIES = {"op4_line_dedup": op4_line_dedup}

ORACLE = {
    "op4_line_dedup": rf"""
WITH lines AS (
  SELECT doc_id, t.line, t.i, length(t.line) >= {LONG} AS long_line FROM documents, unnest(string_split(coalesce(text, ''), chr(10))) WITH ORDINALITY AS t(line, i)
), parts AS (
  SELECT doc_id, i, long_line OR lag(long_line, 1, true) OVER (PARTITION BY doc_id ORDER BY i) AS starts,
    CASE WHEN long_line THEN string_split(regexp_replace(regexp_replace(line, '([.!?]) ', '\1' || chr(1), 'g'), chr(1) || '$', ' '), chr(1)) ELSE [line] END AS p
  FROM lines
), units AS (
  SELECT doc_id, i, u.unit, u.j = 1 AS new_line, u.j = 1 AND starts AS first, row_number() OVER (PARTITION BY doc_id ORDER BY i, u.j) AS k, ('0x' || substr(md5(u.unit), 1, 7))::BIGINT AS h
  FROM parts, unnest(p) WITH ORDINALITY AS u(unit, j)
), blocks AS (
  SELECT *, sum(first::INT) OVER (PARTITION BY doc_id ORDER BY k) AS b FROM units
), rolled AS (
  SELECT *, (h + coalesce(lag(h) OVER w, 0) * {BASE}) % {PRIME} AS r FROM blocks WINDOW w AS (PARTITION BY doc_id, b ORDER BY k)
), ends AS (
  SELECT *, lead(k) OVER w IS NULL OR coalesce(lead(k, 2) OVER w IS NOT NULL AND lag(r) OVER w > r AND r < lead(r) OVER w, false) AS is_end FROM rolled WINDOW w AS (PARTITION BY doc_id, b ORDER BY k)
), numbered AS (
  SELECT *, coalesce(sum(is_end::INT) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM ends
), led AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY doc_id, c ORDER BY k) = 1 THEN '' WHEN new_line THEN chr(10) ELSE ' ' END || unit AS piece FROM numbered
), chunks AS (
  SELECT doc_id, c, string_agg(piece, '' ORDER BY k) AS chunk, min(i) AS from_line, max(i) AS to_line, count(*) AS n FROM led GROUP BY doc_id, c
), several AS (
  SELECT *, length(chunk) >= {LONG} OR n >= 2 AND length(chunk) >= {LEAST} AS several FROM chunks
), marked AS (
  SELECT *, several AND row_number() OVER (PARTITION BY chunk, several ORDER BY doc_id, c) > 1 AS gone FROM several
), kept AS (
  SELECT doc_id, c, CASE WHEN row_number() OVER w = 1 THEN '' WHEN from_line > lag(to_line) OVER w THEN chr(10) ELSE ' ' END || chunk AS piece FROM marked WHERE NOT gone WINDOW w AS (PARTITION BY doc_id ORDER BY c)
), texts AS (
  SELECT doc_id, string_agg(piece, '' ORDER BY c) AS text FROM kept GROUP BY doc_id
), counts AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_removed, 0)::BIGINT AS n_removed, CASE WHEN d.text IS NOT NULL THEN coalesce(t.text, '') END AS text
FROM documents d LEFT JOIN texts t ON t.doc_id = d.doc_id LEFT JOIN counts n ON n.doc_id = d.doc_id
""",
}
