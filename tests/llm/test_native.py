"""Line dedup, mixing and fingerprints: SQL on the small tables, brute force and edges."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.llm import fingerprints, line_dedup, mixing, queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, sf_dir, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = db.execute(queries.ORACLE[name])
    names = sorted(c[0] for c in want.description)
    rows = [dict(zip([c[0] for c in want.description], r, strict=True)) for r in want.fetchall()]
    got = queries.QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == names
    key = lambda rs: sorted(repr([r[c] for c in names]) for r in rs)
    assert key([r.asDict() for r in got.collect()]) == key(rows)


# --- line dedup --------------------------------------------------------------------------------


def chunks(text):
    """(chunk, first line, last line, several lines) of a text."""
    lines = text.split("\n")
    blocks, open_ = [], False
    for i, line in enumerate(lines):
        if len(line) >= line_dedup.LONG:
            blocks.append([(p, i, j == 0) for j, p in enumerate(re.split(r"(?<=[.!?]) (?=.)", line))])
            open_ = False
        else:
            if not open_:
                blocks.append([])
            blocks[-1].append((line, i, True))
            open_ = True
    out = []
    for units in blocks:
        h = [int(hashlib.md5(u.encode()).hexdigest()[:7], 16) for u, _, _ in units]
        r = [sum(h[i - back] * line_dedup.BASE**back for back in range(line_dedup.WINDOW) if back <= i) % line_dedup.PRIME for i in range(len(h))]
        ends = [i + 1 for i in range(1, len(r) - 2) if r[i - 1] > r[i] < r[i + 1]] + [len(r)]
        for start, end in zip([0, *ends], ends, strict=False):
            own = units[start:end]
            piece = own[0][0] + "".join(("\n" if new else " ") + u for u, _, new in own[1:])
            out.append((piece, own[0][1], own[-1][1], len(piece) >= line_dedup.LONG or len(own) >= 2 and len(piece) >= line_dedup.LEAST))
    return out


def joined(kept):
    return "".join(("" if i == 0 else "\n" if c[1] > kept[i - 1][2] else " ") + c[0] for i, c in enumerate(kept))


def brute_dedup(rows):
    """Texts after dedup, for rows with distinct ids in ascending order."""
    seen, out = set(), {}
    for d, text in sorted(rows):
        if text is None:
            out[d] = None
            continue
        kept = []
        for c in chunks(text):
            if not (c[3] and c[0] in seen):
                kept.append(c)
            if c[3]:
                seen.add(c[0])
        out[d] = joined(kept)
    return out


def test_dedup_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    sentences = [" ".join(rng.choice(list("abcdefgh"), 6)).capitalize() + "." for _ in range(40)]
    passage = " ".join(f"Passage word{i} and more of it." for i in range(12))
    rows = []
    for d in range(150):
        lines = ["".join(rng.choice(sentences)) if rng.random() < 0.6 else " ".join(rng.choice(sentences, 15)) for _ in range(rng.integers(1, 12))]
        if d % 5 == 0:
            lines.insert(int(rng.integers(0, len(lines) + 1)), passage)
        rows.append((d, "\n".join(lines)))
    rows += [(500, rows[3][1]), (501, None), (502, ""), (503, "\n\n\n"), (504, rows[7][1] + "\n" + rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).select("row.doc_id", "text").collect()}
    assert got == brute_dedup(rows)
    assert sum(passage in (t or "") for t in got.values()) == 1
    assert line_dedup.dedup_lines(docs).where("n_removed > 0").count() > 25


def test_chunks_join_to_the_text(spark, edge):
    odd = [("A.  B. \n\n" + "Long one here. And more of it. " * 9 + "\n\nx",), ("\n",), ("a\n" * 3000,), ("So it is. " * 3000,)]
    texts = edge.select("text").union(edge.sparkSession.createDataFrame(odd, "text string"))
    chunk = line_dedup.chunks_of(F.col("text"))
    for r in texts.select("text", chunk.alias("c"), line_dedup.let(chunk, line_dedup.joined_text).alias("again")).collect():
        assert r.again == (r.text or "")
        assert [(c.chunk, c.from_line, c.to_line, c.several_lines) for c in r.c] == chunks(r.text or "")


def planted(rng, words):
    """Texts with 40 passages of over 50 words, five times each: (own line, short lines, inside a paragraph), with where each one is."""
    sentence = lambda: " ".join(rng.choice(words, int(rng.integers(6, 16)))).capitalize() + "."
    paragraph = lambda n: " ".join(sentence() for _ in range(n))
    rows, places = [], []
    for k in range(40):
        parts = []
        while sum(len(x.split()) for x in parts) < 51 + k:
            parts.append(sentence())
        for copy in range(5):
            way = ("own line", "short lines", "inside")[k % 3]
            around = [paragraph(int(rng.integers(1, 8))) for _ in range(int(rng.integers(1, 5)))]
            at = int(rng.integers(0, len(around) + 1))
            if way == "inside":
                around.insert(at, f"{paragraph(3)} {' '.join(parts)} {paragraph(3)}")
            else:
                around.insert(at, (" " if way == "own line" else "\n").join(parts))
            rows.append((len(rows), "\n".join(around)))
            places.append((way, copy, parts))
    return rows, places


def test_share_of_planted_passages_that_goes(spark):
    rng = np.random.default_rng(12)
    rows, places = planted(rng, ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(3000)])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).select("row.doc_id", "text").collect()}
    shares = {}
    for (d, text), (way, copy, parts) in zip(rows, places, strict=True):
        own = [x for x in re.split(r"\n|(?<=[.!?]) ", text) if x not in parts]
        assert all(x in got[d] for x in own)  # nothing else goes
        if copy:
            shares.setdefault(way, []).append(sum(len(x.split()) for x in parts if x not in got[d]) / sum(len(x.split()) for x in parts))
        else:
            assert got[d] == text
    assert min(shares["own line"]) == 1.0 and np.mean(shares["short lines"]) > 0.6 and np.mean(shares["inside"]) > 0.45


def test_dedup_edges(edge, empty, edge_rows):
    rows = line_dedup.dedup_lines(edge).collect()
    assert len(rows) == len(edge_rows)
    assert rows[0].row.asDict().keys() == dict.fromkeys(edge.columns).keys()
    by_id = {r.row.doc_id: r for r in rows}
    assert by_id[2].text is None and by_id[3].text == "" and by_id[4].text == " \n\t "
    same = [r.text for r in rows if r.row.doc_id == 1]
    assert same[0] == same[1]  # one document, twice
    assert line_dedup.dedup_lines(empty).count() == 0


# --- mixing ------------------------------------------------------------------------------------


def test_deviation_is_below_one_block(spark):
    rows = [(i, "abcd"[min(3, i % 10 // 2)]) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    weights = {"a": 7, "b": 2, "c": 5, "d": 3}
    got = mixing.mixed(docs, weights, block=1).select("source", "slot", "release", "deadline").collect()
    assert all(r.release <= r.slot < r.deadline for r in got)
    slots = {}
    for r in got:
        slots.setdefault(r.slot, []).append(r.source)
    assert all(len(v) == 1 for v in slots.values())
    first_gap = next(t for t in range(10**6) if t not in slots)
    done = dict.fromkeys(weights, 0)
    for t in range(first_gap):
        done[slots[t][0]] += 1
        assert all(abs(done[s] - w / 17 * (t + 1)) < 1 for s, w in weights.items())
    assert len(got) == len(rows)


def earliest_deadlines(quotas):
    """Sources by slot of one period: of the released blocks the one due first, ties by place."""
    p, done, out = sum(quotas), [0] * len(quotas), []
    for t in range(p):
        ready = [(-(-(done[i] + 1) * p // q), i) for i, q in enumerate(quotas) if done[i] * p // q <= t]
        out.append(min(ready)[1])
        done[out[-1]] += 1
    return out


def test_schedule_over_classes_equals_that_over_sources(spark):
    rng = np.random.default_rng(2)
    for sizes in ([1] * 400 + [300, 20, 20, 7], rng.integers(1, 6, 120).tolist(), [5], [3, 3, 3]):
        rows = [(f"s{i}", 1, int(q)) for i, q in enumerate(sizes)]
        got = mixing.source_table(spark.createDataFrame(rows, "source string, n long, quota long")).collect()
        part = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:8], 16) % mixing.PARTS
        order = sorted(rows, key=lambda r: (r[2], part(r[0]), r[0]))
        want = earliest_deadlines([q for _, _, q in order])
        assert {r.source: r.slots for r in got} == {s: [t for t, i in enumerate(want) if i == k] for k, (s, _, _) in enumerate(order)}
        assert {r.period for r in got} == {len(want)}


def test_many_sources(spark, monkeypatch):
    """Twenty thousand sources, one with a third of the rows: joined in parts, every row placed once."""
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 20_000)).alias("source"))
    got = mixing.mixed(docs)
    places = got.groupBy("slot", "place").count()
    assert got.count() == 60_000 and places.where("count > 1").count() == 0
    assert got.where("slot < release OR slot >= deadline").count() == 0


def test_ranks_are_whole_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 50)
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("source"))
    got = mixing.mixed(docs, block=4).select("source", (F.col("block") * 4 + F.col("place")).alias("rank")).collect()
    for source in ("hot", "cold"):
        ranks = sorted(r.rank for r in got if r.source == source)
        assert ranks == list(range(len(ranks)))


def test_mixing_edges(edge, empty, edge_rows):
    rows = mixing.mixed(edge).collect()
    assert len(rows) == len(edge_rows) and sorted(rows[0].row.asDict()) == sorted(edge.columns)
    assert len({(r.slot, r.place) for r in rows}) == len(rows)
    assert mixing.mixed(empty).count() == 0


# --- fingerprints ------------------------------------------------------------------------------


def test_vectors_add_up(spark):
    rows = [("First one here. Second one here.\nThird line", "Third line\nSecond one here.\nExtra piece\nFirst one here.", "Extra piece")]
    df = spark.createDataFrame(rows, "a string, b string, extra string")
    v = {c: fingerprints.vector(F.col(c)) for c in df.columns}
    same = lambda x, y: fingerprints.text_of(x) == fingerprints.text_of(y)
    got = df.select(same(fingerprints.combined(v["a"], v["extra"]), v["b"]).alias("put_in"), same(fingerprints.combined(v["b"], v["extra"], -1), v["a"]).alias("taken_out"), same(v["a"], v["b"]).alias("same")).first()
    assert got.put_in and got.taken_out and not got.same


def test_edited_texts_and_likeness(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    for i, (d, text) in enumerate(rows):
        other = rows[(i + 1) % len(rows)][1]
        k = len(text) // 2
        edited = text[: len(text) - k] + other[:k]
        assert got[d].n_chars == len(text) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    prints = {}
    for d, text in rows:
        assert prints.setdefault(text, got[d].fingerprint) == got[d].fingerprint
    assert np.mean([r.near_edited for r in got.values()]) > 0.4 > 0.2 > np.mean([r.near_next for r in got.values()])


def test_fingerprint_edges(spark, edge, empty, edge_rows):
    rows = fingerprints.fingerprints(edge).collect()
    assert len(rows) == len(edge_rows)
    assert len({r.fingerprint for r in rows if r.doc_id in (1, 6)}) == 1
    assert fingerprints.fingerprints(empty).count() == 0
    alone = fingerprints.fingerprints(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and alone.near_next == 1.0
