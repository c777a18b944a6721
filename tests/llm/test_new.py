"""Repeated windows, Merkle manifests and source divergences against brute force and by cases."""

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.llm import divergence, merkle, substrings

H = lambda x: sha256(x.encode()).hexdigest()


@pytest.fixture(scope="module")
def passages(spark):
    """Passages of many lengths at many places of documents of invented words; some documents repeat themselves."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    shared = [[word() for _ in range(n)] for n in (34, 35, 36, 50, 120)]
    rows = []
    for i in range(120):
        words = [word() for _ in range(rng.choice([0, 5, 34, 35, 80, 200]))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(shared)
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words), "en", f"s{i % 7}"))
    rows += [(200, "spin " * 60, "en", "a"), (201, "no\x0bbreak\xa0here " * 30, "en", "a"), (202, None, "en", "a"), (203, "", None, None)]
    return rows


def without_repeats(texts, window):
    """Words that stay of each text, by comparing windows as tuples."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = {k for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for k in range(i, i + window)}
        out.append((len(w), len(gone), [x for k, x in enumerate(w) if k not in gone]))
    return out


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 900, "segment_bytes": 2000, "cell_bits": 20}, {"chunk_bytes": 1, "segment_bytes": 500, "cell_bits": 4}])
def test_repeated_windows_go_and_no_others(spark, passages, sizes):
    """Also where a document is a chunk, and where the sketch is so small that it takes all windows for repeated."""
    docs = spark.createDataFrame(passages, "doc_id long, text string, lang string, source string")
    got = {r.row.doc_id: r for r in substrings.dedup_windows(docs, **sizes).collect()}
    assert len(got) == len(passages)
    for (i, text, *_), (n, gone, kept) in zip(passages, without_repeats([r[1] for r in passages], 35), strict=True):
        assert (got[i].n_words, got[i].n_removed) == (n, gone)
        assert got[i].kept == (" ".join(kept) if gone else text)
        assert got[i].row.text == text


def test_sketch_estimates_are_never_too_low(spark, passages):
    """Every repeated window is a candidate; of the others, few are."""
    docs = spark.createDataFrame(passages, "doc_id long, text string, lang string, source string")
    chunks = substrings.chunked(docs, 3000)
    masks = substrings._merged(substrings._sketches(chunks, 3, 35, 20), 20)
    by_chunk = defaultdict(list)
    for r in masks.collect():
        by_chunk[r.chunk].append(r.asDict())
    words, seen, asked, every = substrings._Words(), Counter(), [], 0
    loaded = [(c.chunk, substrings.Chunk(substrings._read(substrings.pa.scalar(bytes(c.payload), substrings.pa.binary())), words)) for c in chunks.collect()]
    for _, chunk in loaded:
        seen.update(zip(*(h.tolist() for h in chunk.halves), strict=True))
    for number, chunk in loaded:
        at = set(substrings._candidates(chunk, by_chunk[number], 3, 20).tolist())
        ids = list(zip(*(h.tolist() for h in chunk.halves), strict=True))
        assert {k for k, x in enumerate(ids) if seen[x] > 1} <= at
        asked.append(sum(seen[ids[k]] == 1 for k in at))
        every += len(ids)
    assert sum(asked) < every / 50


def test_rolled_equals_horner():
    rng = np.random.default_rng(3)
    numbers = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    for width in (1, 2, 3, 7, 35, 64, 200):
        base = int(substrings._BASES[0])
        got = substrings.rolled(numbers, base, width)
        assert len(got) == 201 - width
        for i in (0, len(got) - 1):
            h = 0
            for x in numbers[i : i + width].tolist():
                h = (h * base + x) % (1 << 64)
            h = (h ^ (h >> 30)) * int(substrings._MIX) % (1 << 64)
            assert int(got[i]) == h ^ (h >> 31)
    assert len(substrings.rolled(numbers[:5], 3, 6)) == 0


def test_windows_of_edge_rows(spark, edge, edge_rows, empty):
    got = substrings.dedup_windows(edge).select("row.doc_id", "row.text", "row.kept", "n_removed", F.col("kept").alias("left")).collect()
    assert sorted(map(str, [r.text for r in got])) == sorted(str(r[1]) for r in edge_rows)
    long_one = next(r for r in got if r.doc_id == 5)
    assert long_one.n_removed == 33000 and long_one.left == ""  # the same eleven words over and over
    assert {r["kept"] for r in got} == {"clash"} and all(r.left == r.text for r in got if not r.n_removed)
    assert substrings.dedup_windows(empty).count() == 0


# --- Merkle ------------------------------------------------------------------------------------


def leaf(doc):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H("".join(map(part, doc)))


def climbed(nodes, fan):
    """The root of a list of digests, and the siblings of each, level by level."""
    proofs, holds = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = range(0, len(nodes), fan)
        for a in runs:
            for k in range(a, min(a + fan, len(nodes))):
                for i in holds[k]:
                    proofs[i].append(("".join(nodes[a:k]), "".join(nodes[k + 1 : a + fan])))
        holds = [[i for k in holds[a : a + fan] for i in k] for a in runs]
        nodes = [H("".join(nodes[a : a + fan])) for a in runs]
    return nodes[0], proofs


@pytest.mark.parametrize(("fan", "levels"), [(16, 3), (2, 1), (2, 2), (3, 2)])
def test_manifest_equals_climbing_level_by_level(spark, fan, levels):
    rng = random.Random(fan)
    rows = [(rng.randint(0, 400) if i % 50 else None, rng.choice(["a", "a", "a", "b", "", None, "z", "é"]), "en" if i % 9 else None, i if i % 4 else None, f"Text {i % 30}" if i % 11 else None) for i in range(300)]
    rows += [(7, "lone", None, None, None)] + [(5, "a", "en", 1, "same")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = merkle.manifest(docs, fan=fan, levels=levels).collect()
    assert len(got) == len(rows)
    trees = defaultdict(list)
    for r in rows:
        trees[r[1]].append((r[0] is not None, r[0] or 0, leaf(r)))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    subroots = {s: climbed([x[2] for x in sorted(trees[s])], fan) for s in order}
    root, tops = climbed([subroots[s][0] for s in order], fan)
    want = Counter((x[2], subroots[s][0], root, tuple(own + top)) for s, top in zip(order, tops, strict=True) for x, own in zip(sorted(trees[s]), subroots[s][1], strict=True))
    assert Counter((r.leaf, r.subroot, r.root, tuple((p.left, p.right) for p in r.proof)) for r in got) == want
    folded = merkle.manifest(docs, fan=fan, levels=levels).select(merkle.folded_root(F.col("leaf"), F.col("proof")).alias("f"), "root")
    assert folded.where("f <> root").count() == 0


def test_manifest_query_sees_tampering(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in merkle.op12_merkle_manifest(spark, sf_dir).collect():
        text = docs[r.doc_id].text
        lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 5 > 0 or lowered == (text or ""))


def test_manifest_of_edge_rows(spark, edge, empty):
    got = merkle.manifest(edge.withColumn("n_chars", F.lit(None).cast("long")).withColumn("tree", F.lit("clash"))).collect()
    assert len(got) == edge.count() and len({r.root for r in got}) == 1
    assert merkle.manifest(empty.withColumn("n_chars", F.lit(None).cast("long"))).count() == 0


# --- divergences -------------------------------------------------------------------------------


def divergences(rows, least, top):
    """Straight from the definition: every term of every pair."""
    said, langs, having = defaultdict(Counter), defaultdict(set), defaultdict(lambda: defaultdict(int))
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        said[lang, source].update(terms)
        langs[lang].add(source)
        for t in set(terms):
            having[lang][t] += 1
    out = set()
    for lang, sources in langs.items():
        kept = [t for t, n in having[lang].items() if n >= least]
        share = lambda c, lang=lang, kept=kept: {t: 1 + 1000000000 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}
        p = {s: share(said[lang, s]) for s in sources}
        q = share(sum((said[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) * (a - b) // b
        for s in sources:
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(f(p[s][t], q[t]), t) for t in kept if said[lang, s][t] and p[s][t] > q[t]]
            for part, values, most in (("pair", pair, None), ("term", term, top)):
                ranked = sorted(values, key=lambda v: (-v[0], v[1].encode()))[:most]
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)}
    return out


@pytest.mark.parametrize(("least", "top"), [(3, 200), (1, 4), (1000, 5)])
def test_divergences_equal_brute_force(spark, least, top):
    rng = random.Random(least)
    vocabulary = ["Alpha", "ALPHA", "beta", "gamma's", "naïve", "ÉTÉ", "été", "x1y", "日本", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))]
    rows = [(" ".join(rng.choices(vocabulary, k=rng.randint(0, 30))) if i % 13 else None, rng.choice(["en", "en", "de", "", None]), rng.choice(["a", "a", "a", "b", "c", "", None, "é"])) for i in range(150)]
    rows += [("", "fr", "only"), ("123 ...", "it", "x"), (None, "it", "y")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = {tuple(r) for r in divergence.source_divergences(docs, least, top).select("lang", "source", "part", "item", "value", "rank").collect()}
    assert got == divergences(rows, least, top)


def test_tasks_pass_terms_on_early(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    few, many = (divergence.count_terms(docs, held) for held in (10, 1_000_000))
    assert few.exceptAll(many).count() == 0 and many.exceptAll(few).count() == 0


def test_divergences_of_edge_rows(spark, edge, edge_rows, empty):
    got = {tuple(r) for r in divergence.source_divergences(edge.withColumn("rank", F.lit("clash"))).collect()}
    assert got == divergences([r[1:4] for r in edge_rows], 3, 200)
    assert divergence.source_divergences(empty).count() == 0
