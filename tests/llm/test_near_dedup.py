import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.llm import near_dedup

WORDS = "amber birch cedar delta ember frost grove heath inlet jetty knoll larch marsh north ocean plain quay ridge shore trail upper vale wharf yield zebra".split()


def brute(rows, percent=85):
    """(doc_id -> (n_shingles, component))."""
    sets = {}
    for d, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
        sets[d] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def edited(rng, words, n):
    out = list(words)
    for i in rng.choice(len(out), n, replace=False):
        out[i] = f"new{rng.integers(1 << 30)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus():
    """Chains and groups of near copies around the threshold, with copies, short and empty texts."""
    rng = np.random.default_rng(5)
    rows, d = [], 100
    for _ in range(12):
        base = rng.choice(WORDS, 150).tolist()
        words = base
        for _ in range(12):
            rows.append((d, edited(rng, base, int(rng.integers(0, 8)))))
            words = edited(rng, words, int(rng.integers(0, 3))).split()
            rows.append((d + 1, " ".join(words)))
            d += 2
    rows += [(d, rows[0][1]), (d + 1, rows[0][1].upper()), (d + 2, ""), (d + 3, None), (d + 4, "one two"), (d + 5, "ONE  two\n"), (d + 6, "one two three four five")]
    rng.shuffle(rows)
    return [(int(a), b) for a, b in rows]


def test_equals_brute_force(spark, corpus):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_groups(spark.createDataFrame(corpus, "doc_id long, text string")).collect()}
    assert got == brute(corpus)


def test_lower_threshold(spark, corpus):
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(spark.createDataFrame(corpus, "doc_id long, text string"), 80).collect()}
    assert got == {d: c for d, (_, c) in brute(corpus, 80).items()}


def test_estimate_is_close(spark):
    times, plus = near_dedup._permutations()
    rng = np.random.default_rng(2)
    rows = []
    for share in (0.3, 0.6, 0.85, 0.95):
        for _ in range(20):
            n = int(1000 * share)
            common, a, b = rng.integers(0, 1 << 63, n, np.uint64), *(rng.integers(0, 1 << 63, (1000 - n) // 2, np.uint64) for _ in "ab")
            sig = lambda x: near_dedup.signature(np.unique(np.concatenate([common, x])), times, plus)[1].tolist()  # noqa: E731, B023
            rows.append((n / (n + 2 * ((1000 - n) // 2)), sig(a), sig(b)))
    df = spark.createDataFrame(rows, "truth double, a array<long>, b array<long>")
    got = df.select("truth", near_dedup.estimated_similarity(F.col("a"), F.col("b")).alias("e")).collect()
    assert max(abs(r.e - r.truth) for r in got) < 0.17 and abs(np.mean([r.e - r.truth for r in got])) < 0.02


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(200, 100), (100, 150)], "a long, b long")
    got = {r.node: r.component for r in near_dedup.components(links).collect()}
    assert all(got[i] == 1 for i in range(2, 61)) and got[200] == got[150] == 100


def test_edges(edge, empty, edge_rows):
    rows = near_dedup.near_groups(edge).collect()
    assert len(rows) == len(edge_rows)
    of = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert of[6].component_id == 1 and not of[6].kept and of[1].kept
    assert of[2].n_shingles == of[3].n_shingles == of[4].n_shingles == 0 and of[4].component_id == 4
    assert all(r.component_id is None for r in rows if r.doc_id is None)
    assert near_dedup.near_groups(empty).count() == 0
