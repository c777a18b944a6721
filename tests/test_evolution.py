"""Parsimony, permutation and enrichment against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from helixframe.plans import evolution as E


def pruned(tree, keep):
    """The tree over some leaves; inner nodes with one child go."""
    below = {}
    for i, (_, parent) in enumerate(tree):
        below.setdefault(parent, []).append(i)
    out = []

    def lives(i):
        return any(map(lives, below[i])) if i in below else tree[i][0] in keep

    def add(i, parent):
        kids = [c for c in below.get(i, []) if lives(c)]
        if len(kids) == 1:
            return add(kids[0], parent)
        out.append((tree[i][0], parent))
        own = len(out) - 1
        for c in kids:
            add(c, own)

    if lives(0):
        add(0, -1)
    return out


def fitch(tree, states):
    """Fitch's algorithm on the pruned tree with sets of letters."""
    small = pruned(tree, frozenset(states))
    leaves = {i for i in range(len(small))} - {p for _, p in small}
    if len(leaves) < 3:
        return {}
    sets = [set() for _ in small]
    for i in reversed(range(len(small))):
        if i in leaves:
            sets[i] = {states[small[i][0]]} - {"-"}
        else:
            below = [sets[c] for c, (_, p) in enumerate(small) if p == i and sets[c]]
            sets[i] = (set.intersection(*below) or set.union(*below)) if below else set()
    chosen = []
    for i, (_, parent) in enumerate(small):
        above = chosen[parent] if parent >= 0 else "-"
        chosen.append(above if above in sets[i] else min(sets[i]) if sets[i] else above)
    return {small[i][0]: chosen[small[i][1]] for i in leaves if small[i][1] >= 0}


def native(spark, tree, cases):
    rows = spark.createDataFrame([(k, list(c.items())) for k, c in enumerate(cases)], "k int, states array<struct<species:string,a:string>>")
    states = F.map_from_entries(F.transform("states", lambda s: F.struct(s["species"], E.state_bit(s["a"]))))
    found = rows.select("k", E.fitch_parents(states, tree).alias("p"))
    assert "Python" not in found._jdf.queryExecution().toString()
    named = found.select("k", F.transform("p", lambda p: F.struct(p["species"], E.bit_state(p["parent"]))).alias("p"))
    return {r.k: {s: a for s, a in r.p} for r in named.collect()}


def test_newick():
    tree = E.parse_newick("((a:1,b:2)x:0.5,(c,d)y)r;")
    assert [n for n, _ in tree] == ["r", "x", "a", "b", "y", "c", "d"] and [p for _, p in tree] == [-1, 0, 1, 1, 0, 4, 4]
    assert pruned(tree, frozenset("acd")) == [("r", -1), ("a", 0), ("y", 0), ("c", 2), ("d", 2)]


def test_fitch(spark):
    tree = E.parse_newick("((a,b),(c,d));")
    got = native(spark, tree, [{"a": "K", "b": "K", "c": "R", "d": "K"}, {"a": "V", "b": "A", "c": "A", "d": "-"}, {"a": "K", "b": "R"}, {}])
    assert got[0] == {"a": "K", "b": "K", "c": "K", "d": "K"} and got[1]["a"] == "A" and got[2] == got[3] == {}


def test_fitch_equals_sets_of_letters_on_random_trees(spark):
    rng = random.Random(9)

    def grown(names):
        """A random tree with nodes of one to four children."""
        if len(names) == 1:
            return names[0] if rng.random() < 0.8 else f"({names[0]})"
        cuts = sorted(rng.sample(range(1, len(names)), min(len(names) - 1, rng.randint(1, 3))))
        return "(" + ",".join(grown(names[a:b]) for a, b in zip([0, *cuts], [*cuts, len(names)], strict=True)) + ")"

    for size in (3, 5, 9, 18):
        names = [f"s{i}" for i in range(size)]
        tree = E.parse_newick(grown(names) + ";")
        cases = [{s: rng.choice("KRDE-") for s in rng.sample(names, rng.randint(0, size))} for _ in range(60)]
        got = native(spark, tree, cases)
        assert all(got[k] == fitch(tree, c) for k, c in enumerate(cases))


def test_convergent_positions(spark):
    rows = [
        (1, "g", 0, "AAK", "AAD", "s1", "Rodents"), (2, "g", 0, "AAK", "AAE", "s2", "Bats"), (3, "g", 0, "AAK", "AAW", "s3", "Birds"),
        (4, "g", 1, "AK", "AD", "s4", "Primates"), (5, "h", 0, "K", "D", "s1", "Rodents"), (6, "g", 2, "K", "-", "s5", "Sharks"),
    ]
    df = spark.createDataFrame(rows, "motif long, gene string, start int, human string, animal string, species string, lineage string")
    got = {r.motif: r.convergent_aa for r in E.convergent_positions(df).collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 2, 5: 0, 6: 2}
    with_tree = {r.motif: r.convergent_aa for r in E.convergent_positions(df, "((s1,s2),(s3,s4));").collect()}
    parents = fitch(E.parse_newick("((s1,s2),(s3,s4));"), {"s1": "D", "s2": "E", "s3": "W"})
    independent = [s for s, aa in (("s1", "D"), ("s2", "E"), ("s3", "W")) if parents[s] != aa]
    assert with_tree[1] == (len([s for s in independent if s != "s3"]) if len(independent) >= 2 else 0)


def test_convergence_takes_the_first_best_window(spark):
    rows = [("g", 5, "a", "Rodents"), ("g", 5, "b", "Bats"), ("g", 2, "a", "Rodents"), ("g", 2, "c", "Birds"), ("g", 9, "x", "Primates"), ("h", 1, "x", "Primates")]
    got = {r.gene: r for r in E.convergence(spark.createDataFrame(rows, "gene string, start int, species string, lineage string")).collect()}
    assert got["g"].start == 2 and got["g"].n == 2 and got["h"].n == 0 and got["h"].weight == 0.0


def test_permutation_equals_python(spark):
    lineages = {f"s{i}": l for i, l in enumerate(["Rodents", "Bats", "Birds", "Primates", "Bats", "Sharks"])}
    motifs = spark.createDataFrame([("g", 1, s, lineages[s]) for s in ("s0", "s1", "s3")] + [("h", 1, "s3", "Primates")], "gene string, start int, species string, lineage string")
    got = {r.gene: r.p for r in E.permutation_p(E.convergence(motifs), E.shuffled_labels(spark, lineages, 200, 42)).collect()}
    rng, names, labels, hits = random.Random(42), list(lineages), list(lineages.values()), 0
    for _ in range(200):
        rng.shuffle(labels)
        dealt = dict(zip(names, labels, strict=True))
        hits += len({dealt[s] for s in ("s0", "s1", "s3")} - {"Primates"}) >= 2
    assert got["g"] == pytest.approx(hits / 200) and got["h"] == 1.0
    parts = {r.gene: r.p for r in E.permutation_p(E.convergence(motifs), E.shuffled_labels(spark, lineages, 200, 42), most=6 * 70).collect()}
    assert parts == got  # in three stretches


def test_proxy_and_branches(spark):
    pairs = spark.createDataFrame([("o", "AC-DE", "AW-DE"), ("o", "ACDE", "ACDE")], "og string, a string, b string")
    r = E.divergence_proxy(pairs).first()
    assert r.omega == pytest.approx(0.125 / 0.15) and r.p == pytest.approx(1 - 0.125 / 0.3)
    m = spark.createDataFrame([("o", {"a": 2.0, "b": 0.5, "c": 3.0})], "og string, omegas map<string,double>")
    assert E.meme_branches(m, F.array(F.lit("a"), F.lit("b"))).first().branches == ["a"]


def test_permutation_query_deals_a_thousand(spark, sf_dir):
    import hashlib

    from helixframe.plans import biology

    motifs = biology._motifs(spark, sf_dir)
    lineages = dict(sorted({(r.species, r.lineage) for r in motifs.select("species", "lineage").distinct().collect()}))
    best = E.convergence(motifs, E.distance_map(biology._FAR)).select("gene", "n", "species").collect()
    labels = []
    for i in range(1000):
        order = sorted(lineages, key=lambda s: hashlib.md5(f"{i}{s}".encode()).hexdigest())
        labels.append(dict(zip(order, lineages.values(), strict=True)))
    want = {r.gene: 1.0 if r.n < 1 else round(sum(len({x[s] for s in r.species}) >= r.n for x in labels) / 1000, 4) for r in best}
    got = {r.gene: r.p for r in biology.permutation_p(spark, sf_dir).collect()}
    assert got == want
    assert any(round(p * 1000) % 50 for p in got.values())


def test_permutation_with_many_lineages_and_columns_of_states(spark):
    lineages = {f"s{i}": f"l{i % 100}" for i in range(150)}
    motifs = spark.createDataFrame([("g", 1, s, lineages[s]) for s in list(lineages)[:90]], "gene string, start int, species string, lineage string")
    rng, labels, hits = random.Random(42), list(lineages.values()), 0
    for _ in range(20):
        rng.shuffle(labels)
        hits += len(set(labels[:90])) >= 60
    best = E.convergence(motifs).withColumn("n", F.lit(60))
    assert E.permutation_p(best, E.shuffled_labels(spark, lineages, 20, 42)).first().p == pytest.approx(hits / 20)


def test_permutation_brings_no_labels_to_the_driver(spark, monkeypatch):
    species = spark.createDataFrame([(f"s{i}", f"l{i % 5}") for i in range(40)], "species string, lineage string")
    best = spark.createDataFrame([(k, 1 + k % 5, [f"s{(7 * k + j) % 40}" for j in range(1 + k % 6)]) for k in range(50)], "gene long, n int, species array<string>")
    want = {}
    dealt = [dict(zip(sorted((f"s{i}" for i in range(40)), key=lambda s: hashlib.md5(f"{i}{s}".encode()).hexdigest()), [f"l{int(s[1:]) % 5}" for s in sorted(f"s{i}" for i in range(40))], strict=True)) for i in range(30)]
    for r in best.collect():
        want[r.gene] = round(sum(len({x[s] for s in r.species}) >= r.n for x in dealt) / 30, 4)

    def refuse(*_):
        raise AssertionError("labels go through the driver")

    for place, name in ((type(spark.sparkContext), "broadcast"), (type(best), "toArrow"), (type(best), "collect"), (type(best), "first")):
        monkeypatch.setattr(place, name, refuse)
    spark.sparkContext.setJobGroup("permutation_p built", "")
    built = E.permutation_p(best, E.hashed_labels(species, 30))
    spark.sparkContext.setJobGroup("others", "")
    monkeypatch.undo()
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("permutation_p built")
    assert {r.gene: r.p for r in built.collect()} == want and len(set(want.values())) > 5


def test_permutation_of_labels_in_pieces(spark):
    rng = random.Random(3)
    rows = [(i, f"s{k}", rng.choice([f"l{rng.randrange(400)}", f"l{rng.randrange(3)}", "Primates", None])) for i in range(-3, 37) for k in range(60) if rng.random() < 0.9]
    rng.shuffle(rows)
    labels = spark.createDataFrame(rows, "iteration int, species string, lineage string").repartition(5)
    windows = [(k, rng.randrange(9), [f"s{rng.randrange(64)}" for _ in range(rng.randrange(12))]) for k in range(80)] + [(80, 1, None), (81, 0, None), (82, 1, []), (83, 40, [f"s{k}" for k in range(60)])]
    best = spark.createDataFrame(windows, "gene long, n int, species array<string>")
    dealt = {}
    for i, s, lineage in rows:
        dealt.setdefault(i, {})[s] = lineage
    want = {g: 1.0 if n < 1 else round(sum(len({x.get(s) for s in species or []} - {"Primates", None}) >= n for x in dealt.values()) / 40, 4) for g, n, species in windows}
    for most in (70, 2_000_000):
        assert {r.gene: r.p for r in E.permutation_p(best, labels, most).collect()} == want
    assert {r.p for r in E.permutation_p(best, labels.where("iteration > 99")).collect()} == {1.0}


def test_states_in_columns_equal_states_in_arrays(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(k, f"g{k % 3}", rng.randrange(3), "AKDW", "".join(rng.choice("AKDRVW-") for _ in range(4)), f"s{rng.randrange(7)}", f"l{k % 4}") for k in range(120)] + [(999, "g0", 0, "", "", "s1", "l1")]
    df = spark.createDataFrame(rows, "motif int, gene string, start int, human string, animal string, species string, lineage string")
    tree = "((s0,(s1,s2)),((s3,s4),s5));"
    columns = sorted(map(tuple, E.convergent_positions(df, tree).collect()))
    monkeypatch.setattr(E, "COLUMN_NODES", 0)
    assert columns == sorted(map(tuple, E.convergent_positions(df, tree).collect())) and len(columns) == 121 and any(n for _, n in columns)
