"""Scores and statistics against plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.functions import scores as S
from helixframe.functions import stats
from helixframe.plans import evolution as E


def value(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


@pytest.mark.parametrize(("count", "weight", "want"), [(None, None, 0.0), (0, None, 0.0), (2, None, 0.5), (5, None, round(1 / (1 + math.exp(-4.5)), 4)), (1, 20.46, 1.0), (1, 10.23, 0.5), (1, 99.0, 1.0)])
def test_convergence(spark, count, weight, want):
    assert value(spark, S.convergence(F.lit(count).cast("int"), F.lit(weight).cast("double"))) == want


def test_selection(spark):
    none = F.array().cast("array<string>")
    score = lambda model, w, p, fel=None, busted=None, k=None, kp=None: value(spark, S.selection(F.lit(model), *[F.lit(x).cast("double") for x in (w, p, fel, busted, k, kp)], none, none))
    assert score("paml_branch_site", 5.0, 1e-10) == pytest.approx(1.0)
    assert score("paml_branch_site", 0.9, 1e-10) == 0.0 and score("paml_branch_site", 5.0, None) == 0.0
    assert score("aBSREL", 5.0, 1e-4) == pytest.approx(0.65 * 0.4)
    assert score("aBSREL", 5.0, 1e-4, 10, 1e-10, 3.0, 1e-10) == pytest.approx(0.35 + 0.30 + 0.25 * 0.4 + 0.10)
    assert score("meme", 5.0, 0.0) == pytest.approx(1.0)


def test_safety_and_disease(spark):
    no, N = F.lit(False), F.lit(None).cast("double")  # noqa: N806
    null = F.lit(None).cast("map<string,double>")
    assert value(spark, S.safety(no, no, no, N, N, N, N, null)) == 0.5
    assert value(spark, S.safety(F.lit(True), F.lit(True), F.lit(True), F.lit(150), F.lit(0.8), F.lit(50), F.lit(2000.0), null)) == 0.0
    assert value(spark, S.safety(F.lit(True), no, no, N, F.lit(0.6), F.lit(20), F.lit(600.0), null)) == pytest.approx(1 - 0.15 - 0.05 - 0.08)
    ids = lambda *x: F.array(*[F.lit(i) for i in x]).cast("array<string>")
    drug = lambda a, b: value(spark, S.disease(F.lit(True), N, N, N, N, F.lit(4), a, b, N, N))
    assert drug(ids("EFO_1"), ids("efo:1")) == 0.20 and drug(ids("EFO_1"), ids("EFO_2")) == 0.08 and drug(ids(), ids("EFO_2")) == 0.20
    assert value(spark, S.disease(no, F.lit(1.0), N, N, N, N, ids(), ids(), N, N)) == 0.0
    full = S.disease(F.lit(True), F.lit(1.0), F.lit(1e-20), F.lit(0.0), N, F.lit(4), ids(), ids(), F.lit(2), F.lit(1e-9))
    assert value(spark, full) == 1.0


def test_tiers_and_composites(spark):
    tier = lambda s, g=0.0: value(spark, S.tier(F.lit(s), F.lit(g)))
    assert [tier(0.70), tier(0.69), tier(0.40), tier(0.39), tier(0.7, 0.3), tier(0.2, 0.9)] == ["Tier1", "Tier2", "Tier2", "Tier3", "Validated", "Tier3"]
    weights = {"convergence": 0.5, "selection": 0.3, "disease": 0.2, "safety_floor": 0.2}
    comp = lambda c, s, d: value(spark, S.composite({"convergence": F.lit(c), "selection": F.lit(s), "disease": F.lit(d)}, weights))
    assert comp(1.0, 0.0, 0.0) == pytest.approx(0.625) and comp(1.0, 0.0, 0.5) == pytest.approx(0.6)
    assert value(spark, S.rank_product_tier(F.lit(0.01), F.lit(1))) == "Tier3"


def test_directions_contexts_stages(spark):
    direction = lambda a, e, u: value(spark, S.variant_direction(*[F.lit(x).cast("double") for x in (a, e, u)]))
    assert [direction(0.7, -3, None), direction(0.7, -3, 0.5), direction(0.7, -3, 0.2), direction(0.7, None, None), direction(None, -3, 0.9)] == ["functional_shift", "loss_of_function", "functional_shift", "gain_of_function", "neutral"]
    context = lambda f, a, d, x: value(spark, S.structural_context(F.lit(f).cast("string"), F.lit(a), F.lit(d), F.lit(x).cast("double")))
    assert [context("active_site", True, True, 1), context(None, True, True, 1), context(None, True, False, 1), context(None, False, False, 14), context("site", False, False, None)] == ["active_site", "disordered", "pocket_adjacent", "surface_near_pocket", "distal"]
    assert [value(spark, S.stage_number(F.lit(s))) for s in ("APPROVED", "PHASE_3B", "phase_1", "PHASE_9", "")] == [4, 3, 1, 0, 0]


def test_experiments(spark):
    context = {"knockdown": "K", "repurposing": "test {drug} now", "in_vivo": "V", "organoid": "O", "screening": "S", "assay": "A"}
    row = lambda pocket, drugs, aav: value(spark, S.experiment_recommendations(context, F.lit(pocket).cast("double"), F.array(*map(F.lit, drugs)).cast("array<string>"), F.lit(aav)))
    assert row(0.4, ["aspirin"], True) == ["K", "test aspirin now", "V"] and row(0.6, [], False)[1] == "S" and row(None, [], False)[1] == "A" and row(None, [], False)[2] == "O"


def test_phylogenetic_weight(spark):
    w = lambda *x: value(spark, S.phylogenetic_weight(F.array(*map(F.lit, x)), E.distance_map()))
    assert w("Rodents", "Bats") == pytest.approx(2 * math.log2(1.9)) and w("Rodents", "Primates") == 0.0
    assert w("Birds", "Rodents", "Sharks") == pytest.approx(3 * math.log2(1 + (100 + 450 + 450) / 300))


def test_erf_and_tails(spark):
    for z in (-3.0, -0.5, 0.0, 1.0, 2.5):
        assert value(spark, stats.normal_cdf(F.lit(z))) == pytest.approx(0.5 * (1 + math.erf(z / math.sqrt(2))), abs=2e-7)
    assert value(spark, stats.chi_square_1_survival(F.lit(3.841458820694124))) == pytest.approx(0.05, abs=1e-6)
    table = stats.log_factorials(spark, 200)
    tail = lambda k, big_k, n: table.select(stats.log10_hypergeometric_tail(F.lit(k), F.lit(big_k), F.lit(n), F.lit(200), F.col("lf")).alias("x")).first().x
    exact = lambda k, big_k, n: math.log10(sum(math.comb(big_k, i) * math.comb(200 - big_k, n - i) for i in range(k, min(big_k, n) + 1)) / math.comb(200, n))
    for args in ((3, 10, 20), (1, 5, 8), (5, 5, 90)):
        assert tail(*args) == pytest.approx(exact(*args), abs=1e-9)
    assert tail(0, 5, 5) == 0.0 and tail(9, 5, 5) == -300.0


def test_benjamini_hochberg(spark):
    rng = np.random.default_rng(0)
    ps = [*rng.random(50).round(2).tolist(), None, 0.0, 1.0]
    known = sorted((p, i) for i, p in enumerate(ps) if p is not None)
    want, low = dict.fromkeys(range(len(ps))), 1.0
    for rank in range(len(known), 0, -1):
        p, i = known[rank - 1]
        low = min(low, p * len(known) / rank)
        want[i] = low
    got = stats.benjamini_hochberg(spark.createDataFrame(list(enumerate(ps)), "i long, p double"), "p", "q").collect()
    assert all((r.q is None) == (want[r.i] is None) and (r.q is None or r.q == pytest.approx(want[r.i])) for r in got)


def test_average_ranks(spark):
    rows = [(1, 5.0), (2, 3.0), (3, 5.0), (4, 1.0)]
    got = stats.average_ranks(spark.createDataFrame(rows, "i long, v double"), {"r": (F.col("v"), False), "d": (F.col("v"), True)}).collect()
    assert {r.i: (r.r, r.d) for r in got} == {1: (3.5, 1.5), 2: (2.0, 3.0), 3: (3.5, 1.5), 4: (1.0, 4.0)}


def test_rankings_over_ties_are_dealt_evenly(spark):
    """Nearly all rows share one value: that value is one row of the ranking, and results are those of a plain one."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(5)
    p = np.where(rng.random(4000) < 0.95, 1.0, rng.random(4000).round(3))
    group = rng.integers(0, 3, 4000)
    df = spark.createDataFrame(pd.DataFrame({"i": np.arange(4000), "g": group, "p": p}))
    got = stats.average_ranks(df, {"up": (F.col("p"), False), "down": (F.col("p"), True)}, total="n").toPandas().sort_values("i")
    assert got.up.tolist() == pd.Series(p).rank().tolist() and got.down.tolist() == pd.Series(-p).rank().tolist() and set(got.n) == {4000}

    def q_of(p):
        order = np.argsort(p, kind="stable")
        raw = p[order] * len(p) / np.arange(1, len(p) + 1)
        out = np.empty(len(p))
        out[order] = np.minimum(1, np.minimum.accumulate(raw[::-1])[::-1])
        return out

    whole = stats.benjamini_hochberg(df, "p", "q").toPandas().sort_values("i")
    assert whole.q.to_numpy() == pytest.approx(q_of(p)) and list(whole.columns) == ["i", "g", "p", "q"]
    parts = stats.benjamini_hochberg(df, "p", "q", by=["g"]).toPandas().sort_values("i")
    for g in range(3):
        assert parts.q[parts.g == g].to_numpy() == pytest.approx(q_of(p[group == g]))


def test_exact_percentiles(spark):
    """As numpy has them, by group and over all, with ties, nulls, a null group, one value, and a group of nulls alone."""
    rng = np.random.default_rng(6)
    rows = [(None if g == 0 else f"g{g}", None if i % 11 == 0 else float(rng.integers(0, 40)) if g < 3 else float(rng.normal())) for g in range(5) for i in range(1, 200)] + [("one", 2.5), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    shares = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p73": 0.73, "p100": 1.0}
    got = {r.g: tuple(r)[1:] for r in stats.exact_percentiles(df, "v", shares, ["g"]).collect()}
    for g in {g for g, _ in rows}:
        values = [v for x, v in rows if x == g and v is not None]
        assert got[g] == (pytest.approx(tuple(np.quantile(values, list(shares.values())))) if values else (None,) * 5)
    assert tuple(stats.exact_percentiles(df, "v", shares).first()) == pytest.approx(tuple(np.quantile([v for _, v in rows if v is not None], list(shares.values()))))
    assert tuple(stats.exact_percentiles(df.where("false"), "v", {"p": 0.5}).first()) == (None,)
    q = {(r.g, r.v): r.q for r in stats.benjamini_hochberg(df.where("v > 0 AND v < 1"), "v", "q", by=["g"]).collect()}
    assert None not in q.values()


def test_tail_beyond_the_background(spark):
    table = stats.log_factorials(spark, 200)
    tail = lambda k, big_k, n: table.select(stats.log10_hypergeometric_tail(F.lit(k), F.lit(big_k), F.lit(n), F.lit(200), F.col("lf")).alias("x")).first().x
    assert math.isnan(tail(5, 50, 201)) and math.isnan(tail(5, 201, 50)) and tail(5, 200, 200) == 0.0
