"""Ranks, multiple-testing correction and tail probabilities as window and column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from helixframe.functions.sequence import let

# Coefficients of the Abramowitz-Stegun approximation 7.1.26 of erf, |error| <= 1.5e-7.
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def clamp(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def erf(x: Column) -> Column:
    t = 1.0 / (1.0 + F.lit(ERF_P) * F.abs(x))
    poly = reduce(lambda acc, a: acc * t + F.lit(a), reversed(ERF_A[:-1]), F.lit(ERF_A[-1])) * t
    return F.signum(x) * (1.0 - poly * F.exp(-x * x))


def normal_cdf(z: Column) -> Column:
    return 0.5 * (1.0 + erf(z / F.lit(2.0**0.5)))


def chi_square_1_survival(statistic: Column) -> Column:
    """P(X > statistic) for one degree of freedom."""
    return F.when(statistic <= 0, 1.0).otherwise(1.0 - erf(F.sqrt(statistic / 2.0)))


#: Ranges of distinct values that a ranking over a whole table is dealt to.
RANGES = 64


def _before(distinct: DataFrame, by: list[str], value: str) -> DataFrame:
    """Distinct values (by, value, rank_size) with rank_range, and the rows before them and of all as rank_before and rank_total. Nulls come first.

    Values are dealt to ranges, of which only the sizes meet in one task: RANGES rows at most for each of `by`.
    """
    bounds = F.percentile_approx(F.col(value), F.array(*[F.lit(k / RANGES) for k in range(1, RANGES)]), 1000)
    dealt = distinct.join(F.broadcast(distinct.groupBy(*by).agg(bounds.alias("rank_bounds"))), by) if by else distinct.crossJoin(F.broadcast(distinct.agg(bounds.alias("rank_bounds"))))
    dealt = dealt.withColumn("rank_range", F.coalesce(F.size(F.filter("rank_bounds", lambda x: x < F.col(value))), F.lit(0))).drop("rank_bounds")
    past = lambda over: F.coalesce(F.sum("rank_size").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = dealt.groupBy(*by, "rank_range").agg(F.sum("rank_size").alias("rank_size"))
    sizes = sizes.select(*by, "rank_range", past(Window.partitionBy(*by).orderBy("rank_range")).alias("range_before"), F.sum("rank_size").over(Window.partitionBy(*by)).alias("rank_total"))
    placed = dealt.withColumn("rank_before", past(Window.partitionBy(*by, "rank_range").orderBy(value))).join(sizes, [*by, "rank_range"])
    return placed.withColumn("rank_before", F.col("rank_before") + F.col("range_before")).drop("range_before")


def average_ranks(df: DataFrame, orders: dict[str, tuple[Column, bool]], total: str | None = None) -> DataFrame:
    """Add ranks over the whole table, ties sharing the mean of their places, and if named the number of rows. orders: by name, a value and whether it ranks in descending order.

    Distinct values are counted first, those of all orders in one pass, and ranked by their counts; rows then take the rank
    of their value. So a value that most rows have is one row of the ranking.
    """
    values = {out: (-v if down else v).cast("double") for out, (v, down) in orders.items()}
    keyed = df.withColumns({f"{out}_value": v for out, v in values.items()})
    pairs = F.array(*[F.struct(F.lit(out).alias("rank_of"), F.col(f"{out}_value").alias("rank_value")) for out in values])
    distinct = keyed.select(F.explode(pairs).alias("x")).groupBy("x.rank_of", "x.rank_value").agg(F.count("*").alias("rank_size"))
    ranks = _before(distinct, ["rank_of"], "rank_value")
    out = keyed
    for k, name in enumerate(values):
        own = ranks.where(F.col("rank_of") == name).select(F.col("rank_value").alias("rank_key"), (F.col("rank_before") + (F.col("rank_size") + 1) / 2.0).alias(name), *([F.col("rank_total").alias(total)] if total and not k else []))
        out = out.join(own, F.col(f"{name}_value").eqNullSafe(F.col("rank_key"))).drop(f"{name}_value", "rank_key")
    return out


def rank_product(ranks: list[Column], n: Column) -> Column:
    """Product of the ranks over n to the number of layers."""
    return reduce(lambda a, b: a * b, [r / n for r in ranks])


def rank_product_p(product: Column, layers: Column | int) -> Column:
    """Normal approximation to the log of a rank product, clamped to [1e-15, 1]."""
    k = layers if isinstance(layers, Column) else F.lit(float(layers))
    return clamp(normal_cdf((F.log(product) + k) / F.sqrt(k)), 1e-15, 1.0)


def _grouped(df: DataFrame, by: list[str], value: Column) -> DataFrame:
    """Distinct non-null values and their counts, of each group: (rank_group, rank_value, rank_size). A struct of group columns compares equal where both are null."""
    return df.where(value.isNotNull()).groupBy(F.struct(F.lit(0), *by).alias("rank_group"), value.alias("rank_value")).agg(F.count("*").alias("rank_size"))


def benjamini_hochberg(df: DataFrame, p: str, out: str, by: list[str] | None = None) -> DataFrame:
    """Add q values of p within groups: p * m / rank, running minimum from the largest p, at most 1. Null p stays null.

    Equal p have equal q, that of the last of them, so it is worked out over distinct p and their counts, dealt to ranges of p.
    """
    by, key = by or [], ["rank_group"]
    raw = _before(_grouped(df, by, F.col(p)), key, "rank_value").withColumn("rank_q", F.col("rank_value") * F.col("rank_total") / (F.col("rank_before") + F.col("rank_size")))
    per = Window.partitionBy(*key)
    later = raw.groupBy(*key, "rank_range").agg(F.min("rank_q").alias("least")).select(*key, "rank_range", F.min("least").over(per.orderBy(F.desc("rank_range")).rowsBetween(Window.unboundedPreceding, -1)).alias("rank_later"))
    running = F.min("rank_q").over(Window.partitionBy(*key, "rank_range").orderBy(F.desc("rank_value")).rowsBetween(Window.unboundedPreceding, 0))
    qs = raw.withColumn("rank_q", running).join(later, [*key, "rank_range"]).select(*key, "rank_value", F.least(F.lit(1.0), F.col("rank_q"), F.col("rank_later")).alias(out))
    return df.join(qs, (F.col(p) == F.col("rank_value")) & (F.struct(F.lit(0), *by) == F.col("rank_group")), "left").drop("rank_value", "rank_group")


def exact_percentiles(df: DataFrame, value: str, shares: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """AG6: interpolated percentiles of each group, by name; exact, without a group's values in one buffer.

    Distinct values are counted, dealt to ranges and numbered by their counts; a percentile then picks the one or two
    values that lie at its place. Nulls don't count; a group of nulls alone has null percentiles.
    """
    by = by or []
    placed = _before(_grouped(df, by, F.col(value)), ["rank_group"], "rank_value")
    first, last = F.col("rank_before"), F.col("rank_before") + F.col("rank_size")
    picks = []
    for name, share in shares.items():
        at = F.lit(share) * (F.col("rank_total") - 1)
        for side, place in (("low", F.floor(at)), ("high", F.ceil(at))):
            picks.append(F.max(F.when((first <= place) & (place < last), F.col("rank_value"))).alias(f"{name}_{side}"))
    found = placed.groupBy("rank_group").agg(F.max("rank_total").alias("rank_total"), *picks)

    def between(name: str, share: float) -> Column:
        at = F.lit(share) * (F.col("rank_total") - 1)
        low, high = F.floor(at), F.ceil(at)
        return F.when(low == high, F.col(f"{name}_low").cast("double")).otherwise((high - at) * F.col(f"{name}_low") + (at - low) * F.col(f"{name}_high"))

    values = found.select("rank_group", *[between(n, x).alias(n) for n, x in shares.items()])
    groups = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    return groups.join(values, F.struct(F.lit(0), *by) == F.col("rank_group"), "left").select(*by, *shares)


def min_max(value: Column, by: WindowSpec, higher_is_better: bool = True) -> Column:
    """(0, 1) within a group; a constant group gets 0.5."""
    low, high = F.min(value).over(by), F.max(value).over(by)
    scaled = (value - low) if higher_is_better else (high - value)
    return F.when(high == low, 0.5).otherwise(scaled / (high - low))


def log10_hypergeometric_tail(k: Column, big_k: Column, n: Column, big_n: Column, log_factorials: Column) -> Column:
    """log10 P(X >= k) for n draws from big_n with big_k marked, floored at -300; NaN where more are drawn or marked than there are.

    log_factorials: array with ln(i!) at position i (from 0).
    """
    lf = lambda x: F.get(log_factorials, x.cast("int"))
    choose = lambda a, b: lf(a) - lf(b) - lf(a - b)
    top = F.least(big_k, n)
    terms = F.transform(
        F.sequence(k.cast("int"), top.cast("int")),
        lambda i: F.when((n - i <= big_n - big_k), choose(big_k, i) + choose(big_n - big_k, n - i) - choose(big_n, n)),
    )
    add = lambda ts, most: F.aggregate(ts, F.lit(0.0), lambda a, t: a + F.coalesce(F.exp(t - most), F.lit(0.0)))
    total = let(terms, lambda ts: let(F.array_max(ts), lambda most: most + F.log(add(ts, most))))
    found = F.when(k > top, -300.0).otherwise(total / F.lit(2.302585092994046))
    undefined = (n > big_n) | (big_k > big_n)
    return F.when(undefined, float("nan")).when(k <= 0, 0.0).otherwise(F.greatest(F.lit(-300.0), F.coalesce(found, F.lit(-300.0))))


def log_factorials(spark: SparkSession, top: int) -> DataFrame:
    """One row: lf, the array of ln(i!) for i from 0 to top, as prefix sums."""
    sums = spark.range(1, top + 1).select("id", F.sum(F.log(F.col("id").cast("double"))).over(Window.orderBy("id")).alias("s"))
    listed = sums.agg(F.array_sort(F.collect_list(F.struct("id", "s"))).alias("all"))
    return listed.select(F.concat(F.array(F.lit(0.0)), F.transform("all", lambda x: x["s"])).alias("lf"))
