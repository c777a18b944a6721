"""Relational queries over the star tables: filters, joins, aggregates, rankings, sets.

Parts stand for genes, suppliers for species, their regions for lineages, and line items for motifs
(position l_linenumber, divergence l_discount). Each query has its SQL beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.functions.stats import average_ranks, benjamini_hochberg, exact_percentiles, min_max, rank_product, rank_product_p
from helixframe.operators.relational import (
    dealt_once,
    dedup_first,
    duplicate_keys,
    half_open_bins,
    overlap_join,
    share_of_total,
    symmetric_lookup,
    tasks_for,
    top_per_key,
)

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in names]


# --- filters -----------------------------------------------------------------------------------


@query("SELECT p_partkey, p_brand, p_type, p_retailprice FROM part WHERE p_brand = 'Brand#11' AND p_retailprice >= 900 OR p_size IS NULL")
def filter_dynamic(spark, sf_dir):
    """FLT1, FLT13."""
    part = table(spark, sf_dir, "part")
    keep = (F.col("p_brand") == "Brand#11") & (F.col("p_retailprice") >= 900) | F.col("p_size").isNull()
    return part.where(keep).select("p_partkey", "p_brand", "p_type", "p_retailprice")


@query("SELECT p_partkey, list_contains(string_split(p_type, ' '), 'STEEL') AS is_steel FROM part WHERE list_contains(string_split(p_type, ' '), 'STEEL') OR list_contains(string_split(p_type, ' '), 'SMALL')")
def filter_array_membership(spark, sf_dir):
    """FLT2, SRC4: membership in an array column."""
    words = F.split("p_type", " ")
    steel, small = F.array_contains(words, "STEEL"), F.array_contains(words, "SMALL")
    return table(spark, sf_dir, "part").where(steel | small).select("p_partkey", steel.alias("is_steel"))


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%re%' OR p_brand ILIKE '%re%' OR p_type ILIKE '%re%' ORDER BY p_partkey LIMIT 50")
def search_ilike(spark, sf_dir):
    """FLT3: case-insensitive search of three columns, first 50."""
    part = table(spark, sf_dir, "part")
    hit = F.col("p_name").ilike("%re%") | F.col("p_brand").ilike("%re%") | F.col("p_type").ilike("%re%")
    return part.where(hit).orderBy("p_partkey").limit(50).select("p_partkey", "p_name")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND starts_with(o_orderstatus, 'F')")
def filter_in_distinct(spark, sf_dir):
    """FLT4, FLT9: IN list, prefix, distinct keys."""
    orders = table(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.startswith("o_orderstatus", F.lit("F"))).select("o_custkey").distinct()


@query("""
SELECT l_partkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
GROUP BY l_partkey HAVING count(DISTINCT CASE WHEN s_nationkey <> 0 THEN s_suppkey END) >= 2 AND max(CASE WHEN s_nationkey = 0 THEN 1 ELSE 0 END) = 1
""")
def filter_group_gate(spark, sf_dir):
    """FLT7, FLT11, SQ5, SQ8: groups with a reference member and at least two others."""
    line, supplier = tables(spark, sf_dir, "lineitem", "supplier")
    joined = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    other = F.when(F.col("s_nationkey") != 0, F.col("s_suppkey"))
    gates = joined.groupBy("l_partkey").agg(F.countDistinct(other).alias("others"), F.max(F.when(F.col("s_nationkey") == 0, 1).otherwise(0)).alias("reference"))
    return gates.where("others >= 2 AND reference = 1").select("l_partkey")


@query("""
SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (
  SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) = count(CASE WHEN l_returnflag <> 'N' THEN 1 END))
""")
def filter_resume(spark, sf_dir):
    """FLT8, AN18: keys that are not complete yet."""
    line, orders = tables(spark, sf_dir, "lineitem", "orders")
    done = line.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count(F.when(F.col("l_returnflag") != "N", 1)).alias("complete")).where("n = complete")
    return orders.join(done, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("SELECT event_id, coalesce(CASE WHEN value > 50 THEN value END, value / 2) AS af FROM events WHERE coalesce(CASE WHEN value > 50 THEN value END, value / 2) <= 60")
def filter_coalesced(spark, sf_dir):
    """FLT12: the first value present, at most a bound."""
    af = F.coalesce(F.when(F.col("value") > 50, F.col("value")), F.col("value") / 2)
    return table(spark, sf_dir, "events").select("event_id", af.alias("af")).where("af <= 60")


# --- joins -------------------------------------------------------------------------------------


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey AND o_orderstatus = 'O'")
def join_inner(spark, sf_dir):
    """JN1, JN9: inner join with a further predicate."""
    orders, customer = tables(spark, sf_dir, "orders", "customer")
    return orders.join(customer, (F.col("o_custkey") == F.col("c_custkey")) & (F.col("o_orderstatus") == "O")).select("o_orderkey", "c_name")


@query("""
SELECT r_name, s_suppkey, count(*) AS motifs, count(DISTINCT l_partkey) AS genes, round(avg(l_discount), 6) AS mean_divergence
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, s_suppkey
""")
def motif_per_species(spark, sf_dir):
    """JN2, AG2, AG3: the central fact join, with counts and means."""
    line, supplier, nation, region = tables(spark, sf_dir, "lineitem", "supplier", "nation", "region")
    species = supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    # dealt by both keys first, so that distinct parts are found in tasks of bounded size and once
    lines = line.select("l_suppkey", "l_partkey", "l_discount").repartition(tasks_for(line, line.count(), 1_000_000), "l_suppkey", "l_partkey")
    joined = lines.withColumnRenamed("l_suppkey", "s_suppkey").join(species, "s_suppkey")
    return joined.groupBy("r_name", "s_suppkey").agg(F.count("*").alias("motifs"), F.countDistinct("l_partkey").alias("genes"), F.round(F.avg("l_discount"), 6).alias("mean_divergence"))


@query("""
SELECT p_partkey, n, round(disc, 6) AS disc, round(qty, 6) AS qty FROM part
LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) a ON a.l_partkey = p_partkey
LEFT JOIN (SELECT l_partkey, max(l_discount) AS disc FROM lineitem WHERE l_discount > 0.05 GROUP BY 1) b ON b.l_partkey = p_partkey
LEFT JOIN (SELECT l_partkey, avg(l_quantity) AS qty FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) c ON c.l_partkey = p_partkey
""")
def join_left_chain(spark, sf_dir):
    """JN3: a chain of left joins of per-key tables."""
    part, line = tables(spark, sf_dir, "part", "lineitem")
    n = line.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    disc = line.where("l_discount > 0.05").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_discount").alias("disc"))
    qty = line.where("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.avg("l_quantity").alias("qty"))
    joined = part.select("p_partkey").join(n, "p_partkey", "left").join(disc, "p_partkey", "left").join(qty, "p_partkey", "left")
    return joined.select("p_partkey", "n", F.round("disc", 6).alias("disc"), F.round("qty", 6).alias("qty"))


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 100000)")
def semi_filter(spark, sf_dir):
    """JN4: semi join."""
    customer, orders = tables(spark, sf_dir, "customer", "orders")
    return customer.join(orders.where("o_totalprice > 100000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def anti_orphans(spark, sf_dir):
    """JN5, JN6, JN7: keys without a partner."""
    orders, line = tables(spark, sf_dir, "orders", "lineitem")
    return orders.join(line, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("SELECT o_orderkey FROM orders o WHERE (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) = (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 5) AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def join_correlated_counts(spark, sf_dir):
    """JN8: keys whose two counts agree."""
    line, orders = tables(spark, sf_dir, "lineitem", "orders")
    same = line.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_quantity") > 5).alias("m")).where("n = m")
    return orders.join(same, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@query("SELECT DISTINCT l_orderkey AS og, l_partkey AS gene FROM lineitem")
def og_gene_map(spark, sf_dir):
    """JN10: many-to-many map."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("og"), F.col("l_partkey").alias("gene")).distinct()


_INTERVALS = """
motifs AS (SELECT l_partkey AS gene, l_orderkey AS motif, l_linenumber AS k, (l_suppkey % 50)::INT AS m_start, (l_suppkey % 50 + l_linenumber * 2)::INT AS m_end FROM lineitem),
domains AS (SELECT l_partkey AS gene, (l_orderkey % 60)::INT AS d_start, (l_orderkey % 60 + 6)::INT AS d_end, l_returnflag = 'R' AS preferred, l_orderkey * 10 + l_linenumber AS ordinal FROM lineitem WHERE l_linenumber <= 2)
"""


def _intervals(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    start = (F.col("l_suppkey") % 50).cast("int")
    motifs = line.select(F.col("l_partkey").alias("gene"), F.col("l_orderkey").alias("motif"), F.col("l_linenumber").alias("k"), start.alias("m_start"), (start + F.col("l_linenumber") * 2).cast("int").alias("m_end"))
    d = (F.col("l_orderkey") % 60).cast("int")
    domains = line.where("l_linenumber <= 2").select(F.col("l_partkey").alias("gene"), d.alias("d_start"), (d + 6).alias("d_end"), (F.col("l_returnflag") == "R").alias("preferred"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ordinal"))
    return motifs, domains


@query(f"""
WITH {_INTERVALS}, hits AS (
  SELECT motif, k, ordinal, row_number() OVER (PARTITION BY motif, k ORDER BY preferred DESC, CASE WHEN preferred THEN -ordinal ELSE ordinal END) AS r
  FROM motifs m JOIN domains d ON m.gene = d.gene AND m.m_start + 1 <= d.d_end AND m.m_end >= d.d_start)
SELECT motif, k, ordinal AS domain FROM hits WHERE r = 1
""")
def interval_overlap(spark, sf_dir):
    """JN11: overlapping domain of each motif, the last preferred one, else the first."""
    motifs, domains = _intervals(spark, sf_dir)
    hits = overlap_join(motifs, domains, ["gene"], F.col("m_start") + 1, F.col("m_end"), "d_start", "d_end")
    order = [F.col("preferred").desc(), F.when(F.col("preferred"), -F.col("ordinal")).otherwise(F.col("ordinal"))]
    return dedup_first(hits, ["motif", "k"], order).select("motif", "k", F.col("ordinal").alias("domain"))


@query(f"""
WITH {_INTERVALS}
SELECT gene, count(*) AS matching FROM (SELECT DISTINCT d.gene, d.ordinal FROM domains d JOIN motifs m ON m.gene = d.gene AND abs(m.m_start - d.d_start) <= 3 AND m.k % 3 = d.ordinal % 3) GROUP BY gene
""")
def range_exists_count(spark, sf_dir):
    """JN12, JN13: variants with a position within three residues and of one class, counted once each."""
    motifs, domains = _intervals(spark, sf_dir)
    # positions are spread over their reach, so the join is by equality
    reach = motifs.select("gene", F.explode(F.sequence(F.col("m_start") - 3, F.col("m_start") + 3)).alias("d_start"), (F.col("k") % 3).cast("long").alias("kind")).distinct()
    near = domains.withColumn("kind", F.col("ordinal") % 3).join(reach, ["gene", "d_start", "kind"], "left_semi")
    return near.select("gene", "ordinal").distinct().groupBy("gene").agg(F.count("*").alias("matching"))


@query(f"""
WITH {_INTERVALS}, spots AS (SELECT gene, unnest(generate_series(d_start, d_end)) AS pos, min(ordinal % 6) AS priority FROM domains GROUP BY gene, pos)
SELECT motif, k, min(priority) AS best FROM (SELECT motif, k, gene, unnest(generate_series(m_start, m_end)) AS pos FROM motifs) JOIN spots USING (gene, pos) GROUP BY motif, k
""")
def position_feature(spark, sf_dir):
    """JN14: the best feature of a motif's residues."""
    motifs, domains = _intervals(spark, sf_dir)
    # lines are dealt by gene and only then spread over positions, so positions are never shuffled
    tasks = tasks_for(motifs, motifs.count())
    motifs, domains = dealt_once(motifs, tasks, "gene"), dealt_once(domains, tasks, "gene")
    spots = domains.select("gene", F.explode(F.sequence("d_start", "d_end")).alias("pos"), (F.col("ordinal") % 6).alias("priority")).groupBy("gene", "pos").agg(F.min("priority").alias("priority"))
    residues = motifs.select("motif", "k", "gene", F.explode(F.sequence("m_start", "m_end")).alias("pos"))
    return residues.join(spots.hint("shuffle_hash"), ["gene", "pos"]).groupBy("motif", "k").agg(F.min("priority").alias("best"))


@query("""
WITH d AS (SELECT 'ASIA' AS a, 'EUROPE' AS b, 90 AS my UNION ALL SELECT 'AMERICA', 'ASIA', 310 UNION ALL SELECT 'EUROPE', 'AFRICA', 280)
SELECT x.r_name AS a, y.r_name AS b, CASE WHEN x.r_name = y.r_name THEN 0 ELSE coalesce((SELECT my FROM d WHERE d.a = x.r_name AND d.b = y.r_name), (SELECT my FROM d WHERE d.b = x.r_name AND d.a = y.r_name), 100) END::BIGINT AS distance
FROM region x CROSS JOIN region y
""")
def lineage_distance(spark, sf_dir):
    """JN16, JN17, JN18: pairs of a small dimension with a symmetric lookup."""
    region = table(spark, sf_dir, "region").select("r_name")
    pairs = region.toDF("a").crossJoin(F.broadcast(region.toDF("b")))
    return symmetric_lookup(pairs, [("ASIA", "EUROPE", 90), ("AMERICA", "ASIA", 310), ("EUROPE", "AFRICA", 280)], default=100)


# --- aggregates --------------------------------------------------------------------------------


@query("SELECT count(*) AS n, count(DISTINCT l_partkey) AS parts, round(sum(l_quantity), 2) AS quantity, round(avg(l_discount), 5) AS discount FROM lineitem")
def scalar_aggregates(spark, sf_dir):
    """AG1."""
    line = table(spark, sf_dir, "lineitem")
    return line.agg(F.count("*").alias("n"), F.countDistinct("l_partkey").alias("parts"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.avg("l_discount"), 5).alias("discount"))


@query("SELECT l_partkey, max(l_linenumber) AS most FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_partkey")
def max_over_join(spark, sf_dir):
    """AG4."""
    line, supplier = tables(spark, sf_dir, "lineitem", "supplier")
    return line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("l_partkey").agg(F.max("l_linenumber").alias("most"))


@query("SELECT count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(*) FILTER (WHERE l_discount > 0.05 AND l_tax > 0.02) AS high, count(*) AS n FROM lineitem")
def filter_counts(spark, sf_dir):
    """AG5."""
    return table(spark, sf_dir, "lineitem").agg(F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.count_if((F.col("l_discount") > 0.05) & (F.col("l_tax") > 0.02)).alias("high"), F.count("*").alias("n"))


@query("SELECT l_returnflag, round(quantile_cont(l_quantity, 0.1), 6) AS p10, round(quantile_cont(l_quantity, 0.25), 6) AS p25, round(quantile_cont(l_quantity, 0.5), 6) AS p50, round(quantile_cont(l_quantity, 0.75), 6) AS p75, round(quantile_cont(l_quantity, 0.9), 6) AS p90 FROM lineitem GROUP BY 1")
def percentile_report(spark, sf_dir):
    """AG6: exact, interpolated percentiles."""
    ps = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}
    found = exact_percentiles(table(spark, sf_dir, "lineitem"), "l_quantity", ps, ["l_returnflag"])
    return found.select("l_returnflag", *[F.round(k, 6).alias(k) for k in ps])


@query("SELECT quantile_cont(n, 0.5) AS median FROM (SELECT o_custkey, count(DISTINCT o_orderpriority) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY 1)")
def median_of_distinct(spark, sf_dir):
    """AG7: median of per-key distinct counts, without some keys."""
    orders, customer = tables(spark, sf_dir, "orders", "customer")
    kept = orders.join(customer.where("c_acctbal < 0"), F.col("o_custkey") == F.col("c_custkey"), "left_anti")
    return kept.groupBy("o_custkey").agg(F.countDistinct("o_orderpriority").alias("n")).transform(exact_percentiles, "n", {"median": 0.5})


@query("SELECT l_shipyear, round(stddev_samp(l_extendedprice), 4) AS sd, round(avg(l_extendedprice), 4) AS mean FROM (SELECT *, year(l_shipdate) AS l_shipyear FROM lineitem) GROUP BY 1")
def stddev_rounded(spark, sf_dir):
    """AG8."""
    line = table(spark, sf_dir, "lineitem").withColumn("l_shipyear", F.year("l_shipdate").cast("long"))
    return line.groupBy("l_shipyear").agg(F.round(F.stddev_samp("l_extendedprice"), 4).alias("sd"), F.round(F.avg("l_extendedprice"), 4).alias("mean"))


@query("SELECT count(*) AS duplicates FROM (SELECT l_partkey, l_suppkey FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)")
def dup_having(spark, sf_dir):
    """AG9."""
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"]).agg(F.count("*").alias("duplicates"))


@query("SELECT CASE WHEN l_quantity < 10 THEN 'low' WHEN l_quantity < 30 THEN 'mid' ELSE 'high' END AS bucket, count(*) AS n, round(avg(l_extendedprice), 4) AS price FROM lineitem GROUP BY 1")
def case_buckets(spark, sf_dir):
    """AG10."""
    bucket = F.when(F.col("l_quantity") < 10, "low").when(F.col("l_quantity") < 30, "mid").otherwise("high")
    return table(spark, sf_dir, "lineitem").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.round(F.avg("l_extendedprice"), 4).alias("price"))


@query("SELECT least(floor(l_discount * 50), 4)::BIGINT AS bin, count(*) AS n FROM (SELECT l_discount FROM lineitem WHERE l_discount BETWEEN 0 AND 0.1) GROUP BY 1")
def histogram(spark, sf_dir):
    """AG11: half-open bins, the last one closed."""
    line = table(spark, sf_dir, "lineitem").where("l_discount BETWEEN 0 AND 0.1")
    return half_open_bins(line, F.col("l_discount") * 50, 5)


@query("SELECT n::VARCHAR AS value, count(*) AS parts FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) WHERE n <= 4 GROUP BY n UNION ALL SELECT '4+', count(*) FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) WHERE n >= 4")
def value_distribution(spark, sf_dir):
    """AG12: each value, and the last one once more with all above it."""
    n = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    each = n.where("n <= 4").groupBy(F.col("n").cast("string").alias("value")).agg(F.count("*").alias("parts"))
    return each.unionByName(n.where("n >= 4").agg(F.count("*").alias("parts")).select(F.lit("4+").alias("value"), "parts"))


@query("SELECT l_orderkey, max(n) = 1 AS one_to_one FROM (SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def paralog_flag(spark, sf_dir):
    """AG13."""
    per = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.count("*").alias("n"))
    return per.groupBy("l_orderkey").agg((F.max("n") == 1).alias("one_to_one"))


@query("SELECT l_partkey, l_linenumber, list_sort(list(DISTINCT l_suppkey)) AS species FROM lineitem GROUP BY 1, 2")
def collect_groups(spark, sf_dir):
    """AG14."""
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_linenumber").agg(F.sort_array(F.collect_set("l_suppkey")).alias("species"))


@query("""
WITH best AS (SELECT word, p_partkey, max(p_retailprice) AS s FROM (SELECT unnest(string_split(p_type, ' ')) AS word, p_partkey, p_retailprice FROM part) GROUP BY 1, 2)
SELECT word, count(*) AS genes, round(sum(s), 2) AS total FROM best GROUP BY word HAVING count(*) >= 2
""")
def keep_max_then_sum(spark, sf_dir):
    """AG15."""
    words = table(spark, sf_dir, "part").select(F.explode(F.split("p_type", " ")).alias("word"), "p_partkey", "p_retailprice")
    best = words.groupBy("word", "p_partkey").agg(F.max("p_retailprice").alias("s"))
    return best.groupBy("word").agg(F.count("*").alias("genes"), F.round(F.sum("s"), 2).alias("total")).where("genes >= 2")


@query("""
WITH w AS (SELECT l_partkey, l_linenumber, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_partkey, l_linenumber, n FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_linenumber) AS r FROM w) WHERE r = 1
""")
def arg_max(spark, sf_dir):
    """AG16, AG17: the first of the largest, in a stated order."""
    w = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_linenumber").agg(F.countDistinct("l_suppkey").alias("n"))
    return dedup_first(w, ["l_partkey"], [F.col("n").desc(), F.col("l_linenumber")])


@query("""
SELECT l_partkey, count(DISTINCT CASE WHEN s_nationkey < 5 THEN s_suppkey END) / (SELECT count(*) FROM supplier WHERE s_nationkey < 5)::DOUBLE AS fraction
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1
""")
def control_fraction(spark, sf_dir):
    """AG18: share of the control species that have a row."""
    line, supplier = tables(spark, sf_dir, "lineitem", "supplier")
    controls = supplier.where("s_nationkey < 5").agg(F.count("*").alias("controls"))
    joined = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("l_partkey").agg(F.countDistinct(F.when(F.col("s_nationkey") < 5, F.col("s_suppkey"))).alias("n"))
    return joined.crossJoin(F.broadcast(controls)).select("l_partkey", (F.col("n") / F.col("controls")).alias("fraction"))


@query("SELECT user_id, round(min(value * power(10, -(event_id % 5))), 9) AS p FROM events WHERE value > 0 GROUP BY 1")
def min_mantissa(spark, sf_dir):
    """AG19: smallest of mantissa times a power of ten, positive mantissas only."""
    p = F.col("value") * F.pow(F.lit(10.0), -(F.col("event_id") % 5).cast("double"))
    return table(spark, sf_dir, "events").where("value > 0").groupBy("user_id").agg(F.round(F.min(p), 9).alias("p"))


@query("SELECT user_id, string_agg(DISTINCT trim(event_type), ', ' ORDER BY trim(event_type)) AS kinds FROM events GROUP BY 1")
def sorted_label_list(spark, sf_dir):
    """AG20."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_set(F.trim("event_type"))), ", ").alias("kinds"))


@query("SELECT l_partkey, round(avg(score), 8) AS score FROM (SELECT l_partkey, l_suppkey, max(l_discount) AS score FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def cross_source_mean(spark, sf_dir):
    """AG21."""
    best = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.max("l_discount").alias("score"))
    return best.groupBy("l_partkey").agg(F.round(F.avg("score"), 8).alias("score"))


@query("SELECT DISTINCT word FROM (SELECT unnest(string_split(p_type, ' ')) AS word FROM part) ORDER BY word LIMIT 200")
def array_union_distinct(spark, sf_dir):
    """AG22."""
    return table(spark, sf_dir, "part").select(F.explode(F.split("p_type", " ")).alias("word")).distinct().orderBy("word").limit(200)


# --- windows and rankings ----------------------------------------------------------------------

_GENES = """
genes AS (SELECT l_partkey AS gene, round(avg(l_discount) * 10, 6) AS p, count(*) AS n, round(sum(l_quantity) / 1000, 6) AS w FROM lineitem GROUP BY 1)
"""


def _genes(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("gene"))
    return line.agg(F.round(F.avg("l_discount") * 10, 6).alias("p"), F.count("*").alias("n"), F.round(F.sum("l_quantity") / 1000, 6).alias("w"))


@query(f"WITH {_GENES} SELECT gene, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM genes")
def avg_rank(spark, sf_dir):
    """WN1."""
    return average_ranks(_genes(spark, sf_dir), {"r": (F.col("p"), False)}).select("gene", "r")


_PHI = """0.5 * (1 + sign(z) * (1 - (((((1.061405429 * t - 1.453152027) * t) + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t * exp(-(z * z) / 2)))"""


@query(f"""
WITH {_GENES}, r AS (
  SELECT gene, ((rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0) / (count(*) OVER ())) *
    ((rank() OVER (ORDER BY n DESC) + (count(*) OVER (PARTITION BY n) - 1) / 2.0) / (count(*) OVER ())) AS rp FROM genes
), z AS (SELECT gene, rp, (ln(rp) + 2) / sqrt(2) AS z FROM r), t AS (SELECT *, 1 / (1 + 0.3275911 * abs(z) / sqrt(2)) AS t FROM z)
SELECT gene, round(rp, 10) AS rp, round(least(1.0, greatest(1e-15, {_PHI})), 6) AS p FROM t
""")
def rank_product_pvalue(spark, sf_dir):
    """WN2, WN3."""
    ranked = average_ranks(_genes(spark, sf_dir), {"rank_1": (F.col("p"), False), "rank_2": (F.col("n"), True)}, total="genes")
    product = rank_product([F.col("rank_1"), F.col("rank_2")], F.col("genes"))
    return ranked.select("gene", product.alias("rp")).select("gene", F.round("rp", 10).alias("rp"), F.round(rank_product_p(F.col("rp"), 2), 6).alias("p"))


_BH = """
raw AS (SELECT gene, p, p * count(*) OVER () / row_number() OVER (ORDER BY p, gene) AS q, row_number() OVER (ORDER BY p, gene) AS r FROM ps WHERE p IS NOT NULL),
adjusted AS (SELECT gene, p, round(least(1.0, min(q) OVER (ORDER BY r DESC ROWS UNBOUNDED PRECEDING)), 6) AS q FROM raw UNION ALL SELECT gene, p, NULL FROM ps WHERE p IS NULL)
"""


@query(f"WITH {_GENES}, ps AS (SELECT gene, CASE WHEN n > 1 THEN least(p, 1.0) END AS p FROM genes), {_BH} SELECT gene, p, q FROM adjusted")
def bh_fdr(spark, sf_dir):
    """WN4, WN6."""
    ps = _genes(spark, sf_dir).select("gene", F.when(F.col("n") > 1, F.least(F.col("p"), F.lit(1.0))).alias("p"))
    return benjamini_hochberg(ps, "p", "q").select("gene", "p", F.round("q", 6).alias("q"))


@query("""
WITH sites AS (SELECT l_orderkey AS og, l_linenumber AS site, l_tax / 0.1 AS p FROM lineitem),
raw AS (SELECT *, p * count(*) OVER () / row_number() OVER (ORDER BY p, og, site) AS q, row_number() OVER (ORDER BY p, og, site) AS r FROM sites),
adj AS (SELECT og, site, round(least(1.0, min(q) OVER (ORDER BY r DESC ROWS UNBOUNDED PRECEDING)), 6) AS q FROM raw)
SELECT og, min(q) AS least_q, count(*) AS sites FROM adj GROUP BY og
""")
def bh_nested_sites(spark, sf_dir):
    """WN5: one correction over the sites of all groups, gathered by group again. Equal p values share q, so distinct ones are ranked."""
    sites = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("og"), (F.col("l_tax") / 0.1).alias("p"))
    # the largest rank of each distinct p decides its q, so the window holds distinct values only
    values = sites.groupBy("p").agg(F.count("*").alias("c"))
    up = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, 0)
    q = values.withColumn("raw", F.col("p") * F.sum("c").over(Window.partitionBy()) / F.sum("c").over(up)).select("p", F.round(F.least(F.lit(1.0), F.min("raw").over(down)), 6).alias("q"))
    return sites.join(q, "p").groupBy("og").agg(F.min("q").alias("least_q"), F.count("*").alias("sites"))


@query("SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate ASC NULLS LAST, l_orderkey DESC, l_linenumber) AS r FROM lineitem) WHERE r = 1")
def dedup_keep_first(spark, sf_dir):
    """WN7, WN8, ST5."""
    order = [F.col("l_shipdate").asc_nulls_last(), F.col("l_orderkey").desc(), F.col("l_linenumber")]
    return dedup_first(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], order).select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")


@query("SELECT l_returnflag, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share FROM lineitem GROUP BY 1")
def share_by_group(spark, sf_dir):
    """WN9."""
    return share_of_total(table(spark, sf_dir, "lineitem"), "l_returnflag", 6)


@query("SELECT l_orderkey, l_linenumber, l_discount FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_discount DESC, l_linenumber) AS r FROM lineitem) WHERE r <= 2")
def topn_per_key(spark, sf_dir):
    """WN10."""
    return top_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey"], [F.col("l_discount").desc(), F.col("l_linenumber")], 2).select("l_orderkey", "l_linenumber", "l_discount")


@query("""
WITH s AS (SELECT d.doc_id, d.n_chars, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)),
r AS (SELECT *, row_number() OVER (ORDER BY n_chars DESC, doc_id) * 100.0 / count(*) OVER () AS pct FROM s)
SELECT k, count(*) FILTER (WHERE quality = 1 AND pct <= k) / (count(*) FILTER (WHERE quality = 1))::DOUBLE AS recall FROM r, (SELECT unnest([1, 5, 10, 20]) AS k) GROUP BY k
""")
def recall_at_k(spark, sf_dir):
    """WN11, TK8: share of known positives in the top percents of a ranking.

    A document's place is found from counts per score, with no window over all documents.
    """
    docs, labels = tables(spark, sf_dir, "documents", "labels")
    known = labels.where("quality = 1").select("doc_id")
    total = docs.agg(F.count("*").alias("n"))
    by_score = docs.groupBy("n_chars").agg(F.count("*").alias("c"))
    above = by_score.select("n_chars", (F.sum("c").over(Window.orderBy(F.desc("n_chars")).rowsBetween(Window.unboundedPreceding, 0)) - F.col("c")).alias("above"))
    tied = docs.select("doc_id", "n_chars").withColumn("place", F.row_number().over(Window.partitionBy("n_chars").orderBy("doc_id")))
    placed = tied.join(known, "doc_id", "left_semi").join(above, "n_chars").crossJoin(F.broadcast(total)).withColumn("pct", (F.col("above") + F.col("place")) * 100.0 / F.col("n"))
    ks = placed.select("pct", F.explode(F.array(*[F.lit(k) for k in (1, 5, 10, 20)])).alias("k"))
    return ks.groupBy("k").agg((F.count_if(F.col("pct") <= F.col("k")) / F.count("*")).alias("recall"))


@query("""
SELECT s_nationkey, s_suppkey, CASE WHEN max(s_acctbal) OVER w = min(s_acctbal) OVER w THEN 0.5 ELSE round((s_acctbal - min(s_acctbal) OVER w) / (max(s_acctbal) OVER w - min(s_acctbal) OVER w), 6) END AS scaled
FROM supplier WINDOW w AS (PARTITION BY s_nationkey)
""")
def minmax_norm(spark, sf_dir):
    """WN12."""
    scaled = min_max(F.col("s_acctbal"), Window.partitionBy("s_nationkey"))
    return table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", F.round(scaled, 6).alias("scaled"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey LIMIT 20 OFFSET 10")
def topk_paging(spark, sf_dir):
    """TK1, TK2, TK3, TK4."""
    return table(spark, sf_dir, "orders").orderBy(F.col("o_totalprice").desc_nulls_first(), "o_orderkey").offset(10).limit(20).select("o_orderkey", "o_totalprice")


@query("""
WITH t AS (SELECT l_partkey, list_slice(list(l_returnflag || l_linestatus ORDER BY l_quantity DESC, l_orderkey, l_linenumber), 1, 5) AS top FROM lineitem GROUP BY 1)
SELECT l_partkey, list_slice(list_filter(top, lambda x, i: list_position(top, x) = i), 1, 3) AS kinds FROM t
""")
def top_distinct_of_top(spark, sf_dir):
    """TK5, ST6: the first three distinct kinds among the top five."""
    line = table(spark, sf_dir, "lineitem").withColumn("kind", F.concat("l_returnflag", "l_linestatus"))
    best = top_per_key(line, ["l_partkey"], [F.col("l_quantity").desc(), F.col("l_orderkey"), F.col("l_linenumber")], 5, rank="r")
    top = F.transform(F.array_sort(F.collect_list(F.struct("r", "kind"))), lambda x: x["kind"])
    return best.groupBy("l_partkey").agg(F.slice(F.array_distinct(top), 1, 3).alias("kinds"))


# --- sets --------------------------------------------------------------------------------------


@query("""
WITH a AS (SELECT l_partkey, list_sort(list(DISTINCT l_suppkey)) AS s, list_sort(list(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_suppkey END)) AS r FROM lineitem GROUP BY 1)
SELECT l_partkey, len(list_intersect(s, r)) AS common, len(list_filter(s, lambda x: NOT coalesce(list_contains(r, x), false))) AS only_s, len(list_distinct(list_concat(s, r))) AS either FROM a
""")
def set_operations(spark, sf_dir):
    """ST1, ST2, ST3."""
    sets = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.collect_set("l_suppkey").alias("s"), F.collect_set(F.when(F.col("l_returnflag") == "R", F.col("l_suppkey"))).alias("r"))
    size = lambda c: F.size(c).cast("long")
    return sets.select("l_partkey", size(F.array_intersect("s", "r")).alias("common"), size(F.array_except("s", "r")).alias("only_s"), size(F.array_union("s", "r")).alias("either"))
