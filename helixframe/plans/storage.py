"""Queries that write tables by key and index, change them and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from helixframe.plans.landing import _text, folder
from helixframe.plans.relational import table
from helixframe.sources import keyed, readers

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


@query("""
WITH u AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 500 = 3 AND c_acctbal > 0 THEN -1.0 ELSE c_acctbal END AS c_acctbal FROM customer),
up AS (SELECT c_custkey, CASE WHEN c_custkey % 700 = 5 THEN 'renamed' ELSE c_name END AS c_name, c_acctbal FROM u UNION ALL SELECT DISTINCT -c_custkey, 'renamed', NULL FROM customer WHERE c_custkey % 700 = 5),
ins AS (SELECT * FROM up UNION ALL SELECT max(c_custkey) + 1, 'new', 1.0 FROM customer)
SELECT c_custkey, c_name, CASE WHEN c_custkey % 900 = 7 THEN 0.5 ELSE c_acctbal END AS c_acctbal FROM ins
""")
def keyed_changes(spark, sf_dir):
    """SNK1-SNK5: a table dealt by key; some keys updated, upserted, inserted and replaced, each in their partitions alone."""
    customer, k = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), F.col("c_custkey")
    made = keyed.KeyedTable(spark, folder(customer), ["c_custkey"]).create(customer)
    made.update(customer.where((k % 500 == 3) & (F.col("c_acctbal") > 0)).select("c_custkey", F.lit(-1.0).alias("c_acctbal")))
    named = customer.where(k % 700 == 5)
    made.upsert(named.select(F.explode(F.array(k, -k)).alias("c_custkey"), F.lit("renamed").alias("c_name"), F.lit(None).cast("double").alias("c_acctbal")))
    made.insert_missing(customer.agg((F.max(k) + 1).alias("c_custkey"), F.lit("new").alias("c_name"), F.lit(1.0).alias("c_acctbal")).unionByName(customer.where(k % 100 == 1).withColumn("c_name", F.lit("known"))))
    made.replace(made.read().where(F.pmod(k, F.lit(900)) == 7).where(k > 0).withColumn("c_acctbal", F.lit(0.5)))
    return made.read()


@query("""
SELECT 'P' || p_partkey AS accession, (p_size + 1)::INT AS position, CASE p_partkey % 3 WHEN 0 THEN 'V' ELSE 'W' END AS alt, p_size / 25.0::DOUBLE AS score FROM part WHERE p_partkey % 4 = 0
""")
def variant_index(spark, sf_dir):
    """SRC15: an index built from a table of variants, of which the last of a place counts, and searched for some accessions."""
    part, k, size = table(spark, sf_dir, "part"), F.col("p_partkey"), F.col("p_size")
    x = F.lit("x")
    line = lambda score: F.concat_ws("\t", x, x, x, x, x, F.concat(F.lit("p"), k), x, F.concat(F.lit("A"), size + 1, F.when(k % 3 == 0, "V").otherwise("W")), score.cast("string"), x)
    path = _text(part.select(F.explode(F.array(line(size / 50), line(size / 25))).alias("value")))
    index = keyed.build_variant_index(readers.read_pathogenicity(spark, path), f"variants_{uuid.uuid4().hex}", folder(part))
    return keyed.variants_of(index, part.where(k % 4 == 0).select(F.concat(F.lit("p"), k).alias("accession")))
