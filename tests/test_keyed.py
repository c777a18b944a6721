"""Tables by key, of which only touched partitions change, and the index of variants."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helixframe.sources import keyed


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def rows(table):
    return {r.id: (r.s, r.v) for r in table.read().collect()}


@pytest.fixture
def made(spark, tmp_path):
    df = spark.range(200).select("id", F.concat(F.lit("n"), "id").alias("s"), F.col("id").cast("double").alias("v"))
    return keyed.KeyedTable(spark, str(tmp_path / "t"), ["id"], parts=16).create(df)


def test_only_touched_partitions_are_written(spark, made):
    before, want = files(made.path), rows(made)
    assert len({f.split("/")[0] for f in before}) == 16
    touched = made.update(spark.createDataFrame([(3, -1.0, None), (999, 5.0, "x")], "id long, v double, s string"))
    after = files(made.path)
    assert len(touched) <= 2 and {f for f in before if before[f] != after.get(f)} and all(int(f.split("/")[0].removeprefix("part=")) in touched for f in before.keys() ^ after.keys())
    want[3] = ("n3", -1.0)
    assert rows(made) == want
    made.update_from_arrays(spark.createDataFrame([([4, 5], ["a", None])], "id array<long>, s array<string>"))
    made.upsert(spark.createDataFrame([(6, None, 0.0), (1000, "new", None)], "id long, s string, v double"))
    made.insert_missing(spark.createDataFrame([(7, "no", 0.0), (1001, "yes", 1.0)], "id long, s string, v double"))
    made.replace(spark.createDataFrame([(8, None, None)], "id long, s string, v double"))
    want |= {4: ("a", 4.0), 6: ("n6", 0.0), 1000: ("new", None), 1001: ("yes", 1.0), 8: (None, None)}
    assert rows(made) == want
    assert made.upsert(spark.createDataFrame([], "id long, s string, v double")) == [] and rows(made) == want
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        made.create(spark.range(1))


def test_variant_index_is_read_by_bucket(spark, tmp_path):
    variants = spark.range(3000).select(F.concat(F.lit("P"), F.col("id") % 300).alias("accession"), (F.col("id") % 10).cast("int").alias("position"), F.lit("V").alias("alt"), F.col("id").cast("double").alias("score"))
    index = keyed.build_variant_index(variants, "variants_test", str(tmp_path / "index"), 8)
    plan = lambda df: df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    one = keyed.variants_of(index, ["p7"])
    assert one.count() == 10 and "EqualTo(accession,P7)" in plan(one) and one.select(F.input_file_name()).distinct().count() == 1
    asked = spark.createDataFrame([("p1",), ("P2",), ("p1",), ("none",)], "accession string")
    some = keyed.variants_of(index, asked)
    assert some.count() == 20
    text = plan(some)
    scan = text[text.index("Scan parquet spark_catalog.default.variants_test"):]
    assert "Bucketed: true" in scan and text.count("Exchange hashpartitioning") <= 2  # both of the table that asks
    spark.sql("DROP TABLE variants_test")
    again = keyed.open_variant_index(spark, "variants_again", str(tmp_path / "index"), 8)
    assert keyed.variants_of(again, ["P7", "P8"]).count() == 20
    spark.sql("DROP TABLE variants_again")
