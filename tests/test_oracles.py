"""Every query that has SQL gives the rows that DuckDB gives on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from helixframe import registry


def plain(value):
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_equals_sql(spark, db, sf_dir, name):
    cursor = db.execute(registry.ORACLE[name])
    columns = [c[0] for c in cursor.description]
    order = sorted(columns)
    want = sorted(repr([plain(dict(zip(columns, r, strict=True))[c]) for c in order]) for r in cursor.fetchall())
    df = registry.QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == order
    assert sorted(repr([plain(r[c]) for c in order]) for r in df.collect()) == want


def test_queries_without_sql_run(spark, sf_dir):
    for name in sorted(set(registry.QUERIES) - set(registry.ORACLE)):
        assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 100
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
