"""Every query with SQL gives what DuckDB gives, on the smallest tables."""

import os

import pytest

from cuelake.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = ("orders", "events", "conversations", "documents")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(names, values):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(repr([v[k] for k in order]) for v in values)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    con = duck.execute(registry.oracle_sql()[name])
    assert rows(df.columns, got) == rows([c[0] for c in con.description], con.fetchall())
    assert set(registry.queries()) >= set(registry.oracle_sql())
    spark.catalog.clearCache()


def test_imports_without_the_optional_folder():
    import __spark_entry__

    assert "validation_stats" in __spark_entry__.queries()
