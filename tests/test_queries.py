"""Every query against its DuckDB counterpart over whole tables."""

import math

import duckdb
import pytest

from tidemark.plans import registry

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(float(v)) if isinstance(v, (float, int)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    names = sorted(df.columns)
    got = sorted(tuple(plain(r[n]) for n in names) for r in df.collect())
    if name not in registry.ORACLE:
        assert got
        return
    rel = duck.execute(registry.ORACLE[name])
    found = [d[0] for d in rel.description]
    assert sorted(found) == names
    assert got == sorted(tuple(plain(r[found.index(n)]) for n in names) for r in rel.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries()) and set(e.HEADLINE) <= set(e.queries())
