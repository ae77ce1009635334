"""Every registered query with an oracle agrees with DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from almanac.queries import REGISTRY
from almanac.sources.tables import TABLES

from conftest import SF_SMALL

SQL_QUERIES = sorted(n for n, q in REGISTRY.items() if q.sql)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def _norm(v):
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


def _close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(_close(x, y) for x, y in zip(a, b))
    return a == b


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_query_matches_duckdb(spark, duck, name):
    sdf = REGISTRY[name].build(spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=_key)
    rel = duck.sql(REGISTRY[name].sql)
    idx = [rel.columns.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)
    assert sorted(rel.columns) == cols
    assert len(srows) == len(drows)
    assert all(_close(a, b) for a, b in zip(srows, drows))


def test_entry_contract(spark):
    import __spark_entry__ as entry_mod
    df = entry_mod.entry(spark)
    assert df.columns[:4] == ["store_id", "year", "month", "sales"]
    assert df.count() > 0
    qs, sqls = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sqls) <= set(qs) and len(qs) >= 40
