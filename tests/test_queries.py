"""Every query with SQL gives what DuckDB gives on the smallest tables."""

from __future__ import annotations

import decimal
import os

import pytest

from spanforge.plans import queries as plans

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v) -> str:
    if v is None or v != v:
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int | float | decimal.Decimal):
        return f"{float(v):.6f}"
    if isinstance(v, list | tuple):
        return "[" + ",".join(map(plain, v)) + "]"
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_same_as_sql(name, spark, duck):
    got = plans.queries()[name](spark, SF)
    want = duck.sql(plans.oracle_sql()[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    at = [want.columns.index(c) for c in cols]
    assert sorted(tuple(plain(r[c]) for c in cols) for r in got.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


def test_rows_only(spark):
    for name in set(plans.queries()) - set(plans.oracle_sql()):
        assert plans.queries()[name](spark, SF).count() > 0, name


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
