"""Every registered query against its SQL in an independent engine, on the tables of one scale."""

import collections
import decimal
import math
import os

import duckdb
import pytest

from tallyforge.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = [f[: -len(".parquet")] for f in os.listdir(SF)] if os.path.isdir(SF) else []


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), collections.Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        assert sum(got[1].values()) > 0
        return
    found = sql.sql(ORACLES[name])
    assert got == rows_of(found.columns, found.fetchall())
