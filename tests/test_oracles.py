"""Every query with a DuckDB statement gives the same rows as that statement, at the smallest scale."""

import datetime
import decimal
import math

import duckdb
import pytest

from barloom.plans import registry
from barloom.plans.views import TABLES

def plain(x):
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, float):
        return None if math.isnan(x) else x + 0.0
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


def rows(columns, found):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in at) for r in found), key=lambda r: [(v is None, str(type(v)), v if isinstance(v, (int, float, str, datetime.date)) else str(v)) for v in r])


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_duckdb(spark, duck, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    got = rows(df.columns, df.collect())
    found = duck.execute(registry.ORACLE_SQL[name])
    want = rows([d[0] for d in found.description], found.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in found.description)
    assert got == want


def test_queries_without_a_statement_are_tested_elsewhere():
    assert set(registry.QUERIES) - set(registry.ORACLE_SQL) == {"t09_subsample", "d06_epoch_order", "m01_projection", "m02_embed_new"}
