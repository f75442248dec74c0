"""Every catalogue query equals its DuckDB oracle on the smallest test tables."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL
from lendlayer.plans.oracle import ORACLE
from lendlayer.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem".split()
SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _bag(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    d_cols = list(rel.columns)
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    d_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert {c: SPARK_TO_DUCK.get(t) for c, t in df.dtypes} == d_types
    assert len(s_rows) == len(d_rows)
    assert _bag(df.columns, s_rows) == _bag(d_cols, d_rows)
    assert not any(isinstance(v, float) and math.isnan(v) for r in s_rows for v in r)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "loan_id"
