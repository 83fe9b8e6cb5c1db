"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from edumart.plans.analogues import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


# Spark simple type name -> DuckDB type name
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


def _key(v):
    if isinstance(v, float) and math.isnan(v):
        return (2, "nan")
    return (v is None, str(type(v)), v if v is not None else 0)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda t: tuple(_key(x) for x in t))


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "score" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    res = con.sql(E.oracle_sql()[name])
    exp_cols, exp = res.columns, res.fetchall()
    assert sorted(got_cols) == sorted(exp_cols)
    exp_types = dict(zip(exp_cols, [str(t) for t in res.types]))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == exp_types
    assert len(got) == len(exp)
    assert _rows(got_cols, got) == _rows(exp_cols, exp)
