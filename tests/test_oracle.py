"""Every registered query with an oracle equals its DuckDB twin (sf0.001)."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tagloom.plans.catalog import QUERIES
from tagloom.plans.oracle import SQL

TABLES = "events documents embeddings pages benchmark labels conversations".split()
SLOW = {"train_single", "train_multi", "select_and_test", "model_roundtrip", "train_eval", "select_and_test_multi", "select_and_test_short"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in recs), sorted(cols)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", sorted(k for k in SQL if k in QUERIES and k not in SLOW))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    a, ac = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[key])
    b, bc = _rows([d[0] for d in res.description], res.fetchall())
    assert ac == bc
    assert a == b
    duck = {d[0]: str(d[1]) for d in res.description}
    for f in df.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == duck[f.name], (f.name, f.dataType, duck[f.name])


def test_every_query_has_oracle_or_is_model_job():
    assert set(QUERIES) - set(SQL) <= SLOW


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["label", "n"] and df.count() >= 0
