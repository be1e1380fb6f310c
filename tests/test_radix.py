"""Radix selection and numbering on awkward keys: outliers, shared prefixes, every key type, hot groups."""

import datetime
import decimal
import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators.radix import cut_values, order_key, ordered_starts
from tagloom.session import release_stored


@pytest.fixture(autouse=True)
def scratch(spark):
    yield
    release_stored(spark)


def keyed(df, cols):
    return df.withColumn("_key", order_key(df, cols))


D = decimal.Decimal
VALUES = {
    "bigint": [None, -(1 << 63), -5, -1, 0, 1, 7, (1 << 62) + 5, (1 << 63) - 1],
    "int": [None, -(1 << 31), -3, 0, 4, (1 << 31) - 1],
    "string": [None, "", "Z", "a", "a!", "aa", "ab", "b", "é", "日", "😀"],
    "double": [None, float("-inf"), -1e300, -2.5, -1e-300, 0.0, 1e-300, 2.5, 1e300, float("inf"), float("nan")],
    "decimal(10,2)": [None, D("-99999999.99"), D("-2.50"), D("-2.49"), D("-0.01"), D("0.00"), D("0.05"), D("0.50"), D("7.00"), D("99999999.99")],
    "decimal(38,0)": [None, D(-(10**37)), D(-1), D(0), D(10**37)],
    "date": [None, datetime.date(1900, 1, 1), datetime.date(1970, 1, 1), datetime.date(2024, 2, 29)],
    "timestamp": [None, datetime.datetime(1960, 1, 1), datetime.datetime(1970, 1, 1), datetime.datetime(2024, 1, 1, 1, 1, 1, 5)],
    "boolean": [None, False, True],
    "binary": [None, b"", b"\x00", b"\x00\x01", b"\xff"],
}


@pytest.mark.parametrize("dtype", sorted(VALUES))
def test_order_key_follows_the_order_of_each_type(spark, dtype):
    rows = [(i, v) for i, v in enumerate(VALUES[dtype])]
    df = keyed(spark.createDataFrame(random.Random(1).sample(rows, len(rows)), f"i int, v {dtype}"), ["v"])
    assert [r.i for r in df.orderBy("_key").collect()] == [i for i, _ in rows]


def test_order_key_of_several_columns(spark):
    rows = [(a, b) for a in (None, "", "a", "ab", "b") for b in (None, -1, 0, 5)]
    df = keyed(spark.createDataFrame(random.Random(2).sample(rows, len(rows)), "a string, b int"), ["a", "b"])
    assert [(r.a, r.b) for r in df.orderBy("_key").collect()] == rows


@pytest.mark.parametrize("ids", ["outlier", "wide", "prefix", "tiny"])
def test_cut_values_open_only_what_is_needed(spark, ids):
    n = 3000
    values = {"outlier": [*range(n), 1 << 62], "wide": [-(1 << 62) - 5, (1 << 62) + 5, *range(n)],
              "prefix": [f"https://example.org/very/long/shared/prefix/{i % 7}/{i:06d}" for i in range(n)], "tiny": [3, 1, 2]}[ids]
    df = keyed(spark.createDataFrame([(v,) for v in values], f"v {'string' if ids == 'prefix' else 'bigint'}").repartition(4), ["v"])
    want = sorted(values)
    ks = [k for k in (1, 2, len(values) // 2, len(values) * 4 // 5, len(values)) if k]
    cuts = spark.createDataFrame([(k,) for k in [*ks, 0, len(values) + 1]], "k long")
    got = cut_values(df, "_key", cuts, target_rows=50)
    values_of = {r.k: r.v for r in got.join(df, F.col("key") == F.col("_key")).select("k", "v").collect()}
    assert values_of == {k: want[k - 1] for k in ks}


def test_cut_values_per_group_with_null_and_hot_groups(spark):
    rnd = random.Random(3)
    rows = [(None, i) for i in range(40)] + [("hot", rnd.randrange(10**12)) for _ in range(2500)] + [(f"g{i % 50}", i) for i in range(300)]
    df = keyed(spark.createDataFrame(rows, "g string, v bigint"), ["v"]).cache()
    by = {}
    for g, v in rows:
        by.setdefault(g, []).append(v)
    cuts = [(g, k) for g, vs in by.items() for k in {1, len(vs) // 2, len(vs)} if k]
    got = cut_values(df, "_key", spark.createDataFrame(cuts, "g string, k long"), ["g"], target_rows=64)
    keys = {r._key: r.v for r in df.collect()}
    assert {(r.g, r.k): keys[r.key] for r in got.collect()} == {(g, k): sorted(by[g])[k - 1] for g, k in cuts}


def test_ordered_starts_number_hot_groups_by_buckets(spark):
    rnd = random.Random(4)
    rows = [("hot", f"same prefix {rnd.randrange(10**9):09d}", rnd.randrange(1, 4)) for _ in range(2000)]
    rows += [(None, f"x{i}", 1) for i in range(70)] + [(f"g{i % 30}", f"{i}", 2) for i in range(90)]
    df = keyed(spark.createDataFrame(rows, "g string, v string, w int").repartition(3), ["v"])
    for weight in (None, "w"):
        got = ordered_starts(df, "_key", ["g"], weight, target_rows=64)
        want, total = [], {}
        for g, v, w in sorted(rows, key=lambda r: (str(r[0]), r[1].encode())):
            want.append((g, v, w, total.get(g, 0)))
            total[g] = total.get(g, 0) + (w if weight else 1)
        assert sorted(((r.g, r.v, r.w, r.start) for r in got.collect()), key=str) == sorted(want, key=str)


def test_ordered_starts_without_groups_and_on_an_empty_table(spark):
    df = keyed(spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("v")), ["v"])
    assert all(r.v == r.start for r in ordered_starts(df, "_key", target_rows=20).collect())
    assert ordered_starts(df.where("v < 0"), "_key").count() == 0
    assert cut_values(df.where("v < 0"), "_key", spark.createDataFrame([(1,)], "k long")).count() == 0
