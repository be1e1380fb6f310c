"""Positional splits over ids of any type and spread, and dense label ids over many buckets."""

import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators.split import split_by_position, split_positional
from tagloom.operators.vocab import dense_ids
from tagloom.plans.sft import build_sft_single
from tagloom.session import release_stored


@pytest.fixture(autouse=True)
def scratch(spark):
    yield
    release_stored(spark)


IDS = {
    "one far outlier": ("bigint", [*range(2000), 1 << 62]),
    "both ends of the type": ("bigint", [-(1 << 62) - 5, (1 << 62) + 5, *range(500)]),
    "strings": ("string", [f"row-{i:05d}" for i in range(700)] + ["", "é", "zz"]),
    "negative": ("int", list(range(-300, 41))),
    "doubles": ("double", [x / 7 for x in range(-200, 333)]),
}


@pytest.mark.parametrize("name", sorted(IDS))
@pytest.mark.parametrize("drop_last", [False, True])
def test_positional_split_over_any_ids(spark, name, drop_last):
    dtype, ids = IDS[name]
    rows = random.Random(1).sample(ids, len(ids))
    df = spark.createDataFrame([(v,) for v in rows], f"row_id {dtype}").repartition(5)
    out = {r.row_id: r.split for r in split_by_position(df, ["row_id"], 0.8, drop_last, target_rows=40).collect()}
    want = sorted(ids, key=lambda v: v.encode() if isinstance(v, str) else v)
    k = int(0.8 * len(want))
    kept = want[:-1] if drop_last else want
    assert out == {v: "train" if i < k else "test" for i, v in enumerate(kept)}


def test_positional_split_of_no_and_one_row(spark):
    df = spark.createDataFrame([("a",)], "row_id string")
    assert [r.split for r in split_positional(df).collect()] == ["test"]
    assert split_positional(df.where("row_id > 'b'")).count() == 0


def test_no_bucket_is_numbered_beyond_the_target(spark):
    """2^21 ids and one at 2^62: the rows that are numbered to find the cut are few."""
    from tagloom.operators import radix

    df = spark.range(1 << 21).union(spark.createDataFrame([(1 << 62,)], "id long")).withColumn("_k", F.lit(None))
    keyed = df.select(radix.order_key(df, ["id"]).alias("key"), "id")
    seen = []
    plain = radix.stored

    def spy(table, name):
        out = plain(table, name)
        if name == "radix_cuts":
            seen.append(out.agg(F.max("_n")).first()[0])
        return out

    radix.stored = spy
    try:
        got = radix.cut_values(keyed, "key", spark.createDataFrame([(1 << 20,)], "k long"), target_rows=10_000).first()["key"]
    finally:
        radix.stored = plain
    assert keyed.where(F.col("key") == got).first()["id"] == (1 << 20) - 1
    assert seen[-1] <= 10_000 and len(seen) <= 3


def test_sft_records_by_position_of_string_ids(spark):
    rows = [(f"d{i % 7}", f"p{i}", f"text {i}", "x") for i in range(50)]
    out = build_sft_single(spark.createDataFrame(rows, "doc_id string, page_id string, content string, label string")).collect()
    want = sorted((r[0], r[1]) for r in rows)
    assert {(r.doc_id, r.page_id): r.split for r in out} == {w: "train" if i < 40 else "test" for i, w in enumerate(want)}


def test_dense_ids_of_labels_with_shared_prefixes(spark):
    rnd = random.Random(2)
    labels = {f"shared/prefix/of/every/label/{rnd.randrange(3)}/{rnd.randrange(10**6)}" for _ in range(3000)} | {"", "a", "é", "shared", "日本"}
    df = spark.createDataFrame([(x,) for x in [*labels, *list(labels)[:500], None]], "label string").repartition(4)
    got = {r.label: r.id for r in dense_ids(df, target_rows=100).collect()}
    assert got == {x: i for i, x in enumerate(sorted(labels))}


def test_labels_never_meet_in_one_task(spark):
    df = spark.range(20_000).select(F.concat(F.lit("label "), F.col("id") % 5000).alias("label"))
    plan = dense_ids(df)._jdf.queryExecution().executedPlan().toString()
    # bucket counts meet in one task, labels don't: the only single partition stands over the stored counts
    before = plan.split("Exchange SinglePartition")[1:]
    assert all("label" not in part.split("FileScan")[1] for part in before)
