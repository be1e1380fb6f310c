from collections import Counter

import pytest
from pyspark.sql import functions as F

from tagloom.operators import rank as R
from tagloom.operators import split as X


def _ids(spark, n, parts=4):
    return spark.range(n).withColumnRenamed("id", "row_id").repartition(parts)


def test_positional(spark):
    df = _ids(spark, 10)
    got = {r.row_id: r.split for r in X.split_positional(df, "row_id", 0.8).collect()}
    assert [got[i] for i in range(10)] == ["train"] * 8 + ["test"] * 2
    got = {r.row_id: r.split for r in X.split_positional(df, "row_id", 0.8, drop_last=True).collect()}
    assert sorted(got) == list(range(9)) and Counter(got.values()) == {"train": 8, "test": 1}


def test_random_sizes_and_partition_independence(spark):
    a = {r.row_id: r.split for r in X.split_random(_ids(spark, 1000, 3), "row_id", 0.1, 0.1, 42).collect()}
    b = {r.row_id: r.split for r in X.split_random(_ids(spark, 1000, 11), "row_id", 0.1, 0.1, 42).collect()}
    assert Counter(a.values()) == {"train": 810, "val": 90, "test": 100}
    assert a == b and sorted(a) == list(range(1000))


def test_random_matches_brute_force(spark):
    import hashlib

    n = 137
    order = sorted(range(n), key=lambda i: (hashlib.md5(f"7:{i}".encode()).hexdigest(), i))
    n_test = -(-n // 10)
    expect = {i: ("test" if k < n_test else "train") for k, i in enumerate(order)}
    got = {r.row_id: r.split for r in X.split_random(_ids(spark, n), "row_id", 0.1, 0.0, 7).collect()}
    assert got == expect


def test_small_buckets_still_exact(spark):
    # force many buckets so cut ranks fall inside partially covered buckets
    df = _ids(spark, 3000).withColumn("_k", R.hash_order_key(1, "row_id"))
    cuts = [(0,), (1,), (1500,), (1500,), (2999,), (3000,), (5000,)]
    seg = R.segment_by_rank(df, "_k", "row_id", cuts, target_bucket_rows=50).collect()
    order = sorted(seg, key=lambda r: (r._k, r.row_id))
    for rank, r in enumerate(order, start=1):
        assert r._seg == sum(1 for k in (0, 1, 1500, 1500, 2999, 3000, 5000) if rank > k)


def test_grouped_segments_match_brute_force(spark):
    df = _ids(spark, 2000).withColumn("g", (F.col("row_id") % 3).cast("string")).withColumn("_k", R.hash_order_key(5, "row_id"))
    cuts = [("0", 10), ("0", 10), ("1", 0), ("1", 400), ("2", 666), ("2", 667), ("2", 9999)]
    seg = R.segment_by_rank(df, "_k", "row_id", cuts, group_cols=["g"], target_bucket_rows=20).collect()
    for gv in "012":
        rows = sorted((r for r in seg if r.g == gv), key=lambda r: (r._k, r.row_id))
        ks = [k for g2, k in cuts if g2 == gv]
        for rank, r in enumerate(rows, start=1):
            assert r._seg == sum(1 for k in ks if rank > k)


def test_stratified_quotas(spark):
    df = _ids(spark, 1000).withColumn("c", F.when(F.col("row_id") % 10 < 7, "a").when(F.col("row_id") % 10 < 9, "b").otherwise("c"))
    out = X.split_stratified(df, "c", "row_id", 42)
    counts = Counter((r.c, r.split) for r in out.collect())
    assert counts[("a", "train")] == 490 and counts[("b", "train")] == 140 and counts[("c", "train")] == 70
    assert sum(counts.values()) == 1000
    with pytest.raises(ValueError):
        X.split_stratified(df.withColumn("c", F.when(F.col("row_id") == 0, "lonely").otherwise("x")), "c", "row_id")


def test_stratified_split_of_many_classes(spark):
    classes = 1_000_000  # of 2 or 3 rows each, and one class of 100,000
    ids = spark.range(2_500_000).select(F.col("id").alias("row_id"), (F.col("id") % classes).alias("c"))
    df = ids.unionByName(spark.range(2_500_000, 2_600_000).select(F.col("id").alias("row_id"), F.lit(-1).cast("long").alias("c")))
    counts = X.split_stratified(df, "c", "row_id", 42).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in counts} == {"train": 1_820_000, "val": 390_000, "test": 390_000}


def test_stratified_split_by_any_id_and_in_small_buckets(spark):
    rows = [(f"r{k:03d}" if k % 2 else f"ü{k}", "ab"[k % 3 == 0], k, "x") for k in range(400)]
    df = spark.createDataFrame(rows, "row_id string, c string, k int, n string").repartition(5)
    got = X.split_stratified(df, "c", "row_id", 7, target_rows=20)
    assert sorted(got.columns) == sorted([*df.columns, "split"])
    names = {r.row_id: r.split for r in got.collect()}
    assert names == {r.row_id: r.split for r in X.split_stratified(df, "c", "row_id", 7).collect()}
    import hashlib

    for c in "ab":
        mine = sorted((hashlib.md5(f"7:{i}".encode()).hexdigest(), i) for i, x, *_ in rows if x == c)
        order = [names[i] for _, i in mine]
        assert order == sorted(order, key=["train", "val", "test"].index) and len(set(order)) == 3
    assert X.split_stratified(df.limit(0), "c", "row_id").count() == 0


def test_exact_rank_equals_row_number(spark):
    df = _ids(spark, 500, 7).withColumn("k", R.hash_order_key(3, "row_id"))
    got = {r.row_id: r.rank for r in R.exact_rank(df, "k", "row_id", target_bucket_rows=20).collect()}
    order = sorted(df.collect(), key=lambda r: (r.k, r.row_id))
    assert got == {r.row_id: i for i, r in enumerate(order, start=1)}
    g = df.withColumn("g", (F.col("row_id") % 3).cast("string"))
    got = {(r.g, r.row_id): r.rank for r in R.exact_rank(g, "k", "row_id", ["g"], target_bucket_rows=10).collect()}
    for gv in "012":
        rows = sorted((r for r in g.collect() if r.g == gv), key=lambda r: (r.k, r.row_id))
        assert all(got[(gv, r.row_id)] == i for i, r in enumerate(rows, start=1))


def test_split_plan_moves_no_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("doc_id").alias("row_id"), "text")
    out = X.split_random(df, "row_id", 0.1, 0.1, 42)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SinglePartition" not in plan


def test_null_groups_are_rejected(spark):
    df = _ids(spark, 50).withColumn("c", F.when(F.col("row_id") < 5, None).otherwise("a")).withColumn("_k", R.hash_order_key(1, "row_id"))
    with pytest.raises(ValueError):
        X.split_stratified(df, "c", "row_id")
    with pytest.raises(ValueError):
        R.exact_rank(df, "_k", "row_id", ["c"])


def test_segment_by_rank_random_configs(spark):
    import random

    rng = random.Random(11)
    for trial in range(4):
        n = rng.randint(50, 1500)
        n_groups = rng.randint(1, 4)
        df = _ids(spark, n, rng.randint(1, 9)).withColumn("g", (F.col("row_id") * 7 % n_groups).cast("string"))
        df = df.withColumn("_k", R.hash_order_key(trial, "row_id"))
        sizes = Counter(str(i * 7 % n_groups) for i in range(n))
        cuts = [(g, rng.randint(-2, sizes[g] + 2)) for g in sizes for _ in range(rng.randint(0, 3))]
        seg = R.segment_by_rank(df, "_k", "row_id", cuts, group_cols=["g"], target_bucket_rows=rng.choice([5, 40, 10_000])).collect()
        for gv in sizes:
            rows = sorted((r for r in seg if r.g == gv), key=lambda r: (r._k, r.row_id))
            ks = [k for g2, k in cuts if g2 == gv]
            assert [r._seg for r in rows] == [sum(1 for k in ks if rank > k) for rank in range(1, len(rows) + 1)]
