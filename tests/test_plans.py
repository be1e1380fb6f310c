"""Plan-shape checks: the exact split and rank operators never funnel data through one partition."""

import re

from pyspark.sql import functions as F

from tagloom.operators import rank as R
from tagloom.operators import split as X
from tagloom.operators.joins import left_join_content
from tagloom.plans.loader import assign_batches

DOCS = "/root/testdata/sf0.01/documents.parquet"


def _final_plan(df):
    df.collect()  # run this DataFrame's own execution so AQE shows its final plan
    return df._jdf.queryExecution().executedPlan().toString()


def _docs(spark):
    return spark.read.parquet(DOCS).select(F.col("doc_id").alias("row_id"), "lang", "text")


def test_splits_move_no_rows(spark):
    d = _docs(spark)
    for out in (X.split_positional(d, "row_id"), X.split_stratified(d, "lang", "row_id"), X.split_fraction(d, "row_id")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
        # stratified adds only the broadcast of one row per class; nothing hash- or range-shuffles the rows
        assert "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_exact_rank_shuffles_rows_once_and_never_to_one_partition(spark):
    d = _docs(spark).withColumn("k", R.hash_order_key(1, "row_id"))
    plan = _final_plan(R.exact_rank(d, "k", "row_id"))
    final = plan.split("Initial Plan")[0]
    # the only single-partition step is the running sum over the bucket counts
    for m in re.finditer(r"Exchange SinglePartition", final):
        below = final[m.end(): m.end() + 600]
        assert "_rn" in below or "count(1)" in below
    assert "monotonically_increasing_id" not in final and "rangepartitioning" not in final


def test_batches_single_partition_only_for_counts(spark):
    d = _docs(spark).withColumn("k", R.hash_order_key(1, "row_id"))
    final = _final_plan(assign_batches(d, "k", "row_id", 16, group_col="lang")).split("Initial Plan")[0]
    assert "rangepartitioning" not in final


def test_skew_safe_left_join_equals_plain(spark):
    left = spark.range(300).select(F.col("id").alias("lid"),
                                   F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 5).cast("string")).alias("k"))
    # key "0" holds most right rows (a hot key), null keys on both sides
    right = spark.range(2000).select(F.col("id").alias("rid"),
                                     F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 3 == 0, (F.col("id") % 9).cast("string"))
                                     .otherwise(F.lit("0")).alias("u"))
    a = sorted(tuple(r) for r in left_join_content(left, right, "k", "u").select("lid", "rid").collect())
    b = sorted(tuple(r) for r in left_join_content(left, right, "k", "u", skew_safe=False).select("lid", "rid").collect())
    assert a == b and len(a) > 300


def test_spread_only_for_under_partitioned_inputs(spark):
    from tagloom.session import spread

    target = spark.sparkContext.defaultParallelism
    many = spark.range(1000).repartition(target * 2)
    assert spread(many) is many  # already parallel: the plan is left alone
    few = spark.range(1000).coalesce(1)
    assert spread(few).rdd.getNumPartitions() == target
