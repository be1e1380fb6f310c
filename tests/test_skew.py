"""A key / class holding a third of all rows: results stay exact and the hot group is
reduced or spread before it can land in one task."""

from collections import Counter

from pyspark.sql import functions as F

from tagloom.operators import rank as R
from tagloom.operators import split as X
from tagloom.operators.aggregate import dedupe_first
from tagloom.operators.joins import left_join_content

N = 3000


def _hot(spark):
    # every third row shares key "hot"; the rest have distinct keys
    return spark.range(N).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
    ).repartition(6)


def test_dedupe_hot_key_is_combined_map_side(spark):
    df = _hot(spark)
    out = dedupe_first(df, "k", "row_id")
    rows = {r.k: r.row_id for r in out.collect()}
    assert rows["hot"] == 0 and len(rows) == N - N // 3 + 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan  # hot key collapses to one candidate per map task


def test_stratified_with_dominant_class(spark):
    df = _hot(spark).withColumn("c", F.when(F.col("k") == "hot", "hot").otherwise((F.col("row_id") % 4).cast("string")))
    got = Counter((r.c, r.split) for r in X.split_stratified(df, "c", "row_id", 42, ).collect())
    assert got[("hot", "train")] == 700 and got[("hot", "val")] + got[("hot", "test")] == 300
    # the dominant class is ranked through its own hash buckets, not as one window partition
    keyed = df.withColumn("_k", R.hash_order_key(1, "row_id"))
    ranked = R.exact_rank(keyed, "_k", "row_id", ["c"], target_bucket_rows=100).collect()
    hot = sorted((r for r in ranked if r.c == "hot"), key=lambda r: (r._k, r.row_id))
    assert [r.rank for r in hot] == list(range(1, N // 3 + 1))


def test_left_join_hot_right_key(spark):
    left = spark.range(50).select(F.col("id").alias("lid"), F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    right = _hot(spark).select(F.col("row_id").alias("rid"), F.col("k").alias("u"))
    out = left_join_content(left, right, "k", "u")
    rows = out.collect()
    assert sum(1 for r in rows if r.lid == 0) == N // 3  # fan-out of the hot key kept whole
    assert len(rows) == N // 3 + 49  # other left rows: unmatched, kept once with nulls


def test_labels_meet_their_vocabulary_without_moving_rows(spark):
    """A few labels are no few tasks: whole rows are never dealt out by label, whatever Spark thinks of the vocabulary's size."""
    from tagloom.operators import joins as J
    from tagloom.operators import targets as TG
    from tagloom.operators.vocab import dense_ids

    df = _hot(spark).withColumn("label", F.when(F.col("k") == "hot", "hot").otherwise("other"))
    vocab = dense_ids(df)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        out = J.encode_label_id(df, vocab, "label", "y")
        back = J.decode_label_id(out.drop("label"), vocab, "y")
        cells = df.select("row_id", F.array("label").alias("labels"))
        hot = TG.sparse_targets(cells, vocab)
        for x in (out, back):
            plan = x._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "hashpartitioning(label" not in plan and "hashpartitioning(y" not in plan
        assert "hashpartitioning(label" not in hot._jdf.queryExecution().executedPlan().toString()
        assert out.rdd.getNumPartitions() == 6
        assert sorted((r.y, r.label, r["count"]) for r in back.groupBy("y", "label").count().collect()) == [(0, "hot", 1000), (1, "other", 2000)]
        assert hot.where("label_ids = array(0)").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_gradients_come_from_few_tasks(spark):
    from tagloom.session import gathered

    cores = spark.sparkContext.defaultParallelism
    assert gathered(spark.range(100, numPartitions=50 * cores)).rdd.getNumPartitions() == 2 * cores
    assert gathered(spark.range(100, numPartitions=1)).rdd.getNumPartitions() == 1
