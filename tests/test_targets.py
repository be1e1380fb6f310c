"""Sparse multi-label targets: many labels, awkward cells, and a plan that does not grow with the vocabulary."""

from pyspark.sql import functions as F

from tagloom.operators.split import random_split_column, split_random
from tagloom.operators.targets import dense_targets, sparse_targets
from tagloom.operators.vocab import dense_ids


def test_sparse_targets_on_awkward_cells(spark):
    rows = [(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["zz"]), (5, ["", "c"]), (6, ["unknown", "a"])]
    df = spark.createDataFrame(rows, "row_id bigint, labels array<string>")
    vocab = spark.createDataFrame([("", 0), ("a", 1), ("b", 2), ("c", 3), ("zz", 4)], "label string, id int")
    out = sparse_targets(df, vocab).withColumn("y", dense_targets("label_ids", 5))
    assert {r.row_id: r.label_ids for r in out.collect()} == {1: [1, 2], 2: [], 3: [], 4: [4], 5: [0, 3], 6: [1]}
    assert all([i for i, v in enumerate(r.y) if v] == r.label_ids and len(r.y) == 5 for r in out.collect())
    assert df.select(dense_targets(F.array(F.lit(1)), 0).alias("y")).first().y == []


def test_200_000_labels_over_100_000_rows(spark):
    n, m = 100_000, 200_000
    cells = F.array(*[F.format_string("label %06d", (F.col("id") * k + 7 * k) % m) for k in (1, 2, 3)])
    df = spark.range(n).select(F.col("id").alias("row_id"), cells.alias("labels"))
    df = df.union(spark.range(n, n + 2).select("id", F.array(*[F.concat(F.lit("only "), (F.col("id") % 2).cast("string"))])))
    vocab = dense_ids(df.select(F.explode("labels").alias("label")))
    out = sparse_targets(df, vocab)
    small = sparse_targets(df, vocab.where("id < 3"))
    sizes = [len(x._jdf.queryExecution().analyzed().toString()) for x in (out, small)]
    assert abs(sizes[0] - sizes[1]) < 2000  # the vocabulary is no part of the plan
    per_row = out.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("label_ids")).alias("ids")).first()
    distinct = df.select("row_id", F.explode("labels").alias("l")).distinct().count()
    assert per_row.rows == n + 2 and per_row.ids == distinct
    back = out.select("row_id", F.explode("label_ids").alias("id")).join(vocab, "id").select("row_id", "label")
    assert back.exceptAll(df.select("row_id", F.explode("labels").alias("label")).distinct()).isEmpty()


def test_split_column_names_the_splits_of_split_random(spark):
    for n in (0, 1, 2, 10, 257):
        df = spark.range(n).withColumnRenamed("id", "row_id")
        want = {r.row_id: r.split for r in split_random(df, "row_id", 0.1, 0.1, 42).collect()}
        got = {r.row_id: r.split for r in df.withColumn("split", random_split_column(df)).collect()}
        assert got == want
