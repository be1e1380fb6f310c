"""Orders by a keyed bijection: permutations for any size, no exchange for a further epoch."""

from collections import Counter

from pyspark.sql import functions as F

from tagloom.operators import permute as PM
from tagloom.plans.loader import epoch_batches


def _by_hand(x, n, seed, order):
    for s, a, b in PM.round_keys(seed, order):
        y = (s - x) % n
        top = max(x, y)
        m = (top % 2**30 * a + top // 2**30 * b + b) % PM.PRIME
        x = y if (m * m + s) % PM.PRIME % 2 else x
    return x


def _sizes(spark, sizes):
    rows = spark.createDataFrame([(n,) for n in sizes], "n long")
    return rows.select("n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("x"))


def test_permutations_of_every_size(spark):
    rows = _sizes(spark, [*range(1, 130), 997, 4096, 5000])
    for seed, order in ((42, 1), ("s", 7)):
        out = rows.withColumn("y", PM.permuted(F.col("x"), F.col("n"), seed, order))
        got = out.groupBy("n").agg(F.count("y").alias("k"), F.countDistinct("y").alias("d"), F.min("y").alias("lo"), F.max("y").alias("hi"))
        assert all((r.k, r.d, r.lo, r.hi) == (r.n, r.n, 0, r.n - 1) for r in got.collect())


def test_equal_to_integers_of_any_length(spark):
    n = (1 << 61) + 12345  # no step overflows
    cases = [(x, size) for size in (1, 2, 77, 10**9 + 7, n) for x in (0, size // 3, size - 1)]
    df = spark.createDataFrame(cases, "x long, n long").withColumn("y", PM.permuted(F.col("x"), F.col("n"), 5, 3))
    assert all(r.y == _by_hand(r.x, r.n, 5, 3) for r in df.collect())


def test_orders_look_random():
    n, orders = 64, 400
    for x in (0, 5):
        seen = Counter(_by_hand(x, n, 1, o) for o in range(orders))
        chi = sum((seen[v] - orders / n) ** 2 / (orders / n) for v in range(n))
        assert chi < 63 + 4 * (2 * 63) ** 0.5  # mean and four deviations of chi-square on 63 degrees


def test_epochs_add_no_exchange(spark):
    rows = spark.range(3000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 10 < 8, "train").otherwise("test").alias("split"))
    ranked = PM.rank_once(rows, "row_id", "split", 42)
    one, two = (epoch_batches(ranked, e, 16, 42) for e in (1, 2))
    assert "Exchange" not in two._jdf.queryExecution().executedPlan().toString()
    a, b = ({r.row_id: (r.split, r.batch_id, r.pos_in_batch) for r in d.collect()} for d in (one, two))
    for d in (a, b):
        assert sorted(x * 16 + y for s, x, y in d.values() if s == "train") == list(range(2400))
        assert sorted(x * 16 + y for s, x, y in d.values() if s == "test") == list(range(600))
    assert all(a[k] == b[k] for k in a if a[k][0] == "test") and sum(a[k] == b[k] for k in a if a[k][0] == "train") < 20


def test_empty_table(spark):
    rows = spark.createDataFrame([], "row_id long, split string")
    assert epoch_batches(PM.rank_once(rows, "row_id", "split", 42), 1, 16, 42).count() == 0
