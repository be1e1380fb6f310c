"""Exact distributed ranks and order statistics.

Two tools, both without any unpartitioned window over data-sized input:

* ``exact_rank`` — the exact 1-based position of every row in a hash order
  (optionally within groups). Bucket the hash key so each bucket holds about
  ``target_bucket_rows`` rows, count rows per bucket, and number rows inside
  each bucket from the bucket's start. Deterministic: no range sampling and
  no partition-dependent ids, so recomputed tasks agree.

* ``segment_by_rank`` — exact splits by rank without moving
  the rows at all. A split only needs, per group, the order value at a few
  ranks ("cut points"). Bucket the order key, count rows per bucket (partial
  aggregation, tiny output), find the bucket each cut falls into, rank only
  the rows of those few buckets, and compare every row against the cut
  values in a projection. Buckets are chosen so each holds about
  ``target_bucket_rows`` rows of its group, however large a group is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Cut lists (a few rows per group) carry a broadcast hint up to this many rows.
BROADCAST_ROW_LIMIT = 100_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_order_key(seed, *cols) -> Column:
    """Deterministic pseudo-random order key: md5 of ``seed:col1:col2..`` (32 hex chars).

    The same expression runs in DuckDB as ``md5(concat_ws(':', ...))``.
    """
    parts = [F.lit(str(seed))] + [_col(c).cast("string") for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def exact_rank(
    df: DataFrame,
    key_col: str,
    id_col: str,
    group_cols: Sequence[str] = (),
    rank_col: str = "rank",
    target_bucket_rows: int = 200_000,
    group_sizes: dict | None = None,
) -> DataFrame:
    """Add ``rank_col`` = exact 1-based position of each row in ``(key_col, id_col)`` order
    within its group; ``key_col`` is a hex hash key (e.g. ``hash_order_key``), ``id_col`` unique.

    Rows are numbered inside hash-prefix buckets of about ``target_bucket_rows``
    rows of their group (a group holding a third of all rows just gets more
    buckets), and each bucket's start comes from bucket counts. Everything is
    a function of the data: no sampling, no partition-dependent ids, so a
    recomputed task yields the same ranks. One shuffle moves the rows (by
    group and bucket); Spark picks the join with the bucket table by its size.
    """
    g = list(group_cols) or ["_all"]
    if not group_cols:
        df = df.withColumn("_all", F.lit(0))
    if group_sizes is not None:  # caller already knows the sizes (e.g. a split it just made)
        largest = max(group_sizes.values()) if group_cols else sum(group_sizes.values())
    else:
        null_group = F.lit(False)
        for c in g:
            null_group = null_group | F.col(c).isNull()
        stats = df.groupBy(*g).count().agg(F.max("count").alias("n"), F.coalesce(F.max(null_group), F.lit(False)).alias("null")).first()
        if stats["null"]:
            raise ValueError(f"null values in rank group columns {g}")
        largest = stats["n"] or 0
    # enough buckets for every core, and of a bounded number of rows
    cores = df.sparkSession.sparkContext.defaultParallelism
    digits = max(2, _bucket_digits(largest, target_bucket_rows), _bucket_digits(4 * cores, 1))
    keyed = df.withColumn("_rb", F.substring(key_col, 1, digits))
    hist = keyed.groupBy(*g, "_rb").agg(F.count(F.lit(1)).alias("_rn"))
    upto = Window.partitionBy(*g).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    starts = hist.select(*g, "_rb", F.coalesce(F.sum("_rn").over(upto), F.lit(0)).alias("_rstart"))
    in_bucket = Window.partitionBy(*g, "_rb").orderBy(F.col(key_col), F.col(id_col))
    return (
        keyed.join(starts, g + ["_rb"])
        .withColumn(rank_col, F.col("_rstart") + F.row_number().over(in_bucket))
        .drop("_rb", "_rstart", "_all")
    )


def _bucket_digits(max_group_rows: int, target_bucket_rows: int) -> int:
    if max_group_rows <= target_bucket_rows:
        return 1
    return min(16, max(1, math.ceil(math.log(max_group_rows / target_bucket_rows, 16))))


def segment_by_rank(
    df: DataFrame,
    key_col: str,
    id_col: str,
    cuts: Sequence[tuple],
    group_cols: Sequence[str] = (),
    seg_col: str = "_seg",
    max_group_rows: int | None = None,
    target_bucket_rows: int = 200_000,
) -> DataFrame:
    """Add ``seg_col`` = number of cut ranks each row's rank exceeds.

    Rows are ordered by ``(key_col, id_col)`` inside their group, where
    ``key_col`` is a hex string (e.g. an md5 order key) and ``id_col`` unique.
    ``cuts`` lists ``(*group_values, k)`` rank thresholds (a few per group,
    derived from counts, so bounded). A row of rank r gets ``#{k : r > k}``.

    Jobs: one bucket histogram (partial aggregation, ~n/target_bucket_rows
    rows), one exact ranking restricted to the buckets that hold a cut, then
    a projection (one group: literals; several: a broadcast join of one row
    per group). Rows never move.
    """
    spark = df.sparkSession
    g = list(group_cols) or ["_all"]
    if not group_cols:
        df = df.withColumn("_all", F.lit(0))
        cuts = [(0, c[-1]) for c in cuts]

    def hinted(table):
        return F.broadcast(table) if len(cuts) <= BROADCAST_ROW_LIMIT else table

    if any(v is None for c in cuts for v in c[:-1]):
        raise ValueError("null group value in cut points")
    mult: dict[tuple, int] = {}
    for c in cuts:
        key = tuple(c[:-1]) + (int(c[-1]),)
        mult[key] = mult.get(key, 0) + 1  # equal cut ranks collapse, with a multiplicity
    gtypes = [df.schema[c].dataType.simpleString() for c in g]
    cut_schema = ", ".join(f"`{c}` {t}" for c, t in zip(g, gtypes)) + ", k long, _mult long"
    cuts_df = spark.createDataFrame([k + (m,) for k, m in mult.items()], cut_schema)

    narrow = df.select(*g, F.col(key_col).alias("_ck"), F.col(id_col).alias("_cid"))
    if max_group_rows is None:
        max_group_rows = narrow.groupBy(*g).count().agg(F.max("count")).first()[0] or 0
    digits = _bucket_digits(int(max_group_rows), target_bucket_rows)

    bucketed = narrow.withColumn("_b", F.substring("_ck", 1, digits))
    hist = bucketed.groupBy(*g, "_b").agg(F.count(F.lit(1)).alias("_bn"))
    # running row count per group over its (at most ~ n / target) buckets
    upto = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumn("_end", F.sum("_bn").over(upto)).withColumn("_start", F.col("_end") - F.col("_bn"))
    # the bucket holding each cut rank: start < k <= end (equi-join on the group, range test)
    targets = (
        hist.join(hinted(cuts_df), g, "inner")
        .where((F.col("_start") < F.col("k")) & (F.col("k") <= F.col("_end")))
        .select(*g, "_b", "k", "_mult", (F.col("k") - F.col("_start")).alias("_kr"))
        .collect()  # at most one row per cut point
    )
    below: dict[tuple, int] = {}
    for k, m in mult.items():
        if k[-1] <= 0:  # exceeded by every row of the group
            below[k[:-1]] = below.get(k[:-1], 0) + m

    picked_rows = []
    if targets:
        t_df = spark.createDataFrame([tuple(r) for r in targets], ", ".join(
            [f"`{c}` {t}" for c, t in zip(g, gtypes)] + ["_b string", "k long", "_mult long", "_kr long"]))
        # exact position only inside the target buckets (each about target_bucket_rows rows)
        in_bucket = Window.partitionBy(*g, "_b", "k").orderBy("_ck", "_cid")
        picked_rows = (
            bucketed.join(hinted(t_df), g + ["_b"], "inner")
            .withColumn("_r", F.row_number().over(in_bucket))
            .where(F.col("_r") == F.col("_kr"))
            .select(*g, "_ck", "_cid", "_mult")
            .collect()  # one row per target
        )

    me = F.struct(F.col(key_col).alias("k"), F.col(id_col).alias("i"))
    id_type = df.schema[id_col].dataType
    if not group_cols:
        passed = F.lit(below.get((0,), 0))
        for r in picked_rows:
            v = F.struct(F.lit(r["_ck"]).alias("k"), F.lit(r["_cid"]).cast(id_type).alias("i"))
            passed = passed + F.when(me > v, F.lit(r["_mult"])).otherwise(F.lit(0))
        return df.withColumn(seg_col, passed.cast("int")).drop("_all")

    per_group: dict[tuple, list] = {}
    for r in picked_rows:
        per_group.setdefault(tuple(r[c] for c in g), []).append((r["_ck"], r["_cid"], r["_mult"]))
    groups = set(per_group) | set(below)
    cut_type = f"array<struct<v:struct<k:string,i:{id_type.simpleString()}>,m:long>>"
    rows = [gv + ([((ck, ci), m) for ck, ci, m in per_group.get(gv, [])], below.get(gv, 0)) for gv in groups]
    small = spark.createDataFrame(rows, ", ".join([f"`{c}` {t}" for c, t in zip(g, gtypes)] + [f"_cuts {cut_type}", "_below long"]))
    exceeded = F.aggregate(
        F.coalesce(F.col("_cuts"), F.array().cast(cut_type)), F.lit(0).cast("long"),
        lambda acc, c: acc + F.when(me > c["v"], c["m"]).otherwise(F.lit(0)),
    )
    passed = F.coalesce(F.col("_below"), F.lit(0)) + exceeded
    # one row per group
    return df.join(hinted(small), g, "left").withColumn(seg_col, passed.cast("int")).drop("_cuts", "_below")
