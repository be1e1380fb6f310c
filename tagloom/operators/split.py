"""Exact, reproducible train / validation / test splits.

Contract (not bit-equality with NumPy permutations): exact sizes, disjoint,
exhaustive, deterministic by seed, independent of partitioning. The order
inside each split decision is ``md5("seed:row_id")`` then ``row_id`` (or
``row_id`` itself for positional splits); sizes follow the reference's
formulas. Rows are never shuffled: see ``rank.segment_by_rank``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .radix import cut_values, order_key
from .rank import BROADCAST_ROW_LIMIT, hash_order_key, segment_by_rank


def _name_segments(df: DataFrame, names: Sequence[str], split_col: str, seg_col: str = "_seg") -> DataFrame:
    arr = F.array(*[F.lit(n) for n in names])
    return df.withColumn(split_col, F.element_at(arr, F.col(seg_col) + 1)).drop(seg_col, "_okey")


def split_by_sizes(df: DataFrame, id_col: str, sizes: Sequence[int], names: Sequence[str], seed, split_col: str = "split",
                   n: int | None = None) -> DataFrame:
    """First ``sizes[0]`` rows in hash order -> ``names[0]``, next ``sizes[1]`` -> ``names[1]``, rest -> last name."""
    ks, acc = [], 0
    for s in sizes:
        acc += int(s)
        ks.append((acc,))
    keyed = df.withColumn("_okey", hash_order_key(seed, id_col))
    seg = segment_by_rank(keyed, "_okey", id_col, ks, max_group_rows=n)
    return _name_segments(seg, names, split_col)


def random_split_sizes(n: int, test_size: float, val_size: float) -> tuple[int, int, int]:
    """test = ceil(test_size * n); val = ceil(val_size * (n - test)); train = rest."""
    n_test = math.ceil(float(test_size) * n)
    n_val = math.ceil(float(val_size) * (n - n_test)) if val_size else 0
    return n - n_test - n_val, n_val, n_test


def split_random(df: DataFrame, id_col: str = "row_id", test_size: float = 0.1, val_size: float = 0.1, seed=42,
                 split_col: str = "split") -> DataFrame:
    """Two-step random split (test first, then validation from the rest)."""
    n = df.count()
    n_train, n_val, n_test = random_split_sizes(n, test_size, val_size)
    return split_by_sizes(df, id_col, [n_test, n_val], ["test", "val", "train"], seed, split_col, n)


def random_split_column(ids: DataFrame, id_col: str = "row_id", test_size: float = 0.1, val_size: float = 0.1, seed=42) -> Column:
    """The split of :func:`split_random` as an expression of ``id_col``, found on the narrow table ``ids``: it names the split in
    any table with the same ids, so wide rows take part in no job before their own."""
    n = ids.count()
    _, n_val, n_test = random_split_sizes(n, test_size, val_size)
    key = F.concat(hash_order_key(seed, id_col), order_key(ids, [id_col]))
    cuts = [n_test, n_test + n_val]
    inner = sorted({c for c in cuts if 0 < c < n})
    keys = {}
    if inner:
        wanted = ids.sparkSession.createDataFrame([(c,) for c in inner], "k long")
        keys = {r["k"]: r["key"] for r in cut_values(ids.select(key.alias("_okey")), "_okey", wanted).collect()}  # one row per cut
    passed = [F.lit(0) if c >= n else F.lit(1) if c <= 0 else (key > F.lit(keys[c])).cast("int") for c in cuts]
    return F.element_at(F.array(F.lit("test"), F.lit("val"), F.lit("train")), passed[0] + passed[1] + 1)


def split_holdout(df: DataFrame, id_col: str = "row_id", test_size: float = 0.2, seed=42, split_col: str = "split") -> DataFrame:
    """Single random holdout (``train_test_split(test_size=0.2)``)."""
    return split_random(df, id_col, test_size, 0.0, seed, split_col)


def fraction_sizes(n: int, train_frac: float = 0.8, test_frac: float = 0.1) -> dict[str, int]:
    """train = int(0.8 n), test = int(0.1 n), val = the rest."""
    n_train, n_test = int(float(train_frac) * n), int(float(test_frac) * n)
    return {"train": n_train, "test": n_test, "val": n - n_train - n_test}


def split_fraction(df: DataFrame, id_col: str = "row_id", train_frac: float = 0.8, test_frac: float = 0.1, seed=42,
                   split_col: str = "split", n: int | None = None) -> DataFrame:
    """train = int(0.8 n), test = int(0.1 n), val = the rest (segment order train, test, val)."""
    n = df.count() if n is None else n
    sizes = fraction_sizes(n, train_frac, test_frac)
    n_train, n_test = sizes["train"], sizes["test"]
    return split_by_sizes(df, id_col, [n_train, n_test], ["train", "test", "val"], seed, split_col, n)


def split_by_position(df: DataFrame, order_cols: Sequence[str], train_frac: float = 0.8, drop_last: bool = False,
                      split_col: str = "split", target_rows: int = 200_000) -> DataFrame:
    """First ``int(train_frac * n)`` rows in the order of ``order_cols`` (together unique, of any orderable type, nulls
    first) -> train, the rest -> test.

    Only the key at each cut is found (``radix.cut_values``: buckets are opened until none holds more than ``target_rows``
    rows); every row is then compared with it. ``drop_last=True`` reproduces the reference's
    ``messages[k:-1]``, which loses the last row.
    """
    n = df.count()
    if n == 0:
        return df.withColumn(split_col, F.lit(None).cast("string"))
    keyed = df.withColumn("_okey", order_key(df, order_cols))
    k = int(float(train_frac) * n)
    cuts = [k, n - 1] if drop_last else [k]
    wanted = df.sparkSession.createDataFrame([(c,) for c in cuts], "k long")
    keys = {r["k"]: r["key"] for r in cut_values(keyed, "_okey", wanted, target_rows=target_rows).collect()}  # one row per cut
    passed = [F.lit(0) if c >= n else F.lit(1) if c <= 0 else (F.col("_okey") > F.lit(keys[c])).cast("int") for c in cuts]
    out = _name_segments(keyed.withColumn("_seg", sum(passed[1:], passed[0])), ["train", "test", "_dropped"], split_col)
    return out.where(F.col(split_col) != "_dropped") if drop_last else out


def split_positional(df: DataFrame, id_col: str = "row_id", train_frac: float = 0.8, drop_last: bool = False,
                     split_col: str = "split") -> DataFrame:
    """:func:`split_by_position` by one unique id of any orderable type."""
    return split_by_position(df, [id_col], train_frac, drop_last, split_col)


def stratified_quota(counts: DataFrame, label_col: str, n_col: str, draws: int, out_col: str, target_rows: int = 200_000) -> DataFrame:
    """scikit-learn's ``_approximate_mode``: floor of ``n / total * draws`` per class,
    the remaining draws to the largest remainders (ties: by label, where
    scikit-learn picks at random). Input is one row per class, of any number of classes: how many
    draws remain is one sum, and the last remainder that gets one is found by ``radix.cut_values``."""
    total = counts.agg(F.sum(n_col)).first()[0]
    share = (F.col(n_col) / F.lit(total)) * F.lit(draws)
    w = counts.withColumn("_floor", F.floor(share).cast("long")).withColumn("_less", F.col("_floor") - share)
    need = draws - w.agg(F.sum("_floor")).first()[0]
    more = F.lit(0)
    if need > 0:
        keyed = w.select(order_key(w, ["_less", label_col]).alias("_qkey"))
        last = cut_values(keyed, "_qkey", w.sparkSession.createDataFrame([(need,)], "k long"), target_rows=target_rows).first()
        more = (order_key(w, ["_less", label_col]) <= F.lit(last["key"])).cast("int")
    return w.withColumn(out_col, (F.col("_floor") + more).cast("long")).drop("_floor", "_less")


def stratified_plan(df: DataFrame, label_col: str, first_test: float = 0.3, second_test: float = 0.5, target_rows: int = 200_000) -> DataFrame:
    """Per class ``n, n_train, n_val, n_test`` of the two-step stratified split (70/15/15).

    One job counts the classes (partial aggregation); the quota arithmetic runs on the stored table of one row per
    class. Totals alone come to the driver.
    """
    counts = stored(df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n")), "stratified_classes")
    lonely = F.when(F.col("n") < 2, F.col(label_col))
    seen = counts.agg(F.sum("n").alias("n"), F.count_if(F.col(label_col).isNull()).alias("nulls"), F.min(lonely).alias("lonely")).first()
    if seen["nulls"]:
        raise ValueError(f"null {label_col!r} values: drop or fill them before a stratified split")
    if seen["lonely"] is not None:
        raise ValueError(f"class {seen['lonely']!r} has fewer than 2 rows; stratified split impossible")
    n = seen["n"] or 0
    n_tmp = math.ceil(first_test * n)
    step1 = stratified_quota(counts, label_col, "n", n - n_tmp, "n_train", target_rows) if n else counts.withColumn("n_train", F.col("n"))
    step1 = step1.withColumn("n_tmp", F.col("n") - F.col("n_train"))
    step2 = (stratified_quota(step1, label_col, "n_tmp", n_tmp - math.ceil(second_test * n_tmp), "n_val", target_rows) if n
             else step1.withColumn("n_val", F.col("n")))
    return step2.withColumn("n_test", F.col("n_tmp") - F.col("n_val")).drop("n_tmp")


def split_stratified(df: DataFrame, label_col: str, id_col: str = "row_id", seed=42, split_col: str = "split",
                     target_rows: int = 200_000) -> DataFrame:
    """Stratified 70 / 15 / 15 split: exact per-class quotas, hash order inside each class.

    Quotas and the keys at the cuts are tables of one row per class, joined with the rows and never collected. Keys are found by
    ``radix.cut_values``, so a class holding a third of all rows is spread over many tasks. ``id_col``: unique, of any orderable type.
    An empty table gives no rows.
    """
    plan = stored(stratified_plan(df, label_col, target_rows=target_rows), "stratified_plan")
    key = F.concat(hash_order_key(seed, id_col), order_key(df, [id_col]))
    ends = F.array(F.col("n_train"), F.col("n_train") + F.col("n_val"))
    wanted = plan.select(label_col, F.explode(F.array_distinct(ends)).alias("k"))
    found = cut_values(df.select(label_col, key.alias("_okey")), "_okey", wanted, [label_col], target_rows)
    per_class = found.groupBy(F.col(label_col).alias("_class")).agg(F.collect_list(F.struct("k", "key")).alias("_keys"))  # two at most
    cuts = plan.select(F.col(label_col).alias("_label"), ends.alias("_ends")).join(per_class, F.col("_label") == F.col("_class"), "left")

    def key_at(i: int) -> Column:  # null where the cut lies before the first row
        return F.get(F.filter("_keys", lambda x: x["k"] == F.get("_ends", F.lit(i))), F.lit(0))["key"]

    cuts = stored(cuts.select("_label", key_at(0).alias("_cut0"), key_at(1).alias("_cut1")), "stratified_cuts")
    n_classes = cuts.count()
    hinted = F.broadcast(cuts) if n_classes <= BROADCAST_ROW_LIMIT else cuts
    passed = [F.coalesce((key > F.col(c)).cast("int"), F.lit(1)) for c in ("_cut0", "_cut1")]
    joined = df.join(hinted, df[label_col] == F.col("_label")).withColumn("_seg", passed[0] + passed[1])
    return _name_segments(joined.drop("_label", "_cut0", "_cut1"), ["train", "val", "test"], split_col)
