"""Order statistics and dense numbering over any orderable key, by radix refinement.

``order_key`` turns a list of columns into one string whose binary order is the order of the columns. A
bucket is a prefix of that string. Buckets are counted (partial aggregation), and only a bucket that holds
more than ``target_rows`` rows is opened again, by a longer prefix that begins behind what all of its keys share.
So a far outlier, a long common prefix or a dense stretch costs another pass over the keys, never a
large bucket. Rows whose keys are wholly equal cannot be told apart and stay in one bucket: give a unique key.

* ``cut_values``: per group the key at given ranks; only buckets that hold a rank are opened.
* ``ordered_starts``: for every row the number (or total weight) of rows before it in its group.

Tables of buckets are stored between passes; nothing that grows with rows or groups comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored

#: Characters of the key that one pass looks at: up to 16^3 buckets for each bucket that is opened.
DIGITS = 3
#: Tables of at most this many rows (a few hundred bytes each) carry a broadcast hint.
HINTED_ROWS = 50_000
MIN_LONG = -(1 << 63)


def _encoded(c: Column, dtype: T.DataType, binary_str: bool = True) -> Column:
    """Upper-case hex whose binary order is the order of ``c`` (not null)."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.concat(F.hex(c), F.lit("!"))  # "!" sorts before any hex digit: a prefix comes first
    if isinstance(dtype, T.BooleanType):
        return F.when(c, "1").otherwise("0")
    if isinstance(dtype, T.DateType):
        return _encoded(F.unix_date(c).cast("long"), T.LongType())
    if isinstance(dtype, T.TimestampType):
        return _encoded(F.unix_micros(c), T.LongType())
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        d = F.when(c == 0, F.lit(0.0)).otherwise(c.cast("double"))  # -0.0 equals 0.0; NaN comes last
        bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), d).cast("long")
        return F.when(bits < 0, F.lpad(F.hex(F.bitwise_not(bits)), 16, "0")).otherwise(_encoded(bits, T.LongType()))
    if isinstance(dtype, T.DecimalType):
        whole = F.floor(c.cast(T.DecimalType(38, dtype.scale)))
        part = F.rpad(F.substring_index(F.format_string("%s", (c - whole).cast(T.DecimalType(38, dtype.scale))), ".", -1), max(dtype.scale, 1), "0")
        digits = F.lpad(F.abs(whole).cast("decimal(38,0)").cast("string"), 38, "0")
        mirrored = F.translate(digits, "0123456789", "9876543210")
        return F.concat(F.when(whole < 0, F.concat(F.lit("0"), mirrored)).otherwise(F.concat(F.lit("1"), digits)), part if dtype.scale else F.lit(""))
    if isinstance(dtype, T.IntegralType):
        return F.lpad(F.hex(c.cast("long").bitwiseXOR(F.lit(MIN_LONG))), 16, "0")  # the sign bit turned: negative first
    raise TypeError(f"no order key for {dtype.simpleString()}")


def order_key(df: DataFrame, cols: Sequence[str]) -> Column:
    """One string per row whose binary order is the order by ``cols`` (ascending, nulls first)."""
    parts = []
    for name in cols:
        c = F.col(name)
        parts.append(F.when(c.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), _encoded(c, df.schema[name].dataType))))
    return F.concat(*parts)


def _small(table: DataFrame, rows: int) -> DataFrame:
    """``table`` of so many rows, with a broadcast hint where they are few."""
    return F.broadcast(table) if rows <= HINTED_ROWS else table


def _shared(lo: Column, hi: Column) -> Column:
    """Length of the common prefix of two strings: a binary search over powers of two."""
    powers = F.array(*[F.lit(1 << p) for p in range(30, -1, -1)])
    limit = F.least(F.length(lo), F.length(hi))
    return F.aggregate(powers, F.lit(0), lambda at, p: F.when(
        (at + p <= limit) & (F.substring(lo, F.lit(1), at + p) == F.substring(hi, F.lit(1), at + p)), at + p).otherwise(at))


def _match(a: DataFrame, b: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = F.lit(True)
    for x, y in pairs:
        cond = cond & a[x].eqNullSafe(b[y])
    return cond


def _names(group_cols: Sequence[str]) -> list[str]:
    return [f"_g{i}" for i in range(len(group_cols))]


def _keyed(df: DataFrame, key_col: str, group_cols: Sequence[str], *more: Column) -> DataFrame:
    groups = [F.col(c).alias(n) for c, n in zip(group_cols, _names(group_cols))]
    return df.select(*groups, F.col(key_col).alias("_k"), *more)


def _opened(buckets: DataFrame, digits: int) -> DataFrame:
    """What an opened bucket needs: the length of its children's prefixes."""
    return buckets.withColumn("_len", _shared(F.col("_lo"), F.col("_hi")) + digits)


def _children(rows: DataFrame, open_: DataFrame, g: list[str], carry: Sequence[str] = ()) -> DataFrame:
    """Rows of the opened buckets with the prefix of their child."""
    o = open_.select(*[F.col(c).alias(f"_o{c}") for c in g], F.col("_p").alias("_op"), F.col("_len").alias("_olen"), *carry)
    cond = _match(rows, o, [(c, f"_o{c}") for c in g]) & (rows["_p"] == o["_op"])
    return rows.join(o, cond).withColumn("_p", F.expr("substring(_k, 1, _olen)")).drop("_op", "_olen", *[f"_o{c}" for c in g])


def _root(rows: DataFrame, g: list[str], tally: Sequence[Column], name: str) -> tuple[DataFrame, dict | None]:
    """Counts and key range per group; without groups also as the one row they are."""
    root = rows.groupBy(*g).agg(*tally)
    if g:
        return stored(root, name), None
    only = root.first()
    return rows.sparkSession.createDataFrame([tuple(only)], root.schema), only.asDict()


def _tell(state: DataFrame, *tests: Column) -> list[int]:
    """How many rows of ``state`` there are, and how many pass each test."""
    return list(state.agg(F.count(F.lit(1)), *[F.count_if(t) for t in tests]).first())


def cut_values(df: DataFrame, key_col: str, cuts: DataFrame, group_cols: Sequence[str] = (), target_rows: int = 200_000,
               digits: int = DIGITS) -> DataFrame:
    """For each row of ``cuts`` (``group_cols``, ``k``) the key of rank ``k`` (from 1) in its group: ``group_cols``, ``k``, ``key``.

    A rank beyond its group's rows gives no row. ``key_col`` is a string as ``order_key`` makes."""
    g = _names(group_cols)
    ops = [f"_o{c}" for c in g]
    rows = _keyed(df, key_col, group_cols).withColumn("_p", F.lit(""))
    wanted = cuts.select(*[F.col(c).alias(f"_c{n}") for c, n in zip(group_cols, g)], F.col("k").cast("long").alias("_k0")).distinct()
    sizes, only = _root(rows, g, [F.count(F.lit(1)).alias("_n"), F.min("_k").alias("_lo"), F.max("_k").alias("_hi")], "radix_sizes")
    found = sizes.join(wanted, _match(sizes, wanted, [(c, f"_c{c}") for c in g])).where("_k0 >= 1 AND _k0 <= _n")
    state = found.select(*g, F.lit("").alias("_p"), "_n", "_lo", "_hi", "_k0", F.col("_k0").alias("_r"))
    state = stored(state, "radix_cuts") if g else state
    large, same = F.col("_n") > target_rows, F.col("_lo") == F.col("_hi")
    done, chain = [], rows

    def others(table: DataFrame, *more) -> DataFrame:
        return table.select(*[F.col(c).alias(o) for c, o in zip(g, ops)], *more)

    while True:
        if only and only["_n"] <= target_rows:
            n_state, n_open, n_equal = 1, 0, 0  # a single small bucket holds every rank
        else:
            n_state, n_open, n_equal = _tell(state, large & ~same, large & same)
        if n_equal:
            done.append(state.where(large & same).select(*g, "_k0", F.col("_lo").alias("_v")))
        if n_state > n_open + n_equal:
            need = others(state.where(~large), F.col("_p").alias("_op"), "_k0", "_r")
            # a bucket is numbered once, however many ranks fall into it
            buckets = need.select(*ops, "_op").distinct()
            inside = chain.join(_small(buckets, n_state), _match(chain, buckets, list(zip(g, ops))) & (chain["_p"] == buckets["_op"]), "left_semi")
            numbered = inside.withColumn("_i", F.row_number().over(Window.partitionBy(*g, "_p").orderBy("_k")))
            cond = _match(numbered, need, list(zip(g, ops))) & (numbered["_p"] == need["_op"]) & (numbered["_i"] == need["_r"])
            done.append(numbered.join(_small(need, n_state), cond).select(*g, "_k0", F.col("_k").alias("_v")))
        if not n_open:
            break
        heavy = state.where(large & ~same)
        open_ = stored(_opened(heavy.select(*g, "_p", "_lo", "_hi").distinct(), digits), "radix_open")
        chain = _children(chain, _small(open_, n_open), g)
        hist = chain.groupBy(*g, "_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_k").alias("_lo"), F.max("_k").alias("_hi"))
        parents = others(open_, F.col("_p").alias("_op"))
        # children of one bucket: at most 16^digits rows; their running count places the rank
        hist = hist.join(_small(parents, n_open), _match(hist, parents, list(zip(g, ops))) & F.expr("startswith(_p, _op)")).drop(*ops)
        upto = Window.partitionBy(*g, "_op").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
        ranks = others(heavy, F.col("_p").alias("_of"), "_k0", "_r")
        hit = (_match(hist, ranks, list(zip(g, ops))) & (hist["_op"] == ranks["_of"])
               & (ranks["_r"] > hist["_before"]) & (ranks["_r"] <= hist["_before"] + hist["_n"]))
        state = stored(hist.join(_small(ranks, n_open), hit).select(*g, "_p", "_n", "_lo", "_hi", "_k0", (F.col("_r") - F.col("_before")).alias("_r")),
                       "radix_cuts")
    if not done:
        done = [state.select(*g, "_k0", F.col("_lo").alias("_v"))]  # no rank lies in the table
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(*[F.col(n).alias(c) for c, n in zip(group_cols, g)], F.col("_k0").alias("k"), F.col("_v").alias("key"))


def ordered_starts(df: DataFrame, key_col: str, group_cols: Sequence[str] = (), weight_col: str | None = None,
                   out_col: str = "start", target_rows: int = 200_000, digits: int = DIGITS, open_all: bool = False) -> DataFrame:
    """``df`` with ``out_col``: the number of rows before the row in its group by ``key_col`` (with ``weight_col``: their
    total weight). Rows of equal keys follow one another in any order.

    Groups of at most ``target_rows`` rows are numbered as they are (with ``open_all`` by buckets as well, so that a
    table without groups is always numbered in many tasks); larger ones by buckets of at most as many rows."""
    g = _names(group_cols)
    ops = [f"_o{c}" for c in g]
    weight = F.col(weight_col).cast("long") if weight_col else F.lit(1).cast("long")
    rows = _keyed(df, key_col, group_cols, weight.alias("_w")).withColumn("_p", F.lit(""))
    tally = [F.count(F.lit(1)).alias("_n"), F.sum("_w").alias("_s"), F.min("_k").alias("_lo"), F.max("_k").alias("_hi")]
    large, differ = F.col("_n") > target_rows, F.col("_lo") < F.col("_hi")
    state, only = _root(rows, g, tally, "radix_groups")
    state = state.withColumn("_p", F.lit(""))
    opens, leaves, n_leaves, chain = [], [], 0, rows
    while True:
        opening = differ if open_all and not opens else large & differ
        if only and not opens:
            n_state, n_open = 1, int(bool(only["_n"]) and only["_lo"] < only["_hi"] and (open_all or only["_n"] > target_rows))
        else:
            n_state, n_open = _tell(state, opening)
        if opens:
            leaves.append(state.where(~F.coalesce(opening, F.lit(False))).select(*g, "_p", "_s"))
            n_leaves += n_state - n_open
        if not n_open:
            break
        open_ = _opened(state.where(opening).select(*g, "_p", "_lo", "_hi"), digits)
        open_ = _small(open_ if not g and not opens else stored(open_, "radix_open"), n_open)
        opens.append(open_)
        chain = _children(chain, open_, g)
        state = stored(chain.groupBy(*g, "_p").agg(*tally), "radix_buckets")
    full = df.withColumn("_w", weight).withColumn("_leaf", F.lit(""))
    for open_ in opens:
        o = open_.select(*[F.col(c).alias(x) for c, x in zip(g, ops)], F.col("_p").alias("_op"), F.col("_len").alias("_olen"))
        cond = _match(full, o, list(zip(group_cols, ops))) & (full["_leaf"] == o["_op"])
        child = F.when(F.col("_olen").isNull(), F.col("_leaf")).otherwise(F.expr(f"substring(`{key_col}`, 1, _olen)"))
        full = full.join(o, cond, "left").withColumn("_leaf", child).drop("_op", "_olen", *ops)
    inside = Window.partitionBy(*[F.col(c) for c in group_cols], "_leaf").orderBy(key_col).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    placed = full.withColumn(out_col, F.coalesce(F.sum("_w").over(inside), zero))
    if leaves:
        table = leaves[0]
        for x in leaves[1:]:
            table = table.unionByName(x)
        before = Window.partitionBy(*g).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
        base = table.select(*[F.col(c).alias(x) for c, x in zip(g, ops)], F.col("_p").alias("_op"), F.coalesce(F.sum("_s").over(before), zero).alias("_base"))
        cond = _match(placed, base, list(zip(group_cols, ops))) & (placed["_leaf"] == base["_op"])
        placed = placed.join(_small(base, n_leaves), cond, "left").withColumn(out_col, F.col(out_col) + F.coalesce("_base", zero))
        placed = placed.drop("_op", "_base", *ops)
    return placed.drop("_w", "_leaf")
