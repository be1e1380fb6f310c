"""Random orders of the places 0..n-1 as an expression of the place: a new order costs no shuffle.

``permuted`` is a keyed bijection on 0..n-1 for any n, by the swap-or-not method: a round pairs every place x with
``key - x`` modulo n, and a bit made from the larger of the two says whether both change places. Each round is its own
inverse, so no two places ever meet, and no value leaves the range (no walking back into it as with a power-of-two domain).
Once rows have exact ranks (``rank.exact_rank``), any number of orders follow from the rank alone.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .rank import exact_rank, hash_order_key

#: Rounds of one order. A place needs some 2 * log2(n) of them to forget where it was; 128 do for any table.
ROUNDS = 128
#: Bits are made modulo this prime: products stay below 2^62.
PRIME = (1 << 31) - 1
LOW_BITS = 30


def round_keys(seed, order, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Per round (shift, factor, summand), from the hex digits of ``md5("seed:order:round")``: 15, 7 and 7 of them."""
    out = []
    for r in range(rounds):
        d = hashlib.md5(f"{seed}:{order}:{r}".encode()).hexdigest()
        out.append((int(d[:15], 16), int(d[15:22], 16), int(d[22:29], 16)))
    return out


def permuted(place: Column, n: Column, seed, order, rounds: int = ROUNDS) -> Column:
    """Where ``place`` (0 to ``n`` - 1, below 2^62) stands in order number ``order`` of ``seed``. Null gives null."""
    keys = F.expr("array(" + ", ".join(f"struct({s}L AS s, {a}L AS a, {b}L AS b)" for s, a, b in round_keys(seed, order, rounds)) + ")")

    def step(x: Column, key: Column) -> Column:
        partner = (key["s"] % n + n - x) % n
        top = F.greatest(x, partner)
        mixed = (top.bitwiseAND((1 << LOW_BITS) - 1) * key["a"] + F.shiftright(top, LOW_BITS) * key["b"] + key["b"]) % PRIME
        return F.when((mixed * mixed + key["s"] % PRIME) % PRIME % 2 == 1, partner).otherwise(x)

    return F.aggregate(keys, place.cast("long"), step)


def rank_once(df: DataFrame, id_col: str, group_col: str, seed, rank_col: str = "place", size_col: str = "size") -> DataFrame:
    """``df`` with each row's place (from 0) in its group's hash order and the group's size, stored: ``in_order`` needs no more
    of any order. Give narrow rows. ``group_col`` must not be null."""
    sizes = df.groupBy(group_col).agg(F.count(F.lit(1)).alias(size_col))
    ranked = exact_rank(df.withColumn("_pkey", hash_order_key(seed, id_col)), "_pkey", id_col, [group_col], rank_col)
    return stored(ranked.withColumn(rank_col, F.col(rank_col) - 1).drop("_pkey").join(sizes, group_col), "ranked_once")


def in_order(ranked: DataFrame, seed, order, out_col: str = "position", rank_col: str = "place", size_col: str = "size") -> DataFrame:
    """Rows of ``rank_once`` with their place (from 0) in one more order: a projection, no exchange."""
    return ranked.withColumn(out_col, permuted(F.col(rank_col), F.col(size_col), seed, order))
