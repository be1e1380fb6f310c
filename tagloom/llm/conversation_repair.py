"""Conversation structure repair: the cheapest edits that give every conversation a legal order of speakers.

A conversation's rows (by turn, nulls first; rows of one turn by role, then by the SHA-256 of the text) are read by an
automaton of role initials, ``(s?(ua)+)?``. A node is a place between rows and a state of the automaton. Its arcs
are edits: Keep, Delete, Rerole (to user or assistant) of the next row, Insert of an empty row. The letters of the arcs that
leave one node differ, so a string of letters names one path.

Method:

1. Rows get their place (``ordered_starts``: a long conversation is numbered by buckets) and their first fault. Places are
   cut into blocks of ``BLOCK`` rows, so a conversation of any length is many small rows.
2. Cost DP, from the end: the least cost of finishing from every node. Where a conversation has several blocks, a block's
   4 x 4 table of least costs is combined with those behind it in doubling steps.
3. Prefix-doubling path ranking: only arcs on cheapest paths stay. Arcs are ranked by their letter, then by the pair
   (own rank, rank of the best arc where they land) for audits of 2, 4, 8, ... letters; a node's best arc is that of the least rank,
   and its pointer jumps as many letters. Pointers of all lengths give every letter of the least audit on its own.
   Blocks are ranked apart and joined by the state in which each is left, again in doubling steps.
4. Letters become rows again: ``Repair.edits`` holds a row per letter.

A null conversation id is a conversation of its own; null turns sort first and have no part in gaps; null roles and texts are
one space; a role that is empty or starts with another letter than s, u or a can't be kept; repeated rows are counted, not
copied, until they have places; texts are handled whole and meet the workers only for the last digest, which reads a conversation
as a stream. An empty table gives no rows. Only the four columns are read, whatever else there is. One conversation's
audit is one cell and its digest one stream, as the result asks for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import written
from tagloom.operators.radix import order_key, ordered_starts

BLOCK = 512
#: Rows of blocks that are worked on at a time in a Python worker.
ROWS_AT_ONCE = 50_000

#: Fixed values of the contract.
BLANK, LAST = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
INITIALS = "sua"
FAULTS = ["ok", "truncated", "gone"]  # gone: blank or duplicate, must be deleted

#: States: 0 start, 1 after s, 2 after u, 3 after a; 0 and 3 may end. Next state by initial (-1: not allowed).
NEXT = np.array([[1, 2, -1], [-1, 2, -1], [-1, -1, 3], [-1, 2, -1]])
INSERTED = np.array([2, 2, 3, 2])
FAR = 1 << 40
LONGS = T.ArrayType(T.LongType())
#: Least cost of finishing behind the last row, by state.
END = np.array([0, 2 * INSERT, INSERT, 0], dtype=np.int64)
#: Arcs by letter, in ASCII order of the audit.
LETTERS = "DIKR"
D, I, K, R = range(4)


def _row_arcs() -> tuple[np.ndarray, np.ndarray]:
    """(next state, cost) by code of the row, state and letter; code = initial + 4 * fault, next state -1: no arc."""
    to, cost = np.full((12, 4, 4), -1), np.zeros((12, 4, 4), dtype=np.int64)
    for code in range(12):
        initial, fault = code % 4, code // 4
        extra = TRUNCATED if fault == 1 else 0
        for q in range(4):
            to[code, q, D], cost[code, q, D] = q, DELETE
            if fault == 2:
                continue
            if initial < 3 and NEXT[q, initial] >= 0:
                to[code, q, K], cost[code, q, K] = NEXT[q, initial], extra
            to[code, q, R], cost[code, q, R] = INSERTED[q], REROLE + extra
    return to, cost


TO, COST = _row_arcs()


# ---------------------------------------------------------------- blocks, in numpy


class Blocks:
    """Some blocks side by side: node ``base[b] + 4 * i + q`` is state q before row i of block b."""

    def __init__(self, codes: list[str]):
        self.sizes = np.array([len(c) for c in codes], dtype=np.int64)
        self.base = np.concatenate([[0], np.cumsum(4 * (self.sizes + 1))])
        self.codes = np.frombuffer("".join(codes).encode("ascii"), dtype=np.uint8).astype(np.int64) - 65
        self.first_row = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.order = np.argsort(-self.sizes, kind="stable")

    def costs(self, ends: np.ndarray) -> np.ndarray:
        """Least cost from every node: nodes x targets, for ``ends`` (blocks x 4 x targets)."""
        value = np.full((self.base[-1], ends.shape[2]), FAR, dtype=np.int64)
        for q in range(4):
            value[self.base[:-1] + 4 * self.sizes + q] = ends[:, q]
        sizes = self.sizes[self.order]
        for back in range(1, (sizes[0] if len(sizes) else 0) + 1):
            b = self.order[: np.searchsorted(-sizes, -back, side="right")]  # blocks of at least ``back`` rows
            i = self.sizes[b] - back
            code, here = self.codes[self.first_row[b] + i], self.base[b] + 4 * i
            w = np.full((len(b), 4, ends.shape[2]), FAR, dtype=np.int64)
            for q in range(4):
                for letter in (D, K, R):
                    to = TO[code, q, letter]
                    through = value[here + 4 + np.maximum(to, 0)] + COST[code, q, letter][:, None]
                    w[:, q] = np.minimum(w[:, q], np.where((to >= 0)[:, None], through, FAR))
            both = np.minimum(w[:, 2], w[:, 3] + INSERT), np.minimum(w[:, 3], w[:, 2] + INSERT)
            for q, v in ((0, np.minimum(w[:, 0], both[0] + INSERT)), (1, np.minimum(w[:, 1], both[0] + INSERT)), (2, both[0]), (3, both[1])):
                value[here + q] = np.minimum(v, FAR)
        return value

    def optimal_arcs(self, value: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(from node, letter, to node) of all arcs on cheapest paths, by node and letter. Behind its last row only the
        ``last`` block of a conversation has arcs."""
        row_block = np.repeat(np.arange(len(self.sizes)), self.sizes)
        i = np.arange(len(self.codes)) - self.first_row[row_block]
        here = self.base[row_block] + 4 * i
        found = []
        for q in range(4):
            src = here + q
            for letter in (D, K, R):
                to = TO[self.codes, q, letter]
                dst = here + 4 + np.maximum(to, 0)
                ok = (to >= 0) & (value[src] < FAR) & (value[dst] + COST[self.codes, q, letter] == value[src])
                found.append((src[ok], np.full(ok.sum(), letter), dst[ok]))
            behind = (self.base[:-1] + 4 * self.sizes)[last]
            src = np.concatenate([src, behind + q])
            dst = np.concatenate([here, behind]) + INSERTED[q]
            ok = (value[src] < FAR) & (value[dst] + INSERT == value[src])
            found.append((src[ok], np.full(ok.sum(), I), dst[ok]))
        src, letter, dst = (np.concatenate(x) for x in zip(*found))
        by = np.lexsort((letter, src))
        return src[by], letter[by], dst[by]

    def ranked(self, src: np.ndarray, letter: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """(arc chosen at each node or -1, pointers of 1, 2, 4, ... letters) by prefix doubling over the arcs' ranks.

        ``rank`` orders the arcs by the least audit of so many letters that starts with them. A node without arcs ends the audit: it has rank 0 and
        points to itself."""
        nodes = int(self.base[-1])
        starts = np.flatnonzero(np.diff(src, prepend=-1))
        arcs, rank, land, jumps = len(src), letter + 1, dst.copy(), []
        choice = np.full(nodes, -1)
        while True:
            # the arc of least rank at each node
            best = np.minimum.reduceat(rank * arcs + np.arange(arcs), starts) % arcs if arcs else starts
            choice[src[starts]] = best
            node_rank, pointer = np.zeros(nodes, dtype=np.int64), np.arange(nodes)
            node_rank[src[starts]], pointer[src[starts]] = rank[best], land[best]
            jumps.append(pointer)
            if (choice[land] < 0).all():
                return choice, jumps
            # audits of twice the length: own rank, then that of the best arc where the first half ends
            rank = np.unique(rank * (int(node_rank.max()) + 1) + node_rank[land], return_inverse=True)[1] + 1
            land = pointer[land]

    def paths(self, choice: np.ndarray, letter: np.ndarray, jumps: list[np.ndarray]) -> tuple[list[list[str]], np.ndarray]:
        """(for every block and entering state the edits up to its end, the state in which it is left).

        Edits: D delete, K keep, u/a rerole, U/A insert of a user or assistant row."""
        enter = (self.base[:-1, None] + np.arange(4)).ravel()
        length, cur = np.zeros(len(enter), dtype=np.int64), enter
        for k in range(len(jumps) - 1, -1, -1):
            there = jumps[k][cur]
            on = choice[there] >= 0
            cur, length = np.where(on, there, cur), length + (on.astype(np.int64) << k)
        on = choice[cur] >= 0
        cur, length = np.where(on, jumps[0][cur], cur), length + on
        owner = np.repeat(np.arange(len(enter)), length)
        j = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
        at = enter[owner]
        for k, jump in enumerate(jumps):
            at = np.where((j >> k) & 1, jump[at], at)
        names = np.array([list("DUKu"), list("DUKu"), list("DAKa"), list("DUKu")])
        text = "".join(names[at % 4, letter[choice[at]]])  # a block's base is a multiple of 4
        cuts = np.concatenate([[0], np.cumsum(length)]).tolist()
        parts = [text[a:b] for a, b in zip(cuts, cuts[1:])]
        return [parts[k : k + 4] for k in range(0, len(parts), 4)], (cur % 4).reshape(-1, 4)


def _runs(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Slices of at most ``ROWS_AT_ONCE`` rows of blocks (one block at least)."""
    start = total = 0
    for k, n in enumerate(sizes):
        if total and total + n > ROWS_AT_ONCE:
            yield start, k
            start, total = k, 0
        total += n + 1
    if sizes:
        yield start, len(sizes)


def _sliced(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in _runs([len(x) for x in batch.column(column).to_pylist()]):
            yield batch.slice(a, b - a)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with ``table``: least cost from each entering state (rows) to each state behind the last row."""
    unit = np.where(np.eye(4, dtype=bool), 0, FAR).astype(np.int64)
    for batch in _sliced(batches, "codes"):
        blocks = Blocks(batch.column("codes").to_pylist())
        value = blocks.costs(np.broadcast_to(unit, (batch.num_rows, 4, 4)))
        tables = value[(blocks.base[:-1, None] + np.arange(4)).ravel()].reshape(-1, 16)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(tables), pa.list_(pa.int64()))], [*batch.schema.names, "table"])


def _least_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks (with ``behind``, the least costs behind them; null: the conversation ends there) with ``cost``, ``paths`` and
    ``leave`` by entering state."""
    for batch in _sliced(batches, "codes"):
        blocks = Blocks(batch.column("codes").to_pylist())
        ends = batch.column("behind").to_pylist()
        last = np.array([e is None for e in ends])
        value = blocks.costs(np.array([END if e is None else e for e in ends], dtype=np.int64)[:, :, None])
        value = value[:, 0]
        src, letter, dst = blocks.optimal_arcs(value, last)
        choice, jumps = blocks.ranked(src, letter, dst)
        paths, leave = blocks.paths(choice, letter, jumps)
        more = [pa.array(value[blocks.base[:-1]], pa.int64()), pa.array(paths, pa.list_(pa.string())), pa.array(list(leave), pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "cost", "paths", "leave"])


# ---------------------------------------------------------------- rows, in Spark


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` after the contract's damage, by crc32 of ``conv_id:turn``."""
    space = F.lit(" ")
    fate = F.crc32(F.concat_ws(":", F.coalesce(F.col(conv_col).cast("string"), space), F.coalesce(F.col(turn_col).cast("string"), space))) % 20
    text = F.coalesce(F.col(text_col), space)
    return (rows.withColumn("_fate", fate).where("_fate <> 0").select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.when(F.col("_fate") == 4, "user").otherwise(F.coalesce(F.col(role_col), space)).alias("role"),
        F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.regexp_replace(text, r"[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("_fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy"))


@dataclass
class Repair:
    """``edits``: conv_id, place, k, edit (an audit letter), turn, role, text: a row per letter, in order of (place, k); Delete rows have the turn
    alone. ``audits``: conv_id, audit, cost, illegal. ``faults``: conv_id, gaps, blank, duplicate, truncated."""

    edits: DataFrame
    audits: DataFrame
    faults: DataFrame


def _same(a: DataFrame, b: DataFrame, *pairs: tuple[str, str]) -> Column:
    cond = F.lit(True)
    for x, y in pairs:
        cond = cond & a[x].eqNullSafe(b[y])
    return cond


def placed_rows(rows: DataFrame, target_rows: int = 200_000) -> DataFrame:
    """Distinct rows of every conversation with ``copies``, ``place`` (rows before), ``code`` and ``fault``."""
    rows = rows.select("conv_id", "turn", "role", "text").groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("_hash", F.sha2("text", 256))
    rows = rows.withColumn("_order", order_key(rows, ["turn", "role", "_hash"]))
    placed = written(ordered_starts(rows, "_order", ["conv_id"], "copies", "place", target_rows).drop("_order"), "repair_rows")
    filled = placed.where(F.col("text").rlike(BLANK))
    first = filled.groupBy("conv_id", "role", "_hash").agg(F.min("place").alias("_p")).select(F.col("conv_id").alias("_c"), "_p")
    fault = (F.when(~F.col("text").rlike(BLANK), "blank").when(F.col("_p").isNull(), "duplicate")
             .when(~F.col("text").rlike(LAST), "truncated"))
    initial = F.lit(3)
    for n, letter in enumerate(INITIALS):
        initial = F.when(F.substring("role", 1, 1) == letter, n).otherwise(initial)
    code = initial + 4 * F.when(F.col("fault").isin("blank", "duplicate"), 2).when(F.col("fault") == "truncated", 1).otherwise(0)
    return (placed.join(first, _same(placed, first, ("conv_id", "_c"), ("place", "_p")), "left").withColumn("fault", fault)
            .withColumn("code", code).drop("_c", "_p", "_hash"))


def code_blocks(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, b, codes: a letter per row, in order of place; ``last`` marks a conversation's last block."""
    stretch = 1024
    n = F.col("copies") - 1
    # a row of many copies is spread over many rows first, some at a time
    some = placed.select("conv_id", "place", "copies", "code", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(n / stretch))).alias("_s"))
    upto = F.least(n, (F.col("_s") + 1) * stretch - 1)
    each = some.select("conv_id", "place", "code", F.explode(F.sequence(F.col("_s") * stretch, upto)).alias("_i"))
    code = F.when(F.col("_i") > 0, F.col("code") % 4 + 8).otherwise(F.col("code"))  # further copies are duplicates (or blank)
    at = F.col("place") + F.col("_i")
    narrow = each.select("conv_id", F.floor(at / block).alias("b"), at.alias("_at"), F.char(code + 65).alias("_code"))
    blocks = narrow.groupBy("conv_id", "b").agg(F.sort_array(F.collect_list(F.struct("_at", "_code"))).alias("_c"))
    blocks = blocks.select("conv_id", "b", F.array_join(F.transform("_c", lambda x: x["_code"]), "").alias("codes"))
    total = placed.groupBy("conv_id").agg(F.sum("copies").alias("_n")).select(F.col("conv_id").alias("_c"), "_n")
    last = F.col("b") == F.floor((F.col("_n") - 1) / block)
    return blocks.join(total, _same(blocks, total, ("conv_id", "_c"))).withColumn("last", last).drop("_c", "_n")


def _times(a: Column, b: Column) -> Column:
    """Tables combined: least sums over the state between."""
    return F.array(*[F.least(*[a[4 * i + k] + b[4 * k + j] for k in range(4)], F.lit(FAR)) for i in range(4) for j in range(4)])


def _then(a: Column, b: Column) -> Column:
    """Maps of states combined: b after a."""
    return F.array(*[b[a[q]] for q in range(4)])


def _doubled(parts: DataFrame, value: str, step: int, combine, name: str) -> DataFrame:
    """(conv_id, b, value): each block's value combined with those of all blocks behind (step 1) or before it (step -1)."""
    now, far = parts.select("conv_id", "b", value), 1
    most = parts.agg(F.max("b")).first()[0]
    while far <= most:
        other = now.select(F.col("conv_id").alias("_c"), (F.col("b") - step * far).alias("_b"), F.col(value).alias("_o"))
        mine = now.join(other, _same(now, other, ("conv_id", "_c"), ("b", "_b")), "left")
        both = combine(F.col(value), F.col("_o")) if step > 0 else combine(F.col("_o"), F.col(value))
        now = written(mine.select("conv_id", "b", F.when(F.col("_o").isNull(), F.col(value)).otherwise(both).alias(value)), name)
        far *= 2
    return now


def least_edits(blocks: DataFrame) -> DataFrame:
    """conv_id, b, codes, last, cost (of the rest of the conversation from the block's entering state 0), path (the edits of the block)."""
    spark = blocks.sparkSession
    long_ones = blocks.where("b > 0 OR NOT last")
    many = not long_ones.isEmpty()
    single = blocks.where("b = 0 AND last").withColumn("behind", F.lit(None).cast("array<bigint>"))
    if many:
        tables = written(long_ones.select("conv_id", "b", "codes").mapInArrow(
            _tables, blocks.select("conv_id", "b", "codes").schema.add("table", LONGS)), "repair_tables")
        rest = _doubled(tables, "table", 1, _times, "repair_rest")
        rest = rest.select(F.col("conv_id").alias("_c"), (F.col("b") - 1).alias("_b"), F.array(
            *[F.least(*[F.col("table")[4 * i + j] + F.lit(int(END[j])) for j in range(4)]) for i in range(4)]).alias("behind"))
        behind = long_ones.join(rest, _same(long_ones, rest, ("conv_id", "_c"), ("b", "_b")), "left").drop("_c", "_b")
        single = single.unionByName(behind)
    schema = T.StructType([*single.schema]).add("cost", T.LongType()).add("paths", T.ArrayType(T.StringType())).add("leave", T.ArrayType(T.IntegerType()))
    found = written(single.mapInArrow(_least_paths, schema).drop("behind"), "repair_paths")
    entered = found.where("b = 0").withColumn("path", F.col("paths")[0])
    if many:
        left = _doubled(found.where("b > 0 OR NOT last"), "leave", -1, _then, "repair_left")
        left = left.select(F.col("conv_id").alias("_c"), (F.col("b") + 1).alias("_b"), F.col("leave")[0].alias("_in"))
        later = found.where("b > 0")
        later = later.join(left, _same(later, left, ("conv_id", "_c"), ("b", "_b"))).withColumn("path", F.col("paths")[F.col("_in")])
        entered = entered.unionByName(later.drop("_c", "_b", "_in"))
    return entered.select("conv_id", "b", "codes", "last", "cost", "path")


def _illegal(blocks: DataFrame) -> DataFrame:
    """Neighbouring rows whose initials may not follow one another, per conversation; also over the ends of blocks."""
    initials = F.translate("codes", "ABCDEFGHIJKL", "suaxsuaxsuax")
    n = F.length(initials)
    # a pair is illegal unless it is su, ua or au; every place is looked at by itself
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(initials, i, F.lit(2)))
    inside = F.when(n > 1, F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))).otherwise(0)
    ends = blocks.select("conv_id", "b", inside.alias("_in"), F.substring(initials, -1, 1).alias("_z"))
    heads = blocks.where("b > 0").select(F.col("conv_id").alias("_c"), (F.col("b") - 1).alias("_b"), F.substring(initials, 1, 1).alias("_a"))
    met = ends.join(heads, _same(ends, heads, ("conv_id", "_c"), ("b", "_b")), "left")
    over = F.when(F.col("_a").isNotNull() & ~F.concat("_z", "_a").isin("su", "ua", "au"), 1).otherwise(0)
    return met.groupBy("conv_id").agg(F.sum(F.col("_in") + over).cast("long").alias("illegal"))


def repair_conversations(rows: DataFrame, block: int = BLOCK, target_rows: int = 200_000) -> Repair:
    """The cheapest repair of every conversation of ``rows`` (conv_id, turn, role, text; role and text not null)."""
    placed = written(placed_rows(rows, target_rows), "repair_placed")
    found = written(least_edits(written(code_blocks(placed, block), "repair_blocks")), "repair_found")

    tokens = F.concat(F.regexp_extract_all("path", F.lit("([UA]*[DKua])")), F.array(F.regexp_extract("path", "([UA]*)$", 1)))
    each = found.select("conv_id", "b", F.length("codes").alias("_n"), "last", F.posexplode(tokens).alias("_i", "_token"))
    each = each.where("_token <> '' AND (_i < _n OR last)")
    each = each.select("conv_id", (F.col("b") * block + F.col("_i")).alias("place"), "_token")
    own = placed.select(F.col("conv_id").alias("_c"), F.col("place").alias("_p"), "turn", F.col("role").alias("_role"), "text")
    letters = each.join(own, _same(each, own, ("conv_id", "_c"), ("place", "_p")), "left").select(
        "conv_id", "place", "turn", "_role", "text", F.posexplode(F.split("_token", "")).alias("k", "_e"))
    e = F.col("_e")
    role = F.when(e.isin("U", "u"), "user").when(e.isin("A", "a"), "assistant").when(e == "K", F.col("_role"))
    edits = letters.select("conv_id", "place", "k", F.translate("_e", "UAua", "IIRR").alias("edit"), F.when(~e.isin("U", "A"), F.col("turn")).alias("turn"),
                           role.alias("role"), F.when(e.isin("U", "A"), "").when(e != "D", F.col("text")).alias("text"))

    audit = found.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("b", F.translate("path", "UAua", "IIRR").alias("a")))).alias("_a"),
                                         F.max(F.when(F.col("b") == 0, F.col("cost"))).alias("cost"))
    audit = audit.select("conv_id", F.array_join(F.transform("_a", lambda x: x["a"]), "").alias("audit"), "cost")
    illegal = _illegal(found).withColumnRenamed("conv_id", "_c")
    audits = audit.join(illegal, _same(audit, illegal, ("conv_id", "_c"))).drop("_c")

    zero = F.lit(0).cast("long")
    repeats = F.when(F.col("fault") == "blank", zero).otherwise(F.col("copies") - 1)
    faults = placed.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), zero).alias("gaps"),
        F.sum(F.when(F.col("fault") == "blank", F.col("copies")).otherwise(zero)).alias("blank"),
        F.sum(F.when(F.col("fault") == "duplicate", 1).otherwise(0) + repeats).alias("duplicate"),
        F.sum(F.when(F.col("fault") == "truncated", 1).otherwise(0)).alias("truncated"))
    return Repair(edits, audits, faults)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, which come in order; a conversation may span many batches."""
    now, state, names = None, None, ["conv_id", "repaired_sha256"]

    def row(key, digest):
        return pa.RecordBatch.from_arrays([key, pa.array([digest.hexdigest()])], names)

    for batch in batches:
        keys, lines = batch.column(0), batch.column(1).to_pylist()
        for k, (key, line) in enumerate(zip(keys.to_pylist(), lines)):
            if state is None or key != now[0].as_py():
                if state is not None:
                    yield row(now, state)
                now, state = keys.slice(k, 1), hashlib.sha256(line.encode("utf-8"))
            else:
                state.update(b"\n" + line.encode("utf-8"))
    if state is not None:
        yield row(now, state)


def repaired_digests(edits: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: over ``role:text`` of the repaired rows, joined by newlines."""
    lines = edits.where("edit <> 'D'").select("conv_id", "place", "k", F.concat_ws(":", "role", "text").alias("_line"))
    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "place", "k").select("conv_id", "_line")
    return ordered.mapInArrow(_digests, edits.select("conv_id").schema.add("repaired_sha256", T.StringType()))


def repair_report(rows: DataFrame, repair: Repair) -> DataFrame:
    """A row per conversation of ``rows``: faults, cost, audit and the digest of the repaired rows."""
    out = rows.select("conv_id").distinct()
    for part, renamed in ((repair.faults, "_f"), (repair.audits, "_a"), (repaired_digests(repair.edits), "_d")):
        part = part.withColumnRenamed("conv_id", renamed)
        out = out.join(part, _same(out, part, ("conv_id", renamed)), "left").drop(renamed)
    zero = F.lit(0).cast("long")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select("conv_id", *[F.coalesce(c, zero).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
