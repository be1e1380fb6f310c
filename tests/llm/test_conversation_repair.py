"""Conversation repair against plain Python: nulls, ties, copies, long conversations over many blocks, odd roles."""

import random

import brute
import numpy as np
import pytest

from tagloom.llm.common import release_scratch
from tagloom.llm.conversation_repair import Blocks, damaged, repair_conversations, repair_report
from tagloom.session import release_stored

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.fixture(autouse=True)
def scratch(spark):
    yield
    release_scratch(spark)
    release_stored(spark)


def check(spark, rows, **sizes):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = repair_report(df, repair_conversations(damaged(df), **sizes)).select(*COLUMNS)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute.repaired(rows), key=str)


def random_rows(seed, convs, longest):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "assistant", "user", "system", "tool", "unknown", "", "User", None]
    texts = ["Yes.", "No!", "Really?", "cut off", "", " \t", "Yes.", "née 日本。", "a. b", "end. \n", None, "x ", ". "]
    rows = []
    for c in [None, *range(convs)]:
        for t in range(rnd.randrange(longest)):
            turn = rnd.choice([t, t, t, t // 2, None, t + 3])
            rows.append((c, turn, rnd.choice(roles[: 4 if c and c % 3 else 10]), rnd.choice(texts[: 3 if c and c % 2 else 13]) or None))
    return rows


def test_random_conversations(spark):
    check(spark, random_rows(1, 120, 14))


def test_long_conversations_over_many_blocks_and_buckets(spark):
    check(spark, random_rows(2, 6, 260), block=7, target_rows=40)


def test_one_row_a_third_of_all(spark):
    rows = [(1, 4, "user", "Same.")] * 700 + [(1, 5, "assistant", "Fine.")] + [(1, None, "user", "")] * 300 + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Yo.")]
    check(spark, rows, block=64, target_rows=50)


def test_clean_and_system_conversations_are_kept(spark):
    rows = [(i, t, r, f"Line {i} {t}.") for i in range(60) for t, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    check(spark, rows)


def test_empty_table_and_dropped_conversations(spark):
    check(spark, [])
    gone = [(c, t, "user", "Hello.") for c in range(3000) for t in (0,) if brute.zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:5]
    check(spark, gone)
    df = spark.createDataFrame(gone, SCHEMA)
    rows = repair_report(df, repair_conversations(damaged(df))).collect()
    assert len(rows) == 5 and all((r.audit, r.cost, r.repaired_sha256) == ("", 0, brute.hashlib.sha256(b"").hexdigest()) for r in rows)


def test_edits_are_rows_of_the_repaired_conversation(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Well."), (1, 2, "assistant", "So."), (1, 3, "assistant", "")], SCHEMA)
    out = repair_conversations(df).edits.orderBy("place", "k").collect()
    assert [(r.edit, r.turn, r.role, r.text) for r in out] == [
        ("D", 0, None, None), ("K", 1, "user", "Well."), ("K", 2, "assistant", "So."), ("D", 3, None, None)]


def test_extra_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.", 9, 9, 9, 9), (1, 1, "assistant", "Yo.", 9, 9, 9, 9)],
                               SCHEMA + ", place int, _p int, copies int, _c int")
    assert repair_report(df, repair_conversations(damaged(df))).count() == 1


def test_ranks_are_those_of_the_sorted_audits(spark):
    """Of all cheapest audits of random blocks the ranked path is the least string."""
    rnd = random.Random(5)
    codes = ["".join(rnd.choice("ABCEFGIJKL") for _ in range(rnd.randrange(9))) for _ in range(40)]
    blocks = Blocks(codes)
    value = blocks.costs(np.broadcast_to(np.array([0, 10, 5, 0])[None, :, None], (len(codes), 4, 1)))[:, 0]
    src, letter, dst = blocks.optimal_arcs(value, np.ones(len(codes), dtype=bool))
    choice, jumps = blocks.ranked(src, letter, dst)
    paths, _ = blocks.paths(choice, letter, jumps)
    arcs = {}
    for s, a, d in zip(src.tolist(), letter.tolist(), dst.tolist()):
        arcs.setdefault(s, []).append(("DIKR"[a], d))

    def all_audits(node):
        return [a + rest for a, d in arcs[node] for rest in all_audits(d)] if node in arcs else [""]

    for b in range(len(codes)):
        for q in range(4):
            assert paths[b][q].translate(str.maketrans("UAua", "IIRR")) == min(all_audits(int(blocks.base[b]) + q))
