"""Exact Jaccard self-join of word-shingle sets by a token-group matrix.

A document's set holds the 64-bit hashes of its distinct 5-word shingles. Equal sets are one
class from the start (copies are never paired). Then:

1. *Token postings.* Map tasks send each distinct set's tokens packed by hash range (but for
   frequent tokens, where the others suffice for the prefix). Per range, document frequencies are
   counted over all sets, and tokens that one set alone has are dropped, since no pair shares
   them. Tokens that a hundredth of a task's sets share are found before, so that no range
   gathers them from every document.
2. *Prefixes.* In the order (rare first, frequent ones last) a set of n tokens keeps its first
   n - ceil(0.75 n) + 1; sets that link share one of these. What a set has alone bounds its overlap
   with any other, too.
3. *Groups.* Per token, the set with the smallest share of tokens of its own is the pivot; each set is
   held against the pivot with which it shares most. Similar ones form groups: a clump of thousands
   of near copies becomes one or a few.
4. *Matrix.* (token, group) rows hold each group's token union, with its range of set sizes and the
   largest overlap any member can have. A set queries only other groups that share a prefix token and
   whose bounds can reach the threshold; only there are members paired. A pair is dropped when its
   bounds, or the shared prefix tokens and what can follow the last of them, stay below the overlap
   that 0.75 needs. The rest is checked exactly on whole sets.
5. Links of step 4 join the groups of step 3 to components; the smallest ``doc_id`` names each.

All filters only drop pairs that cannot link, up to equal 64-bit hashes of different shingles.
Documents without words, null texts too, have an empty set and link with nothing. Repeated rows
each give a row. Null ids are never the smallest unless all are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tagloom.llm.common import small, text_batches, text_key, tidy, written
from tagloom.llm.components import components

U = np.uint64
PIECE = 1 << 20
#: Tokens that a task holds before it folds or sends them: bounds a Python worker's memory.
CHUNK = 1 << 20
_MIX = (U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53), U(0x9E3779B97F4A7C15))
_TABLES: dict = {}


def _tables():
    """Random value per byte, separator flags, and powers of an odd multiplier with inverses."""
    if not _TABLES:
        rng = np.random.default_rng(20240229)
        values = rng.integers(1, 2**63, 256, dtype=U) * U(2) + U(1)
        sep = np.zeros(256, dtype=bool)
        sep[[0x20, *range(0x09, 0x0E)]] = True
        p = 0x9E3779B97F4A7C15
        inverse = pow(p, -1, 1 << 64)

        def powers(x):
            out = np.full(PIECE + 1, x, dtype=U)
            out[0] = 1
            return np.multiply.accumulate(out)

        _TABLES.update(values=values, sep=sep, up=powers(p), down=powers(inverse))
    return _TABLES


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(33))) * _MIX[0]
    h = (h ^ (h >> U(29))) * _MIX[1]
    return h ^ (h >> U(32))


def word_hashes(data: bytes) -> np.ndarray:
    """Hash of every word of at most PIECE bytes of lower-cased UTF-8."""
    t = _tables()
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = ~t["sep"][raw]
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, U)
    run = np.concatenate((np.zeros(1, U), np.cumsum(t["values"][raw] * t["up"][: len(raw)], dtype=U)))
    return _mix((run[ends] - run[starts]) * t["down"][starts] + (ends - starts).astype(U) * _MIX[2])


def text_words(text: str) -> np.ndarray:
    """Word hashes of a whole text, taken in pieces that are cut at separators."""
    data = text.encode("utf-8", "replace").lower()  # bytes.lower() changes A-Z alone
    if len(data) <= PIECE:
        return word_hashes(data)
    out, at, sep = [], 0, _tables()["sep"]
    while at < len(data):
        end = min(len(data), at + PIECE)
        if end < len(data):
            places = np.flatnonzero(sep[np.frombuffer(data[at:end], np.uint8)])
            if not len(places):  # one word longer than a piece
                nxt = np.flatnonzero(sep[np.frombuffer(data[end:], np.uint8)])
                end = end + int(nxt[0]) if len(nxt) else len(data)
                word = np.frombuffer(data[at:end].ljust(-(-(end - at) // 8) * 8, b"\0"), U)
                h = U(end - at)
                for k in range(0, len(word), PIECE):
                    part = _mix(word[k : k + PIECE] + np.arange(k, k + len(word[k : k + PIECE]), dtype=U) * _MIX[2])
                    h = _mix(np.array([h + part.sum(dtype=U)], U))[0]
                out.append(np.array([h], U))
                at = end
                continue
            end = at + int(places[-1])
            if end == at:
                at += 1
                continue
        out.append(word_hashes(data[at:end]))
        at = end
    return np.concatenate(out) if out else np.empty(0, U)


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the text's ``size``-word shingles (of all words, if fewer)."""
    words = text_words(text) if text else np.empty(0, U)
    if not len(words):
        return words
    n = min(size, len(words))
    h = np.full(len(words) - n + 1, n, dtype=U)
    for k in range(n):
        h = _mix(h * _MIX[2] + words[k : len(words) - n + 1 + k])
    return np.unique(h)


def signature(s: np.ndarray) -> int:
    """64-bit hash of a set, as a signed long; 0 is left to the empty set."""
    if not len(s):
        return 0
    v = int(_mix(np.array([_mix(s ^ _MIX[0]).sum(dtype=U) + U(len(s))], U)).view(np.int64)[0])
    return v or 1


# ---- what a set sends -------------------------------------------------------------------------


def token_keys(s: np.ndarray, buckets: int) -> np.ndarray:
    """53-bit key of a token at most: its range (bucket), then 32 bits."""
    return ((s >> U(40)) & U(buckets - 1)) << U(32) | ((s >> U(8)) & U(0xFFFFFFFF))


def prefix_size(n: int, percent: int) -> int:
    return n + (percent * n) // -100 + 1


def sent_tokens(s: np.ndarray, buckets: int, hot: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """(keys that a set sends, how many of them lie beyond its prefix)."""
    p = prefix_size(len(s), percent)
    keys = np.unique(token_keys(s, buckets))
    if len(hot):
        cool = keys[~np.isin(keys, hot)]
        if len(cool) >= p:
            return cool, len(cool) - p
    return keys, len(keys) - p


def document_sets(docs: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """Rows (doc_id, n, sig) of all documents, and rows (key, local count, local sets) of tokens that a
    hundredth of a task's sets share (kind 1)."""

    kind = docs.select(F.col(id_col)).schema[0].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        counts: dict[int, int] = {}
        held: list[np.ndarray] = []
        size = 0

        def fold() -> None:
            nonlocal held, size
            if held:
                keys, n = np.unique(np.concatenate(held), return_counts=True)
                often = n >= 8
                for k, c in zip(keys[often].tolist(), n[often].tolist()):
                    counts[k] = counts.get(k, 0) + c
            held, size = [], 0

        def rows(which, ids, key_column, n, sig, c):
            longs = [pa.array(x, pa.int64()) for x in (n, sig, c)]
            return pa.RecordBatch.from_arrays([pa.array([which] * len(n), pa.int32()), ids, key_column, *longs], names)

        id_type = to_arrow_type(kind)
        for batch in batches:
            n, sig = [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text)
                v = signature(s)
                n.append(len(s))
                sig.append(v)
                if len(s) and v not in seen:
                    seen.add(v)
                    held.append(token_keys(s, buckets))
                    size += len(s)
                    if size >= CHUNK:
                        fold()
            yield rows(0, batch.column(0), batch.column(2), n, sig, [0] * len(n))
        fold()
        least = max(8, len(seen) / 100)
        hot = [(k, c) for k, c in counts.items() if c >= least]
        yield rows(1, pa.nulls(len(hot), id_type), pa.nulls(len(hot), pa.int64()), [len(seen)] * len(hot), [k for k, _ in hot], [c for _, c in hot])

    names = ["kind", "doc_id", "_key", "n", "sig", "c"]
    schema = (T.StructType().add("kind", T.IntegerType()).add("doc_id", kind).add("_key", T.LongType()).add("n", T.LongType())
              .add("sig", T.LongType()).add("c", T.LongType()))
    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), text_key(text)).mapInArrow(lambda batches: tidy(run(batches), _TABLES), schema)


def postings(docs: DataFrame, text_col: str, buckets: int, hot: np.ndarray, percent: int) -> DataFrame:
    """Tokens that two or more sets sent: (key, sig, ord, n, slack) with kind 0; (sig, n, slack) of every
    set with kind 1."""
    sent = docs.sparkSession.sparkContext.broadcast(hot)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = sent.value
        seen: set[int] = set()
        keys, info, size = [], [], 0

        def out():
            nonlocal keys, info, size
            if not info:
                return
            flat = np.concatenate(keys)
            owner = np.repeat(np.arange(len(info), dtype=np.int32), [len(k) for k in keys])
            meta = np.array(info, dtype=np.int64)  # sig, n, slack
            home = _mix(meta[:, 0].view(U)) & U(buckets - 1)
            where = (flat >> U(32)).astype(np.int32)
            order = np.argsort(where, kind="stable")
            flat, owner, where = flat[order].astype(np.uint32), owner[order], where[order]
            horder = np.argsort(home, kind="stable")
            meta, home = meta[horder], home[horder].astype(np.int64)
            back = np.empty(len(info), dtype=np.int64)
            back[horder] = np.arange(len(info))
            sigs = meta[:, 0][back[owner]]
            used = np.union1d(where, home)
            a, z = np.searchsorted(where, used), np.searchsorted(where, used, "right")
            c, d = np.searchsorted(home, used), np.searchsorted(home, used, "right")
            rows = [(b, flat[i:j].tobytes(), sigs[i:j].tobytes(), meta[k:n].tobytes())
                    for b, i, j, k, n in zip(used.tolist(), a, z, c, d)]
            keys, info, size = [], [], 0
            yield pd.DataFrame(rows, columns=["bucket", "keys", "sigs", "sets"])

        for pdf in batches:
            for text in pdf["text"]:
                s = shingle_set(text)
                v = signature(s)
                if len(s) and v not in seen:
                    seen.add(v)
                    k, slack = sent_tokens(s, buckets, common, percent)
                    keys.append(k)
                    info.append((v, len(s), slack))
                    size += len(k)
                    if size >= CHUNK:
                        yield from out()
        yield from out()

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = int(pdf["bucket"].iloc[0])
        key = np.frombuffer(b"".join(pdf["keys"]), np.uint32)
        sig = np.frombuffer(b"".join(pdf["sigs"]), np.int64)
        sets = np.unique(np.frombuffer(b"".join(pdf["sets"]), np.int64).reshape(-1, 3), axis=0)
        order = np.lexsort((sig, key))
        key, sig = key[order], sig[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])  # a set met in two tasks counts once
        key, sig = key[fresh], sig[fresh]
        _, inverse, df = np.unique(key, return_inverse=True, return_counts=True)
        df = df[inverse]
        full = key.astype(np.int64) | (bucket << 32)
        frequent = np.isin(full.view(U), sent.value)
        keep = (df > 1) | frequent  # a frequent token stays in its place, though but one set needed to send it
        full, rank = full[keep], df[keep] + np.where(frequent[keep], 1 << 40, 0)
        a = pd.DataFrame({"kind": 0, "key": full, "sig": sig[keep], "ord": rank, "n": 0, "slack": 0})
        b = pd.DataFrame({"kind": 1, "key": 0, "sig": sets[:, 0], "ord": 0, "n": sets[:, 1], "slack": sets[:, 2]})
        return pd.concat([a, b])

    text_batches(docs.sparkSession)
    packed = docs.select(F.col(text_col).alias("text")).mapInPandas(
        lambda batches: tidy(pack(batches), _TABLES), "bucket int, keys binary, sigs binary, sets binary")
    return packed.groupBy("bucket").applyInPandas(
        count, "kind int, key bigint, sig bigint, ord bigint, n bigint, slack bigint")


def need_overlap(a, b, percent: int):
    """Least overlap of two sets of sizes a and b that link: (percent/(100+percent)) (a+b), rounded up."""
    return F.ceil(F.lit(percent) * (a + b) / F.lit(100 + percent))


def _sizes_fit(a, b, percent: int):
    return (F.lit(percent) * a <= 100 * b) & (F.lit(percent) * b <= 100 * a)


def whole_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(sig, tokens) of the sets whose first document is named in ``wanted`` (doc_id, _key)."""
    w = small(wanted.select(F.col("doc_id").alias("_d"), F.col("_key").alias("_k")))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    few = rows.join(w, F.col("doc_id").eqNullSafe(F.col("_d")) & (text_key(F.col("text")) == F.col("_k")), "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingle_set(t) for t in pdf["text"]]
            yield pd.DataFrame({"sig": [signature(s) for s in sets], "tokens": [s.view(np.int64) for s in sets]})

    return few.select("text").mapInPandas(run, "sig bigint, tokens array<bigint>").dropDuplicates(["sig"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of signatures whose whole sets reach the threshold."""
    x = sets.select(F.col("sig").alias("a"), F.col("tokens").alias("ta"))
    y = sets.select(F.col("sig").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.select("a", "b").join(x, "a").join(y, "b")
    shared = F.size(F.array_intersect("ta", "tb"))
    return both.select("a", "b", shared.alias("i"), (F.size("ta") + F.size("tb") - shared).alias("o")).where(
        F.col("i") * 100 >= F.col("o") * percent).select("a", "b")


def jaccard_components(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text",
                       tokens_per_bucket: int = 1 << 20, with_root: bool = False) -> DataFrame:
    """Per document: ``doc_id``, ``_key`` (hash of the text), ``n_shingles``, ``component_id``; if asked for, ``_root``:
    the hash of one set of the component, which also tells components without any id apart (null without words)."""
    most = 1 << 21  # keys are made for the finest ranges; coarser ranges drop their top bits
    first = written(document_sets(docs, id_col, text_col, most), "jaccard_sets")
    rows = first.where("kind = 0")
    total = rows.agg(F.sum("n").alias("n"), F.countDistinct("sig").alias("d")).collect()[0]
    buckets = 64
    while buckets < most and buckets * tokens_per_bucket < (total["n"] or 0):
        buckets *= 2
    hot = first.where("kind = 1").groupBy("sig").agg(F.sum("c").alias("c"))
    # at most 200 times the mean set size, whatever the input's size
    hot = hot.where(F.col("c") >= (total["d"] or 0) / 200).select("sig").toPandas()["sig"].to_numpy()
    hot = np.unique(hot.astype(np.int64).view(U) & U((buckets << 32) - 1))

    post = written(postings(docs, text_col, buckets, hot, percent), "jaccard_postings")
    about = post.where("kind = 1").select("sig", "n", "slack")
    entries = post.where("kind = 0").select("key", "sig", "ord")
    by_set = Window.partitionBy("sig")
    ranked = entries.join(about, "sig").select(
        "key", "sig", "n", "slack", F.count(F.lit(1)).over(by_set).alias("m"),
        F.row_number().over(by_set.orderBy("ord", "key")).alias("r"))
    sent = F.lit(prefix_size(100, percent) - 1) * F.col("n") / 100  # about the prefix's length
    alone = F.floor(sent) + 1 + F.col("slack") - F.col("m")
    prefix = written(ranked.where(F.col("r") <= F.col("m") - F.col("slack")).select(
        "key", "sig", "n",
        (F.col("r") - 1 + alone).cast("long").alias("pos"),  # place in the set's order; its own tokens come first
        (F.col("n") - alone).cast("long").alias("most"),  # bound of its overlap with any other set
        (alone / F.col("n")).alias("own")), "jaccard_prefixes")

    least = prefix.groupBy("key").agg(F.min(F.struct("own", "sig", "n")).alias("p"), F.count(F.lit(1)).alias("k")).where("k > 1")
    star = (prefix.join(least.select("key", "p"), "key")
            .where((F.col("sig") != F.col("p.sig")) & _sizes_fit(F.col("n"), F.col("p.n"), percent))
            .groupBy(F.col("sig").alias("a"), F.col("p.sig").alias("b")).agg(F.count(F.lit(1)).alias("k")))
    star = star.groupBy("a").agg(F.max(F.struct("k", "b")).alias("x")).select("a", F.col("x.b").alias("b"))

    shared = prefix.join(least.select("key"), "key", "left_semi").select("sig").distinct()
    owners = rows.where("n > 0").groupBy("sig").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "_key")).alias("o"))
    owners = owners.select("sig", "o.doc_id", "o._key")
    wanted = written(owners.join(shared, "sig"), "jaccard_wanted")
    sets = written(whole_sets(docs, wanted, id_col, text_col), "jaccard_tokens")

    star_links = written(verified(star, sets, percent), "jaccard_star")
    groups = written(components(star_links, "a", "b"), "jaccard_groups")

    member = prefix.join(groups, prefix["sig"] == groups["node"], "left").select(
        "key", "sig", "n", "pos", "most", F.coalesce("root", "sig").alias("g"))
    several = member.select("key", "g").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("key")
    live = written(member.join(several, "key", "left_semi"), "jaccard_live")
    other = live.groupBy("key", F.col("g").alias("h")).agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.least(F.col("most"), F.col("n") - F.col("pos"))).alias("bound"))
    # a set against the other groups whose token union holds its prefix token; the smallest member that fits
    # asks for the least overlap, and at a pair's first shared token what follows must reach it
    fits = F.greatest(F.col("lo"), F.ceil(F.lit(percent) * F.col("n") / 100))
    opened = (live.join(other, "key")
              .where((F.col("h") > F.col("g")) & (F.lit(percent) * F.col("n") <= 100 * F.col("hi"))
                     & (F.lit(percent) * F.col("lo") <= 100 * F.col("n"))
                     & (F.least(F.col("most"), F.col("n") - F.col("pos"), F.col("bound")) >= need_overlap(F.col("n"), fits, percent)))
              .select("key", F.col("sig").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("most").alias("ma"), "h"))
    inside = live.select("key", F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"),
                         F.col("most").alias("mb"), F.col("g").alias("h"))
    need = need_overlap(F.col("na"), F.col("nb"), percent)
    # what can follow, from a shared token on: for a pair's first shared token it must reach the need alone
    rest = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    met = (opened.join(inside, ["key", "h"]).where(
        _sizes_fit(F.col("na"), F.col("nb"), percent) & (F.least("ma", "mb") >= need) & (rest >= need))
        .groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("c"), F.max("pa").alias("pa"), F.max("pb").alias("pb")))
    # two tokens of one set may have one key, and count once: hence + 2
    pairs = met.where(F.col("c") + F.least(F.col("na") - F.col("pa") - 1, F.col("nb") - F.col("pb") - 1) + 2 >= need)
    # groups are linked as wholes: only links between two of them go through the steps again
    near = verified(pairs, sets, percent)
    for side in ("a", "b"):
        of = groups.select(F.col("node").alias(side), F.col("root").alias("_r"))
        near = near.join(of, side, "left").withColumn(side, F.coalesce("_r", side)).drop("_r")
    joined = written(components(near, "a", "b"), "jaccard_roots")

    ids = owners.join(groups, owners["sig"] == groups["node"], "left").select(
        "sig", F.coalesce("root", "sig").alias("_g"), "doc_id")
    ids = ids.join(joined, ids["_g"] == joined["node"], "left").select("sig", F.coalesce("root", "_g").alias("root"), "doc_id")
    named = ids.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    final = ids.join(named, "root").select(F.col("sig").alias("_s"), "component_id", F.col("root").alias("_root"))
    full = rows.where("n > 0").join(final, F.col("sig") == F.col("_s")).select("doc_id", "_key", "n", "component_id", "_root")
    empty = rows.where("n = 0").select("doc_id", "_key", "n", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("_root"))
    return full.unionByName(empty).select("doc_id", "_key", F.col("n").alias("n_shingles"), "component_id", *["_root"] * with_root)
