"""Ranked lexical search: the k best documents for each item, exactly, by presence-mask grouping.

Terms are found in the UTF-8 bytes of the whole text. One pass over the documents writes, for each, its number of terms and
its counts of the terms that any item asks for; document frequencies and lengths are then aggregated over all documents.

In the second pass every task works on chunks of documents. Bitmaps tell which of the items' terms a document holds; packed over an
item's terms they give the document's presence mask, and documents of equal masks form a group. The most that a
document of a mask can score is the sum, over the mask's terms, of weight times the largest term factor in the chunk. Masks are evaluated by
descending maximum, until it falls below the score of the item's k-th best document so far; no document behind can enter (at equal scores the smaller
id wins, so equal maxima are still evaluated). Only the k best of a task leave it, and they are merged in two steps.

Memory in a task is bounded by ``cells`` (documents of a chunk x distinct terms), whatever the document count. Items are taken in passes of at most
``terms_per_pass`` terms (a longer item is a pass of its own), which bounds what is broadcast.

Null and empty texts have no terms: such documents are found by no item, and such items find nothing. Repeated documents are separate documents;
documents of equal score and id may change places. A null id sorts first. Repeated items (and items without id) each have their ranks. Very long texts are
cut between terms while they are counted. Empty tables give no rows. Only id and text columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import ascii_lower, matches, small, written
from tagloom.operators.radix import order_key, ordered_starts

#: Fixed values of the contract.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
PIECE = 1 << 20


def term_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time; a long text is cut where no term stands."""
    text, at = text.lower(), 0  # bytes: only A-Z change
    while at < len(text):
        end = len(text)
        if end - at > PIECE:
            running = TERM_BYTES.match(text, at + PIECE)
            end = running.end() if running else at + PIECE
        yield TERM_BYTES.findall(text, at, end)
        at = end


def term_counts(text: bytes | None, vocabulary: dict[bytes, int]) -> tuple[int, dict[int, int]]:
    """(number of terms, counts of the terms of the vocabulary by number)."""
    counts: Counter = Counter()
    for terms in term_pieces(text or b""):
        counts.update(map(vocabulary.get, terms))
    total = sum(counts.values())
    counts.pop(None, None)
    return total, counts


def posted(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (its terms with repeats), terms (numbers in ``vocabulary``, ascending) and tfs."""
    shared = docs.sparkSession.sparkContext.broadcast({t.encode(): k for k, t in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shared.value
        for batch in batches:
            totals, sizes, terms, tfs = [], [0], [], []
            for text in batch.column(1):
                n, counts = term_counts(text.as_py(), numbers)
                found = sorted(counts.items())
                totals.append(n)
                sizes.append(sizes[-1] + len(found))
                terms += [t for t, _ in found]
                tfs += [c for _, c in found]
            places = pa.array(sizes, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(totals, pa.int64()), pa.ListArray.from_arrays(places, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(places, pa.array(tfs, pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary"))
    schema = T.StructType([*rows.select("doc_id").schema, T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())),
                           T.StructField("tfs", T.ArrayType(T.LongType()))])
    return rows.mapInArrow(run, schema)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Chunk:
    """Some documents side by side: presence bitmaps and term factors, a row per term and a column per document."""

    def __init__(self, n: np.ndarray, starts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, vocabulary: int, n_docs: int, n_terms: int):
        size = len(n)
        doc = np.repeat(np.arange(size), np.diff(starts))
        m = 75 + (25 * n * n_docs) // max(n_terms, 1)
        factor = (1_000_000_000 * tfs) // (1000 * tfs + 12 * m[doc])
        self.present = np.zeros((vocabulary, size), dtype=bool)
        self.present[terms, doc] = True
        self.factor = np.zeros((vocabulary, size), dtype=np.int32)  # at most 10^6
        self.factor[terms, doc] = factor
        self.highest = self.factor.max(axis=1).astype(np.int64) if size else np.zeros(vocabulary, dtype=np.int64)

    def masks(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents by group, where each group starts, the most its documents can score), groups by descending maximum."""
        packed = np.packbits(self.present[terms], axis=0)
        words = np.zeros((packed.shape[1], -(-packed.shape[0] // 8) * 8), dtype=np.uint8)
        words[:, : packed.shape[0]] = packed.T
        words = words.view(np.uint64)
        if words.shape[1] == 1:
            distinct, group = np.unique(words[:, 0], return_inverse=True)
            distinct = distinct[:, None]
        else:
            order = np.lexsort(words.T)
            new = np.concatenate([[True], (np.diff(words[order], axis=0) != 0).any(axis=1)])
            distinct, group = words[order[new]], np.empty(len(order), dtype=np.int64)
            group[order] = np.cumsum(new) - 1
        bits = np.unpackbits(np.ascontiguousarray(distinct).view(np.uint8), axis=1)[:, : len(terms)]
        most = bits.astype(np.int64) @ (weights * self.highest[terms])
        ranks = np.argsort(-most, kind="stable")
        place = np.empty(len(ranks), dtype=np.int64)
        place[ranks] = np.arange(len(ranks))
        docs = np.argsort(place[group], kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(place[group], minlength=len(ranks)))])
        return docs, starts, most[ranks]

    def scores(self, terms: np.ndarray, weights: np.ndarray, docs: np.ndarray) -> np.ndarray:
        return weights @ self.factor[np.ix_(terms, docs)].astype(np.int64)


class Best:
    """The k best (score, id) of one item so far."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def least(self) -> int:
        """No document below this score can enter; a document must score above 0."""
        return self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        keep = np.flatnonzero(scores >= self.least)
        if len(keep) > self.k:
            keep = keep[scores[keep] >= np.partition(scores[keep], -self.k)[-self.k]]
        if len(keep):
            rows = self.rows + [(int(scores[j]), ids[j]) for j in keep]
            self.rows = sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] if r[1] is not None else 0))[: self.k]


def search_chunk(chunk: Chunk, ids: list, items: list[tuple[np.ndarray, np.ndarray]], best: list[Best]) -> None:
    for (terms, weights), top in zip(items, best):
        if not len(terms) or int(weights @ chunk.highest[terms]) < top.least:
            continue
        docs, starts, most = chunk.masks(terms, weights)
        group = 0
        while group < len(most) and most[group] >= top.least:
            # whole groups, of about as many documents as can enter
            last = max(group + 1, int(np.searchsorted(starts, starts[group] + 2 * top.k, side="right")) - 1)
            part = docs[starts[group] : starts[last]]
            top.add(chunk.scores(terms, weights, part), [ids[d] for d in part])
            group = last


def _task_best(batches, shared, k: int, cells: int) -> Iterator[pa.RecordBatch]:
    items, vocabulary, n_docs, n_terms = shared.value
    best, size = [Best(k) for _ in items], max(64, cells // max(vocabulary, 1))
    id_type = None
    for batch in batches:
        id_type = batch.schema.field(0).type
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            starts = np.concatenate([[0], np.cumsum(part.column(2).value_lengths().to_numpy(zero_copy_only=False))])
            chunk = Chunk(part.column(1).to_numpy(), starts, part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy(),
                          vocabulary, n_docs, n_terms)
            search_chunk(chunk, part.column(0).to_pylist(), items, best)
    rows = [(i, *r) for i, top in enumerate(best) for r in top.rows]
    if rows:
        number, score, doc = zip(*rows)
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array([task] * len(rows), pa.int32()), pa.array(doc, id_type),
                                          pa.array(score, pa.int64())], ["_place", "_task", "doc_id", "score"])


def _first(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 20, terms_per_pass: int = 20_000, cells: int = 8_000_000,
                   doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: for each item its ``k`` best documents."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).alias("item_id"), matches(ascii_lower(F.coalesce(F.col(item_text), F.lit(""))), f"({TERM})").alias("_terms"))
    asked = written(asked.withColumn("_row", F.monotonically_increasing_id()).withColumn("_n", F.size("_terms")), "search_items")
    asked = asked.withColumn("_order", order_key(asked, ["_row"]))
    dealt = written(ordered_starts(asked, "_order", weight_col="_n", out_col="_at").withColumn(
        "_pass", F.floor(F.col("_at") / terms_per_pass)).drop("_at", "_order"), "search_passes")
    result = None
    for (number,) in sorted(dealt.select("_pass").distinct().collect()):  # one row per pass
        here = dealt.where(F.col("_pass") == number)
        found = _one_pass(spark, docs, here, k, cells, doc_id, doc_text)
        result = found if result is None else result.unionByName(found)
    if result is None:
        return spark.createDataFrame([], T.StructType([
            *asked.select("item_id").schema, T.StructField("rank", T.IntegerType()),
            *docs.select(F.col(doc_id).alias("doc_id")).schema, T.StructField("score", T.LongType())]))
    return result


def _one_pass(spark, docs: DataFrame, here: DataFrame, k: int, cells: int, doc_id: str, doc_text: str) -> DataFrame:
    rows = here.select("_row", "_terms").orderBy("_row").collect()  # bounded by the terms of a pass
    vocabulary = sorted({t for r in rows for t in r["_terms"]})
    number = {t: i for i, t in enumerate(vocabulary)}
    postings = written(posted(docs, vocabulary, doc_id, doc_text), "search_postings")
    size = postings.where("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    counted = postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect()  # a row per term of the pass
    weight = np.zeros(len(vocabulary), dtype=np.int64)
    for r in counted:
        weight[r["t"]] = term_weight(size["docs"], r["count"])
    wanted = []
    for r in rows:
        terms, repeats = np.unique(np.array([number[t] for t in r["_terms"]], dtype=np.int64), return_counts=True)
        wanted.append((terms, repeats * weight[terms]))
    shared = spark.sparkContext.broadcast((wanted, len(vocabulary), size["docs"], size["terms"]))
    schema = T.StructType([T.StructField("_place", T.IntegerType()), T.StructField("_task", T.IntegerType()),
                           *postings.select("doc_id").schema, T.StructField("score", T.LongType())])
    local = postings.mapInArrow(lambda batches: _task_best(batches, shared, k, cells), schema)
    merged = _first(local.withColumn("_some", F.col("_task") % 64), ["_place", "_some"], k).drop("rank")
    top = _first(merged, ["_place"], k)
    places = here.select("item_id", "_row").withColumn("_p", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_row")) - 1)
    return top.join(small(places.select("item_id", "_p")), F.col("_place") == F.col("_p")).select("item_id", "rank", "doc_id", "score")
