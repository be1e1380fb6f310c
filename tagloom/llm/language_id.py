"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text becomes the code points of its lower-cased letters, each other run of characters
being one space; n-grams of 1 to 3 of them are hashed into ``buckets`` columns. Training sums
counts per (language, bucket) in Spark; the log-probability matrix (languages x buckets) goes
out as a broadcast variable, and batches are scored in numpy as sparse rows: gather the
matrix's columns by n-gram, then sum by document. Texts are handled whole, in pieces of
``PIECE`` characters that overlap, so memory is bounded for any length.

The classifier is fitted on every labelled row. With ``max_rows_per_label`` it is fitted on at most about so many of each label,
picked by a hash of id and text (the counts that set the rate cover all rows).

The posterior is over the learned labels alone, so a text in no learned language gets one near 1 as well. What tells
it apart is ``gram_logprob``, the mean log-probability of its n-grams under the predicted label: :func:`least_logprob`
learns for each label what the texts it was fitted on get, and how far below a text may lie.

Null texts and texts without a letter: ``und``, score 0, no ``gram_logprob``. Without any labelled row every
document is ``und``. Repeated rows each give a row; ids may be null (and are not trained on).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import text_batches, tidy

PIECE = 1 << 19
ORDERS = (1, 2, 3)
UND = "und"
#: Texts of fewer n-grams (about 34 letters) are not judged by their mean: it says little about so few.
MIN_GRAMS = 100
#: The least a text may lie below its label's median: three halvings of an n-gram's probability. Of some 5,900 texts of
#: sf0.1 the lowest lies 1.92 below its median; hexadecimal runs, over models of three sizes, 2.4 and more, Polish 3.0, random
#: letters 3.8, other scripts 6.
LEAST_MARGIN = 3 * float(np.log(2))
#: The margin widens with the label's own spread: so many times the distance of the median from the 5 % point.
SPREADS = 4
#: Odd multipliers that spread n-grams over the buckets.
MULTIPLIERS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)
_LETTER = None


def _letter_table() -> np.ndarray:
    """True for the code points of letters (general category L)."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER


def letters_only(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, with one space for each run of others."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    is_letter = _letter_table()[points]
    points = np.where(is_letter, points, np.uint32(32))
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first of a run of others stays, as a space
    return points[keep]


def gram_buckets(points: np.ndarray, buckets: int) -> Iterator[np.ndarray]:
    """For each order the bucket of every n-gram that starts before the last two points
    (``buckets`` is a power of two)."""
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    for n in ORDERS:
        if len(points) < n:
            continue
        h = np.full(len(points) - n + 1, n, dtype=np.uint32)
        for k in range(n):
            h = (h ^ points[k : len(points) - n + 1 + k]) * np.uint32(MULTIPLIERS[k])
            h ^= h >> np.uint32(15)
        yield ((h * np.uint32(0x27D4EB2F)) >> shift)[: len(points) - 2]


def pieces(texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points of whole texts, some at a time: (points, number of the document per point).

    Two spaces stand before each text and at the end, so n-grams of a document never reach into its neighbours.
    A text of more than ``PIECE`` letters is cut into parts of that size; a part ends with the first two points of
    the next one, in which no n-gram of it starts, so all parts together have the n-grams of the whole text."""
    gap = np.full(2, 32, dtype=np.uint32)
    held, owner, size = [], [], 0

    def joined(end):
        return np.concatenate([*held, end]), np.repeat([o for o, _ in owner], [n for _, n in owner])

    for k, text in enumerate(texts):
        points = letters_only(text) if text else np.empty(0, np.uint32)
        for at in range(0, len(points), PIECE):
            part, lead = points[at : at + PIECE], gap[: 0 if at else 2]
            held += [lead, part]
            owner.append((k, len(part) + len(lead)))
            size += len(part) + len(lead)
            if size >= PIECE:
                yield joined(np.append(points[at + PIECE : at + PIECE + 2], gap)[:2])
                held, owner, size = [], [], 0
    if held:
        yield joined(gap)


def has_letter(text) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _train_counts(buckets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, group in pdf.groupby("lang"):
                row = total.setdefault(lang, np.zeros(buckets, dtype=np.int64))
                for points, _ in pieces(group["text"]):
                    for idx in gram_buckets(points, buckets):
                        row += np.bincount(idx, minlength=buckets)
        for lang, row in total.items():
            idx = np.flatnonzero(row)
            yield pd.DataFrame({"lang": lang, "bucket": idx.astype("int32"), "n": row[idx]})

    return run


def fitting_rows(docs: DataFrame, max_rows_per_label: int | None = None, id_col: str = "doc_id", text_col: str = "text",
                 lang_col: str = "lang") -> tuple[list[str], DataFrame | None]:
    """The labels of ``docs``, and the rows (text, lang) that the classifier is fitted on (None without a label): all that have
    both, or with ``max_rows_per_label`` about so many of each label."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per label
    labels = sorted(sizes)
    if not labels:
        return [], None
    if max_rows_per_label is None:
        return labels, rows.select("text", "lang")
    share = F.pmod(F.xxhash64("id", "text", F.lit("train")), F.lit(1 << 20))
    rate = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(int(min(1.0, max_rows_per_label / n) * (1 << 20))))])
    return labels, rows.where(share < rate[F.col("lang")]).select("text", "lang")


def fit(labels: list[str], picked: DataFrame | None, buckets: int = 1 << 16) -> tuple[list[str], np.ndarray]:
    """(labels, log-probability matrix buckets x labels)."""
    if not labels:
        return [], np.zeros((buckets, 0), dtype=np.float32)
    text_batches(picked.sparkSession)
    counted = (picked.mapInPandas(lambda batches: tidy(_train_counts(buckets)(batches)), "lang string, bucket int, n bigint")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())  # labels x buckets at most
    matrix = np.full((buckets, len(labels)), 0.5)
    where = {x: i for i, x in enumerate(labels)}
    np.add.at(matrix, (counted["bucket"].to_numpy(), counted["lang"].map(where).to_numpy(dtype="int64")), counted["n"].to_numpy())
    return labels, np.log(matrix / matrix.sum(axis=0)).astype(np.float32)


def train(docs: DataFrame, buckets: int = 1 << 16, max_rows_per_label: int | None = None, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(labels, log-probability matrix buckets x labels) from the labelled rows of ``docs``."""
    return fit(*fitting_rows(docs, max_rows_per_label, id_col, text_col, lang_col), buckets)


def least_logprob(picked: DataFrame, model: tuple[list[str], np.ndarray]) -> dict[str, float]:
    """For each label the ``gram_logprob`` below which a text is not in that language, from the spread over the rows
    that the label was fitted on and that are predicted right. A label without such a row of ``MIN_GRAMS`` has none."""
    judged = predict(picked, model).where((F.col("lang_pred") == F.col("lang")) & (F.col("n_grams") >= MIN_GRAMS))
    spread = judged.groupBy("lang").agg(F.percentile_approx("gram_logprob", [0.5, 0.05], 10_000).alias("q"))
    # one row per label; rounded, as the percentiles are approximate
    return {r["lang"]: round(r["q"][0] - max(LEAST_MARGIN, SPREADS * (r["q"][0] - r["q"][1])), 2) for r in spread.collect()}


def score_texts(texts, labels: list[str], matrix: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """For each text the predicted label, its posterior (uniform prior), the mean log-probability of its n-grams under
    that label (nan where there is none), and the number of n-grams."""
    texts = list(texts)
    logs, grams = np.zeros((len(texts), len(labels))), np.zeros(len(texts), dtype=np.int64)
    for points, owner in pieces(texts):
        firsts = np.flatnonzero(np.diff(owner, prepend=-1))
        for idx in gram_buckets(points, matrix.shape[0]):
            logs[owner[firsts]] += np.add.reduceat(matrix[idx], firsts, axis=0, dtype=np.float64)
            grams[owner[firsts]] += np.diff(firsts, append=len(idx))
    if not labels:
        return [UND] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan), grams
    known = np.array([has_letter(t) for t in texts], dtype=bool)
    best = logs.argmax(axis=1)
    posterior = 1.0 / np.exp(np.clip(logs - logs.max(axis=1, keepdims=True), -700, 0)).sum(axis=1)
    mean = np.where(known, logs[np.arange(len(texts)), best] / np.maximum(grams, 1), np.nan)
    return [labels[b] if k else UND for b, k in zip(best, known)], np.where(known, posterior, 0.0), mean, grams


#: Rows of a batch that are scored at a time.
ROWS_AT_ONCE = 512


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, ``gram_logprob`` and ``n_grams`` (each with ``prefix``; columns of these names are
    replaced). Each row travels once, with its text. The matrix is broadcast: labels x buckets."""
    spark = docs.sparkSession
    text_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    new = [prefix + c for c in ("lang_pred", "score", "gram_logprob", "n_grams")]
    own = [c for c in docs.columns if c not in new]
    if text_col not in own:
        raise ValueError(f"{text_col!r} would be replaced by a prediction")
    at = own.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, matrix = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                pred, score, mean, grams = score_texts(part.column(at).to_pylist(), labels, matrix)
                more = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(mean, pa.float64(), mask=np.isnan(mean)),
                        pa.array(grams, pa.int64())]
                yield pa.RecordBatch.from_arrays(part.columns + more, [*own, *new])

    types = [T.StringType(), T.DoubleType(), T.DoubleType(), T.LongType()]
    schema = T.StructType([*docs.select(*own).schema, *[T.StructField(n, t) for n, t in zip(new, types)]])
    return docs.select(*own).mapInArrow(lambda batches: tidy(run(batches)), schema)


def fold(doc_id: Column) -> Column:
    """The contract's fold: rows of fold 0 are never trained on; null for a null id."""
    return F.crc32(doc_id.cast("string")) % 5
