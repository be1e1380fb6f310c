"""Distributed batch scoring and the tokenizer hook.

Any model plugs in as a *factory*: it is called once per partition on the
executor (load weights there, not on the driver), and the returned callable
scores whole Arrow batches. Rows never pass through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import text_batches

PredictFactory = Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]

#: Bytes of text that a worker turns into ids at a time.
PART_BYTES = 1 << 20


def batch_score(df: DataFrame, factory: PredictFactory, schema: StructType | str) -> DataFrame:
    """``mapInPandas``: one model instance per partition, one call per Arrow batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = factory()
        for pdf in batches:
            yield predict(pdf)

    return df.mapInPandas(run, schema)


def argmax_rule(id_col: str, logits_col: str) -> PredictFactory:
    """A deterministic stand-in model: the values are the logits.

    Emits ``id, pred`` (argmax, first maximum wins) and ``score`` (max softmax prob).
    """

    def factory():
        def predict(pdf: pd.DataFrame) -> pd.DataFrame:
            if len(pdf) == 0:
                return pd.DataFrame({id_col: pd.Series([], dtype="int64"), "pred": pd.Series([], dtype="int32"),
                                     "score": pd.Series([], dtype="float64")})
            z = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[logits_col]])
            pred = z.argmax(axis=1).astype(np.int32)
            e = np.exp(z - z.max(axis=1, keepdims=True))
            score = (e.max(axis=1) / e.sum(axis=1)).astype(np.float64)
            return pd.DataFrame({id_col: pdf[id_col].astype("int64"), "pred": pred, "score": score})

        return predict

    return factory


def tokenizer_udf(factory: Callable[[], Callable[[str], list[int]]]):
    """Wrap a caller's tokenizer as an iterator ``arrow_udf`` returning ``array<int>``.

    The tokenizer is built once per Python worker (factory), then applied to
    every text. A batch goes back in parts of about ``PART_BYTES`` of text, so what a worker
    and the JVM hold of the ids depends on neither the rows of a batch nor the length of its texts (but for a single long one).
    """
    session = SparkSession.getActiveSession()
    if session is not None:
        text_batches(session)

    @F.arrow_udf("array<int>")
    def _tok(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tok = factory()
        for arr in batches:
            for part in parts(arr, pc.binary_length(arr)):
                yield id_lists([None if t is None else tok(t) for t in part.to_pylist()])

    return _tok


def parts(arr: pa.Array, sizes: pa.Array, most: int | None = None) -> Iterator[pa.Array]:
    """``arr`` in slices whose ``sizes`` (null: 0) add up to at most ``most``, or of one value; an empty array is one slice."""
    most = PART_BYTES if most is None else most
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(arr) or not start and not len(arr):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield arr.slice(start, end - start)
        start = end


def id_lists(rows: list) -> pa.ListArray:
    """Rows of ids (lists or arrays; None: null) as one Arrow array."""
    ids = [np.asarray([] if r is None else r, dtype=np.int32) for r in rows]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()), mask=pa.array([r is None for r in rows], pa.bool_()))


def codepoint_tokenizer() -> Callable[[str], np.ndarray]:
    """Simple reference tokenizer: one id per Unicode code point (whole text)."""

    def tok(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int32)

    return tok
