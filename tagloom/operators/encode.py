"""Token sequences: a corpus vocabulary encoder (tokens by regex in the JVM,
vocabulary by distributed count + top-k), masked causal-LM rows,
fixed-length encoder rows, per-batch padding, and prompt stripping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import IGNORE_INDEX, fixed_length, masked_sequence, pad_to
from ..session import text_batches
from .score import parts

# ---------------------------------------------------------------------------
# Fixed values of our corpus tokenizer (ours, not the reference's).
# Special tokens and their ids; corpus tokens follow from id 4 in rank order.
SPECIAL_TOKENS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]"]
PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 1, 2, 3
# Ids of the code points with which tokens outside the vocabulary are spelled, after an [UNK].
SPELL_BASE = 1 << 22
# CJK Unified Ideographs get a space on each side so each is its own token.
CJK_PATTERN = "([一-鿿])"
# A token: a run of letters/digits, or one other non-space character.
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\s\x0b\x1c-\x1f\x85\p{Z}\p{L}\p{N}]"
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text) -> Column:
    """Text -> array<string>: lower-case, split CJK characters, regex tokens (whole text)."""
    spaced = F.regexp_replace(F.lower(_col(text)), CJK_PATTERN, " $1 ")
    return F.regexp_extract_all(spaced, F.lit(TOKEN_PATTERN), 0)


def token_vocab(df: DataFrame, tokens_col: str, max_vocab: int) -> DataFrame:
    """``(token, id, n)``: the ``max_vocab`` most frequent tokens (ties by token), ids after the specials.

    The count is a partial aggregate (a frequent token is combined per map
    task); the top-k is a bounded ``TakeOrderedAndProject``; only the capped
    table is ranked.
    """
    # explode_outer: a plain explode makes Catalyst infer ``size(tokens) > 0`` and push that
    # filter (the whole tokenizer) below any repartition, tokenizing every text twice
    tokens = df.select(F.explode_outer(tokens_col).alias("token")).where(F.col("token").isNotNull())
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), F.asc("token")).limit(max_vocab)
    ranked = top.withColumn("id", (F.row_number().over(Window.orderBy(F.desc("n"), F.asc("token"))) + len(SPECIAL_TOKENS) - 1).cast("int"))
    return ranked.select("token", "id", "n")


def _vocab_arrays(vocab: DataFrame, max_vocab: int) -> tuple[pa.Array, np.ndarray]:
    """Tokens and ids of the vocabulary's first ``max_vocab`` entries."""
    rows = vocab.select("token", "id").orderBy("id").limit(max_vocab).collect()
    return pa.array([r["token"] for r in rows], pa.string()), np.array([r["id"] for r in rows], dtype=np.int32)


def _offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)))


def _list_lengths(arr: pa.ListArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(arr), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _list_bytes(arr: pa.ListArray) -> pa.Array:
    """For each list about the bytes that its values take (8 more for each)."""
    flat = arr.flatten()
    width = pc.fill_null(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False) if pa.types.is_string(flat.type) else np.zeros(len(flat), np.int64)
    ends, at = _offsets(width.astype(np.int64) + 8), _offsets(_list_lengths(arr))
    return pa.array(ends[at[1:]] - ends[at[:-1]])


def encode_lists(arr: pa.ListArray, tokens: pa.Array, ids: np.ndarray) -> pa.ListArray:
    """Ids of lists of tokens. A token outside the vocabulary is spelled: [UNK], then its code points
    from ``SPELL_BASE`` on, so nothing is lost."""
    flat = arr.flatten()
    at = pc.fill_null(pc.index_in(flat, value_set=tokens), -1).to_numpy(zero_copy_only=False)
    unknown = at < 0
    rare = flat.filter(pa.array(unknown))
    n = pc.utf8_length(rare).to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.ones(len(flat), dtype=np.int64)
    size[unknown] += n
    ends = _offsets(size)
    out = np.empty(int(ends[-1]), dtype=np.int32)
    out[ends[:-1][~unknown]] = ids[at[~unknown]]
    out[ends[:-1][unknown]] = UNK_ID
    points = np.frombuffer("".join(rare.to_pylist()).encode("utf-32-le"), dtype="<u4")
    out[np.repeat(ends[:-1][unknown] + 1 - _offsets(n)[:-1], n) + np.arange(len(points))] = points.astype(np.int32) + SPELL_BASE
    offsets = ends[_offsets(_list_lengths(arr))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out), mask=arr.is_null())


def decode_lists(arr: pa.ListArray, tokens: list[str], skip_special: bool) -> pa.ListArray:
    """Tokens of lists of ids, the inverse of :func:`encode_lists`."""
    flat = arr.flatten().to_numpy(zero_copy_only=False)
    spelled = flat >= SPELL_BASE
    begins = ~spelled
    if skip_special:
        begins &= (flat >= len(SPECIAL_TOKENS)) | (flat == UNK_ID)
    # code points belong to the token that began last
    owner = np.cumsum(begins) - 1
    heads = flat[begins]
    text = (flat[spelled] - SPELL_BASE).astype("<u4").tobytes().decode("utf-32-le")
    cuts = _offsets(np.bincount(owner[spelled], minlength=len(heads)))
    table = [*SPECIAL_TOKENS, *tokens]
    out = [text[cuts[k] : cuts[k + 1]] if i == UNK_ID and cuts[k] < cuts[k + 1] else table[i] for k, i in enumerate(heads.tolist())]
    offsets = _offsets(begins)[_offsets(_list_lengths(arr))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out, pa.string()), mask=arr.is_null())


def encode_tokens(df: DataFrame, tokens_col: str, vocab: DataFrame, max_vocab: int, out_col: str = "input_ids") -> DataFrame:
    """Token array -> id array in place (no shuffle of the corpus); tokens outside the vocabulary are spelled.

    The vocabulary (``max_vocab`` entries, a parameter) is shipped once per executor as a
    broadcast variable; Arrow batches are mapped in parts of bounded size.
    """
    table = df.sparkSession.sparkContext.broadcast(_vocab_arrays(vocab, max_vocab))
    text_batches(df.sparkSession)

    @F.arrow_udf("array<int>")
    def _lookup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens, ids = table.value
        for arr in batches:
            for part in parts(arr, _list_bytes(arr)):
                yield encode_lists(part, tokens, ids)

    return df.withColumn(out_col, _lookup(F.col(tokens_col)))


def decode_ids(df: DataFrame, ids_col: str, vocab: DataFrame, max_vocab: int, out_col: str = "tokens", skip_special: bool = True) -> DataFrame:
    """Id array -> token array through the same vocabulary."""
    table = df.sparkSession.sparkContext.broadcast(_vocab_arrays(vocab, max_vocab)[0].to_pylist())
    text_batches(df.sparkSession)

    @F.arrow_udf("array<string>")
    def _take(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            for part in parts(arr, _list_bytes(arr)):
                yield decode_lists(part, table.value, skip_special)

    return df.withColumn(out_col, _take(F.col(ids_col)))


def mask_labels(df: DataFrame, prompt_ids: str, response_ids: str, pad_id: int, max_length: int) -> DataFrame:
    """Add ``input_ids, attention_mask, labels, n_target`` (see ``functions.arrays.masked_sequence``)."""
    return df.withColumns(masked_sequence(prompt_ids, response_ids, pad_id, max_length))


def encode_fixed(df: DataFrame, ids_col: str, max_length: int, cls_id: int = CLS_ID, sep_id: int = SEP_ID, pad_id: int = PAD_ID) -> DataFrame:
    return df.withColumns(fixed_length(ids_col, max_length, cls_id, sep_id, pad_id))


def pad_batches(df: DataFrame, batch_col: str, pad_id: int = PAD_ID) -> DataFrame:
    """Pad ``input_ids`` (pad id), ``attention_mask`` (0), ``labels`` (-100) to the longest row of each batch.

    Batches are small and fixed-size (16 rows), so the window partition is bounded.
    """
    longest = F.max(F.size("input_ids")).over(Window.partitionBy(batch_col))
    return (
        df.withColumn("_len", longest)
        .withColumn("input_ids", pad_to("input_ids", F.col("_len"), pad_id))
        .withColumn("attention_mask", pad_to("attention_mask", F.col("_len"), 0))
        .withColumn("labels", pad_to("labels", F.col("_len"), IGNORE_INDEX))
        .drop("_len")
    )
