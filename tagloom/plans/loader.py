"""Load prepared artifacts into training batches (the reference's loader step).

Label ids come from the saved label metadata, text is encoded to fixed
length, rows are split (or carry their saved split), and each split is cut into
fixed-size batches: in a new order every epoch, or in one fixed order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.encode import encode_fixed, encode_tokens, token_vocab, tokenize
from ..operators.joins import encode_label_id, pair_text_label
from ..operators.permute import in_order
from ..operators.rank import exact_rank, hash_order_key
from ..operators.split import fraction_sizes, split_fraction, split_stratified
from ..sources import tables


def assign_batches(df: DataFrame, key_col: str, id_col: str, batch_size: int, group_col: str | None = None,
                   group_sizes: dict | None = None) -> DataFrame:
    """``batch_id`` / ``pos_in_batch`` from the exact rank in ``(key_col, id_col)`` hash order (within ``group_col``)."""
    ranked = exact_rank(df, key_col, id_col, [group_col] if group_col else [], "_pos", group_sizes=group_sizes)
    return ranked.withColumns({
        "batch_id": F.floor((F.col("_pos") - 1) / batch_size).cast("long"),
        "pos_in_batch": ((F.col("_pos") - 1) % batch_size).cast("int"),
    }).drop("_pos")


def epoch_batches(ranked: DataFrame, epoch: int, batch_size: int, seed, group_col: str = "split", shuffled: Sequence[str] = ("train",)) -> DataFrame:
    """Batches of one epoch of the rows that ``permute.rank_once`` numbered: groups in ``shuffled`` in a new order every epoch,
    the others always in that of epoch 0. A projection: no epoch moves a row."""
    ordered = in_order(in_order(ranked, seed, epoch, "_new"), seed, 0, "_fixed")
    at = F.when(F.col(group_col).isin(*shuffled), F.col("_new")).otherwise(F.col("_fixed"))
    return ordered.withColumns({
        "batch_id": F.floor(at / batch_size).cast("long"), "pos_in_batch": (at % batch_size).cast("int"),
    }).drop("_new", "_fixed", "place", "size")


def encode_and_batch(rows: DataFrame, id_col: str, text_col: str, max_length: int, max_vocab: int, batch_size: int,
                     epoch: int, seed, shuffled: Sequence[str] = ("train",), group_sizes: dict | None = None) -> DataFrame:
    """Rows with a ``split`` as batches of fixed-length ids; the splits in ``shuffled`` change their order every epoch."""
    rows = rows.withColumn("_tokens", tokenize(text_col))
    tv = token_vocab(rows, "_tokens", max_vocab)
    # texts end here; the shuffles below carry unpadded ids, cut to what can be used
    rows = encode_tokens(rows, "_tokens", tv, max_vocab, "_ids").drop("_tokens", text_col)
    rows = rows.withColumn("_ids", F.slice("_ids", 1, max_length))
    ep: Column = F.when(F.col("split").isin(*shuffled), F.lit(epoch)).otherwise(F.lit(0))
    rows = rows.withColumn("_bkey", hash_order_key(seed, ep, id_col))
    batched = assign_batches(rows, "_bkey", id_col, batch_size, group_col="split", group_sizes=group_sizes)
    return encode_fixed(batched, "_ids", max_length).drop("_bkey", "_ids")


def load_batches(merged: DataFrame, vocab_labels: DataFrame, id_col: str, text_col: str = "content", label_col: str = "label",
                 max_length: int = 512, max_vocab: int = 5000, batch_size: int = 16, epoch: int = 1, seed=42) -> DataFrame:
    """Merged rows, split 80/10/10: ``split, batch_id, pos_in_batch, label_id`` and fixed-length ``input_ids`` /
    ``attention_mask``. Train and validation change their order every epoch; test keeps one."""
    rows = encode_label_id(merged, vocab_labels, label_col)
    n = merged.count()
    rows = split_fraction(rows, id_col, 0.8, 0.1, seed, n=n)
    sizes = {k: v for k, v in fraction_sizes(n, 0.8, 0.1).items() if v > 0}
    return encode_and_batch(rows, id_col, text_col, max_length, max_vocab, batch_size, epoch, seed, ("train", "val"), sizes)


def load_batches_short(spark: SparkSession, artifacts_dir: str, id_type: str = "bigint", max_length: int = 128,
                       max_vocab: int = 5000, batch_size: int = 16, epoch: int = 1, seed=42) -> DataFrame:
    """What ``save_short`` wrote, as batches: text and targets of every split paired by row id, train in a new
    order every epoch, validation and test in a fixed one. A row missing on one side, or in two splits, raises."""
    text_col = tables.load_label_metadata(spark, f"{artifacts_dir}/labels").first()["text_col"]
    text = tables.read_csv(spark, f"{artifacts_dir}/splits_text", f"row_id {id_type}, `{text_col}` string, split string")
    y = spark.read.parquet(f"{artifacts_dir}/encoded").withColumnRenamed("split", "_target_split")
    rows = pair_text_label(text, y, "row_id")
    same = F.col("split") == F.col("_target_split")
    rows = rows.where(F.when(same, F.lit(True)).otherwise(F.raise_error(F.lit("text and target in different splits"))))
    return encode_and_batch(rows.drop("_target_split"), "row_id", text_col, max_length, max_vocab, batch_size, epoch, seed)


def load_batches_stratified(rows: DataFrame, vocab_labels: DataFrame, id_col: str, text_col: str, label_col: str,
                            max_length: int = 256, max_vocab: int = 5000, batch_size: int = 8, epoch: int = 1, seed=42) -> DataFrame:
    """Single-label rows, split 70/15/15 within every class, as batches of label ids and fixed-length ids."""
    rows = split_stratified(encode_label_id(rows, vocab_labels, label_col), label_col, id_col, seed)
    return encode_and_batch(rows, id_col, text_col, max_length, max_vocab, batch_size, epoch, seed)
