"""Label vocabularies: distinct labels, dense ids by codepoint order, and the
label-metadata record. Joins with a vocabulary: ``joins.small_vocab``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import parse_labels
from ..session import stored
from .radix import order_key, ordered_starts

def dense_ids(labels: DataFrame, label_col: str = "label", id_col: str = "id", target_rows: int = 200_000) -> DataFrame:
    """``{l: i for i, l in enumerate(sorted(labels))}`` on distinct labels.

    Spark's string order is UTF-8 binary = codepoint order = Python's sort. Labels are numbered inside buckets by prefix
    (``radix.ordered_starts``; a prefix that too many labels share is opened further), and only bucket counts meet in one place.
    """
    distinct = labels.select(F.col(label_col).alias("label")).where(F.col("label").isNotNull()).distinct()
    keyed = stored(distinct.withColumn("_okey", order_key(distinct, ["label"])), "labels")
    numbered = ordered_starts(keyed, "_okey", out_col=id_col, target_rows=target_rows, open_all=True)
    return numbered.select("label", F.col(id_col).cast("int").alias(id_col))


def label_vocab_single(df: DataFrame, label_col: str) -> DataFrame:
    """Single-label vocabulary ``(label, id)``."""
    return dense_ids(df.select(F.col(label_col).alias("label")))


def label_vocab_multi(df: DataFrame, label_col: str) -> DataFrame:
    """Multi-label vocabulary ``(label, id)`` over parsed label cells (no synonym merging)."""
    return dense_ids(df.select(F.explode(parse_labels(label_col)).alias("label")))


def vocab_list(vocab: DataFrame) -> list[str]:
    """Labels in id order (one driver row per label; used to inline a multi-hot class list)."""
    return [r["label"] for r in vocab.orderBy("id").select("label").collect()]


def label_metadata(vocab: DataFrame, label_col: str, text_col: str) -> DataFrame:
    """One-row record ``labels, lab2id, id2lab (string keys), num_labels, label_col, text_col``."""
    entries = F.sort_array(F.collect_list(F.struct("id", "label")))
    # ``vocab`` comes from ``dense_ids`` (size already checked); one row out
    return vocab.agg(entries.alias("_e")).select(
        F.transform("_e", lambda e: e["label"]).alias("labels"),
        F.map_from_entries(F.transform("_e", lambda e: F.struct(e["label"], e["id"]))).alias("lab2id"),
        F.map_from_entries(F.transform("_e", lambda e: F.struct(e["id"].cast("string"), e["label"]))).alias("id2lab"),
        F.size("_e").alias("num_labels"),
        F.lit(label_col).alias("label_col"),
        F.lit(text_col).alias("text_col"),
    )


def metadata_to_vocab(meta: DataFrame) -> DataFrame:
    """Inverse of ``label_metadata``: the ``(label, id)`` table from ``lab2id``."""
    return meta.select(F.explode("lab2id").alias("label", "id")).select("label", F.col("id").cast("int").alias("id"))
