"""Joins: metadata to page content (null-safe, fan-out kept), label <-> id
lookups against a vocabulary, and text/target pairing by row id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: Vocabularies of at most this many labels carry a broadcast hint.
HINTED_LABELS = 50_000


def small_vocab(vocab: DataFrame) -> DataFrame:
    """``vocab``, stored, with a broadcast hint if it has at most ``HINTED_LABELS`` rows: the rows that meet it then stay where they are.
    Left to estimates, Spark may deal whole rows out by label, and a few labels are a few tasks."""
    kept = stored(vocab, "vocab")
    return F.broadcast(kept) if kept.limit(HINTED_LABELS + 1).count() <= HINTED_LABELS else kept


def left_join_content(meta: DataFrame, web: DataFrame, left_key: str, right_key: str, skew_safe: bool = True) -> DataFrame:
    """pandas ``merge(how="left")``: null keys match null keys, repeated right keys fan out.

    ``<=>`` is still an equi-join key. With ``skew_safe`` the left join is
    built as an inner join (AQE can split a hot key on either side) plus the
    left rows without a match, found by an anti-join against the *distinct*
    right keys (partial aggregation collapses a key that holds a third of the
    rows before it is shuffled). A plain left outer join could split only the
    left side, leaving one task with every right row of a hot key.
    """
    cond = meta[left_key].eqNullSafe(web[right_key])
    if not skew_safe:
        return meta.join(web, cond, "left")
    matched = meta.join(web, cond, "inner")
    keys = web.select(F.col(right_key).alias("_rkey")).distinct()
    unmatched = meta.join(keys, meta[left_key].eqNullSafe(keys["_rkey"]), "left_anti")
    pad = [F.lit(None).cast(f.dataType).alias(f.name) for f in web.schema.fields]
    return matched.unionByName(unmatched.select(*meta.columns, *pad))


def merge_content(meta: DataFrame, web: DataFrame, left_key: str, right_key: str, content_col: str) -> DataFrame:
    """Left join then drop rows without content: Catalyst turns it into an inner join."""
    return left_join_content(meta, web, left_key, right_key).where(F.col(content_col).isNotNull())


def encode_label_id(df: DataFrame, vocab: DataFrame, label_col: str, id_col: str = "label_id", on_unknown: str = "error") -> DataFrame:
    """Label -> id through the vocabulary (``label``, ``id``).

    ``on_unknown``: "error" raises like a dict lookup would, "drop" removes
    the row, "null" keeps it with a null id. A null label is unknown.
    """
    v = small_vocab(vocab).select(F.col("label").alias("_lab"), F.col("id").alias(id_col))
    out = df.join(v, df[label_col] == F.col("_lab"), "left").drop("_lab")
    if on_unknown == "drop":
        return out.where(F.col(id_col).isNotNull())
    if on_unknown == "error":
        name = F.coalesce(F.col(label_col).cast("string"), F.lit("null"))
        return out.where(F.when(F.col(id_col).isNotNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("unknown label: "), name))))
    return out


def decode_label_id(df: DataFrame, vocab: DataFrame, id_col: str, label_col: str = "label") -> DataFrame:
    """Id -> label; ids may arrive as int or as their decimal string (JSON map keys)."""
    v = small_vocab(vocab).select(F.col("id").cast("int").alias("_id"), F.col("label").alias(label_col))
    return df.join(v, df[id_col].cast("int") == F.col("_id"), "left").drop("_id")


def pair_text_label(text: DataFrame, target: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Pair text row i with target row i by a stable id; a row missing on either side raises."""
    both = text.withColumn("_lhs", F.lit(True)).join(target.withColumn("_rhs", F.lit(True)), id_col, "full_outer")
    missing = F.col("_lhs").isNull() | F.col("_rhs").isNull()
    check = F.when(missing, F.raise_error(F.concat(F.lit("text/target mismatch at id "), F.col(id_col).cast("string")))).otherwise(
        F.lit(True)
    )
    return both.where(check).drop("_lhs", "_rhs")


__all__ = [
    "small_vocab",
    "left_join_content",
    "merge_content",
    "encode_label_id",
    "decode_label_id",
    "pair_text_label",
]
