"""Multi-label targets: sorted label ids per row. Dense vectors are made from them only where a sink or a loader wants them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import small_vocab


def sparse_targets(rows: DataFrame, vocab: DataFrame, id_col: str = "row_id", labels_col: str = "labels", out_col: str = "label_ids") -> DataFrame:
    """``id_col`` and ``out_col``: for every row the sorted ids of its labels, each once; labels outside ``vocab`` are left out, a row
    without any has an empty array. ``id_col`` is unique.

    Labels meet the vocabulary in a join, one row per label of a cell, so neither the plan nor a row grows with the vocabulary."""
    each = rows.select(id_col, F.explode(F.array_distinct(labels_col)).alias("label"))
    known = each.join(small_vocab(vocab.select("label", "id")), "label").groupBy(id_col).agg(F.sort_array(F.collect_list("id")).alias(out_col))
    return rows.select(id_col).join(known, id_col, "left").withColumn(out_col, F.coalesce(out_col, F.array().cast("array<int>")))


def dense_targets(ids, n_labels: int) -> Column:
    """Indicator array of ``n_labels`` places (float) from label ids."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    if n_labels <= 0:
        return F.array().cast("array<float>")
    return F.transform(F.sequence(F.lit(0), F.lit(n_labels - 1)), lambda i: F.array_contains(ids, i).cast("float"))
