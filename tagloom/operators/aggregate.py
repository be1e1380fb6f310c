"""Grouping operators: keep-first dedupe, class distribution, stage counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe_first(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """``drop_duplicates(subset=[key])`` keeping the first row in ``order_col`` order.

    Null keys form one group. ``min_by`` over the whole row is a partial
    aggregate: a key holding a third of the rows is reduced to one candidate
    per map task before the shuffle, so no task ever sees the whole group.
    """
    cols = df.columns
    return (
        df.groupBy(key)
        .agg(F.min_by(F.struct(*cols), F.col(order_col)).alias("_first"))
        .select(*[F.col("_first")[c].alias(c) for c in cols])
    )


def class_distribution(df: DataFrame, label_col: str, count_col: str = "n") -> DataFrame:
    """``value_counts()``: rows per non-null label, most frequent first, ties by label."""
    return (
        df.where(F.col(label_col).isNotNull())
        .groupBy(label_col)
        .agg(F.count(F.lit(1)).alias(count_col))
        .orderBy(F.desc(count_col), F.asc(label_col))
    )


def stage_counts(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """Row counts for several predicates in one pass (one aggregate, one job)."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(cond).alias(name) for name, cond in stages.items()]
    return df.agg(*aggs)


def mean_loss(df: DataFrame, loss_col: str, out_col: str = "loss") -> DataFrame:
    """Batch-weighted mean of batch means = plain row mean; empty input gives 0.0."""
    return df.agg(F.coalesce(F.avg(F.col(loss_col).cast("double")), F.lit(0.0)).alias(out_col))
