"""Classification metrics as distributed aggregates.

Data never leaves the executors: rows are reduced to a confusion table
(single-label, at most classes^2 rows) or per-label counts (multi-label,
L rows) by partial aggregation, and every average is computed from that
small table. Zero divisions give 0, as scikit-learn's ``zero_division=0``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import threshold
from ..functions.arrays import multi_hot


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return _ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn)


# ---------------------------------------------------------------- single-label


def confusion_matrix(df: DataFrame, y_col: str, pred_col: str) -> DataFrame:
    """``(y_true, y_pred, n)`` — the only row-level aggregation single-label metrics need."""
    return df.groupBy(F.col(y_col).alias("y_true"), F.col(pred_col).alias("y_pred")).agg(F.count(F.lit(1)).alias("n"))


def class_counts(cm: DataFrame) -> DataFrame:
    """Per class over the union of true and predicted classes: ``label, tp, fp, fn, support``."""
    zero, n = F.lit(0).cast("long"), F.col("n").cast("long")
    kind = cm.schema["y_true"].dataType
    hit = F.when(F.col("y_true").eqNullSafe(F.col("y_pred")), n).otherwise(zero)
    # each cell counts once for its true class and once for its predicted class: no join
    sides = cm.select(F.inline(F.array(
        F.struct(F.col("y_true").alias("label"), n.alias("support"), zero.alias("predicted"), hit.alias("tp")),
        F.struct(F.col("y_pred").cast(kind).alias("label"), zero.alias("support"), n.alias("predicted"), zero.alias("tp")))))
    both = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    return both.select("label", "tp", (F.col("predicted") - F.col("tp")).alias("fp"), (F.col("support") - F.col("tp")).alias("fn"), "support")


def with_scores(counts: DataFrame) -> DataFrame:
    """Add per-class ``precision, recall, f1`` to a ``tp, fp, fn`` table."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {"precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn), "f1": _f1(tp, fp, fn)}
    )


def single_label_summary(cm: DataFrame) -> DataFrame:
    """One row: accuracy, macro / micro / weighted precision, recall, f1, and n."""
    s = with_scores(class_counts(cm))
    n = F.sum("support")
    return s.agg(
        _ratio(F.sum("tp"), n).alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        _ratio(F.sum("tp"), F.sum("tp") + F.sum("fp")).alias("micro_precision"),
        _ratio(F.sum("tp"), F.sum("tp") + F.sum("fn")).alias("micro_recall"),
        _f1(F.sum("tp"), F.sum("fp"), F.sum("fn")).alias("micro_f1"),
        _ratio(F.sum(F.col("precision") * F.col("support")), n).alias("weighted_precision"),
        _ratio(F.sum(F.col("recall") * F.col("support")), n).alias("weighted_recall"),
        _ratio(F.sum(F.col("f1") * F.col("support")), n).alias("weighted_f1"),
        n.cast("long").alias("n"),
    )


def classification_metrics(df: DataFrame, y_col: str, pred_col: str) -> DataFrame:
    """``{accuracy, precision, recall, f1}`` with macro averages over the class union."""
    s = single_label_summary(confusion_matrix(df, y_col, pred_col))
    return s.select(
        "accuracy",
        F.col("macro_precision").alias("precision"),
        F.col("macro_recall").alias("recall"),
        F.col("macro_f1").alias("f1"),
    )


def classification_report(df: DataFrame, y_col: str, pred_col: str) -> DataFrame:
    """Per-class rows, then ``accuracy``, ``macro avg``, ``weighted avg``; sort by ``ord, row`` to print.

    Columns ``row, precision, recall, f1, support, ord``; the accuracy row
    carries its value in ``f1`` only (like the printed report).
    """
    cm = confusion_matrix(df, y_col, pred_col)
    per_class = with_scores(class_counts(cm)).select(
        F.col("label").cast("string").alias("row"), "precision", "recall", "f1", "support"
    )
    s = single_label_summary(cm)
    summary = s.select(
        F.inline(
            F.array(
                F.struct(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                         F.lit(None).cast("double").alias("recall"), F.col("accuracy").alias("f1"), F.col("n").alias("support")),
                F.struct(F.lit("macro avg").alias("row"), F.col("macro_precision").alias("precision"),
                         F.col("macro_recall").alias("recall"), F.col("macro_f1").alias("f1"), F.col("n").alias("support")),
                F.struct(F.lit("weighted avg").alias("row"), F.col("weighted_precision").alias("precision"),
                         F.col("weighted_recall").alias("recall"), F.col("weighted_f1").alias("f1"), F.col("n").alias("support")),
            )
        )
    )
    tail = F.when(F.col("row") == "accuracy", 1).when(F.col("row") == "macro avg", 2).otherwise(3)
    return per_class.withColumn("ord", F.lit(0)).unionByName(summary.withColumn("ord", tail.cast("int")))


# ---------------------------------------------------------------- multi-label


def per_label_counts(df: DataFrame, y_col: str, pred_col: str, with_rows: bool = False) -> DataFrame:
    """``pos, tp, fp, fn, support`` per label position of two equal-length 0/1 arrays.

    With ``with_rows`` the same pass also counts, on position 0, the rows and
    the rows whose whole arrays are equal (for subset accuracy).
    """
    same = (F.col(y_col).cast("array<int>") == F.col(pred_col).cast("array<int>")).cast("long")
    z = df.select(same.alias("_same"), F.posexplode(F.arrays_zip(F.col(y_col).alias("t"), F.col(pred_col).alias("p"))).alias("pos", "v"))
    t = F.col("v.t").cast("long")
    p = F.col("v.p").cast("long")
    aggs = [
        F.sum(t * p).alias("tp"),
        F.sum((F.lit(1) - t) * p).alias("fp"),
        F.sum(t * (F.lit(1) - p)).alias("fn"),
        F.sum(t).alias("support"),
    ]
    if with_rows:
        first = F.col("pos") == 0
        aggs += [F.sum(F.when(first, F.col("_same")).otherwise(0)).alias("_exact"),
                 F.sum(F.when(first, 1).otherwise(0)).alias("_rows")]
    return z.groupBy("pos").agg(*aggs)


def multilabel_summary(df: DataFrame, y_col: str, pred_col: str) -> DataFrame:
    """Micro and macro P/R/F1 over all label positions, plus subset accuracy — one pass over ``df``."""
    counts = with_scores(per_label_counts(df, y_col, pred_col, with_rows=True))
    return counts.agg(
        _ratio(F.sum("tp"), F.sum("tp") + F.sum("fp")).alias("micro_precision"),
        _ratio(F.sum("tp"), F.sum("tp") + F.sum("fn")).alias("micro_recall"),
        _f1(F.sum("tp"), F.sum("fp"), F.sum("fn")).alias("micro_f1"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        _ratio(F.sum("_exact"), F.sum("_rows")).alias("subset_acc"),
    )


def multilabel_metrics(df: DataFrame, y_col: str, prob_col: str, t: float = 0.5) -> DataFrame:
    """``micro_f1, macro_f1, micro_precision, micro_recall, subset_acc`` at ``prob >= t``."""
    pred = df.select(F.col(y_col).cast("array<int>").alias("_y"), threshold(prob_col, t).alias("_p"))
    s = multilabel_summary(pred, "_y", "_p")
    return s.select("micro_f1", "macro_f1", "micro_precision", "micro_recall", "subset_acc")


def fixed_class_report(df: DataFrame, gold_col: str, pred_col: str, classes: Sequence[str]):
    """Generated multi-label answers (already split into label arrays) against a fixed class list.

    Returns ``(summary, per_label)``; unknown predicted labels are ignored,
    zero-support classes count in macro averages; per-label rows are ordered
    by support desc then label.
    """
    classes = list(classes)
    ind = df.select(multi_hot(gold_col, classes).cast("array<int>").alias("_y"), multi_hot(pred_col, classes).cast("array<int>").alias("_p"))
    summary = multilabel_summary(ind, "_y", "_p")
    names = F.array(*[F.lit(c) for c in classes])
    per_label = (
        with_scores(per_label_counts(ind, "_y", "_p"))
        .select(F.element_at(names, F.col("pos") + 1).alias("label"), "precision", "recall", "f1", F.col("support").cast("long").alias("support"))
        .orderBy(F.desc("support"), F.asc("label"))
    )
    return summary, per_label


# ---------------------------------------------------------------- epochs


def best_epoch(history: DataFrame, metric: str, epoch_col: str = "epoch") -> DataFrame:
    """Epoch kept by ``if metric > best`` (start -1): the first epoch among the maxima."""
    return history.orderBy(F.desc(metric), F.asc(epoch_col)).limit(1).select(epoch_col, metric)


def improved_epochs(history: DataFrame, metric: str, epoch_col: str = "epoch") -> DataFrame:
    """Flag the epochs at which a checkpoint would be saved (strict improvement)."""
    before = Window.orderBy(epoch_col).rowsBetween(Window.unboundedPreceding, -1)
    best_so_far = F.coalesce(F.max(metric).over(before), F.lit(-1.0))
    return history.select(epoch_col, metric, (F.col(metric) > best_so_far).alias("improved"))
