"""Text classifiers with Spark ML, in place of single-GPU fine-tuning.

Same job as the reference's training loop — text in, class (or label set)
out, pick the best candidate on validation by macro F1, score test once —
but the model is a distributed TF-IDF + logistic regression pipeline.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import gathered, stored
from .aggregate import mean_loss
from .metrics import classification_metrics, multilabel_metrics

TOKEN_GAPS = r"[^\p{L}\p{N}]+"


def feature_stages(text_col: str, num_features: int = 1 << 15):
    return [
        RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern=TOKEN_GAPS, gaps=True, toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="features"),
    ]


def _classifier(label_col: str, reg: float, max_iter: int) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol=label_col, family="multinomial", regParam=reg, maxIter=max_iter)


def train_single(train: DataFrame, text_col: str, label_col: str, reg: float = 0.0, max_iter: int = 30) -> PipelineModel:
    """Multinomial logistic regression on TF-IDF; ``label_col`` holds integer class ids."""
    stages = feature_stages(text_col) + [_classifier(label_col, reg, max_iter)]
    return Pipeline(stages=stages).fit(train.withColumn(label_col, F.col(label_col).cast("double")))


def predict_single(model, df: DataFrame, pred_col: str = "pred") -> DataFrame:
    out = model.transform(df)
    return out.withColumn(pred_col, F.col("prediction").cast("int")).drop("_tok", "_tf", "features", "rawPrediction", "probability", "prediction")


def evaluate_single(model, df: DataFrame, label_col: str) -> dict:
    """Macro metrics and mean cross-entropy ``-log p(y)`` of one split (predictions scored once)."""
    out = model.transform(df).select(
        F.col(label_col).cast("int").alias("_y"),
        F.col("prediction").cast("int").alias("_p"),
        (-F.log(F.greatest(F.element_at(vector_to_array("probability"), F.col(label_col).cast("int") + 1), F.lit(1e-15)))).alias("_loss"),
    ).cache()
    m = classification_metrics(out, "_y", "_p").first().asDict()
    m["loss"] = mean_loss(out, "_loss").first()["loss"]
    out.unpersist()
    return m


def select_and_test(train: DataFrame, val: DataFrame, test: DataFrame, text_col: str, label_col: str,
                    regs: Sequence[float] = (0.0, 0.01, 0.1), max_iter: int = 30) -> tuple[PipelineModel, DataFrame]:
    """Fit each candidate, keep the first with the strictly best validation macro F1, score test once.

    Features are fitted once on train and the three transformed splits are
    stored, so candidates differ only in the classifier fit (which caches its own blocks of them). Returns the
    chosen pipeline and ``candidate, reg, split, accuracy, precision, recall, f1, loss, chosen``.
    """
    y = F.col(label_col).cast("double")
    feats = Pipeline(stages=feature_stages(text_col)).fit(train)
    tr, va, te = (gathered(stored(feats.transform(d.withColumn(label_col, y)).select(label_col, "features"), f"features_{s}"))
                  for s, d in (("train", train), ("val", val), ("test", test)))
    best, best_f1, best_i, rows = None, -1.0, 0, []
    for i, reg in enumerate(regs):
        clf = _classifier(label_col, reg, max_iter).fit(tr)
        m = evaluate_single(clf, va, label_col)
        rows.append((i, float(reg), "val", m["accuracy"], m["precision"], m["recall"], m["f1"], m["loss"]))
        if m["f1"] > best_f1:  # strict: ties keep the earlier candidate
            best, best_f1, best_i = clf, m["f1"], i
    t = evaluate_single(best, te, label_col)
    rows.append((best_i, float(regs[best_i]), "test", t["accuracy"], t["precision"], t["recall"], t["f1"], t["loss"]))
    spark = train.sparkSession
    table = spark.createDataFrame(
        rows, "candidate int, reg double, split string, accuracy double, precision double, recall double, f1 double, loss double")
    model = PipelineModel(stages=feats.stages + [best])
    return model, table.withColumn("chosen", F.col("candidate") == F.lit(best_i))


def _fit_heads(feats: DataFrame, targets, names: Sequence[str], reg: float, max_iter: int) -> list:
    heads = []
    for name, y in zip(names, targets):
        lr = LogisticRegression(featuresCol="features", labelCol="_y", family="binomial", regParam=reg, maxIter=max_iter,
                                probabilityCol=f"_p_{name}", rawPredictionCol=f"_raw_{name}", predictionCol=f"_pred_{name}")
        heads.append(lr.fit(feats.select("features", y.cast("double").alias("_y"))))
    return heads


def predict_multi_heads(heads, df: DataFrame, names: Sequence[str], prob_col: str = "prob") -> DataFrame:
    """``df`` (with ``features``) and the probability of every label; the columns between are dropped head by head."""
    for name, h in zip(names, heads):
        df = h.transform(df).withColumn(f"_p_{name}", vector_to_array(f"_p_{name}")[1]).drop(f"_raw_{name}", f"_pred_{name}")
    return df.withColumn(prob_col, F.array(*[F.col(f"_p_{name}") for name in names])).drop(*[f"_p_{name}" for name in names])


def evaluate_heads(heads, df: DataFrame, y_col: str, names: Sequence[str], t: float = 0.5) -> dict:
    """Multi-label metrics and mean binary cross-entropy of one split (scored once)."""
    scored = predict_multi_heads(heads, df, names, "_prob")
    p = F.transform("_prob", lambda x: F.least(F.greatest(x, F.lit(1e-15)), F.lit(1 - 1e-15)))
    terms = F.zip_with(p, F.col(y_col).cast("array<double>"), lambda x, y: -(y * F.log(x) + (1 - y) * F.log(1 - x)))
    loss = F.aggregate(terms, F.lit(0.0), lambda a, v: a + v) / F.size(y_col)
    scored = scored.select(y_col, "_prob", loss.alias("_loss")).cache()
    m = multilabel_metrics(scored, y_col, "_prob", t).first().asDict()
    m["loss"] = mean_loss(scored, "_loss").first()["loss"]
    scored.unpersist()
    return m


MULTI_COLS = ("micro_f1", "macro_f1", "micro_precision", "micro_recall", "subset_acc", "loss")


def select_and_test_multi(train: DataFrame, val: DataFrame, test: DataFrame, text_col: str, y_col: str, n_labels: int,
                          regs: Sequence[float] = (0.0, 0.01, 0.1), max_iter: int = 30) -> tuple[PipelineModel, DataFrame]:
    """As :func:`select_and_test`, for a multi-hot ``y_col`` of ``n_labels`` places: one head per place,
    the candidate with the best validation macro F1 is scored on test once.

    Returns the chosen pipeline (features, then heads whose probability columns are ``_p_0``, ``_p_1``, ...) and
    ``candidate, reg, split``, the multi-label metrics, ``loss`` and ``chosen``.
    """
    names = [str(i) for i in range(n_labels)]
    targets = [F.element_at(y_col, i + 1) for i in range(n_labels)]
    feats = Pipeline(stages=feature_stages(text_col)).fit(train)
    tr, va, te = (feats.transform(d).select("features", y_col).cache() for d in (train, val, test))
    best, best_f1, best_i, rows = None, -1.0, 0, []
    for i, reg in enumerate(regs):
        heads = _fit_heads(tr, targets, names, reg, max_iter)
        m = evaluate_heads(heads, va, y_col, names)
        rows.append((i, float(reg), "val", *[m[c] for c in MULTI_COLS]))
        if m["macro_f1"] is not None and m["macro_f1"] > best_f1:  # strict: ties keep the earlier candidate
            best, best_f1, best_i = heads, m["macro_f1"], i
    if best is None:
        raise ValueError("no candidate could be scored: is the validation split empty?")
    m = evaluate_heads(best, te, y_col, names)
    rows.append((best_i, float(regs[best_i]), "test", *[m[c] for c in MULTI_COLS]))
    for d in (tr, va, te):
        d.unpersist()
    table = train.sparkSession.createDataFrame(
        rows, "candidate int, reg double, split string, " + ", ".join(f"{c} double" for c in MULTI_COLS))
    return PipelineModel(stages=feats.stages + best), table.withColumn("chosen", F.col("candidate") == F.lit(best_i))


def save_model(model: PipelineModel, metadata: DataFrame, path: str) -> None:
    """Model and its label metadata side by side: the id order used in training travels with it."""
    model.write().overwrite().save(f"{path}/model")
    metadata.write.mode("overwrite").json(f"{path}/labels")


def load_model(spark, path: str) -> tuple[PipelineModel, DataFrame]:
    from ..sources.tables import load_label_metadata

    return PipelineModel.load(f"{path}/model"), load_label_metadata(spark, f"{path}/labels")


def train_multi(train: DataFrame, text_col: str, label_cols: Sequence[str], reg: float = 0.0, max_iter: int = 30):
    """Binary relevance: one logistic regression per label on shared (cached) TF-IDF features.

    BCE over L sigmoids is L independent logistic losses, so this trains the
    same objective as a shared multi-label head without the shared encoder.
    """
    feats_model = Pipeline(stages=feature_stages(text_col)).fit(train)
    feats = feats_model.transform(train).select("features", *label_cols).cache()
    heads = _fit_heads(feats, [F.col(lab) for lab in label_cols], label_cols, reg, max_iter)
    feats.unpersist()
    return feats_model, heads


def predict_multi(feats_model, heads, df: DataFrame, label_cols: Sequence[str], prob_col: str = "prob") -> DataFrame:
    return predict_multi_heads(heads, feats_model.transform(df), label_cols, prob_col).select(*df.columns, prob_col)


def evaluate_multi(pred: DataFrame, label_cols: Sequence[str], prob_col: str = "prob", t: float = 0.5) -> DataFrame:
    y = F.array(*[F.col(c).cast("int") for c in label_cols])
    return multilabel_metrics(pred.withColumn("_y", y), "_y", prob_col, t)
