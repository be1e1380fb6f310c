from collections import Counter

from pyspark.sql import functions as F

from tagloom.operators import train as TR
from tagloom.operators import vocab as V
from tagloom.operators.joins import encode_label_id
from tagloom.operators.metrics import classification_metrics
from tagloom.operators.split import split_random
from tagloom.session import scratch_path


def test_text_classifier_beats_majority_and_reloads(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("doc_id").alias("row_id"), "text", "lang")
    vocab = V.dense_ids(docs.select(F.col("lang").alias("label")))
    d = split_random(encode_label_id(docs, vocab, "lang", "y"), "row_id", 0.2, 0.0, 42).cache()
    train, test = d.where("split = 'train'"), d.where("split = 'test'")
    model = TR.train_single(train, "text", "y")
    pred = TR.predict_single(model, test)
    acc = classification_metrics(pred, "y", "pred").first().accuracy
    ys = [r.y for r in test.collect()]
    majority = Counter(ys).most_common(1)[0][1] / len(ys)
    assert acc > majority + 0.15
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    again = TR.predict_single(TR.PipelineModel.load(path), test)
    a = {r.row_id: r.pred for r in pred.collect()}
    b = {r.row_id: r.pred for r in again.collect()}
    assert a == b
