"""Nothing is lost or refused for its size: rare tokens are spelled, label tables may be long."""

import pyarrow as pa
from pyspark.sql import functions as F

from tagloom.operators import encode as EN
from tagloom.operators import joins as J
from tagloom.operators import vocab as V


def test_encode_lists_is_reversible():
    arr = pa.array([["a", "zz", "日本", "a"], [], None, ["x😀"]], pa.list_(pa.string()))
    ids = EN.encode_lists(arr, pa.array(["a", "b"]), EN.np.array([4, 5], dtype="int32"))
    assert ids.to_pylist()[0][:2] == [4, EN.UNK_ID] and ids.to_pylist()[1:3] == [[], None]
    assert EN.decode_lists(ids, ["a", "b"], True).to_pylist() == arr.to_pylist()
    assert EN.decode_lists(ids.slice(3), ["a", "b"], True).to_pylist() == [["x😀"]]


def test_long_label_table(spark):
    labels = spark.range(200_000).select(F.concat(F.lit("l"), "id").alias("label"))
    vocab = V.dense_ids(labels)
    out = J.encode_label_id(labels, vocab, "label")
    assert out.count() == 200_000 and out.agg(F.countDistinct("label_id")).first()[0] == 200_000


def test_long_class_list_is_one_constant(spark):
    from tagloom.functions.arrays import multi_hot

    classes = ["", "x", "a.b|c", *[f"l{i}" for i in range(8000)]]
    df = spark.createDataFrame([(["l7999", "", "l7999", "other"],), (["x", "a.b|c"],), (None,)], "labels array<string>")
    out = df.select(multi_hot("labels", classes).alias("y"))
    assert [[i for i, v in enumerate(r.y) if v] for r in out.collect()] == [[0, 8002], [1, 2], []]
    assert all(len(r.y) == len(classes) for r in out.collect())
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("array(") == 0 and "split(" in plan
    assert "split(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert df.select(multi_hot("labels", []).alias("y")).first().y == []
