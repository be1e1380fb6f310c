import pytest
from pyspark.sql import functions as F

from tagloom.functions import text as T
from tagloom.operators.clean import normalize_headers


def _one(spark, expr, value):
    df = spark.createDataFrame([(value,)], "c string")
    return df.select(expr(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "cell, expected",
    [
        ("事故处理、停车管控", ["事故处理", "停车管控"]),
        ("A ，B", ["A", "B"]),
        ("A;B/C", ["A", "B", "C"]),
        ("A　B", ["A", "B"]),
        ("A,B", ["A,B"]),
        ("A；B", ["A；B"]),
        ("、A、", ["A"]),
        (" ", []),
        (None, []),
        ("A、A", ["A", "A"]),
        (" x\x1cy\x85z", ["x", "y", "z"]),
    ],
)
def test_parse_labels(spark, cell, expected):
    assert _one(spark, T.parse_labels, cell) == expected


@pytest.mark.parametrize(
    "cell, expected",
    [("A、 B", ["A", "B"]), ("A,,B", ["A", "B"]), (" 无 ", []), ("A;B", ["A;B"]), ("", []), (None, []), ("无", [])],
)
def test_split_predicted_labels(spark, cell, expected):
    assert _one(spark, T.split_predicted_labels, cell) == expected


def test_strip_every_python_space(spark):
    spaces = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
    assert _one(spark, T.strip_text, spaces + "x y" + spaces) == "x y"
    for ch in "\t\n\xa0　\x1c ":
        assert _one(spark, T.strip_text, ch + "x" + ch) == "x"
    assert _one(spark, T.strip_text, "​x") == "​x"  # zero-width space is not a space in Python


def test_first_label_and_separator(spark):
    assert _one(spark, T.first_label, "a、b、c") == "a"
    assert _one(spark, T.first_label, "、b") == ""
    assert _one(spark, T.first_label, None) is None
    assert _one(spark, T.canonical_separator, "a、b") == "a,b"
    assert _one(spark, T.clean_response, "\na\nb ") == "ab "


def test_normalize_headers(spark):
    df = spark.createDataFrame([(1, 2)], ["  场景归类 \n(可多选) ", "x"])
    assert normalize_headers(df).columns == ["场景归类", "x"]
    with pytest.raises(ValueError):
        normalize_headers(spark.createDataFrame([(1, 2)], ["a\n1", "a\n2"]))


def test_require_and_find_columns(spark):
    from tagloom.operators.clean import find_column, require_columns

    df = spark.createDataFrame([(1, 2, 3)], ["场景归类A", "场景归类B", "x"])
    assert find_column(df, "场景归类") == "场景归类A"  # first in column order
    with pytest.raises(ValueError):
        find_column(df, "missing")
    with pytest.raises(ValueError):
        require_columns(df, ["x", "来源"])
    assert require_columns(df, ["x"]) is df
