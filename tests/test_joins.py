from pyspark.sql import functions as F

from tagloom.operators.aggregate import dedupe_first
from tagloom.operators.joins import left_join_content, merge_content, pair_text_label


def test_left_join_null_keys_and_fan_out(spark):
    left = spark.createDataFrame([(1, None), (2, "u")], "id int, src string")
    right = spark.createDataFrame([(10, None, "n"), (11, "u", "a"), (12, "u", "b")], "pid int, url string, content string")
    rows = sorted((r.id, r.pid) for r in left_join_content(left, right, "src", "url").collect())
    assert rows == [(1, 10), (2, 11), (2, 12)]


def test_merge_becomes_inner_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id int, src string")
    right = spark.createDataFrame([(10, "a", "x")], "pid int, url string, content string")
    df = merge_content(left, right, "src", "url", "content")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Inner" in plan and "LeftOuter" not in plan
    assert df.count() == 1


def test_dedupe_keeps_first_and_one_null(spark):
    df = spark.createDataFrame([(3, "a", "z"), (1, "a", "y"), (5, None, "p"), (4, None, "q")], "id int, k string, v string")
    rows = sorted(dedupe_first(df, "k", "id").collect(), key=lambda r: r.id)
    assert [(r.id, r.k, r.v) for r in rows] == [(1, "a", "y"), (4, None, "q")]


def test_pair_raises_on_missing_side(spark):
    import pytest

    text = spark.createDataFrame([(1, "t")], "row_id int, text string")
    y = spark.createDataFrame([(1, 0), (2, 1)], "row_id int, y int")
    with pytest.raises(Exception):
        pair_text_label(text, y).collect()
    assert pair_text_label(text, y.where(F.col("row_id") == 1)).count() == 1


def merged_by_duckdb(sf):
    import duckdb

    from tagloom.plans.oracle import SQL

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return len(con.execute(SQL["prepare_long"]).fetchall())


def test_prepare_long_observes_stage_counts(spark):
    from tagloom.plans import fixtures as FX
    from tagloom.plans.prepare import prepare_long

    sf = "/root/testdata/sf0.01"
    meta, web = FX.fx_meta(spark, sf), FX.fx_web(spark, sf)
    p = prepare_long(meta, web, observe=True)
    n = p.data.count()
    counts = p.counts()
    assert counts["merged_rows"] == n == merged_by_duckdb(sf)
    assert counts["meta_rows"] == meta.count()
    assert counts["deduped_rows"] == meta.select("src").distinct().count()
