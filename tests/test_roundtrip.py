from tagloom.session import scratch_path
from tagloom.sources import tables as S

EDGE = [(1, 'line1\nline2 "quoted", comma'), (2, "  leading and trailing  "), (3, ""), (4, None), (5, "﻿bom-ish 文本")]


def test_csv_round_trip(spark):
    df = spark.createDataFrame(EDGE, "id int, text string")
    path = scratch_path(spark, "rt_csv")
    S.write_csv(df, path)
    back = {r.id: r.text for r in S.read_csv(spark, path, "id int, text string").collect()}
    # like pandas, an empty cell reads back as null; everything else survives exactly
    assert back == {i: (None if t == "" else t) for i, t in EDGE}


def test_jsonl_round_trip_keeps_nulls(spark):
    df = spark.createDataFrame(EDGE, "id int, text string")
    path = scratch_path(spark, "rt_json")
    S.write_jsonl(df, path)
    raw = spark.read.text(path).collect()
    assert any('"text":null' in r.value for r in raw)
    back = S.read_jsonl(spark, path, "id int, text string")
    assert sorted(back.collect()) == sorted(df.collect())


def test_csv_with_bom_header(spark, tmp_path):
    p = tmp_path / "bom.csv"
    p.write_bytes("﻿content,label\n\"a\nb\",x\n".encode("utf-8"))
    back = S.read_csv(spark, str(p))
    assert back.columns == ["content", "label"]
    assert back.collect()[0].content == "a\nb"


def test_save_short_artifacts_and_release(spark):
    from tagloom.plans import fixtures as FX
    from tagloom.plans import prepare as P

    cached_before = spark.sparkContext._jsc.getPersistentRDDs().size()
    p = P.prepare_short(FX.fx_meta(spark, "/root/testdata/sf0.001"))
    expected = {r.row_id: r.split for r in p.data.select("row_id", "split").collect()}
    out = scratch_path(spark, "short")
    P.save_short(p, out)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= cached_before  # nothing left behind
    back = S.load_split(spark, f"{out}/splits_text", f"{out}/encoded", "train", "row_id bigint, scene string, split string")
    assert {r.row_id for r in back.collect()} == {i for i, s in expected.items() if s == "train"}
    meta = S.load_label_metadata(spark, f"{out}/labels").first()
    assert meta.num_labels == len(meta.labels) and meta.id2lab["0"] == meta.labels[0]


def test_prepare_short_observes_stage_counts(spark):
    from tagloom.plans import fixtures as FX
    from tagloom.plans import prepare as P

    meta = FX.fx_meta(spark, "/root/testdata/sf0.01")
    p = P.prepare_short(meta, observe=True)
    n = p.data.count()
    c = p.counts()
    assert c["meta_rows"] == 1000 and c["clean_rows"] == n == 948
    p.release()
