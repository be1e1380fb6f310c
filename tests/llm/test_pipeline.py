"""The pipeline's stages against plain Python, and the queries against DuckDB."""

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tagloom.llm.common import release_scratch, table, written
from tagloom.llm.oracle import SQL
from tagloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "secrets", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = written(stage(spark, docs, SF), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = {r.doc_id: r for r in docs.collect()}
        texts = [(r.doc_id, r.text) for r in before]
        if name == "language_id":
            assert set(after) >= {d for d, t in texts if sum(map(str.isalpha, t)) > 50}
        elif name == "near_duplicates":
            assert set(after) == {d for d, n, c in brute.jaccard(texts) if n == 0 or d == c}
        elif name == "decontamination":
            assert set(after) == {r[0] for r in brute.decontaminated(texts, items) if not r[5]}
        else:
            assert set(after) == {d for d, _ in texts}
            for r in before:
                if brute.base_spans(r.text)[:3] == (0, 0, 0):
                    assert after[r.doc_id].text == r.text
                assert after[r.doc_id].n_chars == len(after[r.doc_id].text)
            assert any("<secret>" in r.text for r in after.values()) == any(sum(brute.base_spans(t)[:3]) for _, t in texts)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    release_scratch(spark)


def test_language_stage_drops_what_is_in_no_learned_language(spark):
    import random

    rng = random.Random(1)
    docs = table(spark, SF, "documents")
    clean = docs.where("lang = 'de' and length(text) > 2000").first().text
    gibberish = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(120))
    foreign = ["Это простой русский текст о том, как дети играют в саду, а вечером все вместе идут домой и читают книги. " * 3,
               "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
               "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待", gibberish, "".join(rng.choices("0123456789abcdef", k=800))]
    kept = [clean[:1000], clean[:25], "The children play in the garden and in the evening they all go home together and read books about the sea."]
    rows = [(9000 + k, t, None, "s", len(t)) for k, t in enumerate(foreign + kept)]
    more = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    before = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, SF).collect()}
    after = {r.doc_id for r in corpus_pipeline.language_stage(spark, more, SF).collect()}
    assert after == before | {9000 + len(foreign) + k for k in range(len(kept))}


def test_near_duplicates_keep_one_of_repeated_rows(spark):
    rows = [(1, "a b c d e f g", "en"), (1, "a b c d e f g", "en"), (2, "A b c d e f g", "en"), (3, "other words stand here now and then", "en"), (4, None, "en"),
            (4, None, "en"), (None, "a b c d e f g", "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()), key=str)
    assert out == sorted([(1, "a b c d e f g"), (3, rows[3][1]), (4, None), (4, None)], key=str)


def test_near_duplicates_without_ids_keep_one(spark):
    words = [f"word{i}" for i in range(60)]
    texts = [" ".join(words), " ".join(words[:59]), " ".join(words).upper(), "other words stand here now and then", "Other words stand here now and then"]
    rows = [(None, t) for t in texts] + [(None, texts[3]), (7, "a third text of its own with some words")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = sorted(r.text.lower() for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect())
    assert len(out) == 3 and out[0] == rows[-1][1] and out[1] == texts[3] and out[2] in {t.lower() for t in texts[:3]}


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    res = con.execute(SQL[name])
    cols = [d[0] for d in res.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)

    def norm(rows):
        return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=str)

    assert norm(tuple(r) for r in df.select(*cols).collect()) == norm(res.fetchall())
    release_scratch(spark)


def test_language_stage_keeps_columns_named_like_its_own(spark):
    docs = table(spark, SF, "documents")
    more = docs.withColumn("score", F.col("doc_id") * 3).withColumn("lang_pred", F.lit("mine"))
    out = corpus_pipeline.language_stage(spark, more, SF)
    assert out.columns == more.columns and out.count() > 0
    assert out.where("score <> doc_id * 3 OR lang_pred <> 'mine'").count() == 0


def test_run_leaves_only_its_result_behind(spark):
    from tagloom.llm.common import scratch_mark

    mark = scratch_mark(spark)
    out = corpus_pipeline.run(spark, SF)
    assert scratch_mark(spark) == mark + 1 and out.count() > 0


def test_language_stage_learns_from_every_labelled_row(spark):
    """Far more rows of one label than any sample would hold: the n-grams of every one of them count."""
    from tagloom.llm import language_id

    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.concat(F.lit("plain words stand here "), F.conv(F.col("id").cast("string"), 10, 36)).alias("text"),
                                    F.when(F.col("id") < 8900, "en").otherwise("de").alias("lang"))
    labels, picked = language_id.fitting_rows(docs)
    assert labels == ["de", "en"] and picked.count() == 9000
    assert language_id.fitting_rows(docs, 4000)[1].count() < 9000
    seen = []
    fit = language_id.fit
    docs = docs.withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text"))
    try:
        language_id.fit = lambda labels, picked, *a: seen.append(picked.count()) or fit(labels, picked, *a)
        corpus_pipeline.language_stage(spark, docs, SF)
    finally:
        language_id.fit = fit
    assert seen == [docs.where(language_id.fold(F.col("doc_id")) != 0).count()]
