"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
reread as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import language_id
from tagloom.llm.common import release_scratch, scratch_mark, table, text_key, without, written
from tagloom.llm.decontaminate import decontaminate
from tagloom.llm.ngram_join import jaccard_components
from tagloom.llm.packing import pack
from tagloom.llm.queries import tokenizer_path
from tagloom.llm.secret_scan import redact

#: Least posterior of the predicted language for a document to stay.
MIN_SCORE = 0.5
#: Prefix of the columns that a stage adds for itself: a document's own columns stay as they are, whatever their names.
OWN = "__pipeline_"


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; those without a letter, without text, of no clear language, or
    (if of ``language_id.MIN_GRAMS`` n-grams or more) unlike the texts of the language they come nearest to go.
    Without any labelled row nothing can be judged, and all stay."""
    labels, picked = language_id.fitting_rows(docs.where(language_id.fold(F.col("doc_id")) != 0))
    if not labels:
        return docs
    model = language_id.fit(labels, picked)
    least = language_id.least_logprob(picked, model)
    pred, score, like_it, grams = (F.col(OWN + c) for c in ("lang_pred", "score", "gram_logprob", "n_grams"))
    bound = F.coalesce(*[F.when(pred == k, F.lit(v)) for k, v in sorted(least.items())], F.lit(float("-inf")))
    like = (grams < language_id.MIN_GRAMS) | (like_it >= bound)
    rows = language_id.predict(docs, model, prefix=OWN)
    return rows.where((pred != language_id.UND) & (score >= MIN_SCORE) & like).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id (of equal ids, the
    smallest text hash; of equal rows, one), be there ids or not. Documents without words all stay."""
    found = written(jaccard_components(docs, with_root=True), "pipeline_components")
    full = found.where("n_shingles > 0")
    # nulls are no smallest id while another is there
    first = full.groupBy("_root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "_key")).alias("_f"))
    marked = full.join(first, "_root")
    rest = marked.where(~(F.col("doc_id").eqNullSafe(F.col("_f.doc_id")) & (F.col("_key") == F.col("_f._key"))))
    single = without(docs, rest)
    again = written(full.groupBy("doc_id", "_key").count().where("count > 1"), "pipeline_repeated")
    if again.isEmpty():
        return single
    kept = without(single, again)
    a = again.select(F.col("doc_id").alias("_d"), F.col("_key").alias("_k"))
    repeated = single.join(a, F.col("doc_id").eqNullSafe(F.col("_d")) & (text_key(F.col("text")) == F.col("_k")), "left_semi")
    return kept.unionByName(repeated.dropDuplicates(["doc_id", "text"]))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found.where("contaminated").select("doc_id", "_key"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are replaced in the text; all documents stay."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, packed."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again; what a stage wrote on its way goes when it is done."""
    docs = table(spark, sf_dir, "documents")
    mark = scratch_mark(spark)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
        release_scratch(spark, since=mark, keep=1)
    return docs


#: Training, tokenizing and packing are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None
