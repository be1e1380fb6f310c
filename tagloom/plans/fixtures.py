"""Input shapes of the reference (metadata table, web table, generated
answers, score arrays, epoch history) derived by Spark from the given tables,
so every job's work grows with them. The DuckDB oracle builds the same rows
with the same rules (see ``plans.oracle``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_parquet_table

U3000 = "　"


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def fx_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata table ``(doc_id, src, scene, tags)``: null and repeated keys, null/blank
    text, every label separator, and an ASCII comma that must not split."""
    d = read_parquet_table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    src = F.when(i % 97 == 0, F.lit(None)).otherwise(F.concat(F.lit("u"), _s(F.expr("doc_id div 3"))))
    scene = (
        F.when(i % 53 == 0, F.lit(None))
        .when(i % 59 == 0, F.lit(" " + U3000))
        .otherwise(F.concat(F.lit(" "), F.col("text"), F.lit(U3000)))
    )
    lead = F.when(i % 5 == 1, F.lit("、")).when(i % 5 == 2, F.lit(" ")).otherwise(F.lit(""))
    sep = (
        F.when(i % 6 == 0, F.lit("、")).when(i % 6 == 1, F.lit("，")).when(i % 6 == 2, F.lit(";"))
        .when(i % 6 == 3, F.lit("/")).when(i % 6 == 4, F.lit(U3000)).otherwise(F.lit(","))
    )
    tags = (
        F.when(i % 61 == 1, F.lit(None))
        .when(i % 67 == 1, F.lit(" 、 "))
        .otherwise(F.concat(lead, F.col("lang"), sep, F.col("source")))
    )
    return d.select("doc_id", src.cast("string").alias("src"), scene.cast("string").alias("scene"), tags.cast("string").alias("tags"))


def fx_web(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web table ``(page_id, url, content)``: null and repeated keys, null and blank content."""
    p = read_parquet_table(spark, sf_dir, "pages")
    i = F.col("page_id")
    url = F.when(i % 41 == 0, F.lit(None)).otherwise(F.concat(F.lit("u"), _s(F.expr("page_id div 2"))))
    content = F.when(i % 37 == 1, F.lit(None)).when(i % 43 == 1, F.lit(U3000 + " ")).otherwise(F.col("html"))
    return p.select("page_id", url.cast("string").alias("url"), content.cast("string").alias("content"))


def fx_resp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold and generated single labels ``(vec_id, gold, resp)``."""
    e = read_parquet_table(spark, sf_dir, "embeddings")
    i, lab = F.col("vec_id"), F.col("label")
    gold = F.concat(F.lit("s"), _s(lab % 7))
    resp = F.when(i % 9 == 0, F.lit("other")).otherwise(
        F.concat(F.when(i % 2 == 0, F.lit("\n")).otherwise(F.lit("")), F.lit("s"), _s((lab + i % 3) % 7))
    )
    return e.select("vec_id", gold.alias("gold"), resp.alias("resp"))


def fx_resp_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold and generated label lists ``(vec_id, gold, resp)`` over classes s0..s6."""
    e = read_parquet_table(spark, sf_dir, "embeddings")
    i, lab = F.col("vec_id"), F.col("label")
    gold = F.when(lab == 9, F.lit("无")).otherwise(
        F.concat(F.lit("s"), _s(lab % 7), F.lit(","), F.lit("s"), _s((lab + i) % 7))
    )
    resp = (
        F.when(i % 11 == 0, F.lit(" 无 "))
        .when(i % 13 == 0, F.lit(""))
        .otherwise(
            F.concat(
                F.lit("s"), _s((lab + i % 2) % 7),
                F.when(i % 2 == 0, F.lit("、 ")).otherwise(F.lit(", ")),
                F.when(i % 5 == 0, F.lit("other")).otherwise(F.concat(F.lit("s"), _s((lab + i) % 7))),
            )
        )
    )
    return e.select("vec_id", gold.alias("gold"), resp.alias("resp"))


FX_MULTI_CLASSES = ["s0", "s1", "s2", "s3", "s4", "s5", "s6"]


def fx_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch history ``(epoch, macro_f1)`` with tied metrics."""
    ev = read_parquet_table(spark, sf_dir, "events")
    return ev.groupBy((F.col("user_id") % 20 + 1).alias("epoch")).agg(
        F.round(F.avg("value") / 10, 0).alias("macro_f1")
    )


def fx_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores ``(vec_id, y, z, y_multi)``: the whole vector as logits, a class id, and a 0/1 truth as wide
    (``z_i >= 0``, flipped where ``(vec_id * 7 + i) % 31 == 0``)."""
    e = read_parquet_table(spark, sf_dir, "embeddings")
    z = F.col("embedding").cast("array<double>")
    base = e.select("vec_id", F.col("label").alias("y"), z.alias("z"))
    flip = lambda x, i: F.when((F.col("vec_id") * 7 + i) % 31 == 0, F.lit(1) - (x >= 0).cast("int")).otherwise((x >= 0).cast("int"))
    return base.withColumn("y_multi", F.transform("z", flip))
