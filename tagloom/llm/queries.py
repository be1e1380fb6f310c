"""The registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import language_id
from tagloom.llm.chat_perspective import rotate_perspectives
from tagloom.llm.common import scratch_folder, table
from tagloom.llm.conversation_repair import damaged, repair_conversations, repair_report
from tagloom.llm.decontaminate import decontaminate
from tagloom.llm.lexical_search import lexical_search
from tagloom.llm.license_scan import license_scan
from tagloom.llm.ngram_join import jaccard_components
from tagloom.llm.packing import pack
from tagloom.llm.pii import pii
from tagloom.llm.quality_rules import quality_rules
from tagloom.llm.secret_scan import secret_scan
from tagloom.llm.url_filter import url_filter
from tagloom.llm.warc import read_warc, write_warc


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = language_id.fold(F.col("doc_id"))
    model = language_id.train(docs.where(fold != 0))
    rows = docs.select("doc_id", "text", F.coalesce(fold == 0, F.lit(False)).alias("held_out"))
    return language_id.predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def listed_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of this query: urls of pages made from documents that are labelled toxic."""
    pages = table(spark, sf_dir, "pages")
    number = F.regexp_extract("url", r"://[^/?#]*/[a-z]+/([0-9]{1,18})", 1)
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    return pages.select("url", number.cast("long").alias("doc_id")).join(toxic, "doc_id").select("url")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, listed_urls(spark, sf_dir)).select("page_id", "host", "path", "rule", "verdict", "canonical_url", "listed")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("_key")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_key")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    back = read_warc(spark, path)
    revisit = F.col("record_type") == "revisit"  # its header declares the payload that it leaves out
    return back.select(
        "page_id", F.when(revisit, F.col("declared_bytes")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.col("declared_digest")).otherwise(F.sha2("payload", 256)).alias("payload_digest"), "record_type",
        F.col("refers_to_page").alias("refers_to"), "error")


def op8_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate_perspectives(table(spark, sf_dir, "conversations"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules(table(spark, sf_dir, "documents"))
    return rows.withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair_report(rows, repair_conversations(damaged(rows)))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_language_id, op3_best_fit_packing, op4_url_filter, op5_ngram_jaccard, op6_decontaminate, op7_warc,
    op8_perspective_rotation, op9_quality_rules, op10_secret_scan,
    op11_lexical_search, op12_pii, op13_conversation_repair)}
