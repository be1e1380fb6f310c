"""Benchmark decontamination with a distributed positional inverted index.

Native: DataFrame functions only.

1. Benchmark items become windows of ``size`` words (one, if an item is shorter); equal windows
   are one phrase.
2. How many documents hold each benchmark word is counted over all documents.
3. A phrase's ``rarest`` words, by that count, are its index terms. Postings (term, document,
   position) of these terms are taken from every document and written, one row each, beside
   one row per document with its number of words.
4. Per phrase the lists of its terms, each shifted by the term's offset, are intersected: a
   start held by all of them is a candidate. Candidates are few; their documents alone are
   read again, and the phrase's words are compared in place.

``proximity`` gives from the same postings the places where the terms stand near, but not at,
their distances.

Null and empty texts have no words; items without an id or without words have no windows. Repeated rows each give a
row (documents are known by id and hash of the text, so rows that share an id alone keep their own counts). Ties: of
equally rare words the smallest, then the first, is the index term. Very long texts are read whole. Without documents there are no rows,
without items no hits. Extra columns are not carried, whatever their names. The benchmark is joined by Spark's choice
of join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import small, text_key, word_array, written

SIZE = 13


def phrases(benchmark: DataFrame, size: int = SIZE, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(phrase, words, items): distinct windows with the ids of the items that hold them."""
    w = F.col("_w")
    last = F.greatest(F.size(w) - size, F.lit(0))
    cut = (benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), word_array(F.col(text_col)).alias("_w"))
           .where(F.size("_w") > 0)
           .select("item", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(w, i + 1, F.lit(size)))).alias("words")))
    return (cut.groupBy("words").agg(F.collect_set("item").alias("items"))
            .select(F.sha2(F.array_join("words", " "), 256).alias("phrase"), "words", "items"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)), word_array(F.col(text_col)).alias("_w"))


def index_terms(docs: DataFrame, windows: DataFrame, rarest: int, text_col: str) -> DataFrame:
    """(phrase, term, offset, lists): each phrase's rarest places, by document frequency. A phrase
    with a word that no document holds is left out, as it occurs nowhere."""
    places = windows.select("phrase", F.posexplode("words").alias("offset", "term"))
    terms = places.select("term").distinct()
    seen = docs.select(F.explode(F.array_distinct(word_array(F.col(text_col)))).alias("term"))
    df = written(seen.join(terms, "term").groupBy("term").agg(F.count(F.lit(1)).alias("df")), "decontamination_terms")
    known = places.join(df, "term", "left")
    w = Window.partitionBy("phrase")
    return (known.withColumn("_least", F.min(F.coalesce("df", F.lit(0))).over(w)).where("_least > 0")
            .withColumn("_r", F.row_number().over(w.orderBy("df", "term", "offset"))).where(F.col("_r") <= rarest)
            .withColumn("lists", F.count(F.lit(1)).over(w)).select("phrase", "term", "offset", "lists"))


def postings(docs: DataFrame, terms: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, _key, _row, term, position) of the given terms in all documents; a row with the empty
    term after the last word holds each document's number of words as its position."""
    rows = _keyed(docs, id_col, text_col).withColumn("_row", F.monotonically_increasing_id())
    words = rows.select("doc_id", "_key", "_row", F.posexplode(F.concat("_w", F.array(F.lit("")))).alias("position", "term"))
    wanted = terms.select("term").distinct().withColumn("_in", F.lit(True))
    return words.join(wanted, "term", "left").where(F.col("_in") | (F.col("term") == "")).select(
        "doc_id", "_key", "_row", "term", "position")


def candidates(index: DataFrame, terms: DataFrame) -> DataFrame:
    """Starts that every list of a phrase holds, once its offset is taken off."""
    shifted = index.join(terms, "term").withColumn("start", F.col("position") - F.col("offset")).where("start >= 0")
    return (shifted.groupBy("_row", "doc_id", "_key", "phrase", "start", "lists")
            .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == F.col("lists"))
            .groupBy("doc_id", "_key", "phrase", "start").agg(F.lit(1).alias("_one")).drop("_one"))


def proximity(index: DataFrame, terms: DataFrame, slop: int = 3) -> DataFrame:
    """(doc_id, _key, phrase, start): two index terms of a phrase whose shifted starts differ by 1 to ``slop``."""
    shifted = index.join(terms.where("lists > 1"), "term").select(
        "_row", "doc_id", "_key", "phrase", "offset", (F.col("position") - F.col("offset")).alias("start"))
    w = Window.partitionBy("_row", "phrase").orderBy("start").rangeBetween(1, slop)
    near = shifted.withColumn("_others", F.max("offset").over(w)).withColumn("_least", F.min("offset").over(w))
    return near.where((F.col("_others") != F.col("offset")) | (F.col("_least") != F.col("offset"))).where(
        F.col("_others").isNotNull()).select("doc_id", "_key", "phrase", "start").distinct()


def exact_matches(docs: DataFrame, found: DataFrame, windows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, _key, phrase, start, length, items) where a candidate's document has the very words."""
    per_doc = written(found.groupBy(F.col("doc_id").alias("_d"), F.col("_key").alias("_k")).agg(
        F.collect_list(F.struct("phrase", "start")).alias("_c")), "decontamination_per_document")
    per_doc = small(per_doc, entries="_c")
    rows = docs.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t"))
    few = rows.join(per_doc, F.col("_i").eqNullSafe(F.col("_d")) & (text_key(F.col("_t")) == F.col("_k")))
    words = few.select(F.col("_d").alias("doc_id"), F.col("_k").alias("_key"), "_c", word_array(F.col("_t")).alias("_w"))
    taken = F.transform("_c", lambda c: F.struct(
        c["phrase"].alias("phrase"), c["start"].alias("start"),
        F.slice(F.col("_w"), (c["start"] + 1).cast("int"), F.lit(SIZE)).alias("have")))
    cut = words.select("doc_id", "_key", F.inline(taken))
    return (cut.join(windows, "phrase").where(F.slice("have", F.lit(1), F.size("words")) == F.col("words"))
            .groupBy("doc_id", "_key", "phrase", "start").agg(F.max(F.size("words")).alias("length"), F.max("items").alias("items")))


def hit_words(matches: DataFrame) -> DataFrame:
    """Per document the number of words inside any match (the union of the places)."""
    spans = matches.groupBy("doc_id", "_key", "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    w = Window.partitionBy("doc_id", "_key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(w), F.lit(0))))
    return spans.withColumn("_n", fresh).groupBy("doc_id", "_key").agg(F.sum("_n").cast("long").alias("n_hit"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, rarest: int = 2, slop: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, and n_near (phrases with a
    proximity match). Carries ``_key``, the hash of the text."""
    windows = written(phrases(benchmark), "decontamination_phrases")
    terms = written(index_terms(docs, windows, rarest, text_col), "decontamination_index_terms")
    index = written(postings(docs, terms, id_col, text_col), "decontamination_postings")
    found = written(candidates(index.where("term <> ''"), terms), "decontamination_candidates")
    exact = written(exact_matches(docs, found, windows, id_col, text_col), "decontamination_matches")
    items = (exact.select("doc_id", "_key", F.explode("items").alias("item")).distinct()
             .groupBy("doc_id", "_key").agg(F.sort_array(F.collect_list("item")).alias("_items")))
    hits = hit_words(exact)
    near = proximity(index.where("term <> ''"), terms, slop).groupBy("doc_id", "_key").agg(F.count(F.lit(1)).alias("n_near"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["_key"] == b["_key"])
    sizes = index.where("term = ''").select("doc_id", "_key", F.col("position").cast("long").alias("n_words"))
    zero = F.lit(0).cast("long")
    per_near = near.select(F.col("doc_id").alias("_nd"), F.col("_key").alias("_nk"), "n_near")
    out = sizes.join(hits.join(items, same(hits, items), "left").select(
        hits["doc_id"].alias("_d"), hits["_key"].alias("_k"), "n_hit", "_items"),
        F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_k")), "left")
    out = out.join(per_near, F.col("doc_id").eqNullSafe(F.col("_nd")) & (F.col("_key") == F.col("_nk")), "left")
    listed = F.coalesce("_items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", zero)
    return out.select("doc_id", "_key", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
                      F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
                      ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
                      F.coalesce("n_near", zero).alias("n_near"))
