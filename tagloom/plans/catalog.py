"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the given tables (or data Spark derives
from them). Output columns are aliased to match ``plans.oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays as AR
from ..functions import templates as TP
from ..functions import text as T
from ..operators import aggregate as A
from ..operators import clean as C
from ..operators import encode as EN
from ..operators import heads as H
from ..operators import joins as J
from ..operators import metrics as M
from ..operators import permute as PM
from ..operators import rank as R
from ..operators import score as SC
from ..operators import split as X
from ..operators import targets as TG
from ..operators import train as TR
from ..operators import vocab as V
from ..session import read_parquet_table, scratch_path, table_path
from ..sources import tables as S
from . import fixtures as FX
from . import loader as LD
from . import prepare as P
from . import sft as SFT
from .loader import assign_batches

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


DOCUMENTS_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _merged_long(spark, sf_dir) -> DataFrame:
    return P.merge_long(FX.fx_meta(spark, sf_dir), FX.fx_web(spark, sf_dir))


# ------------------------------------------------------------------ sources


@query("read_table")
def q_read_table(spark, sf_dir):
    return S.read_table(spark, table_path(sf_dir, "documents"), "parquet", DOCUMENTS_SCHEMA)


# ------------------------------------------------------------------ projection / filtering


def _messy_headers(spark, sf_dir) -> DataFrame:
    m = FX.fx_meta(spark, sf_dir)
    return m.toDF("doc_id", "  src \n(网址)", " scene\n(描述)", "tags \n(可多选)")


@query("normalize_headers")
def q_normalize_headers(spark, sf_dir):
    return C.normalize_headers(_messy_headers(spark, sf_dir))


@query("find_column")
def q_find_column(spark, sf_dir):
    df = C.normalize_headers(_messy_headers(spark, sf_dir))
    return df.select("doc_id", C.find_column(df, "tag"))


@query("project")
def q_project(spark, sf_dir):
    return C.project(FX.fx_meta(spark, sf_dir), ["scene", "tags"])


@query("drop_nulls")
def q_drop_nulls(spark, sf_dir):
    return C.drop_nulls(FX.fx_meta(spark, sf_dir).select("doc_id", "scene", "tags"), ["scene", "tags"])


@query("strip_text")
def q_strip_text(spark, sf_dir):
    return C.strip_columns(FX.fx_meta(spark, sf_dir).select("doc_id", "scene", "tags"), ["scene", "tags"])


@query("drop_blank")
def q_drop_blank(spark, sf_dir):
    df, _ = P.clean_short(FX.fx_meta(spark, sf_dir))
    return df


@query("cast_cells")
def q_cast_cells(spark, sf_dir):
    e = read_parquet_table(spark, sf_dir, "embeddings")
    df = e.select("vec_id", F.col("label").alias("label_text"), F.col("label").cast("double").alias("label_float_text"),
                  F.col("label").cast("string").alias("label_int"))
    return C.cast_cells(df, text_cols=["label_text", "label_float_text"], int_cols=["label_int"])


@query("take_rows")
def q_take_rows(spark, sf_dir):
    docs = read_parquet_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "lang")
    index = read_parquet_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"))
    return C.take_rows(docs, index).withColumnRenamed("row_id", "doc_id")


# ------------------------------------------------------------------ label cells


@query("parse_labels")
def q_parse_labels(spark, sf_dir):
    m = FX.fx_meta(spark, sf_dir)
    labs = T.parse_labels("tags")
    return m.select("doc_id", F.array_join(labs, "|").alias("labels"), F.size(labs).alias("n_labels"))


@query("first_label")
def q_first_label(spark, sf_dir):
    return FX.fx_meta(spark, sf_dir).select("doc_id", T.first_label("tags").alias("label"))


@query("canonical_separator")
def q_canonical_separator(spark, sf_dir):
    return FX.fx_meta(spark, sf_dir).select("doc_id", T.canonical_separator("tags").alias("tags"))


# ------------------------------------------------------------------ joins


@query("left_join_web")
def q_left_join_web(spark, sf_dir):
    m, w = A.dedupe_first(FX.fx_meta(spark, sf_dir).select("doc_id", "src"), "src", "doc_id"), FX.fx_web(spark, sf_dir)
    return J.left_join_content(m, w, "src", "url").select("doc_id", "page_id")


@query("merge_content")
def q_merge_content(spark, sf_dir):
    m, w = A.dedupe_first(FX.fx_meta(spark, sf_dir).select("doc_id", "src"), "src", "doc_id"), FX.fx_web(spark, sf_dir)
    return J.merge_content(m, w, "src", "url", "content").select("doc_id", "page_id", "content")


@query("encode_label_id")
def q_encode_label_id(spark, sf_dir):
    merged = _merged_long(spark, sf_dir).cache()
    vocab = V.label_vocab_single(merged, "label")
    return J.encode_label_id(merged, vocab, "label").select("doc_id", "page_id", "label", "label_id")


@query("decode_label_id")
def q_decode_label_id(spark, sf_dir):
    docs = read_parquet_table(spark, sf_dir, "documents")
    vocab = V.dense_ids(docs.select(F.col("source").alias("label")))
    e = read_parquet_table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("label_id"))
    return J.decode_label_id(e, vocab, "label_id").select("vec_id", "label_id", "label")


@query("pair_text_label")
def q_pair_text_label(spark, sf_dir):
    labels = read_parquet_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"), "quality", "toxic")
    docs = read_parquet_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text")
    text = C.take_rows(docs, labels)
    return J.pair_text_label(text, labels).select("row_id", "text", "quality", "toxic")


# ------------------------------------------------------------------ aggregation


@query("dedupe_first")
def q_dedupe_first(spark, sf_dir):
    m = FX.fx_meta(spark, sf_dir).select("doc_id", "src", "tags")
    return A.dedupe_first(m, "src", "doc_id")


@query("prepare_long")
def q_prepare_long(spark, sf_dir):
    return _merged_long(spark, sf_dir)


@query("class_distribution")
def q_class_distribution(spark, sf_dir):
    return A.class_distribution(_merged_long(spark, sf_dir), "label")


@query("stage_counts")
def q_stage_counts(spark, sf_dir):
    m = FX.fx_meta(spark, sf_dir)
    scene_ok = F.coalesce(T.strip_text("scene") != "", F.lit(False))
    tags_ok = F.coalesce(T.strip_text("tags") != "", F.lit(False))
    return A.stage_counts(m, {"n_src": F.col("src").isNotNull(), "n_scene": scene_ok, "n_tags": tags_ok,
                              "n_clean": scene_ok & tags_ok})


@query("label_vocab_single")
def q_label_vocab_single(spark, sf_dir):
    return V.label_vocab_single(_merged_long(spark, sf_dir), "label")


@query("label_vocab_multi")
def q_label_vocab_multi(spark, sf_dir):
    df, label_col = P.clean_short(FX.fx_meta(spark, sf_dir))
    return V.label_vocab_multi(df, label_col)


@query("label_ids")
def q_label_ids(spark, sf_dir):
    return V.dense_ids(read_parquet_table(spark, sf_dir, "documents").select(F.col("lang").alias("label")))


# ------------------------------------------------------------------ ranks, batches, splits


SEED = 42


def _docs_ids(spark, sf_dir) -> DataFrame:
    return read_parquet_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "lang")


@query("exact_rank")
def q_exact_rank(spark, sf_dir):
    d = _docs_ids(spark, sf_dir).withColumn("_k", R.hash_order_key(SEED, "row_id"))
    return R.exact_rank(d, "_k", "row_id", rank_col="rank").select("row_id", "rank")


def _epoch_order(spark, sf_dir, epoch: int) -> DataFrame:
    d = _docs_ids(spark, sf_dir).withColumn("epoch", F.lit(epoch))
    return d.withColumn("shuffle_key", R.hash_order_key(SEED, "epoch", "row_id"))


@query("epoch_shuffle")
def q_epoch_shuffle(spark, sf_dir):
    d = _epoch_order(spark, sf_dir, 1)
    return R.exact_rank(d, "shuffle_key", "row_id", rank_col="position").select("row_id", "epoch", "shuffle_key", "position")




@query("epoch_orders")
def q_epoch_orders(spark, sf_dir):
    """Batches of epochs 1 and 2 of a random split, from ranks that are computed once."""
    rows = X.split_random(_docs_ids(spark, sf_dir).select("row_id"), "row_id", 0.1, 0.1, SEED)
    ranked = PM.rank_once(rows, "row_id", "split", SEED)
    epochs = [LD.epoch_batches(ranked, e, 16, SEED).withColumn("epoch", F.lit(e)) for e in (1, 2)]
    return epochs[0].unionByName(epochs[1]).select("row_id", "split", "epoch", "batch_id", "pos_in_batch")


@query("assign_batches")
def q_assign_batches(spark, sf_dir):
    d = _epoch_order(spark, sf_dir, 1)
    return assign_batches(d, "shuffle_key", "row_id", 16).select("row_id", "batch_id", "pos_in_batch")


@query("split_random")
def q_split_random(spark, sf_dir):
    df, _ = P.clean_short(FX.fx_meta(spark, sf_dir))
    return X.split_random(df, "row_id", 0.1, 0.1, SEED).select("row_id", "split")


@query("split_holdout")
def q_split_holdout(spark, sf_dir):
    return X.split_holdout(_docs_ids(spark, sf_dir), "row_id", 0.2, SEED).select("row_id", "split")


@query("split_fraction")
def q_split_fraction(spark, sf_dir):
    lab = read_parquet_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"))
    return X.split_fraction(lab, "row_id", 0.8, 0.1, SEED).select("row_id", "split")


@query("split_positional")
def q_split_positional(spark, sf_dir):
    pages = read_parquet_table(spark, sf_dir, "pages").select(F.col("page_id").alias("row_id"))
    return X.split_positional(pages, "row_id", 0.8).select("row_id", "split")


@query("split_stratified")
def q_split_stratified(spark, sf_dir):
    return X.split_stratified(_docs_ids(spark, sf_dir), "lang", "row_id", SEED).select("row_id", "lang", "split")


# ------------------------------------------------------------------ multi-hot, short preparation, metadata


def _prepared_short(spark, sf_dir) -> P.Prepared:
    return P.prepare_short(FX.fx_meta(spark, sf_dir))


@query("multi_hot")
def q_multi_hot(spark, sf_dir):
    df, label_col = P.clean_short(FX.fx_meta(spark, sf_dir))
    df = df.withColumn("labels", T.parse_labels(label_col))
    vocab = V.label_vocab_multi(df, label_col)
    rows = TG.sparse_targets(df, vocab)
    y = TG.dense_targets("label_ids", vocab.count())
    return rows.select("row_id", F.array_join(y.cast("array<int>"), "|").alias("y"), F.size("label_ids").alias("n_hot"))


@query("prepare_short")
def q_prepare_short(spark, sf_dir):
    p = _prepared_short(spark, sf_dir)
    return p.dense().select("row_id", "split", F.array_join(F.col("y").cast("array<int>"), "|").alias("y"))


def _metadata_row(meta: DataFrame) -> DataFrame:
    return meta.select(
        F.array_join("labels", "|").alias("labels"),
        "num_labels", "label_col", "text_col",
        F.array_join(F.transform(F.map_entries("lab2id"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), "|").alias("lab2id"),
        F.array_join(F.transform(F.map_entries("id2lab"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|").alias("id2lab"),
    )


@query("label_metadata")
def q_label_metadata(spark, sf_dir):
    df, label_col = P.clean_short(FX.fx_meta(spark, sf_dir))
    return _metadata_row(V.label_metadata(V.label_vocab_multi(df, label_col), label_col, "scene"))


@query("load_label_metadata")
def q_load_label_metadata(spark, sf_dir):
    df, label_col = P.clean_short(FX.fx_meta(spark, sf_dir))
    path = scratch_path(spark, "labels")
    S.write_label_metadata(V.label_metadata(V.label_vocab_multi(df, label_col), label_col, "scene"), path)
    return V.metadata_to_vocab(S.load_label_metadata(spark, path))


# ------------------------------------------------------------------ scores and losses


def _r(c, n: int = 6):
    return F.round(c.cast("double") if not isinstance(c, str) else F.col(c).cast("double"), n)


@query("sigmoid_threshold")
def q_sigmoid_threshold(spark, sf_dir):
    lg = FX.fx_logits(spark, sf_dir)
    p = AR.sigmoid("z")
    return lg.select("vec_id", F.array_join(AR.threshold(p, 0.5), "|").alias("pred"),
                     F.array_join(F.transform(p, lambda x: F.floor(x * 1e6 + 0.5).cast("long").cast("string")), "|").alias("p_millionths"))


@query("softmax_argmax")
def q_softmax_argmax(spark, sf_dir):
    lg = FX.fx_logits(spark, sf_dir)
    return lg.select("vec_id", AR.argmax("z").alias("pred"), _r(F.array_max(AR.softmax("z"))).alias("p_max"))


@query("bce_loss")
def q_bce_loss(spark, sf_dir):
    lg = FX.fx_logits(spark, sf_dir)
    return lg.select("vec_id", _r(AR.bce_with_logits("z", F.col("y_multi").cast("array<double>"))).alias("loss"))


@query("ce_loss")
def q_ce_loss(spark, sf_dir):
    lg = FX.fx_logits(spark, sf_dir)
    return lg.select("vec_id", _r(AR.cross_entropy("z", "y")).alias("loss"))


@query("mean_loss")
def q_mean_loss(spark, sf_dir):
    lg = FX.fx_logits(spark, sf_dir).select(AR.cross_entropy("z", "y").alias("row_loss"))
    return A.mean_loss(lg, "row_loss").select(_r("loss").alias("loss"))


# ------------------------------------------------------------------ metrics


def _single_pairs(spark, sf_dir) -> DataFrame:
    return FX.fx_logits(spark, sf_dir).select(F.col("y").alias("y_true"), AR.argmax("z").alias("y_pred"))


def _multi_pairs(spark, sf_dir) -> DataFrame:
    lg = FX.fx_logits(spark, sf_dir)
    return lg.select(F.col("y_multi").alias("y_true"), AR.threshold(AR.sigmoid("z"), 0.5).alias("y_pred"))


def _round_all(df: DataFrame, keep=()) -> DataFrame:
    return df.select(*[F.col(c) if c in keep or not str(df.schema[c].dataType).startswith("Double") else _r(c).alias(c) for c in df.columns])


@query("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(_single_pairs(spark, sf_dir), "y_true", "y_pred")


@query("per_label_counts")
def q_per_label_counts(spark, sf_dir):
    return M.per_label_counts(_multi_pairs(spark, sf_dir), "y_true", "y_pred")


@query("single_metrics")
def q_single_metrics(spark, sf_dir):
    return _round_all(M.classification_metrics(_single_pairs(spark, sf_dir), "y_true", "y_pred"))


@query("multilabel_metrics")
def q_multilabel_metrics(spark, sf_dir):
    lg = FX.fx_logits(spark, sf_dir).select("y_multi", AR.sigmoid("z").alias("prob"))
    return _round_all(M.multilabel_metrics(lg, "y_multi", "prob", 0.5))


def _resp_pairs(spark, sf_dir) -> DataFrame:
    r = FX.fx_resp(spark, sf_dir)
    return r.select("vec_id", F.col("gold"), T.clean_response("resp").alias("pred"))


@query("clean_response")
def q_clean_response(spark, sf_dir):
    return _resp_pairs(spark, sf_dir).select("vec_id", F.col("pred").alias("resp"))


@query("sft_single_report")
def q_sft_single_report(spark, sf_dir):
    cm = M.confusion_matrix(_resp_pairs(spark, sf_dir), "gold", "pred")
    return _round_all(M.single_label_summary(cm))


@query("classification_report")
def q_classification_report(spark, sf_dir):
    return _round_all(M.classification_report(_resp_pairs(spark, sf_dir), "gold", "pred"))


def _multi_resp(spark, sf_dir) -> DataFrame:
    r = FX.fx_resp_multi(spark, sf_dir)
    return r.select("vec_id", T.split_predicted_labels("gold").alias("gold_labels"), T.split_predicted_labels("resp").alias("pred_labels"))


@query("split_predicted_labels")
def q_split_predicted_labels(spark, sf_dir):
    m = _multi_resp(spark, sf_dir)
    return m.select("vec_id", F.array_join("gold_labels", "|").alias("gold"), F.array_join("pred_labels", "|").alias("resp"),
                    F.size("pred_labels").alias("n_resp"))


@query("binarize_fixed")
def q_binarize_fixed(spark, sf_dir):
    m = _multi_resp(spark, sf_dir)
    yg = AR.multi_hot("gold_labels", FX.FX_MULTI_CLASSES).cast("array<int>")
    yp = AR.multi_hot("pred_labels", FX.FX_MULTI_CLASSES).cast("array<int>")
    return m.select("vec_id", F.array_join(yg, "|").alias("y_gold"), F.array_join(yp, "|").alias("y_resp"))


@query("sft_multi_report")
def q_sft_multi_report(spark, sf_dir):
    summary, _ = M.fixed_class_report(_multi_resp(spark, sf_dir), "gold_labels", "pred_labels", FX.FX_MULTI_CLASSES)
    return _round_all(summary)


@query("per_label_report")
def q_per_label_report(spark, sf_dir):
    _, per_label = M.fixed_class_report(_multi_resp(spark, sf_dir), "gold_labels", "pred_labels", FX.FX_MULTI_CLASSES)
    return _round_all(per_label)


@query("best_epoch")
def q_best_epoch(spark, sf_dir):
    return M.best_epoch(FX.fx_epochs(spark, sf_dir), "macro_f1")


@query("improved_epochs")
def q_improved_epochs(spark, sf_dir):
    return M.improved_epochs(FX.fx_epochs(spark, sf_dir), "macro_f1")


# ------------------------------------------------------------------ sinks and round trips



@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    web = FX.fx_web(spark, sf_dir)
    path = scratch_path(spark, "web_csv")
    S.write_csv(web, path)
    return S.read_csv(spark, path, "page_id bigint, url string, content string")


@query("jsonl_roundtrip")
def q_jsonl_roundtrip(spark, sf_dir):
    docs = read_parquet_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = scratch_path(spark, "docs_jsonl")
    S.write_jsonl(docs, path)
    return S.read_jsonl(spark, path, "doc_id bigint, text string, lang string")


@query("write_splits_json")
def q_write_splits_json(spark, sf_dir):
    p = _prepared_short(spark, sf_dir)
    path = scratch_path(spark, "splits_json")
    S.write_splits_json(p.data.select("row_id", "scene", "tags", "split"), path)
    return S.read_jsonl(spark, path, "row_id bigint, scene string, tags string, split string")


@query("write_splits_csv")
def q_write_splits_csv(spark, sf_dir):
    p = _prepared_short(spark, sf_dir)
    path = scratch_path(spark, "splits_text")
    S.write_splits_csv(p.data, path, "scene")
    return S.read_csv(spark, path, "row_id bigint, scene string, split string")


@query("write_encoded")
def q_write_encoded(spark, sf_dir):
    p = _prepared_short(spark, sf_dir)
    path = scratch_path(spark, "encoded")
    S.write_encoded(p.dense(), path)
    back = spark.read.parquet(path)
    return back.select("row_id", "split", F.array_join(F.col("y").cast("array<int>"), "|").alias("y"))


@query("load_split")
def q_load_split(spark, sf_dir):
    p = _prepared_short(spark, sf_dir)
    text_path, y_path = scratch_path(spark, "splits_text"), scratch_path(spark, "encoded")
    S.write_splits_csv(p.data, text_path, "scene")
    S.write_encoded(p.dense(), y_path)
    test = S.load_split(spark, text_path, y_path, "test", "row_id bigint, scene string, split string")
    return test.select("row_id", "scene", F.array_join(F.col("y").cast("array<int>"), "|").alias("y"))


# ------------------------------------------------------------------ instruction-tuning records


def _short_records(spark, sf_dir) -> DataFrame:
    return SFT.build_sft_multi(_prepared_short(spark, sf_dir).data)


@query("category_prompt")
def q_category_prompt(spark, sf_dir):
    return FX.fx_meta(spark, sf_dir).select("doc_id", TP.category_prompt(T.parse_labels("tags")).alias("categories"))


@query("sft_records")
def q_sft_records(spark, sf_dir):
    df, label_col = P.clean_short(FX.fx_meta(spark, sf_dir))
    rec = TP.sft_record("scene", label_col, TP.MULTI_LABEL_INSTRUCTION, TP.FIXED_CLASSES)
    return df.select("row_id", rec.alias("r")).select("row_id", "r.*")


@query("build_sft_multi")
def q_build_sft_multi(spark, sf_dir):
    return _short_records(spark, sf_dir)


@query("build_sft_single")
def q_build_sft_single(spark, sf_dir):
    return SFT.build_sft_single(_merged_long(spark, sf_dir))


@query("sft_jsonl")
def q_sft_jsonl(spark, sf_dir):
    path = scratch_path(spark, "sft_multi")
    S.write_sft_jsonl(_short_records(spark, sf_dir), path)
    return S.read_sft_jsonl(spark, path)


@query("render_prompt")
def q_render_prompt(spark, sf_dir):
    return _short_records(spark, sf_dir).select("row_id", TP.render_prompt("instruction", "input").alias("prompt"))


def _single_records_with_answer(spark, sf_dir) -> DataFrame:
    """Single-label test records with a deterministic stand-in answer (see ``eval_generated_single``)."""
    recs = SFT.build_sft_single(_merged_long(spark, sf_dir)).where(F.col("split") == "test")
    return SFT.generate(recs, echo_model("input", "output"), ECHO_SCHEMA)


@query("chat_messages")
def q_chat_messages(spark, sf_dir):
    ans = _single_records_with_answer(spark, sf_dir)
    t = SFT.chat_transcript(ans, "response")
    return t.select("doc_id", "page_id", F.size("messages").alias("n_messages"), "transcript")


@query("render_chat")
def q_render_chat(spark, sf_dir):
    return SFT.render_chat(read_parquet_table(spark, sf_dir, "conversations"))


# ------------------------------------------------------------------ token sequences

# The vocabulary size is a parameter of the encoder: tokens outside it are spelled, so nothing is lost.
MAX_VOCAB = 5000


def _doc_tokens(spark, sf_dir) -> DataFrame:
    return read_parquet_table(spark, sf_dir, "documents").select("doc_id", EN.tokenize("text").alias("tokens"))


@query("token_vocab")
def q_token_vocab(spark, sf_dir):
    return EN.token_vocab(_doc_tokens(spark, sf_dir), "tokens", MAX_VOCAB)


def _encoded_docs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Encoded documents and the (cached, capped) vocabulary they were encoded with."""
    toks = _doc_tokens(spark, sf_dir)
    vocab = EN.token_vocab(toks, "tokens", MAX_VOCAB).cache()
    return EN.encode_tokens(toks, "tokens", vocab, MAX_VOCAB), vocab


@query("encode_text")
def q_encode_text(spark, sf_dir):
    enc, _ = _encoded_docs(spark, sf_dir)
    return enc.select("doc_id", F.size("input_ids").alias("n_ids"), F.array_join("input_ids", " ").alias("input_ids"))


@query("decode_ids")
def q_decode_ids(spark, sf_dir):
    enc, vocab = _encoded_docs(spark, sf_dir)
    dec = EN.decode_ids(enc, "input_ids", vocab, MAX_VOCAB)
    return dec.select("doc_id", F.array_join("tokens", " ").alias("decoded"))


@query("encode_fixed")
def q_encode_fixed(spark, sf_dir):
    enc, _ = _encoded_docs(spark, sf_dir)
    fx = EN.encode_fixed(enc, "input_ids", 128)
    return fx.select("doc_id", F.array_join("input_ids", " ").alias("input_ids"),
                     F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_real"),
                     F.size("token_type_ids").alias("n_types"))


def _codepoints(col):
    return SC.tokenizer_udf(SC.codepoint_tokenizer)(col)


@query("tokenizer_udf")
def q_tokenizer_udf(spark, sf_dir):
    docs = read_parquet_table(spark, sf_dir, "documents")
    return docs.select("doc_id", _codepoints(F.col("text")).alias("ids")).select("doc_id", F.array_join("ids", " ").alias("ids"))


def _masked_records(spark, sf_dir) -> DataFrame:
    recs = _short_records(spark, sf_dir)
    seq = recs.select(
        "row_id",
        _codepoints(TP.render_prompt("instruction", "input")).alias("prompt_ids"),
        _codepoints(F.col("output")).alias("response_ids"),
    )
    return EN.mask_labels(seq, "prompt_ids", "response_ids", EN.PAD_ID, 512)


@query("sft_mask_labels")
def q_sft_mask_labels(spark, sf_dir):
    m = _masked_records(spark, sf_dir)
    return m.select("row_id", F.array_join("input_ids", " ").alias("input_ids"), F.size("attention_mask").alias("n_mask"),
                    F.array_join("labels", " ").alias("labels"), "n_target")


@query("strip_prompt_ids")
def q_strip_prompt_ids(spark, sf_dir):
    recs = _short_records(spark, sf_dir)
    seq = recs.select(
        "row_id",
        _codepoints(TP.render_prompt("instruction", "input")).alias("inp"),
        _codepoints(F.concat(TP.render_prompt("instruction", "input"), F.col("output"))).alias("out"),
    )
    return seq.select("row_id", F.array_join(AR.strip_prompt_ids("inp", "out"), " ").alias("ids"))


@query("pad_batches")
def q_pad_batches(spark, sf_dir):
    m = _masked_records(spark, sf_dir).withColumn("_k", R.hash_order_key(SEED, "row_id"))
    b = assign_batches(m, "_k", "row_id", 16)
    padded = EN.pad_batches(b, "batch_id")
    return padded.select(
        "row_id", "batch_id", F.array_join("input_ids", " ").alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"),
        F.array_join("labels", " ").alias("labels"),
    )


# ------------------------------------------------------------------ scoring and generated answers

ECHO_SCHEMA = "doc_id bigint, page_id bigint, instruction string, input string, output string, response string"


def echo_model(input_col: str, output_col: str, id_cols=("doc_id", "page_id")):
    """Deterministic stand-in for a generator: answers the gold label, except
    "无" when len(input) % 3 == 0 and with a leading newline when it is 1."""

    def factory():
        def predict(pdf):
            n = pdf[input_col].str.len() % 3
            resp = pdf[output_col].where(n != 0, "无")
            resp = resp.where(n != 1, "\n" + pdf[output_col])
            out = pdf[list(id_cols) + ["instruction", input_col, output_col]].copy()
            out["response"] = resp
            return out

        return predict

    return factory


@query("batch_score")
def q_batch_score(spark, sf_dir):
    e = read_parquet_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return SC.batch_score(e, SC.argmax_rule("vec_id", "embedding"), "vec_id bigint, pred int, score double").select(
        "vec_id", "pred", F.round("score", 6).alias("score"))


@query("eval_generated_single")
def q_eval_generated_single(spark, sf_dir):
    summary, _ = SFT.eval_generated_single(_single_records_with_answer(spark, sf_dir))
    return _round_all(summary)


MULTI_ECHO_SCHEMA = "row_id bigint, output string, response string"


def multi_echo_model():
    """Stand-in multi-label generator: the gold list; "无" when len(input) % 3 == 0;
    an unknown extra label when it is 1."""

    def factory():
        def predict(pdf):
            n = pdf["input"].str.len() % 3
            resp = pdf["output"].where(n != 0, "无")
            resp = resp.where(n != 1, pdf["output"] + "、未知")
            return pdf[["row_id", "output"]].assign(response=resp)

        return predict

    return factory


@query("eval_generated_multi")
def q_eval_generated_multi(spark, sf_dir):
    p = _prepared_short(spark, sf_dir)
    records = SFT.build_sft_multi(p.data)
    ans = SFT.generate(records.where(F.col("split") == "test"), multi_echo_model(), MULTI_ECHO_SCHEMA)
    # classes by the grammar that reads the gold answers
    classes = V.vocab_list(V.dense_ids(records.select(F.explode(T.split_predicted_labels("output")).alias("label"))))
    summary, _ = SFT.eval_generated_multi(ans, classes)
    return _round_all(summary)


# ------------------------------------------------------------------ loader and training



def _keyed(m: DataFrame) -> DataFrame:
    return m.withColumn("row_key", F.concat_ws(":", F.col("doc_id").cast("string"), F.col("page_id").cast("string")))


def _merged_keyed(spark, sf_dir) -> DataFrame:
    return _keyed(_merged_long(spark, sf_dir))


def _batch_columns(b: DataFrame, *cols: str) -> DataFrame:
    return b.select(*cols, "split", "batch_id", "pos_in_batch", F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_real"),
                    F.array_join("input_ids", " ").alias("input_ids"))


@query("load_batches")
def q_load_batches(spark, sf_dir):
    """The long path from its saved artifacts: merged CSV and label metadata."""
    path = scratch_path(spark, "long")
    P.save_long(P.prepare_long(FX.fx_meta(spark, sf_dir), FX.fx_web(spark, sf_dir)), path)
    merged = S.read_csv(spark, f"{path}/merged", "doc_id bigint, page_id bigint, content string, label string")
    vocab = V.metadata_to_vocab(S.load_label_metadata(spark, f"{path}/labels"))
    return _batch_columns(LD.load_batches(_keyed(merged), vocab, "row_key", max_length=512), "row_key", "label_id")


@query("load_batches_short")
def q_load_batches_short(spark, sf_dir):
    """The short path from its saved artifacts: split text CSV, targets with their split, label metadata."""
    path = scratch_path(spark, "short")
    P.save_short(_prepared_short(spark, sf_dir), path)
    b = LD.load_batches_short(spark, path)
    return _batch_columns(b.withColumn("y", F.array_join(F.col("y").cast("array<int>"), "|")), "row_id", "y")


@query("load_batches_stratified")
def q_load_batches_stratified(spark, sf_dir):
    docs, vocab = _lang_docs(spark, sf_dir)
    return _batch_columns(LD.load_batches_stratified(docs, vocab, "row_id", "text", "lang"), "row_id", "label_id")


def _lang_splits(spark, sf_dir) -> DataFrame:
    docs, vocab = _lang_docs(spark, sf_dir)
    enc = J.encode_label_id(docs, vocab, "lang", "y")
    return X.split_random(enc, "row_id", 0.2, 0.2, SEED).cache()


def _lang_docs(spark, sf_dir):
    docs = read_parquet_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text", "lang")
    return docs, V.dense_ids(docs.select(F.col("lang").alias("label")))


@query("train_single")
def q_train_single(spark, sf_dir):
    d = _lang_splits(spark, sf_dir)
    model = TR.train_single(d.where("split = 'train'"), "text", "y")
    pred = TR.predict_single(model, d.where("split = 'test'"))
    return _round_all(M.classification_metrics(pred, "y", "pred"))


@query("select_and_test")
def q_select_and_test(spark, sf_dir):
    d = _lang_splits(spark, sf_dir)
    _, table = TR.select_and_test(d.where("split = 'train'"), d.where("split = 'val'"), d.where("split = 'test'"), "text", "y")
    return _round_all(table)


@query("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    d = _lang_splits(spark, sf_dir)
    _, vocab = _lang_docs(spark, sf_dir)
    model = TR.train_single(d.where("split = 'train'"), "text", "y")
    path = scratch_path(spark, "model")
    TR.save_model(model, V.label_metadata(vocab, "lang", "text"), path)
    reloaded, meta = TR.load_model(spark, path)
    test = d.where("split = 'test'")
    a = TR.predict_single(model, test).select("row_id", F.col("pred").alias("before"))
    b = TR.predict_single(reloaded, test).select("row_id", F.col("pred").alias("after"))
    # predictions decode through the reloaded metadata, as inference would
    b = J.decode_label_id(b, V.metadata_to_vocab(meta), "after", "after_label")
    both = a.join(b, "row_id")
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("before") == F.col("after")).alias("n_equal"),
                    F.count_if(F.col("after_label").isNotNull()).alias("n_decoded"))


@query("train_multi")
def q_train_multi(spark, sf_dir):
    labels = read_parquet_table(spark, sf_dir, "labels")
    docs = read_parquet_table(spark, sf_dir, "documents").select("doc_id", "text")
    d = docs.join(labels, "doc_id").withColumnRenamed("doc_id", "row_id")
    d = X.split_random(d, "row_id", 0.2, 0.0, SEED).cache()
    feats, heads = TR.train_multi(d.where("split = 'train'"), "text", ["quality", "toxic"])
    pred = TR.predict_multi(feats, heads, d.where("split = 'test'"), ["quality", "toxic"])
    return _round_all(TR.evaluate_multi(pred, ["quality", "toxic"]))


@query("train_eval")
def q_train_eval(spark, sf_dir):
    """Long-text job end to end: merged pages -> label ids -> 80/10/10 split -> candidates -> best -> test."""
    merged = _merged_keyed(spark, sf_dir).cache()
    vocab = V.label_vocab_single(merged, "label")
    rows = J.encode_label_id(merged, vocab, "label", "y")
    rows = X.split_fraction(rows, "row_key", 0.8, 0.1, SEED).cache()
    _, table = TR.select_and_test(rows.where("split = 'train'"), rows.where("split = 'val'"), rows.where("split = 'test'"),
                                  "content", "y", regs=(0.0, 0.1))
    return _round_all(table)


@query("select_and_test_multi")
def q_select_and_test_multi(spark, sf_dir):
    """Multi-label job end to end: documents with their labels -> candidates by macro F1 -> test once -> saved with
    the label metadata -> read back. Split sizes, and test rows to which the model read back gives equal scores."""
    names = ["quality", "toxic"]
    labels = read_parquet_table(spark, sf_dir, "labels")
    docs = read_parquet_table(spark, sf_dir, "documents").select(F.col("doc_id"), "text")
    rows = docs.join(labels, "doc_id").select(F.col("doc_id").alias("row_id"), "text", F.array(*names).alias("y"))
    d = X.split_random(rows, "row_id", 0.2, 0.2, SEED).cache()
    parts = {s: d.where(F.col("split") == s) for s in ("train", "val", "test")}
    model, _ = TR.select_and_test_multi(parts["train"], parts["val"], parts["test"], "text", "y", len(names))
    vocab = V.dense_ids(labels.select(F.explode(F.array(*[F.lit(n) for n in names])).alias("label")))
    path = scratch_path(spark, "model")
    TR.save_model(model, V.label_metadata(vocab, "y", "text"), path)
    again, meta = TR.load_model(spark, path)
    places = [str(i) for i in range(meta.first()["num_labels"])]

    def scores(m, name: str) -> DataFrame:
        feats = TR.PipelineModel(stages=m.stages[: -len(places)]).transform(parts["test"])
        return TR.predict_multi_heads(m.stages[-len(places):], feats, places).select("row_id", F.col("prob").alias(name))

    both = scores(model, "before").join(scores(again, "after"), "row_id")
    equal = both.where(F.col("before") == F.col("after")).count()
    sizes = d.agg(*[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in parts])
    return sizes.select("*", F.lit(equal).cast("long").alias("n_equal"))


@query("select_and_test_short")
def q_select_and_test_short(spark, sf_dir):
    """The short path end to end: prepared rows with all labels of their vocabulary -> all heads of all candidates trained
    together -> candidate by macro F1 -> test once. Split sizes, heads, and how many of them a pass of its own over the training rows proves optimal."""
    p = _prepared_short(spark, sf_dir)
    rows = p.data.select("row_id", "scene").join(p.targets, "row_id")
    n_labels, tol = p.vocab.count(), 1e-3
    _, heads, _, _, train = H.select_and_test_heads(rows, "scene", "label_ids", n_labels, regs=(0.1, 1.0), num_features=1 << 11, tol=tol)
    proofs = H.certificates(train, heads, 1 << 11)
    optimal = sum(gradient <= 2 * tol for *_, gradient in proofs)  # one row per head
    sizes = p.targets.agg(*[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "val", "test")])
    return sizes.select("*", F.lit(n_labels).cast("long").alias("n_labels"), F.lit(len(proofs)).cast("long").alias("n_heads"),
                        F.lit(optimal).cast("long").alias("n_optimal"))
