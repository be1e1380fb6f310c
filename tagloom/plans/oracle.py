"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on DuckDB over the driver's views of the parquet tables.
Fixtures are CTEs that build the same rows as ``plans.fixtures``.
"""

from __future__ import annotations

from ..functions.templates import FIXED_CLASSES, MULTI_LABEL_INSTRUCTION, SINGLE_LABEL_INSTRUCTION

# Python's str.isspace() set (see functions.text) as a DuckDB expression.
WS = "(" + " || ".join(
    f"chr({c})" for c in [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760]
    + list(range(8192, 8203)) + [8232, 8233, 8239, 8287, 12288]
) + ")"
SEP_RE = r"[\s\x0b\x1c-\x1f\x85\p{Z}，、;/]+"


def strip(x: str) -> str:
    return f"trim(CAST({x} AS VARCHAR), {WS})"


def parse_labels(x: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({x}, ''), '{SEP_RE}'), lambda s: s <> '')"


def split_pred(x: str) -> str:
    pieces = f"list_filter(list_transform(string_split(replace({x}, '、', ','), ','), lambda s: {strip('s')}), lambda s: s <> '')"
    return f"(CASE WHEN {x} IS NULL OR {strip(x)} = '无' THEN []::VARCHAR[] ELSE {pieces} END)"


def joined(x: str) -> str:
    return f"array_to_string({x}, '|')"


FX_META = """fx_meta AS (
SELECT doc_id,
  CASE WHEN doc_id % 97 = 0 THEN NULL ELSE concat('u', CAST(doc_id // 3 AS VARCHAR)) END AS src,
  CASE WHEN doc_id % 53 = 0 THEN NULL WHEN doc_id % 59 = 0 THEN ' 　' ELSE concat(' ', text, '　') END AS scene,
  CASE WHEN doc_id % 61 = 1 THEN NULL WHEN doc_id % 67 = 1 THEN ' 、 '
    ELSE concat(CASE doc_id % 5 WHEN 1 THEN '、' WHEN 2 THEN ' ' ELSE '' END, lang,
      CASE doc_id % 6 WHEN 0 THEN '、' WHEN 1 THEN '，' WHEN 2 THEN ';' WHEN 3 THEN '/' WHEN 4 THEN '　' ELSE ',' END,
      source) END AS tags
FROM documents)"""

FX_WEB = """fx_web AS (
SELECT page_id,
  CASE WHEN page_id % 41 = 0 THEN NULL ELSE concat('u', CAST(page_id // 2 AS VARCHAR)) END AS url,
  CASE WHEN page_id % 37 = 1 THEN NULL WHEN page_id % 43 = 1 THEN '　 ' ELSE html END AS content
FROM pages)"""

FX_RESP = """fx_resp AS (
SELECT vec_id, concat('s', CAST(label % 7 AS VARCHAR)) AS gold,
  CASE WHEN vec_id % 9 = 0 THEN 'other'
    ELSE concat(CASE WHEN vec_id % 2 = 0 THEN chr(10) ELSE '' END, 's', CAST((label + vec_id % 3) % 7 AS VARCHAR)) END AS resp
FROM embeddings)"""

FX_RESP_MULTI = """fx_resp_multi AS (
SELECT vec_id,
  CASE WHEN label = 9 THEN '无' ELSE concat('s', CAST(label % 7 AS VARCHAR), ',', 's', CAST((label + vec_id) % 7 AS VARCHAR)) END AS gold,
  CASE WHEN vec_id % 11 = 0 THEN ' 无 ' WHEN vec_id % 13 = 0 THEN ''
    ELSE concat('s', CAST((label + vec_id % 2) % 7 AS VARCHAR),
      CASE WHEN vec_id % 2 = 0 THEN '、 ' ELSE ', ' END,
      CASE WHEN vec_id % 5 = 0 THEN 'other' ELSE concat('s', CAST((label + vec_id) % 7 AS VARCHAR)) END) END AS resp
FROM embeddings)"""

FX_EPOCHS = """fx_epochs AS (
SELECT user_id % 20 + 1 AS epoch, round(avg(value) / 10, 0) AS macro_f1 FROM events GROUP BY user_id % 20 + 1)"""

FX_LOGITS = """fx_logits AS (
SELECT vec_id, label AS y, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS z FROM embeddings),
fx_logits_m AS (
SELECT vec_id, y, z,
  list_transform(z, lambda x, i: CASE WHEN (vec_id * 7 + (i - 1)) % 31 = 0 THEN 1 - CAST(x >= 0 AS INTEGER) ELSE CAST(x >= 0 AS INTEGER) END) AS y_multi
FROM fx_logits)"""

MERGED_LONG = """first_meta AS (
  SELECT doc_id, src, tags FROM fx_meta QUALIFY row_number() OVER (PARTITION BY src ORDER BY doc_id) = 1),
merged AS (
  SELECT m.doc_id, w.page_id, STRIP_CONTENT AS content, STRIP_LABEL AS label
  FROM first_meta m LEFT JOIN fx_web w ON m.src IS NOT DISTINCT FROM w.url
  WHERE w.content IS NOT NULL AND split_part(m.tags, '、', 1) IS NOT NULL),
merged_long AS (SELECT * FROM merged WHERE content <> '' AND label <> '')""".replace(
    "STRIP_CONTENT", strip("w.content")).replace("STRIP_LABEL", strip("split_part(m.tags, '、', 1)"))

CLEAN_SHORT = f"""clean_short AS (
  SELECT doc_id AS row_id, {strip('scene')} AS scene, {strip('tags')} AS tags FROM fx_meta
  WHERE scene IS NOT NULL AND tags IS NOT NULL AND {strip('scene')} <> '' AND {strip('tags')} <> '')"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["read_table"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"
SQL["normalize_headers"] = with_(FX_META) + "SELECT doc_id, src, scene, tags FROM fx_meta"
SQL["find_column"] = with_(FX_META) + "SELECT doc_id, tags FROM fx_meta"
SQL["project"] = with_(FX_META) + "SELECT scene, tags FROM fx_meta"
SQL["drop_nulls"] = with_(FX_META) + "SELECT doc_id, scene, tags FROM fx_meta WHERE scene IS NOT NULL AND tags IS NOT NULL"
SQL["strip_text"] = with_(FX_META) + f"SELECT doc_id, {strip('scene')} AS scene, {strip('tags')} AS tags FROM fx_meta"
SQL["drop_blank"] = with_(FX_META, CLEAN_SHORT) + "SELECT row_id, scene, tags FROM clean_short"
SQL["cast_cells"] = ("SELECT vec_id, CAST(label AS VARCHAR) AS label_text, CAST(CAST(label AS DOUBLE) AS VARCHAR) AS label_float_text, "
                     "CAST(CAST(label AS VARCHAR) AS INTEGER) AS label_int FROM embeddings")
SQL["take_rows"] = "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"
SQL["parse_labels"] = with_(FX_META) + f"SELECT doc_id, {joined(parse_labels('tags'))} AS labels, CAST(len({parse_labels('tags')}) AS INTEGER) AS n_labels FROM fx_meta"
SQL["first_label"] = with_(FX_META) + "SELECT doc_id, split_part(tags, '、', 1) AS label FROM fx_meta"
SQL["canonical_separator"] = with_(FX_META) + "SELECT doc_id, replace(tags, '、', ',') AS tags FROM fx_meta"
SQL["left_join_web"] = with_(FX_META, FX_WEB) + (
    "SELECT m.doc_id, w.page_id FROM (SELECT src, min(doc_id) AS doc_id FROM fx_meta GROUP BY src) m "
    "LEFT JOIN fx_web w ON m.src IS NOT DISTINCT FROM w.url")
SQL["merge_content"] = with_(FX_META, FX_WEB) + (
    "SELECT m.doc_id, w.page_id, w.content FROM (SELECT src, min(doc_id) AS doc_id FROM fx_meta GROUP BY src) m "
    "LEFT JOIN fx_web w ON m.src IS NOT DISTINCT FROM w.url "
    "WHERE w.content IS NOT NULL")
SQL["dedupe_first"] = with_(FX_META) + (
    "SELECT doc_id, src, tags FROM fx_meta QUALIFY row_number() OVER (PARTITION BY src ORDER BY doc_id) = 1")
SQL["prepare_long"] = with_(FX_META, FX_WEB, MERGED_LONG) + "SELECT doc_id, page_id, content, label FROM merged_long"
SQL["class_distribution"] = with_(FX_META, FX_WEB, MERGED_LONG) + "SELECT label, count(*) AS n FROM merged_long GROUP BY label"
SQL["stage_counts"] = with_(FX_META) + f"""SELECT count(*) AS n_rows, CAST(count_if(src IS NOT NULL) AS BIGINT) AS n_src,
  CAST(count_if(coalesce({strip('scene')} <> '', false)) AS BIGINT) AS n_scene,
  CAST(count_if(coalesce({strip('tags')} <> '', false)) AS BIGINT) AS n_tags,
  CAST(count_if(coalesce({strip('scene')} <> '' AND {strip('tags')} <> '', false)) AS BIGINT) AS n_clean FROM fx_meta"""
SQL["label_vocab_single"] = with_(FX_META, FX_WEB, MERGED_LONG) + (
    "SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS id FROM (SELECT DISTINCT label FROM merged_long)")
SQL["label_vocab_multi"] = with_(FX_META, CLEAN_SHORT) + (
    f"SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS id FROM "
    f"(SELECT DISTINCT unnest({parse_labels('tags')}) AS label FROM clean_short)")
SQL["label_ids"] = ("SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS id "
                    "FROM (SELECT DISTINCT lang AS label FROM documents)")
SQL["encode_label_id"] = with_(FX_META, FX_WEB, MERGED_LONG) + """SELECT m.doc_id, m.page_id, m.label, v.id AS label_id
FROM merged_long m JOIN (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS id
  FROM (SELECT DISTINCT label FROM merged_long)) v ON m.label = v.label"""
SQL["decode_label_id"] = """SELECT e.vec_id, e.label AS label_id, v.label FROM embeddings e LEFT JOIN
  (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS id FROM (SELECT DISTINCT source AS label FROM documents)) v
  ON e.label = v.id"""
SQL["pair_text_label"] = ("SELECT d.doc_id AS row_id, d.text, l.quality, l.toxic FROM documents d "
                          "JOIN labels l ON d.doc_id = l.doc_id")


# ------------------------------------------------------------------ ranks, batches, splits


def okey(*cols: str, seed: int = 42) -> str:
    parts = ", ".join([f"'{seed}'"] + [f"CAST({c} AS VARCHAR)" for c in cols])
    return f"md5(concat_ws(':', {parts}))"


SQL["exact_rank"] = f"SELECT doc_id AS row_id, row_number() OVER (ORDER BY {okey('doc_id')}, doc_id) AS rank FROM documents"
SQL["epoch_shuffle"] = (f"SELECT doc_id AS row_id, 1 AS epoch, {okey('1', 'doc_id')} AS shuffle_key, "
                        f"row_number() OVER (ORDER BY {okey('1', 'doc_id')}, doc_id) AS position FROM documents")
SQL["assign_batches"] = (f"SELECT row_id, CAST(floor((position - 1) / 16) AS BIGINT) AS batch_id, CAST((position - 1) % 16 AS INTEGER) AS pos_in_batch "
                         f"FROM (SELECT doc_id AS row_id, row_number() OVER (ORDER BY {okey('1', 'doc_id')}, doc_id) AS position FROM documents)")


def random_split_sql(source: str, test: float, val: float) -> str:
    """``source`` yields ``row_id``; test = ceil(test n), val = ceil(val (n - test)), hash order."""
    return f"""ranked AS (SELECT row_id, row_number() OVER (ORDER BY {okey('row_id')}, row_id) AS r, count(*) OVER () AS n FROM ({source})),
sized AS (SELECT row_id, r, ceil(CAST({test} AS DOUBLE) * n) AS n_test, n FROM ranked),
sized2 AS (SELECT row_id, r, n_test, ceil(CAST({val} AS DOUBLE) * (n - n_test)) AS n_val FROM sized)
SELECT row_id, CASE WHEN r <= n_test THEN 'test' WHEN r <= n_test + n_val THEN 'val' ELSE 'train' END AS split FROM sized2"""


SQL["split_random"] = with_(FX_META, CLEAN_SHORT, random_split_sql("SELECT row_id FROM clean_short", 0.1, 0.1))
SQL["split_holdout"] = with_(random_split_sql("SELECT doc_id AS row_id FROM documents", 0.2, 0.0))
SQL["split_fraction"] = f"""WITH ranked AS (SELECT doc_id AS row_id, row_number() OVER (ORDER BY {okey('doc_id')}, doc_id) AS r, count(*) OVER () AS n FROM labels),
sized AS (SELECT *, floor(CAST(0.8 AS DOUBLE) * n) AS n_train, floor(CAST(0.1 AS DOUBLE) * n) AS n_test FROM ranked)
SELECT row_id, CASE WHEN r <= n_train THEN 'train' WHEN r <= n_train + n_test THEN 'test' ELSE 'val' END AS split FROM sized"""
SQL["split_positional"] = """WITH ranked AS (SELECT page_id AS row_id, row_number() OVER (ORDER BY page_id) AS r, count(*) OVER () AS n FROM pages)
SELECT row_id, CASE WHEN r <= floor(CAST(0.8 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS split FROM ranked"""


SQL["epoch_orders"] = f"""WITH RECURSIVE placed AS (WITH {random_split_sql("SELECT doc_id AS row_id FROM documents", 0.1, 0.1)}),
ranks AS (SELECT row_id, split, CAST(row_number() OVER (PARTITION BY split ORDER BY {okey('row_id')}, row_id) - 1 AS BIGINT) AS x,
  count(*) OVER (PARTITION BY split) AS size FROM placed),
digests AS (SELECT o, r, md5(concat('42:', o, ':', r)) AS d FROM (SELECT unnest([0, 1, 2]) AS o), (SELECT unnest(range(0, 128)) AS r)),
ks AS (SELECT o, r, CAST(concat('0x', substr(d, 1, 15)) AS BIGINT) AS s, CAST(concat('0x', substr(d, 16, 7)) AS BIGINT) AS a,
  CAST(concat('0x', substr(d, 23, 7)) AS BIGINT) AS b FROM digests),
walk AS (SELECT row_id, split, size, e AS epoch, CASE WHEN split = 'train' THEN e ELSE 0 END AS o, x, 0 AS r FROM ranks, (SELECT unnest([1, 2]) AS e)
  UNION ALL
  SELECT row_id, split, size, epoch, o, CASE WHEN (m * m + s % 2147483647) % 2147483647 % 2 = 1 THEN y ELSE x END, r + 1
  FROM (SELECT *, (greatest(x, y) % 1073741824 * a + greatest(x, y) // 1073741824 * b + b) % 2147483647 AS m
    FROM (SELECT walk.*, s, a, b, (s % size + size - x) % size AS y FROM walk JOIN ks ON walk.o = ks.o AND walk.r = ks.r)))
SELECT row_id, split, CAST(epoch AS INTEGER) AS epoch, CAST(x // 16 AS BIGINT) AS batch_id, CAST(x % 16 AS INTEGER) AS pos_in_batch FROM walk WHERE r = 128"""


def quota_sql(name: str, src: str, n_col: str, draws: str, out: str) -> str:
    """scikit-learn's approximate mode with ties broken by label (``src`` has label, n_col)."""
    return f"""{name}_a AS (SELECT *, ({n_col} / sum({n_col}) OVER ()) * ({draws}) AS _cont FROM {src}),
{name}_b AS (SELECT *, floor(_cont) AS _fl FROM {name}_a),
{name}_c AS (SELECT *, ({draws}) - sum(_fl) OVER () AS _need, row_number() OVER (ORDER BY _cont - _fl DESC, label) AS _ord FROM {name}_b),
{name} AS (SELECT * EXCLUDE (_cont, _fl, _need, _ord), CAST(_fl + CASE WHEN _ord <= _need THEN 1 ELSE 0 END AS BIGINT) AS {out} FROM {name}_c)"""


SQL["split_stratified"] = with_(
    "cls AS (SELECT lang AS label, count(*) AS n FROM documents GROUP BY lang)",
    "tot AS (SELECT sum(n) AS total, ceil(CAST(0.3 AS DOUBLE) * sum(n)) AS n_tmp FROM cls)",
    "c1 AS (SELECT cls.*, tot.total - tot.n_tmp AS d1 FROM cls, tot)",
    quota_sql("q1", "c1", "n", "d1", "n_train"),
    "c2 AS (SELECT label, n, n_train, n - n_train AS n_rest FROM q1)",
    "tot2 AS (SELECT sum(n_rest) - ceil(CAST(0.5 AS DOUBLE) * sum(n_rest)) AS d2 FROM c2)",
    "c3 AS (SELECT c2.*, tot2.d2 FROM c2, tot2)",
    quota_sql("q2", "c3", "n_rest", "d2", "n_val"),
    f"ranked AS (SELECT doc_id AS row_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {okey('doc_id')}, doc_id) AS r FROM documents)",
) + """SELECT r.row_id, r.lang, CASE WHEN r.r <= q.n_train THEN 'train' WHEN r.r <= q.n_train + q.n_val THEN 'val' ELSE 'test' END AS split
FROM ranked r JOIN q2 q ON r.lang = q.label"""

# ------------------------------------------------------------------ multi-hot, short preparation, metadata

VOCAB_MULTI = f"""vocab AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS id
  FROM (SELECT DISTINCT unnest({parse_labels('tags')}) AS label FROM clean_short)),
vlist AS (SELECT list(label ORDER BY id) AS classes FROM vocab),
hot AS (SELECT c.row_id, list_transform(v.classes, lambda l: CASE WHEN list_contains({parse_labels('c.tags')}, l) THEN 1 ELSE 0 END) AS y
  FROM clean_short c, vlist v)"""

SQL["multi_hot"] = with_(FX_META, CLEAN_SHORT, VOCAB_MULTI) + (
    "SELECT row_id, array_to_string(y, '|') AS y, CAST(list_sum(y) AS INTEGER) AS n_hot FROM hot")
_split_cte = f"""ranked AS (SELECT row_id, row_number() OVER (ORDER BY {okey('row_id')}, row_id) AS r, count(*) OVER () AS n FROM clean_short),
sized AS (SELECT row_id, r, ceil(CAST(0.1 AS DOUBLE) * n) AS n_test, n FROM ranked),
sized2 AS (SELECT row_id, r, n_test, ceil(CAST(0.1 AS DOUBLE) * (n - n_test)) AS n_val FROM sized),
splits AS (SELECT row_id, CASE WHEN r <= n_test THEN 'test' WHEN r <= n_test + n_val THEN 'val' ELSE 'train' END AS split FROM sized2)"""
SQL["prepare_short"] = with_(FX_META, CLEAN_SHORT, VOCAB_MULTI, _split_cte) + (
    "SELECT h.row_id, s.split, array_to_string(h.y, '|') AS y FROM hot h JOIN splits s ON h.row_id = s.row_id")
SQL["label_metadata"] = with_(FX_META, CLEAN_SHORT, VOCAB_MULTI.split(",\nvlist")[0]) + """SELECT
  string_agg(label, '|' ORDER BY id) AS labels, CAST(count(*) AS INTEGER) AS num_labels, 'tags' AS label_col, 'scene' AS text_col,
  string_agg(label || '=' || CAST(id AS VARCHAR), '|' ORDER BY id) AS lab2id,
  string_agg(CAST(id AS VARCHAR) || '=' || label, '|' ORDER BY id) AS id2lab FROM vocab"""
SQL["load_label_metadata"] = SQL["label_vocab_multi"]

# ------------------------------------------------------------------ scores and losses

SIG = "list_transform(z, lambda x: 1.0 / (1.0 + exp(-x)))"
SQL["sigmoid_threshold"] = with_(FX_LOGITS) + (
    f"SELECT vec_id, array_to_string(list_transform({SIG}, lambda p: CAST(p >= 0.5 AS INTEGER)), '|') AS pred, "
    f"array_to_string(list_transform({SIG}, lambda p: CAST(floor(p * 1e6 + 0.5) AS BIGINT)), '|') AS p_millionths FROM fx_logits_m")
SQL["softmax_argmax"] = with_(FX_LOGITS) + (
    "SELECT vec_id, CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS pred, "
    "round(1.0 / list_sum(list_transform(z, lambda x: exp(x - list_max(z)))), 6) AS p_max FROM fx_logits")
SQL["bce_loss"] = with_(FX_LOGITS) + (
    "SELECT vec_id, round(list_sum(list_transform(list_zip(z, y_multi), lambda t: greatest(t[1], 0.0) - t[1] * t[2] + ln(1 + exp(-abs(t[1]))))) / len(z), 6) AS loss "
    "FROM fx_logits_m")
CE = "(ln(list_sum(list_transform(z, lambda x: exp(x - list_max(z))))) + list_max(z) - z[y + 1])"
SQL["ce_loss"] = with_(FX_LOGITS) + f"SELECT vec_id, round({CE}, 6) AS loss FROM fx_logits"
SQL["mean_loss"] = with_(FX_LOGITS) + f"SELECT round(coalesce(avg({CE}), 0.0), 6) AS loss FROM fx_logits"

# ------------------------------------------------------------------ metrics


def single_cls_sql(pairs: str) -> str:
    """CTEs cm / cls / sc over ``pairs(y_true, y_pred)``."""
    return f"""cm AS (SELECT y_true, y_pred, count(*) AS n FROM ({pairs}) GROUP BY y_true, y_pred),
tr AS (SELECT y_true AS label, sum(n) AS support, sum(CASE WHEN y_true = y_pred THEN n ELSE 0 END) AS tp FROM cm GROUP BY y_true),
pr AS (SELECT y_pred AS label, sum(n) AS predicted FROM cm GROUP BY y_pred),
cls AS (SELECT coalesce(tr.label, pr.label) AS label, coalesce(tp, 0) AS tp, coalesce(predicted, 0) - coalesce(tp, 0) AS fp,
  coalesce(support, 0) - coalesce(tp, 0) AS fn, coalesce(support, 0) AS support FROM tr FULL OUTER JOIN pr ON tr.label = pr.label),
sc AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM cls)"""


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) > 0 THEN ({a}) / ({b}) ELSE 0.0 END"


SUMMARY_COLS = f"""round({ratio('sum(tp)', 'sum(support)')}, 6) AS accuracy,
  round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1,
  round({ratio('sum(tp)', 'sum(tp) + sum(fp)')}, 6) AS micro_precision, round({ratio('sum(tp)', 'sum(tp) + sum(fn)')}, 6) AS micro_recall,
  round({ratio('2 * sum(tp)', '2 * sum(tp) + sum(fp) + sum(fn)')}, 6) AS micro_f1,
  round({ratio('sum(precision * support)', 'sum(support)')}, 6) AS weighted_precision,
  round({ratio('sum(recall * support)', 'sum(support)')}, 6) AS weighted_recall,
  round({ratio('sum(f1 * support)', 'sum(support)')}, 6) AS weighted_f1, CAST(sum(support) AS BIGINT) AS n"""

SINGLE_PAIRS = "SELECT y AS y_true, CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS y_pred FROM fx_logits"
MULTI_PAIRS = f"SELECT y_multi AS y_true, list_transform({SIG}, lambda p: CAST(p >= 0.5 AS INTEGER)) AS y_pred FROM fx_logits_m"
RESP_PAIRS = "SELECT vec_id, gold, replace(resp, chr(10), '') AS pred FROM fx_resp"

SQL["confusion_matrix"] = with_(FX_LOGITS) + f"SELECT y_true, y_pred, count(*) AS n FROM ({SINGLE_PAIRS}) GROUP BY y_true, y_pred"


def per_label_sql(pairs: str) -> str:
    return f"""z AS (SELECT unnest(range(len(y_true))) AS pos, unnest(y_true) AS t, unnest(y_pred) AS p FROM ({pairs})),
plc AS (SELECT CAST(pos AS INTEGER) AS pos, sum(t * p) AS tp, sum((1 - t) * p) AS fp, sum(t * (1 - p)) AS fn, sum(t) AS support FROM z GROUP BY pos),
pls AS (SELECT *, {ratio('tp', 'tp + fp')} AS precision, {ratio('tp', 'tp + fn')} AS recall, {ratio('2 * tp', '2 * tp + fp + fn')} AS f1 FROM plc)"""


SQL["per_label_counts"] = with_(FX_LOGITS, per_label_sql(MULTI_PAIRS)) + (
    "SELECT pos, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(support AS BIGINT) AS support FROM plc")
SQL["single_metrics"] = with_(FX_LOGITS, single_cls_sql(SINGLE_PAIRS)) + (
    f"SELECT round({ratio('sum(tp)', 'sum(support)')}, 6) AS accuracy, round(avg(precision), 6) AS precision, "
    "round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1 FROM sc")


def multi_summary_sql(pairs: str) -> str:
    return f"""SELECT round({ratio('sum(tp)', 'sum(tp) + sum(fp)')}, 6) AS micro_precision,
  round({ratio('sum(tp)', 'sum(tp) + sum(fn)')}, 6) AS micro_recall,
  round({ratio('2 * sum(tp)', '2 * sum(tp) + sum(fp) + sum(fn)')}, 6) AS micro_f1,
  round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1,
  (SELECT round(coalesce(avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END), 0.0), 6) FROM ({pairs})) AS subset_acc
FROM pls"""


SQL["multilabel_metrics"] = with_(FX_LOGITS, per_label_sql(MULTI_PAIRS)) + (
    "SELECT micro_f1, macro_f1, micro_precision, micro_recall, subset_acc FROM (" + multi_summary_sql(MULTI_PAIRS) + ")")
SQL["clean_response"] = with_(FX_RESP) + "SELECT vec_id, replace(resp, chr(10), '') AS resp FROM fx_resp"
SQL["sft_single_report"] = with_(FX_RESP, single_cls_sql("SELECT gold AS y_true, pred AS y_pred FROM (" + RESP_PAIRS + ")")) + (
    f"SELECT {SUMMARY_COLS} FROM sc")
SQL["classification_report"] = with_(FX_RESP, single_cls_sql("SELECT gold AS y_true, pred AS y_pred FROM (" + RESP_PAIRS + ")")) + f"""
SELECT CAST(label AS VARCHAR) AS row, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support, 0 AS ord FROM sc
UNION ALL SELECT 'accuracy', NULL, NULL, round({ratio('sum(tp)', 'sum(support)')}, 6), CAST(sum(support) AS BIGINT), 1 FROM sc
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT), 2 FROM sc
UNION ALL SELECT 'weighted avg', round({ratio('sum(precision * support)', 'sum(support)')}, 6), round({ratio('sum(recall * support)', 'sum(support)')}, 6),
  round({ratio('sum(f1 * support)', 'sum(support)')}, 6), CAST(sum(support) AS BIGINT), 3 FROM sc"""

MULTI_RESP = f"SELECT vec_id, {split_pred('gold')} AS gold_labels, {split_pred('resp')} AS pred_labels FROM fx_resp_multi"
FX_CLASSES_SQL = "['s0', 's1', 's2', 's3', 's4', 's5', 's6']"
BIN_RESP = (f"SELECT vec_id, list_transform({FX_CLASSES_SQL}, lambda c: CASE WHEN list_contains(gold_labels, c) THEN 1 ELSE 0 END) AS y_true, "
            f"list_transform({FX_CLASSES_SQL}, lambda c: CASE WHEN list_contains(pred_labels, c) THEN 1 ELSE 0 END) AS y_pred FROM ({MULTI_RESP})")
SQL["split_predicted_labels"] = with_(FX_RESP_MULTI) + (
    f"SELECT vec_id, array_to_string(gold_labels, '|') AS gold, array_to_string(pred_labels, '|') AS resp, "
    f"CAST(len(pred_labels) AS INTEGER) AS n_resp FROM ({MULTI_RESP})")
SQL["binarize_fixed"] = with_(FX_RESP_MULTI) + (
    f"SELECT vec_id, array_to_string(y_true, '|') AS y_gold, array_to_string(y_pred, '|') AS y_resp FROM ({BIN_RESP})")
SQL["sft_multi_report"] = with_(FX_RESP_MULTI, per_label_sql(BIN_RESP)) + multi_summary_sql(BIN_RESP)
SQL["per_label_report"] = with_(FX_RESP_MULTI, per_label_sql(BIN_RESP)) + (
    f"SELECT {FX_CLASSES_SQL}[pos + 1] AS label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, "
    "CAST(support AS BIGINT) AS support FROM pls")
SQL["best_epoch"] = with_(FX_EPOCHS) + "SELECT epoch, macro_f1 FROM fx_epochs ORDER BY macro_f1 DESC, epoch LIMIT 1"
SQL["improved_epochs"] = with_(FX_EPOCHS) + (
    "SELECT epoch, macro_f1, macro_f1 > coalesce(max(macro_f1) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1.0) "
    "AS improved FROM fx_epochs")


# ------------------------------------------------------------------ sinks and round trips

NL = "chr(10)"
SPLITS_SHORT = with_(FX_META, CLEAN_SHORT, VOCAB_MULTI, _split_cte)
SQL["csv_roundtrip"] = with_(FX_WEB) + "SELECT page_id, url, content FROM fx_web"
SQL["jsonl_roundtrip"] = "SELECT doc_id, text, lang FROM documents"
SQL["write_splits_json"] = SPLITS_SHORT + "SELECT c.row_id, c.scene, c.tags, s.split FROM clean_short c JOIN splits s ON c.row_id = s.row_id"
SQL["write_splits_csv"] = SPLITS_SHORT + "SELECT c.row_id, c.scene, s.split FROM clean_short c JOIN splits s ON c.row_id = s.row_id"
SQL["write_encoded"] = SQL["prepare_short"]
SQL["load_split"] = SPLITS_SHORT + (
    "SELECT c.row_id, c.scene, array_to_string(h.y, '|') AS y FROM clean_short c JOIN splits s ON c.row_id = s.row_id "
    "JOIN hot h ON c.row_id = h.row_id WHERE s.split = 'test'")

# ------------------------------------------------------------------ instruction-tuning records

MULTI_INSTRUCTION = MULTI_LABEL_INSTRUCTION
SINGLE_INSTRUCTION = SINGLE_LABEL_INSTRUCTION
FIXED_CATS = "[" + ", ".join(FIXED_CLASSES) + "]"


def record_cols(text: str, label: str, instruction: str, cats: str) -> str:
    return (f"'{instruction}' AS instruction, concat('文本:', {text}, ',类型选型:', '{cats}') AS input, "
            f"replace({label}, '、', ',') AS output")


def prompt_sql(instr: str, inp: str) -> str:
    return (f"concat('<|system|>', {NL}, ' ', {instr}, '<|endoftext|>', {NL}, '<|user|>', {NL}, {inp}, "
            f"'<|endoftext|>', {NL}, '<|assistant|>', {NL})")


def codepoints(x: str) -> str:
    return f"list_transform(string_split({x}, ''), lambda c: CAST(unicode(c) AS INTEGER))"


MULTI_RECORDS = f"""multi_records AS (SELECT c.row_id, s.split, {record_cols('c.scene', 'c.tags', MULTI_INSTRUCTION, FIXED_CATS)}
  FROM clean_short c JOIN splits s ON c.row_id = s.row_id WHERE s.split IN ('train', 'test'))"""
SINGLE_RECORDS = f"""single_ranked AS (SELECT *, row_number() OVER (ORDER BY doc_id, page_id) AS position, count(*) OVER () AS n FROM merged_long),
single_records AS (SELECT doc_id, page_id, CASE WHEN position <= floor(CAST(0.8 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS split,
  {record_cols('content', 'label', SINGLE_INSTRUCTION, '[]')} FROM single_ranked)"""
ECHO_SINGLE = f"""single_answers AS (SELECT *, CASE length(input) % 3 WHEN 0 THEN '无' WHEN 1 THEN concat({NL}, output) ELSE output END AS response
  FROM single_records WHERE split = 'test')"""

SQL["category_prompt"] = with_(FX_META) + f"SELECT doc_id, concat('[', array_to_string({parse_labels('tags')}, ', '), ']') AS categories FROM fx_meta"
SQL["sft_records"] = with_(FX_META, CLEAN_SHORT) + f"SELECT row_id, {record_cols('scene', 'tags', MULTI_INSTRUCTION, FIXED_CATS)} FROM clean_short"
SQL["build_sft_multi"] = with_(FX_META, CLEAN_SHORT, VOCAB_MULTI, _split_cte, MULTI_RECORDS) + "SELECT * FROM multi_records"
SQL["build_sft_single"] = with_(FX_META, FX_WEB, MERGED_LONG, SINGLE_RECORDS) + "SELECT * FROM single_records"
SQL["sft_jsonl"] = with_(FX_META, CLEAN_SHORT, VOCAB_MULTI, _split_cte, MULTI_RECORDS) + "SELECT instruction, input, output FROM multi_records"
SQL["render_prompt"] = with_(FX_META, CLEAN_SHORT, VOCAB_MULTI, _split_cte, MULTI_RECORDS) + (
    f"SELECT row_id, {prompt_sql('instruction', 'input')} AS prompt FROM multi_records")
SQL["chat_messages"] = with_(FX_META, FX_WEB, MERGED_LONG, SINGLE_RECORDS, ECHO_SINGLE) + f"""SELECT doc_id, page_id, 3 AS n_messages,
  concat('system: ', instruction, {NL}, {NL}, 'user: ', input, {NL}, {NL}, 'assistant: ', replace(response, {NL}, '')) AS transcript
  FROM single_answers"""
SQL["render_chat"] = f"""SELECT conv_id, concat(string_agg(concat('<|', role, '|>', {NL}, text, '<|endoftext|>', {NL}), '' ORDER BY turn),
  '<|assistant|>', {NL}) AS prompt, CAST(count(*) AS INTEGER) AS n_turns FROM conversations GROUP BY conv_id"""

# ------------------------------------------------------------------ token sequences

TOKENS = r"""toks AS (SELECT doc_id, regexp_extract_all(regexp_replace(lower(text), '([一-鿿])', ' \1 ', 'g'),
  '[\p{L}\p{N}]+|[^\s\x0b\x1c-\x1f\x85\p{Z}\p{L}\p{N}]') AS t FROM documents),
tcounts AS (SELECT tok, count(*) AS n FROM (SELECT unnest(t) AS tok FROM toks) GROUP BY tok),
tvocab AS (SELECT tok AS token, CAST(row_number() OVER (ORDER BY n DESC, tok) + 3 AS INTEGER) AS id, n FROM tcounts
  ORDER BY n DESC, tok LIMIT 5000),
tpos AS (SELECT doc_id, unnest(t) AS tok, unnest(range(1, len(t) + 1)) AS pos FROM toks),
enc AS (SELECT d.doc_id, coalesce(flatten(list(CASE WHEN v.id IS NOT NULL THEN [v.id]
    ELSE list_concat([1], list_transform(string_split(p.tok, ''), lambda c: CAST(unicode(c) + 4194304 AS INTEGER))) END ORDER BY p.pos)
    FILTER (WHERE p.pos IS NOT NULL)), []) AS ids
  FROM documents d LEFT JOIN tpos p ON d.doc_id = p.doc_id LEFT JOIN tvocab v ON p.tok = v.token GROUP BY d.doc_id)"""

SQL["token_vocab"] = with_(TOKENS) + "SELECT token, id, n FROM tvocab"
SQL["encode_text"] = with_(TOKENS) + "SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_ids, array_to_string(ids, ' ') AS input_ids FROM enc"
SQL["decode_ids"] = with_(TOKENS) + "SELECT doc_id, array_to_string(t, ' ') AS decoded FROM toks"
FIXED128 = "list_concat([2], list_slice(ids, 1, 126), [3])"
SQL["encode_fixed"] = with_(TOKENS) + f"""SELECT doc_id,
  array_to_string(list_concat({FIXED128}, list_transform(range(128 - len({FIXED128})), lambda x: 0)), ' ') AS input_ids,
  CAST(len({FIXED128}) AS INTEGER) AS n_real, 128 AS n_types FROM enc"""
SQL["tokenizer_udf"] = f"SELECT doc_id, array_to_string({codepoints('text')}, ' ') AS ids FROM documents"

MASKED = f"""masked0 AS (SELECT row_id, {codepoints(prompt_sql('instruction', 'input'))} AS p, {codepoints('output')} AS r FROM multi_records),
masked AS (SELECT row_id, list_slice(list_concat(p, r, [0]), 1, 512) AS ids,
  list_slice(list_concat(list_transform(p, lambda x: -100), r, [0]), 1, 512) AS labels FROM masked0)"""
SQL["sft_mask_labels"] = with_(FX_META, CLEAN_SHORT, VOCAB_MULTI, _split_cte, MULTI_RECORDS, MASKED) + """SELECT row_id, array_to_string(ids, ' ') AS input_ids,
  CAST(len(ids) AS INTEGER) AS n_mask, array_to_string(labels, ' ') AS labels,
  CAST(len(list_filter(labels, lambda x: x <> -100)) AS INTEGER) AS n_target FROM masked"""
SQL["strip_prompt_ids"] = with_(FX_META, CLEAN_SHORT, VOCAB_MULTI, _split_cte, MULTI_RECORDS) + f"""SELECT row_id, array_to_string(s, ' ') AS ids FROM (
  SELECT row_id, list_slice(o, len(i) + 1, len(o)) AS s FROM (
    SELECT row_id, {codepoints(prompt_sql('instruction', 'input'))} AS i, {codepoints(f"concat({prompt_sql('instruction', 'input')}, output)")} AS o
    FROM multi_records))"""
SQL["pad_batches"] = with_(FX_META, CLEAN_SHORT, VOCAB_MULTI, _split_cte, MULTI_RECORDS, MASKED) + f"""SELECT row_id, batch_id,
  array_to_string(list_concat(ids, list_transform(range(max(len(ids)) OVER (PARTITION BY batch_id) - len(ids)), lambda x: 0)), ' ') AS input_ids,
  CAST(len(ids) AS INTEGER) AS mask_sum,
  array_to_string(list_concat(labels, list_transform(range(max(len(ids)) OVER (PARTITION BY batch_id) - len(ids)), lambda x: -100)), ' ') AS labels
FROM (SELECT *, CAST(floor((row_number() OVER (ORDER BY {okey('row_id')}, row_id) - 1) / 16) AS BIGINT) AS batch_id FROM masked)"""

# ------------------------------------------------------------------ scoring and generated answers

SQL["batch_score"] = with_(FX_LOGITS) + (
    "SELECT vec_id, CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS pred, "
    "round(1.0 / list_sum(list_transform(z, lambda x: exp(x - list_max(z)))), 6) AS score FROM fx_logits")
SQL["eval_generated_single"] = with_(
    FX_META, FX_WEB, MERGED_LONG, SINGLE_RECORDS, ECHO_SINGLE,
    single_cls_sql(f"SELECT output AS y_true, replace(response, {NL}, '') AS y_pred FROM single_answers"),
) + f"SELECT {SUMMARY_COLS} FROM sc"

MULTI_ANSWERS = f"""multi_answers AS (SELECT row_id, output, CASE length(input) % 3 WHEN 0 THEN '无' WHEN 1 THEN concat(output, '、未知') ELSE output END AS response
  FROM multi_records WHERE split = 'test'),
mclasses AS (SELECT list(DISTINCT label ORDER BY label) AS cl FROM (SELECT unnest({split_pred('output')}) AS label FROM multi_records)),
mbin AS (SELECT list_transform(m.cl, lambda c: CASE WHEN list_contains(g, c) THEN 1 ELSE 0 END) AS y_true,
  list_transform(m.cl, lambda c: CASE WHEN list_contains(p, c) THEN 1 ELSE 0 END) AS y_pred
  FROM (SELECT {split_pred('output')} AS g, {split_pred(f"replace(response, {NL}, '')")} AS p FROM multi_answers), mclasses m)"""
SQL["eval_generated_multi"] = with_(
    FX_META, CLEAN_SHORT, VOCAB_MULTI, _split_cte, MULTI_RECORDS, MULTI_ANSWERS, per_label_sql("SELECT * FROM mbin")
) + multi_summary_sql("SELECT * FROM mbin")


# ------------------------------------------------------------------ loader

def encoded_sql(src: str, key: str, text: str, n: int) -> str:
    """CTE ``lenc`` (key, t): the first ``n`` ids of every text of ``src``, over its own vocabulary."""
    return f"""ltoks AS (SELECT {key}, regexp_extract_all(regexp_replace(lower({text}), '([一-鿿])', ' \\1 ', 'g'),
  '[\\p{{L}}\\p{{N}}]+|[^\\s\\x0b\\x1c-\\x1f\\x85\\p{{Z}}\\p{{L}}\\p{{N}}]') AS t FROM {src}),
ltok AS (SELECT {key}, unnest(t) AS tok, unnest(range(1, len(t) + 1)) AS pos FROM ltoks),
lcount AS (SELECT tok, count(*) AS n FROM ltok GROUP BY tok),
ltv AS (SELECT tok AS token, CAST(row_number() OVER (ORDER BY n DESC, tok) + 3 AS INTEGER) AS id FROM lcount ORDER BY n DESC, tok LIMIT 5000),
lenc AS (SELECT k.{key}, coalesce(list_slice(flatten(list(CASE WHEN v.id IS NOT NULL THEN [v.id]
  ELSE list_concat([1], list_transform(string_split(p.tok, ''), lambda c: CAST(unicode(c) + 4194304 AS INTEGER))) END ORDER BY p.pos)
  FILTER (WHERE p.pos IS NOT NULL)), 1, {n}), []) AS t FROM {src} k LEFT JOIN ltok p ON k.{key} = p.{key} LEFT JOIN ltv v ON p.tok = v.token GROUP BY k.{key})"""


def batch_order(key: str, fixed: str) -> str:
    """Place in the split's order; the splits of ``fixed`` (an SQL list) keep one order in every epoch."""
    return (f"row_number() OVER (PARTITION BY split ORDER BY md5(concat_ws(':', '42', CASE WHEN split IN ({fixed}) THEN '0' ELSE '1' END, "
            f"CAST({key} AS VARCHAR))), {key}) AS p")


def batch_columns(size: int, n: int) -> str:
    """Batch, place and padded ids of rows with a place ``p`` and ids ``t`` of at most ``n``."""
    return f"""split, CAST(floor((p - 1) / {size}) AS BIGINT) AS batch_id, CAST((p - 1) % {size} AS INTEGER) AS pos_in_batch,
  CAST(len(t) + 2 AS INTEGER) AS n_real,
  array_to_string(list_concat([2], t, [3], list_transform(range({n} - len(t)), lambda x: 0)), ' ') AS input_ids"""


LOAD_BATCHES = f"""keyed AS (SELECT *, concat_ws(':', CAST(doc_id AS VARCHAR), CAST(page_id AS VARCHAR)) AS row_key FROM merged_long),
lvocab AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS id FROM (SELECT DISTINCT label FROM keyed)),
{encoded_sql('keyed', 'row_key', 'content', 510)},
lranked AS (SELECT k.row_key, v.id AS label_id, l.t, row_number() OVER (ORDER BY {okey('k.row_key')}, k.row_key) AS r, count(*) OVER () AS n
  FROM keyed k JOIN lvocab v ON k.label = v.label JOIN lenc l ON k.row_key = l.row_key),
lsplit AS (SELECT *, CASE WHEN r <= floor(CAST(0.8 AS DOUBLE) * n) THEN 'train' WHEN r <= floor(CAST(0.8 AS DOUBLE) * n) + floor(CAST(0.1 AS DOUBLE) * n)
  THEN 'test' ELSE 'val' END AS split FROM lranked),
lbatch AS (SELECT *, {batch_order('row_key', "'test'")} FROM lsplit)"""
SQL["load_batches"] = with_(FX_META, FX_WEB, MERGED_LONG, LOAD_BATCHES) + f"SELECT row_key, label_id, {batch_columns(16, 510)} FROM lbatch"
SQL["load_batches_short"] = with_(
    FX_META, CLEAN_SHORT, VOCAB_MULTI, _split_cte, encoded_sql("clean_short", "row_id", "scene", 126),
    f"""lbatch AS (SELECT *, {batch_order('row_id', "'val', 'test'")} FROM (SELECT l.row_id, l.t, s.split, array_to_string(h.y, '|') AS y
  FROM lenc l JOIN splits s ON l.row_id = s.row_id JOIN hot h ON l.row_id = h.row_id))""",
) + f"SELECT row_id, y, {batch_columns(16, 126)} FROM lbatch"
SQL["load_batches_stratified"] = with_(
    f"strat AS ({SQL['split_stratified']})",
    "lvocab AS (SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS id FROM (SELECT DISTINCT lang FROM documents))",
    encoded_sql("documents", "doc_id", "text", 254),
    f"""lbatch AS (SELECT *, {batch_order('row_id', "'val', 'test'")} FROM (SELECT s.row_id, s.split, l.t, v.id AS label_id
  FROM strat s JOIN lenc l ON s.row_id = l.doc_id JOIN lvocab v ON s.lang = v.lang))""",
) + f"SELECT row_id, label_id, {batch_columns(8, 254)} FROM lbatch"
SQL["select_and_test_multi"] = """WITH t AS (SELECT count(*) AS n FROM documents JOIN labels USING (doc_id)),
u AS (SELECT n, CAST(ceil(CAST(0.2 AS DOUBLE) * n) AS BIGINT) AS n_test FROM t),
v AS (SELECT n, n_test, CAST(ceil(CAST(0.2 AS DOUBLE) * (n - n_test)) AS BIGINT) AS n_val FROM u)
SELECT n - n_test - n_val AS n_train, n_val, n_test, n_test AS n_equal FROM v"""
SQL["model_roundtrip"] = """SELECT CAST(ceil(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT) AS n_rows, CAST(ceil(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT) AS n_equal,
  CAST(ceil(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT) AS n_decoded FROM documents"""
SQL["select_and_test_short"] = SPLITS_SHORT + """SELECT count(*) FILTER (WHERE s.split = 'train') AS n_train, count(*) FILTER (WHERE s.split = 'val') AS n_val,
  count(*) FILTER (WHERE s.split = 'test') AS n_test, any_value(v.n) AS n_labels, any_value(2 * v.n) AS n_heads, any_value(2 * v.n) AS n_optimal
  FROM splits s, (SELECT count(*) AS n FROM vocab) v"""
