"""Instruction-tuning datasets and the evaluation of generated answers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import templates as TP
from ..functions.text import clean_response, split_predicted_labels
from ..operators import metrics as M
from ..operators.score import batch_score
from ..operators.split import split_by_position


def build_sft_multi(split_rows: DataFrame, text_col: str = "scene", label_col: str = "tags",
                    classes: Sequence[str] = TP.FIXED_CLASSES, splits: Sequence[str] = ("train", "test")) -> DataFrame:
    """Multi-label SFT records from the train/test split rows: fixed candidate list, '、' -> ','."""
    rows = split_rows.where(F.col("split").isin(*splits))
    rec = TP.sft_record(text_col, label_col, TP.MULTI_LABEL_INSTRUCTION, list(classes))
    return rows.select("row_id", "split", rec.alias("r")).select("row_id", "split", "r.*")


def build_sft_single(merged: DataFrame, categories: Sequence[str] = (), train_frac: float = 0.8,
                     drop_last: bool = False) -> DataFrame:
    """Single-label SFT records from the merged table, split by position (first 80 % train).

    Position is the merged table's row order ``(doc_id, page_id)``, whatever the type of the ids. Records never move.
    ``drop_last=True`` reproduces the reference's loss of the last row.
    """
    rec = TP.sft_record("content", "label", TP.SINGLE_LABEL_INSTRUCTION, list(categories))
    placed = split_by_position(merged, ["doc_id", "page_id"], train_frac, drop_last)
    return placed.select("doc_id", "page_id", "split", rec.alias("r")).select("doc_id", "page_id", "split", "r.*")


def prompt_of(records: DataFrame) -> F.Column:
    return TP.render_prompt("instruction", "input")


CHAT_TURN = "<|{role}|>\n{text}" + TP.PROMPT_END


def _render_turn(fmt: str, m) -> F.Column:
    """``fmt`` with ``{role}`` / ``{text}`` placeholders -> concat of literals and struct fields."""
    parts = [p for p in re.split(r"(\{role\}|\{text\})", fmt) if p]
    return F.concat(*[m["_role"] if p == "{role}" else m["_text"] if p == "{text}" else F.lit(p) for p in parts])


def render_chat(turns: DataFrame, conv_col: str = "conv_id", order_col: str = "turn", role_col: str = "role",
                text_col: str = "text", turn_format: str = CHAT_TURN,
                generation_prompt: str | None = TP.PROMPT_ASSISTANT) -> DataFrame:
    """One prompt string per conversation: each turn rendered with ``turn_format`` in turn order,
    then ``generation_prompt`` (the assistant header) unless it is None."""
    msgs = F.sort_array(F.collect_list(F.struct(F.col(order_col).alias("_o"), F.col(role_col).alias("_role"),
                                                F.col(text_col).alias("_text"))))
    body = F.array_join(F.transform("_m", lambda m: _render_turn(turn_format, m)), "")
    tail = F.lit(generation_prompt or "")
    return turns.groupBy(conv_col).agg(msgs.alias("_m")).select(conv_col, F.concat(body, tail).alias("prompt"), F.size("_m").alias("n_turns"))


def chat_transcript(records: DataFrame, response_col: str) -> DataFrame:
    """Messages system/user/assistant and their ``role: content`` transcript joined by blank lines."""
    msgs = TP.chat_messages("instruction", "input", clean_response(response_col))
    return records.withColumn("messages", msgs).withColumn("transcript", TP.join_messages("messages"))


def generate(records: DataFrame, factory, schema) -> DataFrame:
    """Batch generation over the records (any model plugs in through the factory)."""
    return batch_score(records, factory, schema)


def eval_generated_single(answers: DataFrame, gold_col: str = "output", resp_col: str = "response") -> tuple[DataFrame, DataFrame]:
    """Accuracy + macro/micro/weighted P/R/F1 and the per-class report of generated single labels."""
    pairs = answers.select(F.col(gold_col).alias("gold"), clean_response(resp_col).alias("pred"))
    summary = M.single_label_summary(M.confusion_matrix(pairs, "gold", "pred"))
    return summary, M.classification_report(pairs, "gold", "pred")


def eval_generated_multi(answers: DataFrame, classes: Sequence[str], gold_col: str = "output", resp_col: str = "response"):
    """Micro/macro P/R/F1, subset accuracy and per-label table over a fixed class list."""
    pairs = answers.select(
        split_predicted_labels(gold_col).alias("g"), split_predicted_labels(clean_response(resp_col)).alias("p")
    )
    return M.fixed_class_report(pairs, "g", "p", classes)
