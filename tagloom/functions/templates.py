"""Prompt and record templates for instruction tuning and chat rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import canonical_separator

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's strings exactly).
# Instruction for the multi-label task:
MULTI_LABEL_INSTRUCTION = (
    "你是一个文本多标签分类专家。给定一段文本和一组备选标签，请从中选择所有适用的标签，"
    "并且只输出这些标签的列表，用逗号分隔；如果没有任何标签适用，则输出“无”,注意：只能从备选标签中选择，不要生成新的标签。"
)
# Instruction for the single-label task:
SINGLE_LABEL_INSTRUCTION = "你是一个文本分类领域的专家，你会接收到一段文本和几个潜在的分类选项，请输出文本内容的正确类型。"
# Fixed candidate classes of the multi-label task, in this order:
FIXED_CLASSES = ["事故处理", "停车管控", "安全引导", "拥堵治理", "流量检测", "流量监测", "车辆违法"]
# Record input layout: "文本:{text},类型选型:{categories}"
INPUT_TEXT_PREFIX = "文本:"
INPUT_CATEGORY_PREFIX = ",类型选型:"
# Training prompt layout (note the space after the first newline):
#   "<|system|>\n {instruction}<|endoftext|>\n<|user|>\n{input}<|endoftext|>\n<|assistant|>\n"
PROMPT_SYSTEM = "<|system|>\n "
PROMPT_END = "<|endoftext|>\n"
PROMPT_USER = "<|user|>\n"
PROMPT_ASSISTANT = "<|assistant|>\n"
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def category_prompt(categories) -> Column:
    """``"[" + ", ".join(categories) + "]"`` from an array column or a Python list."""
    if isinstance(categories, (list, tuple)):
        cats = F.array(*[F.lit(c) for c in categories]) if categories else F.array().cast("array<string>")
    else:
        cats = _col(categories)
    return F.concat(F.lit("["), F.array_join(cats, ", "), F.lit("]"))


def sft_record(text, label, instruction: str, categories) -> Column:
    """struct(instruction, input, output) for one labelled row."""
    inp = F.concat(F.lit(INPUT_TEXT_PREFIX), _col(text), F.lit(INPUT_CATEGORY_PREFIX), category_prompt(categories))
    return F.struct(
        F.lit(instruction).alias("instruction"),
        inp.alias("input"),
        canonical_separator(_col(label)).alias("output"),
    )


def render_prompt(instruction, user_input) -> Column:
    return F.concat(
        F.lit(PROMPT_SYSTEM),
        _col(instruction),
        F.lit(PROMPT_END + PROMPT_USER),
        _col(user_input),
        F.lit(PROMPT_END + PROMPT_ASSISTANT),
    )


def chat_messages(instruction, user_input, response=None) -> Column:
    """array<struct<role,content>>: system, user, and the assistant answer when given."""
    msgs = [
        F.struct(F.lit("system").alias("role"), _col(instruction).alias("content")),
        F.struct(F.lit("user").alias("role"), _col(user_input).alias("content")),
    ]
    if response is not None:
        msgs.append(F.struct(F.lit("assistant").alias("role"), _col(response).alias("content")))
    return F.array(*msgs)


def join_messages(messages, sep: str = "\n\n") -> Column:
    """``role: content`` of each message, joined by ``sep``."""
    return F.array_join(
        F.transform(_col(messages), lambda m: F.concat(m["role"], F.lit(": "), m["content"])),
        sep,
    )
