"""Array expressions for scores, labels and token sequences (higher-order
functions, kept inside whole-stage codegen where Spark allows)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORE_INDEX = -100


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sigmoid(z) -> Column:
    return F.transform(_col(z), lambda x: F.lit(1.0) / (F.lit(1.0) + F.exp(-x)))


def threshold(p, t: float = 0.5) -> Column:
    """``prob >= t`` as 0/1 ints."""
    return F.transform(_col(p), lambda x: (x >= F.lit(t)).cast("int"))


def softmax(z) -> Column:
    z = _col(z)
    m = F.array_max(z)
    e = F.transform(z, lambda x: F.exp(x - m))
    s = F.aggregate(e, F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / s)


def argmax(z) -> Column:
    """0-based index of the first maximum (NaN counts as greatest)."""
    z = _col(z)
    return (F.array_position(z, F.array_max(z)) - F.lit(1)).cast("int")


def bce_with_logits(z, y) -> Column:
    """Mean over labels of the numerically stable binary cross-entropy."""
    z, y = _col(z), _col(y)
    terms = F.zip_with(
        z,
        y,
        lambda x, t: F.greatest(x, F.lit(0.0)) - x * t + F.log1p(F.exp(-F.abs(x))),
    )
    return F.aggregate(terms, F.lit(0.0).cast("double"), lambda a, v: a + v) / F.size(z)


def cross_entropy(z, y) -> Column:
    """``logsumexp(z) - z[y]`` with integer class ``y`` (0-based)."""
    z, y = _col(z), _col(y)
    m = F.array_max(z)
    lse = F.log(F.aggregate(F.transform(z, lambda x: F.exp(x - m)), F.lit(0.0).cast("double"), lambda a, v: a + v)) + m
    return lse - F.element_at(z, y + F.lit(1))


def string_array(values: list[str]) -> Column:
    """A list of strings as one array constant: a single literal, split by a character that
    none of them holds and folded once by the optimizer, so a long list adds no plan nodes."""
    if not values:
        return F.array().cast("array<string>")
    used = set().union(*values)
    sep = next(c for c in map(chr, range(0xE000, 0x110000)) if c not in used)
    return F.split(F.lit(sep.join(values)), sep, -1)


def multi_hot(labels, classes: list[str]) -> Column:
    """Indicator array over ``classes`` (in the given order) as float.

    Unknown labels are ignored, duplicates count once, null labels give zeros.
    """
    labels = _col(labels)
    vocab = string_array(classes)
    return F.transform(vocab, lambda lab: F.coalesce(F.array_contains(labels, lab), F.lit(False)).cast("float"))


def strip_prompt_ids(inp, out) -> Column:
    """``out[len(inp):]``; empty when the output is not longer than the input."""
    inp, out = _col(inp), _col(out)
    return F.slice(out, F.size(inp) + F.lit(1), F.greatest(F.size(out) - F.size(inp), F.lit(0)))


def masked_sequence(prompt_ids, response_ids, pad_id: int, max_length: int) -> dict[str, Column]:
    """Causal-LM training row: ids = prompt + response + [pad]; mask all 1;
    labels = -100 x prompt + response + [pad]; all cut on the right to ``max_length``."""
    p, r = _col(prompt_ids), _col(response_ids)
    pad = F.array(F.lit(pad_id))
    ids = F.concat(p, r, pad)
    mask = F.array_repeat(F.lit(1), F.size(ids))
    labels = F.concat(F.array_repeat(F.lit(IGNORE_INDEX), F.size(p)), r, pad)
    cut = {
        "input_ids": F.slice(ids, 1, max_length),
        "attention_mask": F.slice(mask, 1, max_length),
        "labels": F.slice(labels, 1, max_length),
    }
    cut["n_target"] = F.size(F.filter(cut["labels"], lambda x: x != F.lit(IGNORE_INDEX)))
    return cut


def fixed_length(ids, max_length: int, cls_id: int, sep_id: int, pad_id: int) -> dict[str, Column]:
    """Encoder input of exactly ``max_length``: [CLS] ids[:max_length-2] [SEP] then padding;
    mask 1 on real positions, 0 on padding; token types all 0."""
    ids = _col(ids)
    body = F.slice(ids, 1, max_length - 2)
    real = F.concat(F.array(F.lit(cls_id)), body, F.array(F.lit(sep_id)))
    n_pad = F.lit(max_length) - F.size(real)
    return {
        "input_ids": F.concat(real, F.array_repeat(F.lit(pad_id), n_pad)),
        "attention_mask": F.concat(F.array_repeat(F.lit(1), F.size(real)), F.array_repeat(F.lit(0), n_pad)),
        "token_type_ids": F.array_repeat(F.lit(0), F.lit(max_length)),
    }


def pad_to(arr, length, value) -> Column:
    arr = _col(arr)
    return F.concat(arr, F.array_repeat(F.lit(value), F.greatest(_col(length) - F.size(arr), F.lit(0))))
