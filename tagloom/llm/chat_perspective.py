"""Multi-party perspective rotation of conversations.

Native: DataFrame functions only. For every participant of a conversation the dialogue is
rendered with that speaker as the assistant and all others as named users; system turns stay system
turns and are no participant. Each row is one turn as one participant sees it, with its place in
the dialogue and the place of what is trained on (the assistant's words and end mark), in code
points. Rows instead of one string keep a conversation of any length out of a single task:
places are running sums within blocks of turns, plus the sums of the blocks before.
``dialogues`` joins them to strings for conversations known to be short.

Order: turn (nulls first), speaker, text. Null roles speak as ``unknown``, null texts are empty. Repeated
rows are repeated turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The marks of the chat format.
START, END, SYSTEM, NOBODY = "<|im_start|>", "<|im_end|>", "system", "unknown"
BLOCK = 256


def header(as_role: Column, speaker: Column) -> Column:
    return F.concat(F.lit(START), as_role, F.when(as_role == "user", F.concat(F.lit(" name="), speaker)).otherwise(F.lit("")), F.lit("\n"))


def rotate_perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                        text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """conv_id, participant, seq, turn, speaker, as_role, segment, start, end, mask_start, mask_end
    (both null for turns that are not trained on)."""
    t = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit(NOBODY)).alias("speaker"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
                     F.floor(F.col(turn_col) / block).alias("_block"))
    who = t.where(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("_c"), F.col("speaker").alias("participant")).distinct()
    seen = t.join(who, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
    as_role = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(F.col("speaker") == F.col("participant"), "assistant").otherwise("user")
    seen = seen.withColumn("as_role", as_role)
    head = header(F.col("as_role"), F.col("speaker"))
    # lengths alone go through the shuffles; segments are put together at the end
    seen = seen.withColumn("_n", F.length(head) + F.length("_text") + len(END) + 1)
    keys = ["conv_id", "participant"]
    inner = Window.partitionBy(*keys, "_block").orderBy(F.col("turn").asc_nulls_first(), "speaker", "_text")
    before = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = seen.withColumn("_end", F.sum("_n").over(before)).withColumn("_seq", F.row_number().over(inner))
    outer = Window.partitionBy(*keys).orderBy(F.col("_block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    bases = seen.groupBy(*keys, "_block").agg(F.sum("_n").alias("_s"), F.count(F.lit(1)).alias("_k")).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("_block").alias("_b"),
        F.coalesce(F.sum("_s").over(outer), zero).alias("_base"), F.coalesce(F.sum("_k").over(outer), zero).alias("_count"))
    placed = local.join(bases, F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("participant") == F.col("_participant"))
                        & F.col("_block").eqNullSafe(F.col("_b")))
    end = F.col("_base") + F.col("_end")
    start = end - F.col("_n")
    own = F.col("as_role") == "assistant"
    return placed.select("conv_id", "participant", (F.col("_count") + F.col("_seq") - 1).alias("seq"), "turn", "speaker", "as_role",
                         F.concat(head, "_text", F.lit(END + "\n")).alias("segment"), start.alias("start"), end.alias("end"),
                         F.when(own, start + F.length(head)).alias("mask_start"), F.when(own, end - 1).alias("mask_end"))


def dialogues(rotated: DataFrame) -> DataFrame:
    """conv_id, participant, dialogue, masks: one string each, for conversations that fit a row."""
    return rotated.groupBy("conv_id", "participant").agg(
        F.sort_array(F.collect_list(F.struct("seq", "segment"))).alias("_s"),
        F.sort_array(F.collect_list(F.when(F.col("mask_start").isNotNull(), F.struct("mask_start", "mask_end")))).alias("masks")).select(
        "conv_id", "participant", F.array_join(F.transform("_s", lambda x: x["segment"]), "").alias("dialogue"), "masks")
