"""Composite preparation jobs (the reference's ``process_data`` mode).

Both return lazy DataFrames; sinks are separate calls so a caller can write
any subset. The driver only ever sees a few counts and cut keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import first_label, parse_labels
from ..operators.aggregate import dedupe_first
from ..operators.clean import clean_text_columns, find_column, normalize_headers, require_columns
from ..operators.joins import merge_content
from ..operators.split import random_split_column
from ..operators.targets import dense_targets, sparse_targets
from ..operators.vocab import dense_ids, label_metadata, label_vocab_single
from ..sources import tables


@dataclass
class ShortConfig:
    text_col: str = "scene"
    label_col_contains: str = "tags"
    id_col: str = "doc_id"
    test_size: float = 0.1
    val_size: float = 0.1
    seed: int = 42


@dataclass
class LongConfig:
    meta_key: str = "src"
    meta_label: str = "tags"
    meta_order: str = "doc_id"
    web_key: str = "url"
    web_content: str = "content"
    web_order: str = "page_id"


@dataclass
class Prepared:
    data: DataFrame
    vocab: DataFrame
    metadata: DataFrame
    # stage -> Observation with a row count ``n``; filled by the first action on ``data``
    stage_counts: dict = field(default_factory=dict)
    # multi-label jobs: ``row_id``, ``label_ids`` (sorted), ``split``
    targets: DataFrame | None = None

    def counts(self) -> dict[str, int]:
        return {k: o.get["n"] for k, o in self.stage_counts.items()}

    def dense(self) -> DataFrame:
        """``row_id, split, y``: the targets as vectors over all labels, for a sink or a loader that wants them."""
        return self.targets.select("row_id", "split", dense_targets("label_ids", self.vocab.count()).alias("y"))

    def release(self) -> None:
        """Drop cached intermediates (the cleaned short-text table) once the sinks are written."""
        for df in [self.data, self.vocab, *self._persisted]:
            df.unpersist()

    _persisted: list = field(default_factory=list)


def clean_short(meta: DataFrame, cfg: ShortConfig = ShortConfig()) -> tuple[DataFrame, str]:
    meta = normalize_headers(meta)
    require_columns(meta, [cfg.text_col, cfg.id_col])
    label_col = find_column(meta, cfg.label_col_contains)
    df = meta.select(F.col(cfg.id_col).alias("row_id"), cfg.text_col, label_col)
    return clean_text_columns(df, [cfg.text_col, label_col]), label_col


def _observed(df: DataFrame, stages: dict | None, name: str) -> DataFrame:
    """Record the row count of ``df`` as an ``Observation`` (filled by the job that runs the plan)."""
    if stages is None:
        return df
    stages[name] = Observation(name)
    return df.observe(stages[name], F.count(F.lit(1)).alias("n"))


def prepare_short(meta: DataFrame, cfg: ShortConfig = ShortConfig(), observe: bool = False) -> Prepared:
    """Clean -> parse labels -> vocabulary -> label ids per row -> exact random split."""
    stages: dict | None = {} if observe else None
    df, label_col = clean_short(_observed(meta, stages, "meta_rows"), cfg)
    df = _observed(df, stages, "clean_rows")
    rows = df.withColumn("labels", parse_labels(label_col))
    # ids and labels feed vocabulary, targets and split cuts; texts are read once more, by whoever takes ``data``
    narrow = rows.select("row_id", "labels").persist(StorageLevel.MEMORY_AND_DISK)
    vocab = dense_ids(narrow.select(F.explode("labels").alias("label")))
    split = random_split_column(narrow, "row_id", cfg.test_size, cfg.val_size, cfg.seed)
    targets = sparse_targets(narrow, vocab).withColumn("split", split)
    return Prepared(rows.withColumn("split", split), vocab, label_metadata(vocab, label_col, cfg.text_col), stages or {}, targets,
                    _persisted=[narrow])


def merge_long(meta: DataFrame, web: DataFrame, cfg: LongConfig = LongConfig(), stages: dict | None = None) -> DataFrame:
    """Dedupe metadata by source (keep first), first label, join page content, clean.

    Returns ``doc_id, page_id, content, label``; (doc_id, page_id) is the row
    order of the reference's merged table. With ``stages`` (a dict), row
    counts of the metadata, the deduped metadata and the merged table are
    recorded as ``Observation``s, collected by the same job that runs the plan.
    """
    def seen(df: DataFrame, name: str) -> DataFrame:
        return _observed(df, stages, name)

    meta = require_columns(normalize_headers(meta), [cfg.meta_key, cfg.meta_label, cfg.meta_order])
    web = require_columns(normalize_headers(web), [cfg.web_key, cfg.web_content, cfg.web_order])
    meta = seen(meta.select(cfg.meta_order, cfg.meta_key, cfg.meta_label), "meta_rows")
    first = seen(dedupe_first(meta, cfg.meta_key, cfg.meta_order), "deduped_rows")
    first = first.withColumn("label", first_label(cfg.meta_label))
    joined = merge_content(first, web.select(cfg.web_order, cfg.web_key, cfg.web_content), cfg.meta_key, cfg.web_key, cfg.web_content)
    merged = joined.select(
        F.col(cfg.meta_order).alias("doc_id"), F.col(cfg.web_order).alias("page_id"),
        F.col(cfg.web_content).alias("content"), "label",
    )
    return seen(clean_text_columns(merged, ["content", "label"]), "merged_rows")


def prepare_long(meta: DataFrame, web: DataFrame, cfg: LongConfig = LongConfig(), observe: bool = False) -> Prepared:
    stages: dict | None = {} if observe else None
    merged = merge_long(meta, web, cfg, stages)
    vocab = label_vocab_single(merged, "label")
    return Prepared(merged, vocab, label_metadata(vocab, "label", "content"), stages or {})


def save_short(p: Prepared, out_dir: str, text_col: str = "scene") -> None:
    """The reference's artifact set: split JSONL, split text CSV, targets + index, label metadata."""
    tables.write_splits_json(p.data.drop("labels"), f"{out_dir}/splits_json")
    tables.write_splits_csv(p.data, f"{out_dir}/splits_text", text_col)
    tables.write_encoded(p.dense(), f"{out_dir}/encoded")
    tables.write_label_metadata(p.metadata, f"{out_dir}/labels")
    p.release()


def save_long(p: Prepared, out_dir: str) -> None:
    tables.write_csv(p.data, f"{out_dir}/merged")
    tables.write_label_metadata(p.metadata, f"{out_dir}/labels")
