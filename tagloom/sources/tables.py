"""Sources and sinks: parquet / CSV / JSON Lines readers with explicit
schemas, split-partitioned sinks, and the label-metadata record.

Spreadsheets are single-machine files; tables come as parquet, CSV or JSONL.
All readers take a schema (inference costs an extra pass over the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.joins import pair_text_label

LABEL_METADATA_SCHEMA = (
    "labels array<string>, lab2id map<string,int>, id2lab map<string,string>, "
    "num_labels int, label_col string, text_col string"
)
SFT_SCHEMA = "instruction string, input string, output string"

# CSV options that make text with newlines, quotes and edge spaces survive a round trip.
CSV_READ = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"'}
CSV_WRITE = {"header": "true", "escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false", "emptyValue": '""'}


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None) -> DataFrame:
    """One reader for the three table formats (``csv`` and ``json`` want a schema)."""
    if fmt == "parquet":
        r = spark.read
        return (r.schema(schema) if schema else r).parquet(path)
    if fmt == "csv":
        return read_csv(spark, path, schema)
    if fmt in ("json", "jsonl"):
        return read_jsonl(spark, path, schema)
    raise ValueError(f"unknown format {fmt}")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Header CSV, quoted newlines allowed; a UTF-8 BOM on the header is dropped by Spark.

    ``multiLine`` reads a file in one task: write many files (or parquet) for large inputs.
    """
    r = spark.read.options(**CSV_READ)
    return (r.schema(schema) if schema else r).csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    r = spark.read
    return (r.schema(schema) if schema else r).json(path)


def write_csv(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode).options(**CSV_WRITE)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(path)


def write_jsonl(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite") -> None:
    """JSON Lines, non-ASCII kept, null fields written (as pandas does)."""
    w = df.write.mode(mode).option("ignoreNullFields", "false")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.json(path)


def write_splits_json(df: DataFrame, path: str, split_col: str = "split") -> None:
    """One JSONL set per split, laid out as ``split=train|val|test`` directories."""
    write_jsonl(df, path, partition_by=split_col)


def write_splits_csv(df: DataFrame, path: str, text_col: str, split_col: str = "split", id_col: str = "row_id") -> None:
    """Text CSV per split (header, quotes, edge spaces and empty strings preserved).

    The row id is written beside the text: pairing with targets is by key, not by position.
    """
    write_csv(df.select(id_col, text_col, split_col), path, partition_by=split_col)


def write_encoded(df: DataFrame, path: str, id_col: str = "row_id", y_col: str = "y", split_col: str = "split") -> None:
    """Targets and split index next to the row id (parquet replaces the .npy files)."""
    df.select(id_col, split_col, y_col).write.mode("overwrite").partitionBy(split_col).parquet(path)


def write_label_metadata(meta: DataFrame, path: str) -> None:
    meta.write.mode("overwrite").json(path)


def load_label_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LABEL_METADATA_SCHEMA).json(path)


def load_split(spark: SparkSession, text_path: str, y_path: str, split: str, text_schema: str,
               id_col: str = "row_id", split_col: str = "split") -> DataFrame:
    """Text and targets of one split (partition-pruned reads), paired by id; a missing side raises."""
    text = read_csv(spark, text_path, text_schema).where(F.col(split_col) == split).drop(split_col)
    y = spark.read.parquet(y_path).where(F.col(split_col) == split).drop(split_col)
    return pair_text_label(text, y, id_col)


def write_sft_jsonl(df: DataFrame, path: str) -> None:
    write_jsonl(df.select("instruction", "input", "output"), path)


def read_sft_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, SFT_SCHEMA)
