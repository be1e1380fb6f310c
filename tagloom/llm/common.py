"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import scratch_path, text_batches  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Word patterns (fixed values of the contracts).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TOKEN = r"[^\x20\x09-\x0D]+"

_SCRATCH: dict[int, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; Spark's reader alone touches the path."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character kept."""
    return F.translate(c, UPPER, LOWER)


def matches(c: Column, pattern: str) -> Column:
    """All non-overlapping matches of a Java pattern, as an array."""
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def word_array(c: Column) -> Column:
    """The words of a text after A-Z is lower-cased; null gives an empty array."""
    return matches(ascii_lower(F.coalesce(c, F.lit(""))), f"({WORD})")


def text_key(text: Column) -> Column:
    """``_key``: with the id it tells rows apart where ids repeat or are null."""
    return F.xxhash64(F.coalesce(text, F.lit(""))).alias("_key")


def small(df: DataFrame, most: int = 200_000, entries: str | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` (narrow) rows, or as many ``entries``
    in that array column over all rows; else as it is, and Spark joins it by shuffle."""
    few = df.limit(most + 1).count() <= most
    if few and entries is not None:
        few = (df.agg(F.sum(F.size(entries)).alias("n")).first()["n"] or 0) <= most
    return F.broadcast(df) if few else df


def without(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` but for the rows named in ``dropped`` (doc_id, _key)."""
    d = small(written(dropped.select(F.col("doc_id").alias("_d"), F.col("_key").alias("_k")).distinct(), "dropped"))
    return docs.join(d, docs[id_col].eqNullSafe(d["_d"]) & (text_key(docs[text_col]) == d["_k"]), "left_anti")


def literal_table(spark: SparkSession, rows: list[tuple], names: list[str], types: list[str]) -> DataFrame:
    """A parameter list as a DataFrame, without Python in the plan."""
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, types))
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in zip(names, types)])
    cells = [F.struct(*[_lit(v).cast(t).alias(n) for v, n, t in zip(r, names, types)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*cells).cast(f"array<struct<{schema.replace(' ', ':')}>>".replace(",:", ","))))


def _lit(v):
    return F.array(*map(F.lit, v)) if isinstance(v, (list, tuple)) else F.lit(v)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` beneath the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs no recomputation of what went before, and
    row numbers made before the write stay the same ever after.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path beneath the shared checkpoint folder that :func:`release_scratch` deletes."""
    path = scratch_path(spark, name)
    _SCRATCH.setdefault(id(spark), []).append(path)
    return path


def scratch_mark(spark: SparkSession) -> int:
    """How many intermediate tables there are: what :func:`release_scratch` leaves alone if told so."""
    return len(_SCRATCH.get(id(spark), []))


def release_scratch(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Delete the intermediate tables that :func:`written` made in this session, but the first ``since`` and the last ``keep``.

    Call it once the results built on them have been written. Returns how many went.
    """
    made = _SCRATCH.get(id(spark), [])
    paths = made[since : len(made) - keep]
    _SCRATCH[id(spark)] = made[:since] + made[len(made) - keep :] if keep else made[:since]
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


def tidy(batches: Iterator, *states: dict) -> Iterator:
    """A task's output; when it ends, module state kept by the Python worker is dropped and memory held for reuse goes back
    to the system, as the worker lives on beside those of other stages."""
    try:
        yield from batches
    finally:
        for state in states:
            state.clear()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)
