"""Projection, filtering and validation of raw tables (schema-level work runs
on the driver without a job; row work is lazy and pushed to the scan)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_text


def normalize_header(name: str) -> str:
    """First line of a header cell, stripped (Python ``str.strip``)."""
    return name.split("\n")[0].strip()


def normalize_headers(df: DataFrame) -> DataFrame:
    new = [normalize_header(c) for c in df.columns]
    dup = sorted({c for c in new if new.count(c) > 1})
    if dup:
        raise ValueError(f"headers collide after normalising: {dup}")
    return df.toDF(*new)


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; have {df.columns}")
    return df


def find_column(df: DataFrame, contains: str) -> str:
    """First column (in column order) whose name contains ``contains``."""
    for c in df.columns:
        if contains in c:
            return c
    raise ValueError(f"no column containing {contains!r}; have {df.columns}")


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def drop_nulls(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(subset))


def strip_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``astype(str).str.strip()`` on each column (null stays null)."""
    return df.withColumns({c: strip_text(c) for c in cols})


def drop_blank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cond = None
    for c in cols:
        term = F.col(c) != F.lit("")
        cond = term if cond is None else cond & term
    return df.where(cond) if cond is not None else df


def clean_text_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """dropna(subset) -> strip -> drop blanks, in the reference's order.

    ``isNotNull`` comes first so it reaches the parquet scan as a pushed filter.
    """
    return drop_blank(strip_columns(drop_nulls(df, cols), cols), cols)


def cast_cells(df: DataFrame, text_cols: Sequence[str] = (), int_cols: Sequence[str] = ()) -> DataFrame:
    """``str(x)`` / ``int(x)`` of cells; with ANSI mode a bad int cast raises."""
    out = {c: F.col(c).cast("string") for c in text_cols}
    out.update({c: F.col(c).cast("int") for c in int_cols})
    return df.withColumns(out)


def take_rows(df: DataFrame, index: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Rows whose id is in ``index`` (an index list is itself a table: semi-join)."""
    return df.join(index.select(id_col), id_col, "left_semi")
