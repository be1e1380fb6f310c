"""Column expressions for text cells: Unicode strip, the two label grammars,
separator rewriting and response cleaning. All JVM-side (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour exactly).
#
# Every code point for which Python's str.isspace() is true; str.strip() and
# the "\s" class of Python's re module remove/match exactly these:
#   U+0009 U+000A U+000B U+000C U+000D U+001C U+001D U+001E U+001F U+0020
#   U+0085 U+00A0 U+1680 U+2000 U+2001 U+2002 U+2003 U+2004 U+2005 U+2006
#   U+2007 U+2008 U+2009 U+200A U+2028 U+2029 U+202F U+205F U+3000
# The same set as a regex class valid in Java regex and RE2:
#   [\s\x0b\x1c-\x1f\x85\p{Z}]
# Label-cell separators (besides whitespace): '，' (U+FF0C), '、' (U+3001),
# ';' and '/'. ASCII ',' and full-width '；' are NOT separators.
# Prediction-list separators: ',' and '、' only; "无" means "no label".
# ---------------------------------------------------------------------------
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS_CLASS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
LABEL_SPLIT_PATTERN = r"[\s\x0b\x1c-\x1f\x85\p{Z}，、;/]+"
ENUM_COMMA = "、"
NO_LABEL = "无"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c) -> Column:
    """Python ``str(x).strip()``: cast to string, trim every Unicode space from both ends.

    Spark's one-argument ``trim`` removes only U+0020, so the full set is passed.
    """
    return F.trim(_col(c).cast("string"), F.lit(WHITESPACE_CHARS))


def parse_labels(c) -> Column:
    """Label cell -> array<string>; null/blank -> []; duplicates kept, order kept."""
    parts = F.split(F.coalesce(_col(c).cast("string"), F.lit("")), LABEL_SPLIT_PATTERN)
    return F.filter(parts, lambda x: x != F.lit(""))


def first_label(c) -> Column:
    """Text before the first '、' (the whole cell when there is none); null stays null."""
    return F.split(_col(c), ENUM_COMMA).getItem(0)


def canonical_separator(c) -> Column:
    """Literal replacement of '、' by ','."""
    return F.replace(_col(c), F.lit(ENUM_COMMA), F.lit(","))


def split_predicted_labels(c) -> Column:
    """Generated answer -> array<string> with the prediction grammar.

    Null/empty or (stripped) "无" -> []; else split on ',' after turning '、'
    into ',', strip every piece, drop empty pieces.
    """
    col = _col(c)
    pieces = F.split(canonical_separator(col), ",")
    stripped = F.filter(F.transform(pieces, lambda x: strip_text(x)), lambda x: x != F.lit(""))
    return F.when(col.isNull() | (strip_text(col) == F.lit(NO_LABEL)), F.array().cast("array<string>")).otherwise(
        stripped
    )


def clean_response(c) -> Column:
    """Remove newlines only (no strip)."""
    return F.replace(_col(c), F.lit("\n"), F.lit(""))
