"""String helpers (C12, C15, R4, R10 tokenising)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.dates import ColumnOrName, _c

# Topic-name prefix of the per-table ODS topics.
ODS_PREFIX = "ODS_T_"


def ods_topic(table: ColumnOrName, upper: bool = True) -> Column:
    """``ODS_T_`` + table name, upper-cased by default."""
    t = _c(table)
    return F.concat(F.lit(ODS_PREFIX), F.upper(t) if upper else t)


def row_text(*fields: str, sep: str = "|") -> Column:
    """``field:value`` pairs joined by a bar; null values print as ``null``."""
    parts = [F.concat(F.lit(f + ":"), F.coalesce(F.col(f).cast("string"), F.lit("null"))) for f in fields]
    return F.concat_ws(sep, *parts)


def word_tokens(text: ColumnOrName) -> Column:
    """Lower-cased word tokens, split on non-word characters (full-text match analyser)."""
    return F.filter(F.split(F.lower(_c(text)), r"[^\p{L}\p{N}_]+"), lambda t: F.length(t) > 0)


def has_word(text: ColumnOrName, word: str) -> Column:
    """True when ``word`` (case-insensitive) is one of the tokens of ``text``."""
    return F.array_contains(word_tokens(text), word.lower())
