"""Range filter plus full-text term match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.text import has_word


def range_text_search(df: DataFrame, range_col: str, lo: float, hi: float, text_col: str, term: str) -> DataFrame:
    """Rows with ``lo <= range_col <= hi`` whose ``text_col`` contains the word ``term``.

    The range predicate is a plain comparison, so it reaches the Parquet scan
    as a pushed filter; the word test runs on the surviving rows.
    """
    return df.where(F.col(range_col).between(lo, hi)).where(has_word(text_col, term))
