"""Typed decoding of JSON rows with a quarantine.

The reference decodes with a bean mapper and a malformed record fails the
task.  Here such records are split off into a quarantine frame, and the good
rows are typed: quoted numbers parse, absent numbers are 0, absent strings null.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.json import bad_numbers, is_corrupt, parse_text_fields, typed_fields


class Decoded(NamedTuple):
    rows: DataFrame
    quarantine: DataFrame


def decode_json(df: DataFrame, schema: T.StructType, value: str = "value", keep: tuple[str, ...] = (),
                zero_numbers: bool = True) -> Decoded:
    """JSON text -> typed columns of ``schema`` (plus ``keep`` columns).

    ``quarantine`` holds every other input row: no text, text that is not a JSON
    object, or a field whose text is not of its type.  Both frames share one
    parse; persist the input when both are consumed as actions.
    """
    parsed = df.select(*df.columns, parse_text_fields(F.col(value), schema).alias("_p"))
    bad = F.col(value).isNull() | is_corrupt(F.col("_p")) | F.coalesce(bad_numbers(F.col("_p"), schema), F.lit(True))
    rows = parsed.where(~bad).select(*keep, *typed_fields(F.col("_p"), schema, zero_numbers=zero_numbers))
    return Decoded(rows, parsed.where(bad).select(*df.columns))


def pick_columns(df: DataFrame, schema: T.StructType, key: str, value: str = "value",
                 keep: tuple[str, ...] = ()) -> Decoded:
    """Dimension row JSON -> the named string columns of ``schema`` (untyped pick).

    Dimension columns are all text; absent fields are null.  Rows without a
    ``key``, and text that is not a JSON object, go to the quarantine.
    """
    parsed = df.select(*df.columns, parse_text_fields(F.col(value), schema).alias("_p"))
    good = F.coalesce(~is_corrupt(F.col("_p")) & F.col("_p").getField(key).isNotNull(), F.lit(False))
    rows = parsed.where(good).select(*keep, *[F.col("_p").getField(f.name).alias(f.name) for f in schema.fields])
    return Decoded(rows, parsed.where(~good).select(*df.columns))
