"""JSON encode / decode.

Decoding is two-step so that quoted numbers parse (SURVEY T1): every field is
read as text by ``from_json``, then cast with ``try_cast``.  Absent numeric
fields default to 0 and absent strings stay null, as a bean decoder does.
Malformed text and text in a numeric field that is no number are flagged
instead of failing the task, so the caller can route them to a quarantine table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.dates import ColumnOrName, _c

CORRUPT = "_corrupt_record"
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def as_text_schema(schema: T.StructType, with_corrupt: bool = True) -> T.StructType:
    """Same field names, every field a string (plus the corrupt-record column)."""
    fields = [T.StructField(f.name, T.StringType(), True) for f in schema.fields]
    if with_corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType(), True))
    return T.StructType(fields)


def parse_text_fields(value: ColumnOrName, schema: T.StructType) -> Column:
    """``from_json`` into an all-string struct with the corrupt-record column."""
    return F.from_json(
        _c(value),
        as_text_schema(schema),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )


def typed_fields(parsed: Column, schema: T.StructType, zero_numbers: bool = True) -> list[Column]:
    """Cast the text fields of ``parsed`` to ``schema``; absent numbers -> 0."""
    out = []
    for f in schema.fields:
        v = parsed.getField(f.name)
        if isinstance(f.dataType, T.StringType):
            out.append(v.alias(f.name))
            continue
        cast = v.try_cast(f.dataType)
        if zero_numbers and isinstance(f.dataType, _NUMERIC):
            # absent or null -> 0; present but not a number: see ``bad_numbers``
            cast = F.coalesce(cast, F.lit(0).cast(f.dataType))
        out.append(cast.alias(f.name))
    return out


def bad_numbers(parsed: Column, schema: T.StructType) -> Column:
    """True where a typed field is present but its text is not of its type."""
    bad = F.lit(False)
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            v = parsed.getField(f.name)
            bad = bad | (v.isNotNull() & v.try_cast(f.dataType).isNull())
    return bad


def is_corrupt(parsed: Column) -> Column:
    """True for text that is not a JSON object (null input is not corrupt, it is absent)."""
    return parsed.getField(CORRUPT).isNotNull()


def encode_row(*cols: ColumnOrName, as_text: bool = False) -> Column:
    """Row -> JSON object; null fields are left out.

    ``as_text=True`` writes every value as a JSON string, as CDC tools do.
    """
    cs = [_c(c) for c in cols]
    if as_text:
        names = [c if isinstance(c, str) else None for c in cols]
        cs = [c.cast("string").alias(n) if n else c.cast("string") for c, n in zip(cs, names)]
    return F.to_json(F.struct(*cs))


def json_text(value: ColumnOrName, path: str) -> Column:
    """Untyped pick of one field as its JSON text (objects keep their braces)."""
    return F.get_json_object(_c(value), path)
