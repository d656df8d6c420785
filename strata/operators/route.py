"""Routing of raw feeds to per-purpose topics (R1-R4) and the start-log projection.

All routers add a ``topic`` column and keep the payload, so the same frame can
go to one topic sink whose topic is a column (S3/S4), batch or streaming.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.dates import day_str, hour_str, minute_str, ts_from_millis
from strata.functions.json import json_text
from strata.functions.text import ods_topic
from strata.schemas import APP_COMMON

# Topic names and the CDC allow-list of the reference.
START_TOPIC = "GMALL_START"
EVENT_TOPIC = "GMALL_EVENT"
CDC_TABLES = ("order_info", "order_detail")
CDC_INSERT = "INSERT"
BOOTSTRAP_TYPES = ("bootstrap-start", "bootstrap-complete")


def route_app_log(df: DataFrame, value: str = "value",
                  start_topic: str = START_TOPIC, event_topic: str = EVENT_TOPIC) -> DataFrame:
    """Logs whose ``start`` field has a non-empty text form go to the start topic.

    ``{}`` counts as present; ``""``, null and an absent field do not.
    """
    start_len = F.length(json_text(value, "$.start"))
    topic = F.when(F.coalesce(start_len, F.lit(0)) > 0, F.lit(start_topic)).otherwise(F.lit(event_topic))
    return df.withColumn("topic", topic)


_ENVELOPE_BATCH = T.StructType([T.StructField("type", T.StringType()), T.StructField("table", T.StringType()),
                                 T.StructField("data", T.ArrayType(T.StringType()))])
_ENVELOPE_ROW = T.StructType([T.StructField("type", T.StringType()), T.StructField("table", T.StringType()),
                              T.StructField("data", T.StringType())])


def flatten_cdc_batch(df: DataFrame, value: str = "value", tables: tuple[str, ...] = CDC_TABLES,
                      op_type: str = CDC_INSERT) -> DataFrame:
    """R2 + R4: keep ``type == INSERT`` envelopes of allow-listed tables, one row per element.

    Output: the input columns except ``value``, plus ``topic`` (``ODS_T_`` + upper
    table), ``table`` and ``value`` (one row as JSON text).  Envelopes with an
    empty or absent ``data`` array yield nothing (``explode`` drops them).
    """
    env = F.from_json(F.col(value), _ENVELOPE_BATCH)
    rest = [c for c in df.columns if c != value]
    return (
        df.select(*rest, env.alias("_env"))
        .where((F.col("_env.type") == op_type) & F.col("_env.table").isin(*tables))
        .select(*rest, F.col("_env.table").alias("table"), F.explode("_env.data").alias("value"))
        .withColumn("topic", ods_topic("table"))
    )


def route_cdc_rows(df: DataFrame, value: str = "value", drop_bootstrap: bool = True,
                   upper: bool = True) -> DataFrame:
    """R3 + R4: forward each row-style envelope's ``data`` to ``ODS_T_<table>``.

    Every change type is forwarded as-is (upserts downstream); envelopes without
    a table or data are not (see ``cdc_rejects``).  Bootstrap markers are dropped by default and the table name is upper-cased, so the
    dimension consumers receive it (SURVEY Q4, Q5).
    """
    env = F.from_json(F.col(value), _ENVELOPE_ROW)
    rest = [c for c in df.columns if c != value]
    out = df.select(*rest, env.alias("_env"))
    out = out.where(F.col("_env.table").isNotNull() & F.col("_env.data").isNotNull())
    if drop_bootstrap:
        out = out.where(~F.coalesce(F.col("_env.type").isin(*BOOTSTRAP_TYPES), F.lit(False)))
    return out.select(
        *rest,
        F.col("_env.table").alias("table"),
        ods_topic(F.col("_env.table"), upper=upper).alias("topic"),
        F.col("_env.data").alias("value"),
    )


# Every field as text: a number may come quoted.
_START_SCHEMA = T.StructType([T.StructField("common", APP_COMMON), T.StructField("ts", T.StringType())])


def _parsed_start(df: DataFrame, value: str) -> DataFrame:
    return df.withColumn("_j", F.from_json(F.col(value), _START_SCHEMA)).withColumn(
        "_ts", F.col("_j.ts").try_cast("bigint"))


_IS_START = "_j.common.mid is not null and _ts is not null"


def project_start_log(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """R5 + C1/C2: start-log JSON -> mid, uid, ar, ch, vc, dt, hr, mi, ts.

    ``dt`` is the event day as ``y-M-d`` (unpadded), ``hr``/``mi`` unpadded, in
    the session time zone.  ``keep`` lists input columns to carry along.  Logs
    without a device or a time are left to ``start_log_rejects``.
    """
    t = ts_from_millis(F.col("_ts"))
    return _parsed_start(df, value).where(_IS_START).select(
        *keep,
        F.col("_j.common.mid").alias("mid"),
        F.col("_j.common.uid").alias("uid"),
        F.col("_j.common.ar").alias("ar"),
        F.col("_j.common.ch").alias("ch"),
        F.col("_j.common.vc").alias("vc"),
        day_str(t).alias("dt"),
        hour_str(t).alias("hr"),
        minute_str(t).alias("mi"),
        F.col("_ts").alias("ts"),
    )


def start_log_rejects(df: DataFrame, value: str = "value") -> DataFrame:
    """The rows that ``project_start_log`` leaves out: malformed, or without a device or a time."""
    return _parsed_start(df, value).where(f"not coalesce({_IS_START}, false)").select(*df.columns)


def cdc_rejects(df: DataFrame, value: str = "value") -> DataFrame:
    """Envelopes that are malformed or name no type or table."""
    env = F.from_json(F.col(value), _ENVELOPE_ROW)
    return df.where(F.coalesce(env.getField("type").isNull() | env.getField("table").isNull(), F.lit(True)))
