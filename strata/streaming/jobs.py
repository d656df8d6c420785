"""One streaming job per hop.

Each builder takes streaming input frames, applies the same operators as the
batch catalogue, and returns a ``DataStreamWriter`` with its checkpoint set;
the caller picks the trigger (``processingTime='5 seconds'`` in service,
``availableNow`` in tests) and starts it.  Sinks are either exactly-once file
sinks or ``foreachBatch`` writes keyed by the batch id, so a replayed batch
overwrites its own output (at-least-once input, effectively-once output).
Dimension lookups re-read the current dimension table in every micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from strata.functions.dates import ts_from_millis
from strata.functions.json import encode_row
from strata.operators.activity import DAU_COLUMNS, with_index_day
from strata.operators.decode import decode_json
from strata.operators.dims import decode_dimension
from strata.operators.enrich import join_detail_dims, join_province, join_user_profile, with_create_parts
from strata.operators.route import START_TOPIC, cdc_rejects, flatten_cdc_batch, project_start_log, route_app_log, \
    route_cdc_rows
from strata.operators.wide import merge_wide, retained_join, unmatched, window_join
from strata.schemas import ORDER_DETAIL, ORDER_DETAIL_WIRE, ORDER_INFO, ORDER_INFO_WIRE, TOPIC_RECORD
from strata.sources.dimstore import DimensionStore
from strata.sources.sinks import DayIndex, write_order_wide
from strata.sources.topics import TOPIC_CODEC, read_topic, write_topic_batch
from strata.streaming.apportion_state import apportion_stream

# The topics of the enriched orders and order lines.
DWD_ORDER_INFO, DWD_ORDER_DETAIL = "DWD_ORDER_INFO", "DWD_ORDER_DETAIL"

# Takes a batch's rejected rows and its id; writes them keyed by the id, as the sinks do.
RejectSink = Callable[[DataFrame, int], None]


def route_app_log_job(records: DataFrame, out_path: str, checkpoint: str) -> DataStreamWriter:
    """R1 + S3: app logs to the start / event topics (file stand-in: one folder per topic)."""
    routed = route_app_log(records).select("key", "value", "topic", "partition", "offset", "timestamp")
    return (routed.writeStream.format("parquet").partitionBy("topic").option("checkpointLocation", checkpoint)
            .option("path", out_path).outputMode("append"))


def _to_topics(rows: DataFrame, out_path: str, checkpoint: str) -> DataStreamWriter:
    """S3: rows with ``value`` and ``topic`` as topic records; they keep the arrival columns they have."""
    cols = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in TOPIC_RECORD.fields]
    return (rows.select(*cols).writeStream.format("parquet").partitionBy("topic").option("compression", TOPIC_CODEC)
            .option("checkpointLocation", checkpoint).option("path", out_path).outputMode("append"))


def cdc_ods_job(envelopes: DataFrame, out_path: str, checkpoint: str) -> DataStreamWriter:
    """R2 + R4 + S3: batch-style CDC envelopes to per-table ODS topics."""
    return _to_topics(flatten_cdc_batch(envelopes), out_path, checkpoint)


def cdc_rows_job(envelopes: DataFrame, out_path: str, checkpoint: str) -> DataStreamWriter:
    """R3 + R4 + S3: row-style CDC envelopes to per-table ODS topics, with the arrival that S6 orders by."""
    return _to_topics(route_cdc_rows(envelopes), out_path, checkpoint)


def cdc_rejects_job(envelopes: DataFrame, out_path: str, checkpoint: str) -> DataStreamWriter:
    """The envelopes that neither router can read, as they came."""
    return (cdc_rejects(envelopes).writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .option("path", out_path).outputMode("append"))


def dimension_job(records: DataFrame, store: DimensionStore, schema, checkpoint: str, compact_every: int = 20,
                  reject: RejectSink | None = None) -> DataStreamWriter:
    """Keep a dimension table up to date from its ODS topic (idempotent per batch id)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_dimension(batch, schema, store.key)
        store.write_batch(decoded.rows, batch_id)
        if reject:
            reject(decoded.quarantine, batch_id)
        if compact_every and batch_id > 0 and batch_id % compact_every == 0:
            store.compact(batch_id)

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def dau_job(records: DataFrame, index: DayIndex, checkpoint: str, delay: str = "1 day",
            compact_every: int = 20) -> DataStreamWriter:
    """R5 + D1 + S8: earliest start per device and event day, upserted into the day index.

    A streaming ``min_by`` per (day window, mid) in update mode: each batch
    emits the keys it touched with their earliest start so far, and the index
    keeps the newest emission per (day, mid).  The result does not depend on
    how rows are split into batches; state for a day is dropped once the
    watermark passes the end of that day.  Every ``compact_every`` batches (0:
    never) the days with many folders are compacted through the batch before,
    which can't be replayed any more.
    """
    starts = route_app_log(records).where(F.col("topic") == START_TOPIC)
    logs = with_index_day(project_start_log(starts, keep=("offset",))).withColumn("_event_ts", ts_from_millis("ts"))
    payload = [c for c in DAU_COLUMNS if c not in ("mid",)]
    firsts = (
        logs.withWatermark("_event_ts", delay)
        .groupBy(F.window("_event_ts", "1 day").alias("_w"), "day", "mid")
        .agg(F.min_by(F.struct(*payload), F.struct("ts", "offset")).alias("_r"))
        .select("day", "mid", *[F.col("_r." + c).alias(c) for c in payload])
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        index.write_batch(batch, batch_id)
        if compact_every and batch_id > 0 and batch_id % compact_every == 0:
            index.compact(batch_id - 1)

    return firsts.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)


def enrich_orders_job(ods_orders: DataFrame, read_provinces: Callable[[], DataFrame],
                      read_users: Callable[[], DataFrame], sink: Callable[[DataFrame, int], None],
                      checkpoint: str, as_of_year: int | None = None,
                      reject: RejectSink | None = None) -> DataStreamWriter:
    """R6 + J1 + J2: decode order rows, add date parts, province and user profile per batch.

    ``reject`` takes the rows that can't be decoded.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        keep = tuple(c for c in ("timestamp",) if c in batch.columns)
        decoded = decode_json(batch, ORDER_INFO_WIRE, keep=keep)
        if reject:
            reject(decoded.quarantine, batch_id)
        rows = with_create_parts(decoded.rows)
        rows = join_province(rows, read_provinces())
        rows = join_user_profile(rows, read_users(), as_of_year=as_of_year)
        sink(rows, batch_id)

    return ods_orders.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def topic_sink(root: str, topic: str, key: str, fmt: str = "files", options: dict | None = None) -> RejectSink:
    """S12 + S4: a batch's rows as JSON records of a topic, keyed by a column; ``timestamp`` stays the record's own.

    A broker gives its own times.  In topic folders a replayed batch overwrites
    its records; a broker has them twice, and D2 drops the second downstream.
    """

    def sink(rows: DataFrame, batch_id: int) -> None:
        arrival = [F.col("timestamp")] if "timestamp" in rows.columns else []
        value = encode_row(*[c for c in rows.columns if c != "timestamp"])
        records = rows.select(F.lit(topic).alias("topic"), F.col(key).cast("string").alias("key"), value.alias("value"), *arrival)
        write_topic_batch(records, fmt=fmt, root=root, batch_id=batch_id, options=options)

    return sink


def enrich_details_job(ods_details: DataFrame, read_dims: Callable[[], tuple[DataFrame, ...]],
                       sink: Callable[[DataFrame, int], None], checkpoint: str,
                       on_missing: str = "left", reject: RejectSink | None = None) -> DataStreamWriter:
    """Decode order lines and add the sku snowflake, dimensions read per batch.

    ``reject`` takes the rows that can't be decoded and, with
    ``on_missing="reject"``, the lines without a match as JSON.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        keep = tuple(c for c in ("timestamp",) if c in batch.columns)
        decoded = decode_json(batch, ORDER_DETAIL_WIRE, keep=keep)
        sku, spu, tm, c3 = read_dims()
        enriched = join_detail_dims(decoded.rows, sku, spu, tm, c3, on_missing=on_missing)
        if reject:
            bad = decoded.quarantine.select("value")
            if enriched.rejects is not None:
                bad = bad.unionByName(enriched.rejects.select(encode_row(*enriched.rejects.columns).alias("value")))
            reject(bad, batch_id)
        sink(enriched.rows, batch_id)

    return ods_details.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def wide_pairs_stream(info: DataFrame, detail: DataFrame, mode: str = "window", delay: str = "1 minute",
                      retention_s: int = 600, time_col: str = "arrive_ts") -> DataFrame:
    """J4 (``window``) or J5 (``retained``) as a stream-stream join, inputs de-duplicated first.

    ``retained_outer`` is J5 that also gives the rows whose time ran out (D4).

    Repeated deliveries of a header or a line are dropped within the watermark
    on each input, so each (order, line) pair is emitted once.
    """
    i = info.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["id"])
    d = detail.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["order_id", "id"])
    if mode == "window":
        return window_join(i, d, info_time=time_col, detail_time=time_col)
    return retained_join(i, d, info_time=time_col, detail_time=time_col, retention_s=retention_s,
                         dedup_detail=False, how="full_outer" if mode == "retained_outer" else "inner")


def retained_pairs_job(info: DataFrame, detail: DataFrame, pairs: RejectSink, expired: RejectSink, checkpoint: str,
                       delay: str = "10 minutes", retention_s: int = 600, time_col: str = "arrive_ts") -> DataStreamWriter:
    """Pairs to one sink, and headers and lines that expired without a partner to another, each once."""
    joined = wide_pairs_stream(info, detail, "retained_outer", delay, retention_s, time_col)

    def write(batch: DataFrame, batch_id: int) -> None:
        # Two sinks look at the rows: without holding them the join and its state would be worked off twice.
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            pairs(batch.where("i_id is not null and d_id is not null"), batch_id)
            expired(unmatched(batch), batch_id)
        finally:
            batch.unpersist()

    return joined.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def order_wide_stream(info: DataFrame, detail: DataFrame, scale: int | None = 2, delay: str = "1 minute",
                      time_col: str = "arrive_ts", mode: str = "window", retention_s: int = 600) -> DataFrame:
    """J4 -> R7 -> D6: the wide fact with apportioned line amounts, as one stream.

    ``mode="retained"`` joins by J5 instead.  After the join only the header's
    arrival time is kept as event time (SURVEY T3).
    """
    pairs = wide_pairs_stream(info, detail, mode, delay, retention_s, time_col)
    wide = merge_wide(pairs, keep=(F.col("i_" + time_col).alias(time_col),))
    return apportion_stream(wide, scale=scale, time_col=time_col, delay=None)


def order_wide_job(info: DataFrame, detail: DataFrame, path: str, checkpoint: str, **options) -> DataStreamWriter:
    """The wide fact from both feeds, stored in month folders; each batch overwrites its own part of a month."""
    wide = order_wide_stream(with_create_parts(info), detail, **options)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_order_wide(batch, path, batch_id)

    return wide.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def dwd_feed(records: DataFrame, schema, time_col: str = "arrive_ts") -> DataFrame:
    """The enriched rows of a DWD topic's records, with their arrival; what can't be decoded: ``dwd_rejects_job``."""
    return decode_json(records, schema, keep=("timestamp",), zero_numbers=False).rows.withColumnRenamed("timestamp", time_col)


def dwd_rejects_job(records: DataFrame, schema, out_path: str, checkpoint: str) -> DataStreamWriter:
    """The records of a DWD topic that ``dwd_feed`` can't decode, as they came."""
    bad = decode_json(records, schema, zero_numbers=False).quarantine
    return bad.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out_path).outputMode("append")


def dws_wide_job(spark: SparkSession, root: str, path: str, checkpoint: str, fmt: str = "files",
                 source_options: dict | None = None, max_per_trigger: int | None = None, **options) -> DataStreamWriter:
    """S1 -> J4 or J5 -> R7 -> D6: the stored wide fact from the topics of enriched orders and lines."""
    read = lambda topic: read_topic(spark, topic, fmt=fmt, root=root, stream=True, options=source_options,
                                    max_per_trigger=max_per_trigger)
    info, detail = dwd_feed(read(DWD_ORDER_INFO), ORDER_INFO), dwd_feed(read(DWD_ORDER_DETAIL), ORDER_DETAIL)
    return order_wide_job(info.drop("create_date", "create_hour"), detail, path, checkpoint, **options)


def service(writer: DataStreamWriter, every: str = "5 seconds") -> DataStreamWriter:
    """T-a: micro-batches at an interval; how much a batch takes is bounded at its source (``max_per_trigger``)."""
    return writer.trigger(processingTime=every)
