"""Streaming twins of catalogue queries: the stream result must equal the batch oracle.

Each twin stages its whole input as Parquet files in one write (the file
stand-in for a topic, SURVEY T5/T6), runs the streaming job with
``availableNow`` and a checkpoint under the shared folder, and returns what
the job's sink wrote.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from strata.functions.money import sum_money
from strata.functions.text import ODS_PREFIX
from strata.operators.wide import merge_wide
from strata.plans.warehouse import AS_OF_YEAR, Warehouse
from strata.schemas import DIMENSIONS, TOPIC_RECORD
from strata.session import shared_path, start_stateful, state_partitions, tidy
from strata.sources.dimstore import DimensionStore
from strata.sources.ledger import OffsetLedger, with_ledger
from strata.sources.sinks import DayIndex, archive_stream, read_archive, read_order_wide
from strata.sources.testdata import TestData
from strata.sources.topics import read_topic, write_topic_batch
from strata.streaming.apportion_state import apportion_stream
from strata.streaming.jobs import DWD_ORDER_DETAIL, DWD_ORDER_INFO, cdc_ods_job, cdc_rows_job, dau_job, dimension_job, \
    dws_wide_job, enrich_details_job, enrich_orders_job, order_wide_job, retained_pairs_job, route_app_log_job, topic_sink, \
    wide_pairs_stream
from strata.streaming.late import LateGate, folder_sink, late_gate_job

DAY_S = 86_400
FILES_PER_TRIGGER = 4
ROWS_PER_FILE = 100_000
PARTITIONS_PER_FILE = 3
STAGED_CODEC = "zstd"
# A part of a feed goes through all hops of a chain before the next one; each hop starts anew for it, which takes seconds.
FILES_OF_A_PART = 16
# A feed whose files come in any order: no row may ever be late.
DELAY = "3650 days"
# A feed that is staged on its event time comes in that order, so its state may expire behind the newest file;
# what a watermark drops is tested on its own.
ORDERED_DELAY = "10 minutes"


def _files_of(spark: SparkSession, path: str) -> dict[str, object]:
    """The data files right below ``path``, by name."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [f.getPath() for f in (fs.listStatus(folder) if fs.exists(folder) else [])]
    return {f.getName(): f for f in found if f.getName().startswith("part-")}


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def write_in_order(rows: DataFrame, path: str, order_col: str, files: int, sort_cols: tuple[str, ...] = (), mode: str = "append") -> None:
    """``rows`` as ``files`` files, ranged on ``order_col`` (equal values share a file); a stream takes files by their times, so they are given times in that order."""
    spark = rows.sparkSession
    fs, _ = _fs(spark, path)
    before = _files_of(spark, path) if mode == "append" else {}
    ranged = rows.repartitionByRange(files, order_col).sortWithinPartitions(order_col, *sort_cols)
    ranged.write.mode(mode).option("compression", STAGED_CODEC).parquet(path)
    new = sorted((name, at) for name, at in _files_of(spark, path).items() if name not in before)
    now = int(time.time() * 1000)
    for i, (_, at) in enumerate(new):
        fs.setTimes(at, now - len(new) + i, -1)


def stage(df: DataFrame, path: str, order_col: str, sort_cols: tuple[str, ...] = (), files: int = 0) -> int:
    """Append ``df`` to ``path`` by ``write_in_order``; gives the number of files.

    The number of files, and so of triggers, follows the number of rows, unless
    it is given.  Counting, ranging and writing all look at the rows, so they
    are written once as they come, compressed, and that copy is deleted after.
    """
    spark, held = df.sparkSession, f"{path}-unordered"
    fs, at = _fs(spark, held)
    with tidy(spark):
        try:
            df.write.mode("overwrite").option("compression", STAGED_CODEC).parquet(held)
            rows = spark.read.schema(df.schema).parquet(held)
            files = files or max(FILES_PER_TRIGGER, -(-rows.count() // ROWS_PER_FILE))
            write_in_order(rows, path, order_col, files, sort_cols)
        finally:
            fs.delete(at, True)
    return files


def state_files(spark: SparkSession) -> int:
    """Files of a trigger of a stream with state: as many as its partitions, so that each gets a file's rows."""
    return max(FILES_PER_TRIGGER, state_partitions(spark))


def read_staged(spark: SparkSession, path: str, schema, files: int = 0) -> DataFrame:
    """A stream over staged files, ``files`` a trigger; unless they are given, they follow the session's partitions."""
    files = files or max(FILES_PER_TRIGGER, int(spark.conf.get("spark.sql.shuffle.partitions")) // PARTITIONS_PER_FILE)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def run(writer: DataStreamWriter, stateful: bool = False) -> None:
    """Run a stream over everything staged, then stop."""
    writer = writer.trigger(availableNow=True)
    if stateful:
        q = start_stateful(writer)
    else:
        with tidy(writer._spark):
            q = writer.start()
    try:
        q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def ods_topic_name(table: str) -> str:
    return ODS_PREFIX + table.upper()


def _dirs(spark: SparkSession, name: str) -> tuple[str, str, str]:
    base = shared_path(spark, "twins", name, unique=True)
    return f"{base}/in", f"{base}/out", f"{base}/checkpoint"


# ---- twins ----------------------------------------------------------------------------------

def stream_route_app_logs(spark, sf_dir):
    td = TestData(spark, sf_dir)
    src, out, ckpt = _dirs(spark, "route")
    rec = td.app_log_records()
    stage(rec, src, "offset")
    run(route_app_log_job(read_staged(spark, src, rec.schema), out, ckpt))
    return spark.read.parquet(out).select("topic", F.col("key").cast("bigint").alias("event_id"))


def _stream_dim(dim: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark, sf_dir):
        td = TestData(spark, sf_dir)
        schema, key, _t = DIMENSIONS[dim]
        src, out, ckpt = _dirs(spark, f"dim_{dim}")
        hist = td.dimension_history(dim)
        stage(hist, src, "offset")
        store = DimensionStore(spark, out, key)
        run(dimension_job(read_staged(spark, src, hist.schema), store, schema, ckpt))
        return store.read().select(*td.dimension(dim).columns)

    q.__name__ = f"stream_dim_upsert_{dim}"
    return q


def stream_dau_dedup(spark, sf_dir):
    td = TestData(spark, sf_dir)
    src, out, ckpt = _dirs(spark, "dau")
    rec = td.app_log_records().withColumn("_t", F.unix_seconds("timestamp"))
    stage(rec, src, "_t")
    stream = read_staged(spark, src, rec.schema).drop("_t")
    index = DayIndex(spark, out)
    run(dau_job(stream, index, ckpt, delay=ORDERED_DELAY))
    return index.read().select("mid", "uid", "ar", "ch", "vc", "dt", "hr", "mi", "ts")


# The fixtures' arrival clock starts at the epoch, and a watermark starts at 0, so
# rows at t <= 0 would count as late.  Streams run the clock one day later; a day
# is a whole number of slides, so every window relation is unchanged.
CLOCK_SHIFT_S = DAY_S


def _shifted(df: DataFrame) -> DataFrame:
    return df.withColumn("arrive_ts", F.timestamp_seconds(F.col("arrive_s") + CLOCK_SHIFT_S))


def _arrivals(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    wh = Warehouse(spark, sf_dir)
    return _shifted(wh.td.order_info), _shifted(wh.td.order_detail)


def _staged_feeds(spark, base: str, info: DataFrame, detail: DataFrame) -> tuple[DataFrame, DataFrame]:
    # Both feeds in as many files, so that neither runs ahead of the other.
    files = stage(detail, f"{base}/detail", "arrive_s")
    stage(info, f"{base}/info", "arrive_s", files=files)
    take = state_files(spark)
    return read_staged(spark, f"{base}/info", info.schema, take), read_staged(spark, f"{base}/detail", detail.schema, take)


def _stream_pairs(mode: str, retention_s: int = 600):
    def q(spark, sf_dir):
        info, detail = _arrivals(spark, sf_dir)
        base = shared_path(spark, "twins", f"pairs_{mode}", unique=True)
        si, sd = _staged_feeds(spark, base, info, detail)
        pairs = wide_pairs_stream(si, sd, mode, delay=ORDERED_DELAY, retention_s=retention_s)
        out = pairs.select(F.col("i_id").alias("order_id"), F.col("d_id").alias("order_detail_id"))
        run(out.writeStream.format("parquet").option("path", f"{base}/out")
            .option("checkpointLocation", f"{base}/checkpoint").outputMode("append"), stateful=True)
        return spark.read.parquet(f"{base}/out")

    q.__name__ = f"stream_wide_{mode}_join"
    return q


def stream_apportion_cents(spark, sf_dir):
    """D6 in a stream over the window-join pairs (each order's lines arrive in one batch)."""
    wh = Warehouse(spark, sf_dir)
    pairs = wh.window_pairs()
    wide = _shifted(merge_wide(pairs, keep=(F.col("i_arrive_s").alias("arrive_s"),)))
    src, out, ckpt = _dirs(spark, "apportion")
    stage(wide, src, "arrive_s", sort_cols=("order_detail_id",))
    # No more than the amounts of each line is asked for: what a Python function does not need is not read or shuffled.
    stream = read_staged(spark, src, wide.schema, state_files(spark)).select(
        "order_id", "order_detail_id", "original_total_amount", "final_total_amount", "sku_price", "sku_num", "arrive_ts")
    res = apportion_stream(stream, scale=2, delay=ORDERED_DELAY)
    run(res.select("order_id", "order_detail_id", "final_detail_amount").writeStream.format("parquet")
        .option("path", out).option("checkpointLocation", ckpt).outputMode("append"), stateful=True)
    return spark.read.parquet(out)


def stream_order_wide(spark, sf_dir):
    """D2 -> J4 -> R7 -> D6 -> stored fact; every fifth line and seventh header is delivered twice.

    The lines of an order may come in several batches, so which of them
    completes it is open: compared are each order's lines and their sum.
    """
    info, detail = _arrivals(spark, sf_dir)
    info, detail = info.unionByName(info.where("id % 7 = 0")), detail.unionByName(detail.where("id % 5 = 0"))
    base = shared_path(spark, "twins", "order_wide", unique=True)
    si, sd = _staged_feeds(spark, base, info, detail)
    run(order_wide_job(si, sd, f"{base}/out", f"{base}/checkpoint", delay=ORDERED_DELAY), stateful=True)
    stored = read_order_wide(spark, f"{base}/out")
    return stored.groupBy("dt", "order_id").agg(
        F.count("*").alias("n_lines"), sum_money("final_detail_amount").cast("double").alias("amount"))


def stream_cdc_dims(spark, sf_dir):
    """R3 -> ODS topics -> S6, chained: the sku dimension from row-style envelopes."""
    td = TestData(spark, sf_dir)
    schema, key, table = DIMENSIONS["sku"]
    src, out, ckpt = _dirs(spark, "cdc_dims")
    env = td.cdc_row_envelopes().select(
        "value", F.timestamp_seconds(F.lit(1704067200)).alias("timestamp"), F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"))
    stage(env, src, "offset")
    run(cdc_rows_job(read_staged(spark, src, env.schema), f"{out}/ods", f"{ckpt}/ods"))
    topic = ods_topic_name(table)
    ods = spark.readStream.schema(TOPIC_RECORD).parquet(f"{out}/ods").where(F.col("topic") == topic)
    store = DimensionStore(spark, f"{out}/dim", key)
    run(dimension_job(ods, store, schema, f"{ckpt}/dim"))
    return store.read().select(*td.sku_info().columns)


def stream_detail_dims(spark, sf_dir):
    """R2 -> ODS topics -> J3, chained: order lines with the sku snowflake, from batch-style envelopes."""
    td = TestData(spark, sf_dir)
    src, out, ckpt = _dirs(spark, "detail_dims")
    env = td.cdc_batch_envelopes()
    stage(env, src, "env_id")
    run(cdc_ods_job(read_staged(spark, src, env.schema), f"{out}/ods", f"{ckpt}/ods"))
    lines = (spark.readStream.schema(TOPIC_RECORD).parquet(f"{out}/ods")
             .where(F.col("topic") == ods_topic_name("order_detail")))

    def sink(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").option("compression", STAGED_CODEC).parquet(f"{out}/dwd/batch={batch_id}")

    dims = lambda: (td.sku_info(), td.spu_info(), td.trademark_info(), td.category3_info())
    run(enrich_details_job(lines, dims, sink, f"{ckpt}/dwd"))
    return spark.read.parquet(f"{out}/dwd").select(
        "id", "order_id", "sku_id", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name")


def _enriched_topics(spark, sf_dir, base: str, envelopes: DataFrame) -> str:
    """ODS -> DWD: R2, then J1 / J2 and J3, each hop a stream of its own, chained by topics; gives the root of the enriched ones."""
    td = TestData(spark, sf_dir)
    ods, dwd, ckpt = f"{base}/ods", f"{base}/dwd", f"{base}/checkpoint"
    run(cdc_ods_job(envelopes, ods, f"{ckpt}/ods"))
    orders = read_topic(spark, ods_topic_name("order_info"), root=ods, stream=True)
    lines = read_topic(spark, ods_topic_name("order_detail"), root=ods, stream=True)
    run(enrich_orders_job(orders, td.province_info, td.user_info, topic_sink(dwd, DWD_ORDER_INFO, "id"),
                          f"{ckpt}/orders", as_of_year=AS_OF_YEAR))
    dims = lambda: (td.sku_info(), td.spu_info(), td.trademark_info(), td.category3_info())
    run(enrich_details_job(lines, dims, topic_sink(dwd, DWD_ORDER_DETAIL, "order_id"), f"{ckpt}/lines"))
    return dwd


def order_wide_chain(spark, sf_dir, base: str, envelopes: DataFrame) -> DataFrame:
    """ODS -> DWD -> DWS over staged ``envelopes``: R2, then J1 / J2 and J3, then J4 -> R7 -> D6, chained by topics.

    Each hop is a stream of its own, with its checkpoint under ``base``; called
    again after more envelopes were staged, every hop goes on where it stopped.
    """
    dwd = _enriched_topics(spark, sf_dir, base, envelopes)
    run(dws_wide_job(spark, dwd, f"{base}/wide", f"{base}/checkpoint/wide", delay=DELAY), stateful=True)
    return read_order_wide(spark, f"{base}/wide")


def order_wide_service(spark, sf_dir, base: str, staged: str, schema, files: int) -> DataFrame:
    """The hops of ``order_wide_chain`` over a feed staged in order, which comes in ``files`` files at a time.

    The wide job goes on running and takes each part when it is enriched, so a
    trigger, its state and its shuffles are a part's, not the whole feed's.  The
    parts come in the order of their event time, so state expires behind them.
    """
    feed, wide = f"{base}/in", None
    fs, at = _fs(spark, feed)
    fs.mkdirs(at)
    parts = sorted(_files_of(spark, staged))
    try:
        for i in range(0, len(parts), files):
            for name in parts[i:i + files]:
                _move(spark, f"{staged}/{name}", f"{feed}/{name}")
            dwd = _enriched_topics(spark, sf_dir, base, spark.readStream.schema(schema).parquet(feed).drop("arrive_s"))
            if wide is None:
                wide = start_stateful(dws_wide_job(spark, dwd, f"{base}/wide", f"{base}/checkpoint/wide", delay=ORDERED_DELAY))
            wide.processAllAvailable()
    finally:
        if wide is not None:
            wide.stop()
    return read_order_wide(spark, f"{base}/wide")


def with_order_share(wide: DataFrame) -> DataFrame:
    """The wide rows with the order's sum instead of the line's share: which line takes the remainder is open in a stream."""
    sums = wide.groupBy("order_id").agg(sum_money("final_detail_amount").cast("double").alias("order_share"))
    return wide.drop("final_detail_amount").join(sums, "order_id")


def stream_order_wide_chain(spark, sf_dir):
    """Three chained streams from CDC envelopes to the stored fact, all columns; a share as its order's sum."""
    base = shared_path(spark, "twins", "chain", unique=True)
    env = TestData(spark, sf_dir).cdc_order_envelopes()
    env = env.withColumn("timestamp", F.timestamp_seconds(F.col("arrive_s") + CLOCK_SHIFT_S))
    stage(env, f"{base}/staged", "arrive_s")
    files = max(FILES_OF_A_PART, state_files(spark))
    return with_order_share(order_wide_service(spark, sf_dir, base, f"{base}/staged", env.schema, files))


# Deliveries: five batches by arrival; every eleventh row comes one batch late.
DELIVERIES = 5
LATE_MOD = 11
# Every thirteenth line arrives long after its header, beyond the retention.
STRAY_MOD = 13
STRAY_S = 1000
WATERMARK_S = 600


def deliveries(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Headers and lines with ``batch``, the delivery that they come in."""
    info, detail = Warehouse(spark, sf_dir).td.order_info, Warehouse(spark, sf_dir).td.order_detail
    detail = detail.withColumn("arrive_s", F.col("arrive_s") + F.when(F.col("id") % STRAY_MOD == 0, STRAY_S).otherwise(0))
    # As many seconds as the last order's arrival, in as many parts.
    span = info.agg(F.max("arrive_s").alias("span"))
    at = F.least(F.lit(DELIVERIES - 1), F.greatest(F.lit(0), F.expr(f"arrive_s * {DELIVERIES} div span")))
    late = F.when(F.col("id") % LATE_MOD == 0, 1).otherwise(0)
    return tuple(_shifted(df.crossJoin(F.broadcast(span)).withColumn("batch", (at + late).cast("int")).drop("span"))
                 for df in (info, detail))


def _files(lines: DataFrame) -> int:
    """Files of a delivery's rows in time: they follow the number of rows."""
    return max(FILES_PER_TRIGGER, -(-lines.count() // (DELIVERIES * ROWS_PER_FILE)))


def _move(spark: SparkSession, source: str, target: str) -> bool:
    """A written folder or file becomes part of a feed; False where there is none."""
    fs, at = _fs(spark, source)
    if not fs.exists(at):
        return False
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"{source} can't be moved to {target}")
    return True


def _gated(spark, base: str, name: str, feed: DataFrame, files: int) -> tuple[str, DataFrame]:
    """Sends a feed through a late gate, delivery by delivery: the folder of the rows in time, the late rows.

    The rows in time are stored in the order of their arrival, in ``files`` files a
    delivery, so the next stream may take a few files at a time: none of them
    is behind the watermark of those before.
    """
    src, on_time = f"{base}/{name}", f"{base}/{name}-ontime"
    with tidy(spark):
        feed.write.partitionBy("batch").option("compression", STAGED_CODEC).parquet(f"{src}-deliveries")
    gate = LateGate(spark, f"{base}/{name}-gate", "arrive_ts", WATERMARK_S)

    def in_order(rows: DataFrame, batch_id: int) -> None:
        write_in_order(rows, f"{on_time}/batch={int(batch_id)}", "arrive_ts", files, mode="overwrite")

    for batch in range(DELIVERIES + 1):
        if _move(spark, f"{src}-deliveries/batch={batch}", f"{src}/batch={batch}"):
            run(late_gate_job(spark.readStream.schema(feed.schema).parquet(src), gate, in_order, folder_sink(f"{base}/{name}-late"),
                              f"{base}/checkpoint-{name}"))
    return on_time, spark.read.schema(feed.schema).parquet(f"{base}/{name}-late")


def stream_late_rows(spark, sf_dir):
    """The headers and lines behind a 10-minute watermark, from the late table."""
    base = shared_path(spark, "twins", "late", unique=True)
    info, detail = deliveries(spark, sf_dir)
    files = _files(TestData(spark, sf_dir).table("lineitem"))
    late_info, late_detail = _gated(spark, base, "info", info, files)[1], _gated(spark, base, "detail", detail, files)[1]
    return late_info.select(F.lit("info").alias("side"), "id").unionByName(late_detail.select(F.lit("detail").alias("side"), "id"))


def stream_retained_outer(spark, sf_dir):
    """Late gate -> J5 with a 10-minute watermark and retention: the pairs, and what expired without a partner.

    A last header and line, long after all others, let every state expire.
    """
    base = shared_path(spark, "twins", "outer", unique=True)
    feeds, files = [], _files(TestData(spark, sf_dir).table("lineitem"))
    for name, df in zip(("info", "detail"), deliveries(spark, sf_dir), strict=True):
        path, _ = _gated(spark, base, name, df, files)
        end = spark.read.schema(df.schema).parquet(f"{base}/{name}").limit(1).withColumns({"id": F.lit(-1).cast("bigint"), "arrive_ts": F.lit("2200-01-01").cast("timestamp")})
        if name == "detail":
            end = end.withColumn("order_id", F.lit(-1).cast("bigint"))
        end.write.parquet(f"{path}/batch={DELIVERIES + 1}")
        feeds.append(read_staged(spark, path, df.schema, state_files(spark)))
    job = retained_pairs_job(*feeds, folder_sink(f"{base}/pairs"), folder_sink(f"{base}/expired"), f"{base}/checkpoint",
                             delay=f"{WATERMARK_S} seconds", retention_s=WATERMARK_S)
    run(job, stateful=True)
    pairs = spark.read.parquet(f"{base}/pairs").where("i_id >= 0").select(
        F.lit("pair").alias("side"), F.col("i_id").alias("order_id"), F.col("d_id").alias("order_detail_id"))
    expired = spark.read.parquet(f"{base}/expired").where("order_id >= 0")
    return pairs.unionByName(expired.select("side", "order_id", "order_detail_id"))


def stream_offset_ledger(spark, sf_dir):
    """A consumer stops half-way; another one, with a checkpoint of its own, goes on from the stored ledger.

    The ledger at the end, and the records that the two have consumed.
    """
    base = shared_path(spark, "twins", "ledger", unique=True)
    rec = TestData(spark, sf_dir).app_log_records()
    middle = rec.agg(F.max("offset")).first()[0] // 2
    consumed = folder_sink(f"{base}/out")

    def consume(part: str) -> None:
        ledger = OffsetLedger(spark, f"{base}/offsets", "start_app_group")
        seen = ledger.read()
        stream = read_topic(spark, "APP_LOG", root=f"{base}/in", stream=True, ledger=seen)
        sink = with_ledger(lambda rows, batch_id: consumed(rows, batch_id + (0 if part == "first" else 1000)), ledger)
        run(stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/checkpoint-{part}"))

    write_topic_batch(rec.where(F.col("offset") <= middle), root=f"{base}/in")
    consume("first")
    write_topic_batch(rec.where(F.col("offset") > middle), root=f"{base}/in")
    consume("second")
    ledger = OffsetLedger(spark, f"{base}/offsets", "start_app_group").read()
    count = spark.read.parquet(f"{base}/out").groupBy("topic", "partition").agg(F.count("*").alias("n_records"))
    return ledger.join(count, ["topic", "partition"], "full").select(
        "topic", F.col("partition").cast("bigint").alias("partition"), "next_offset", "n_records")


def stream_archive(spark, sf_dir):
    """S5 as a stream: the collector's lines in day folders."""
    src, out, ckpt = _dirs(spark, "archive")
    logs = TestData(spark, sf_dir).app_log_json().withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    stage(logs, src, "event_id")
    run(archive_stream(read_staged(spark, src, logs.schema), out, ckpt))
    back = read_archive(spark, out, batched=False)
    return back.select("dt", F.get_json_object("value", "$.common.mid").alias("mid"),
                       F.get_json_object("value", "$.ts").cast("bigint").alias("ts"))


def twins() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "stream_route_app_logs": stream_route_app_logs,
        "stream_dim_upsert_province": _stream_dim("province"),
        "stream_dim_upsert_sku": _stream_dim("sku"),
        "stream_dau_dedup": stream_dau_dedup,
        "stream_wide_window_join": _stream_pairs("window"),
        "stream_wide_retained_join": _stream_pairs("retained", retention_s=10),
        "stream_apportion_cents": stream_apportion_cents,
        "stream_order_wide": stream_order_wide,
        "stream_cdc_dims": stream_cdc_dims,
        "stream_detail_dims": stream_detail_dims,
        "stream_order_wide_chain": stream_order_wide_chain,
        "stream_late_rows": stream_late_rows,
        "stream_retained_outer": stream_retained_outer,
        "stream_offset_ledger": stream_offset_ledger,
        "stream_archive": stream_archive,
    }


_BATCH_OF = {
    "stream_route_app_logs": "route_app_logs",
    "stream_dim_upsert_province": "dim_upsert_province",
    "stream_dim_upsert_sku": "dim_upsert_sku",
    "stream_dau_dedup": "dau_dedup",
    "stream_wide_window_join": "wide_window_join",
    "stream_wide_retained_join": "wide_retained_join",
    "stream_apportion_cents": "apportion_cents",
    "stream_order_wide": "order_wide_sums",
    "stream_cdc_dims": "dim_upsert_sku",
    "stream_detail_dims": "detail_dims_inserted",
    "stream_order_wide_chain": "order_wide_chain",
    "stream_late_rows": "late_rows",
    "stream_retained_outer": "retained_outer",
    "stream_offset_ledger": "source_ledger",
    "stream_archive": "sink_archive",
}


def twin_oracles(batch: dict[str, str]) -> dict[str, str]:
    """A twin's oracle is the batch oracle of the same query, or one of its own."""
    from strata.plans.oracle import twin_only

    every = batch | twin_only()
    return {k: every[v] for k, v in _BATCH_OF.items() if v in every}
