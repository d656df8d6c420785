"""What keeps a stream's disk, and the fixed cost of its triggers, in proportion to its input."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.session import start_stateful
from strata.sources.testdata import TestData
from strata.sources.topics import write_topic_batch
from strata.streaming import apportion_state, jobs
from strata.streaming.apportion_state import make_bucket_fn
from strata.streaming.late import folder_sink
from strata.streaming.twins import CLOCK_SHIFT_S, ORDERED_DELAY, order_wide_chain, order_wide_service, read_staged, run, stage, with_order_share, write_in_order
from test_stream_scale import State, lines


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_cent_amounts_are_worked_off_by_columns(monkeypatch):
    """No call a line; the result is that of the way order by order, also where lines below nothing complete an order twice."""
    pdf = lines(range(50), 6)
    pdf.loc[pdf.order_id % 5 == 0, "sku_price"] = -1.25
    pdf.loc[pdf.order_id % 7 == 0, "original_total_amount"] = 0.0
    twice = pd.DataFrame({"order_id": 99, "order_detail_id": range(4), "sku_price": [2.0, 3.0, -3.0, 3.0], "sku_num": 1, "_bucket": 1,
                          "original_total_amount": 5.0, "final_total_amount": 4.99, "arrive_ts": pd.Timestamp("2024-01-01")})
    pdf = pd.concat([pdf, twice])
    states = State(), State()
    with monkeypatch.context() as m:
        m.setattr(apportion_state._Frames, "_fits", lambda *_: False)
        want = pd.concat(make_bucket_fn(2, 600)((1,), iter([pdf[:70], pdf[70:]]), states[0]))
    monkeypatch.setattr(apportion_state, "_cents", lambda x: 1 / 0)
    got = pd.concat(make_bucket_fn(2, 600)((1,), iter([pdf[:70], pdf[70:]]), states[1]))
    np.testing.assert_array_equal(got["final_detail_amount"], want["final_detail_amount"])
    assert states[0].kept == states[1].kept and got["order_detail_id"].tolist() == pdf["order_detail_id"].tolist()


def test_amounts_that_are_no_cents_round_as_before():
    x = np.array([0.005, 1.005, 2.675, -0.005, -1.005, 1e15 / 7, 123456789.125, 0.1 + 0.2, 19.99])
    assert list(apportion_state._all_cents(x)) == [apportion_state._cents(v) for v in x]


def test_state_has_partitions_for_the_cores_not_for_whole_tables(spark, scratch):
    rows = spark.range(50).select("id", F.timestamp_seconds(F.col("id") + 86_400).alias("at"))
    stage(rows, f"{scratch}/in", "id")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        seen = read_staged(spark, f"{scratch}/in", rows.schema).withWatermark("at", "1 day").dropDuplicatesWithinWatermark(["id"])
        q = start_stateful(seen.writeStream.format("parquet").option("path", f"{scratch}/out")
                           .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True))
        q.awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert spark.read.parquet(f"{scratch}/out").count() == 50
    assert {s["numShufflePartitions"] for p in q.recentProgress for s in p["stateOperators"]} == {16}


def test_staging_and_streams_leave_no_shuffles_behind(spark, scratch):
    before = shuffle_files(spark)
    rows = spark.range(5000).groupBy((F.col("id") % 1000).alias("k")).agg(F.count("*").alias("n"))
    stage(rows, f"{scratch}/in", "k")
    counted = read_staged(spark, f"{scratch}/in", rows.schema).groupBy("k").count()
    run(counted.writeStream.foreachBatch(lambda df, i: folder_sink(f"{scratch}/out")(df.repartition(3), i)).outputMode("update")
        .option("checkpointLocation", f"{scratch}/ck"))
    assert not shuffle_files(spark) - before
    assert spark.read.parquet(f"{scratch}/in").count() == 1000 and spark.read.parquet(f"{scratch}/out").count() == 1000
    held = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{scratch}/in-unordered")
    assert not held.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(held)


def test_two_sinks_work_off_a_retained_join_once(spark, scratch):
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    at = F.timestamp_seconds(F.col("id") * 60 + 86_400)
    info = spark.range(40).select("id", at.alias("arrive_ts"))
    detail = info.select((F.col("id") * 10).alias("id"), F.col("id").alias("order_id"), "arrive_ts").where("order_id % 4 > 0")
    for name, df in (("info", info), ("detail", detail)):
        write_in_order(df, f"{scratch}/{name}", "arrive_ts", 2)
    feeds = {name: read_staged(spark, f"{scratch}/{name}", df.schema) for name, df in (("info", info), ("detail", detail))}
    feeds["info"] = feeds["info"].mapInPandas(count, info.schema)
    job = jobs.retained_pairs_job(feeds["info"], feeds["detail"], folder_sink(f"{scratch}/pairs"), folder_sink(f"{scratch}/expired"), f"{scratch}/ck")
    run(job, stateful=True)
    assert spark.read.parquet(f"{scratch}/pairs").count() == 30
    assert seen.value == 40


def test_a_chain_takes_its_feed_in_parts(spark, scratch):
    """The same rows as from the whole feed at once, in triggers of a part each."""
    env = TestData(spark, SF_SMALL).cdc_order_envelopes().where("arrive_s < 6000")
    env = env.withColumn("timestamp", F.timestamp_seconds(F.col("arrive_s") + CLOCK_SHIFT_S)).persist()
    stage(env, f"{scratch}/a/in", "arrive_s")
    whole = order_wide_chain(spark, SF_SMALL, f"{scratch}/a", read_staged(spark, f"{scratch}/a/in", env.schema).drop("arrive_s"))
    stage(env, f"{scratch}/b/staged", "arrive_s")
    parts = order_wide_service(spark, SF_SMALL, f"{scratch}/b", f"{scratch}/b/staged", env.schema, 2)
    assert _rows(with_order_share(parts)) == _rows(with_order_share(whole)) and whole.count() > 0
    batches = {f.split("batch=")[1].split("/")[0] for f in parts.inputFiles()}
    assert len(batches) >= 2 and ORDERED_DELAY == "10 minutes"


def test_topics_are_compressed_for_text(spark, scratch):
    rows = spark.range(20).select(F.col("id").cast("string").alias("key"), F.lit("{}").alias("value"), F.lit("T").alias("topic"))
    write_topic_batch(rows, root=f"{scratch}/appended")
    write_topic_batch(rows, root=f"{scratch}/batches", batch_id=3)
    rows.write.parquet(f"{scratch}/in")
    env = spark.readStream.schema(rows.schema).parquet(f"{scratch}/in").withColumn(
        "value", F.lit('{"type":"INSERT","table":"order_info","data":[{"id":"1"}]}'))
    run(jobs.cdc_ods_job(env.select("value"), f"{scratch}/ods", f"{scratch}/ck"))
    for name in ("appended", "batches", "ods"):
        written = spark.read.parquet(f"{scratch}/{name}")
        assert written.count() == 20 and all(".zstd." in f for f in written.inputFiles())
