"""Operator semantics on hand-made rows (FIXTURES.md §D)."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from strata.functions.dates import processing_day
from strata.operators.apportion import apportion
from strata.operators.dedup import first_per_key, last_per_key
from strata.operators.dims import upsert
from strata.operators.enrich import join_detail_dims
from strata.operators.offsets import merge_ledgers, offset_ledger
from strata.operators.wide import full_outer, retained_join, window_join
from strata.sources.dimstore import DimensionStore
from strata.sources.sinks import DayIndex, console
from strata.sources.topics import read_topic, write_topic_batch

WIDE = "order_id long, order_detail_id long, sku_price double, sku_num long, final_total_amount double, " \
       "original_total_amount double"


def _dims(spark):
    sku = spark.createDataFrame([("1", "10", "20", "30")], "id string, spu_id string, tm_id string, category3_id string")
    spu = spark.createDataFrame([("10", "spu")], "id string, spu_name string")
    tm = spark.createDataFrame([("20", "tm")], "tm_id string, tm_name string")
    c3 = spark.createDataFrame([("30", "c3")], "id string, name string")
    return sku, spu, tm, c3


def test_detail_dims_modes(spark):
    details = spark.createDataFrame([(1, 100, 1), (2, 100, 99)], "id long, order_id long, sku_id long")
    dims = _dims(spark)
    left = {r.id: r for r in join_detail_dims(details, *dims).rows.collect()}
    assert (left[1].spu_name, left[1].tm_name, left[1].category3_name, left[1].tm_id) == ("spu", "tm", "c3", 20)
    assert left[2].spu_name is None and left[2].spu_id is None
    rej = join_detail_dims(details, *dims, on_missing="reject")
    assert [r.id for r in rej.rows.collect()] == [1]
    assert [r.id for r in rej.rejects.collect()] == [2]
    with pytest.raises(Exception, match="no dimension match"):
        join_detail_dims(details, *dims, on_missing="strict").rows.collect()
    assert join_detail_dims(details.where("id = 1"), *dims, on_missing="strict").rows.count() == 1


def test_apportion_zero_total_is_null(spark):
    w = spark.createDataFrame([(1, 11, 5.0, 2, 9.0, 0.0)], WIDE)
    assert apportion(w).first().final_detail_amount is None


def test_apportion_cents_sum_to_final(spark):
    # three equal lines of 1.00, final 1.00: shares 0.33, 0.33, remainder 0.34 on the last line
    w = spark.createDataFrame([(1, i, 1.0, 1, 1.0, 3.0) for i in (11, 12, 13)], WIDE)
    got = {r.order_detail_id: r.final_detail_amount for r in apportion(w, scale=2).collect()}
    assert got == {11: 0.33, 12: 0.33, 13: 0.34}


def test_apportion_missing_line_is_proportional(spark):
    # original total 4.00 but only 3.00 of lines present: no line completes the order
    w = spark.createDataFrame([(1, i, 1.0, 1, 1.0, 4.0) for i in (11, 12, 13)], WIDE)
    assert sorted(r.final_detail_amount for r in apportion(w, scale=2).collect()) == [0.25, 0.25, 0.25]


def test_apportion_trailing_zero_line(spark):
    rows = [(1, 11, 1.0, 1, 1.0, 2.0), (1, 12, 1.0, 1, 1.0, 2.0), (1, 13, 0.0, 5, 1.0, 2.0)]
    got = {r.order_detail_id: r.final_detail_amount for r in apportion(spark.createDataFrame(rows, WIDE), 2).collect()}
    assert got == {11: 0.5, 12: 0.5, 13: 0.0}


def _arrivals(spark, info_s, detail_s):
    info = spark.createDataFrame([(1, info_s)], "id long, s long").withColumn("arrive_ts", F.timestamp_seconds("s"))
    det = spark.createDataFrame([(11, 1, d) for d in detail_s], "id long, order_id long, s long") \
        .withColumn("arrive_ts", F.timestamp_seconds("s"))
    return info, det


def test_window_join_buckets(spark):
    # header in bucket 20 (100 s); lines in buckets 22 (2 apart) and 23 (3 apart)
    info, det = _arrivals(spark, 100, [110, 115])
    got = [r.d_s for r in window_join(info, det).collect()]
    assert got == [110]


def test_window_join_one_row_per_pair(spark):
    # same bucket: the pair shares three windows but is emitted once
    info, det = _arrivals(spark, 100, [101])
    assert window_join(info, det).count() == 1


def test_retained_join_bound(spark):
    info, det = _arrivals(spark, 0, [9 * 60, 11 * 60, -9 * 60])
    got = sorted(r.d_s for r in retained_join(info, det, retention_s=600).collect())
    assert got == [-540, 540]


def test_retained_join_collapses_identical_lines(spark):
    info, det = _arrivals(spark, 0, [5, 5])
    assert retained_join(info, det).count() == 1


def test_full_outer_keeps_both_sides(spark):
    info = spark.createDataFrame([(1,), (2,)], "id long")
    det = spark.createDataFrame([(11, 1), (31, 3)], "id long, order_id long")
    got = {(r.i_id, r.d_id) for r in full_outer(info, det).collect()}
    assert got == {(1, 11), (2, None), (None, 31)}


def test_first_last_per_key(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")], "k string, t long, v string")
    assert sorted(tuple(r) for r in first_per_key(df, ["k"], ["t"]).collect()) == [("a", 1, "y"), ("b", 2, "z")]
    assert sorted(tuple(r) for r in last_per_key(df, ["k"], ["t"]).collect()) == [("a", 3, "x"), ("b", 2, "z")]


def test_upsert_order_is_timestamp_partition_offset(spark):
    t0 = F.timestamp_seconds(F.lit(0))
    upd = spark.createDataFrame([("1", "late-offset-small", 0, 9), ("1", "early", 0, 1)],
                                "id string, name string, partition int, offset long").withColumn("timestamp", t0)
    one = upsert(None, upd.select("id", "name", "timestamp", "partition", "offset"), "id")
    assert one.first().name == "late-offset-small"  # same timestamp and partition: higher offset wins
    upd2 = spark.createDataFrame([("1", "newer"), ("2", "two")], "id string, name string") \
        .withColumn("timestamp", t0).withColumn("partition", F.lit(0)).withColumn("offset", F.lit(0).cast("long"))
    two = upsert(one, upd2.select("id", "name", "timestamp", "partition", "offset"), "id", version=1)
    assert sorted((r.id, r.name) for r in two.collect()) == [("1", "newer"), ("2", "two")]


def test_dimension_store_replay_is_idempotent(spark, scratch):
    store = DimensionStore(spark, scratch, "id")
    t = F.timestamp_seconds(F.lit(0))

    def batch(rows):
        return spark.createDataFrame(rows, "id string, name string, offset long") \
            .withColumn("timestamp", t).withColumn("partition", F.lit(0))

    store.write_batch(batch([("1", "a", 0), ("2", "b", 1)]), 0)
    store.write_batch(batch([("1", "a2", 2)]), 1)
    store.write_batch(batch([("1", "a2", 2)]), 1)  # replay of batch 1
    assert sorted(tuple(r) for r in store.read().collect()) == [("1", "a2"), ("2", "b")]
    store.compact(1)
    store.compact(1)  # replay of a compaction
    store.write_batch(batch([("2", "b2", 3)]), 2)
    assert sorted(tuple(r) for r in store.read().collect()) == [("1", "a2"), ("2", "b2")]


def test_day_index_last_write_wins(spark, scratch):
    idx = DayIndex(spark, scratch)
    docs = spark.createDataFrame([("20240101", "m1", 5), ("20240101", "m1", 7), ("20240102", "m1", 1)],
                                 "day string, mid string, ts long")
    idx.write_batch(docs, 0, order=("ts",))
    idx.write_batch(spark.createDataFrame([("20240101", "m1", 3)], "day string, mid string, ts long"), 1)
    assert sorted(tuple(r) for r in idx.read().select("day", "mid", "ts").collect()) == \
        [("20240101", "m1", 3), ("20240102", "m1", 1)]
    assert idx.read("20240102").count() == 1


def test_offset_ledger(spark):
    rec = spark.createDataFrame([("t", 0, 5), ("t", 0, 9), ("t", 1, 2)], "topic string, partition int, offset long")
    led = offset_ledger(rec)
    assert sorted(tuple(r) for r in led.collect()) == [("t", 0, 10), ("t", 1, 3)]
    old = spark.createDataFrame([("t", 0, 20)], "topic string, partition int, next_offset long")
    assert sorted(tuple(r) for r in merge_ledgers(old, led).collect()) == [("t", 0, 20), ("t", 1, 3)]


def test_dimension_store_takes_the_last_arrival_whatever_the_batches(spark, scratch):
    store = DimensionStore(spark, scratch, "id")
    rows = [("1", "old", 0, 0), ("1", "new", 1, 5), ("2", "only", 0, 1)]
    t = F.timestamp_seconds(F.lit(0))
    df = spark.createDataFrame(rows, "id string, name string, partition int, offset long").withColumn("timestamp", t)
    store.write_batch(df.repartition(3), 0)  # two versions of a key in one batch, over several partitions
    assert sorted(tuple(r) for r in store.read().collect()) == [("1", "new"), ("2", "only")]
    store.write_batch(df.where("name = 'old'"), 1)  # a late redelivery of the older version
    assert sorted(tuple(r) for r in store.read().collect()) == [("1", "new"), ("2", "only")]


def test_topics_round_trip(spark, scratch):
    df = spark.createDataFrame([("a", "k", "1"), ("b", None, "2")], "topic string, key string, value string")
    for _ in range(2):  # the replay of a batch overwrites it
        write_topic_batch(df, root=scratch, batch_id=3)
    assert [(r.key, r.value, r.offset) for r in read_topic(spark, "a", root=scratch).collect()] == [("k", "1", None)]
    assert read_topic(spark, "b", root=scratch).count() == 1
    write_topic_batch(df, root=f"{scratch}/plain")
    assert read_topic(spark, "b", root=f"{scratch}/plain").count() == 1
    with pytest.raises(ValueError):
        read_topic(spark, "a", root=scratch, starting_offsets="earliest")


def test_strict_lookup_cannot_be_pruned(spark):
    details = spark.createDataFrame([(1, 1, 9)], "id long, order_id long, sku_id long")
    sku = spark.createDataFrame([], "id string, spu_id string, tm_id string, category3_id string")
    spu = spark.createDataFrame([], "id string, spu_name string")
    tm = spark.createDataFrame([], "tm_id string, tm_name string")
    c3 = spark.createDataFrame([], "id string, name string")
    rows = join_detail_dims(details, sku, spu, tm, c3, on_missing="strict").rows
    for df in (rows.select("id"), rows.groupBy("order_id").count(), rows.select("tm_name")):
        with pytest.raises(Exception, match="no dimension match"):
            df.collect()


def test_zero_and_negative_lines_apportion_exactly(spark):
    def shares(total, final, lines, scale=2):
        rows = [(1, i, float(p), 1, float(total), float(final)) for i, p in enumerate(lines)]
        df = spark.createDataFrame(rows, "order_id long, order_detail_id long, sku_price double, sku_num long, "
                                         "original_total_amount double, final_total_amount double")
        return [r.final_detail_amount for r in apportion(df, scale=scale).orderBy("order_detail_id").collect()]

    assert shares(3, 1, [1, 1, 1, 0]) == [0.33, 0.33, 0.34, 0.0]
    assert shares(3, 1, [0, 1, 1, 1]) == [0.0, 0.33, 0.33, 0.34]
    assert round(sum(shares(3, 1, [2, 2, -1])), 2) == 1.0
    assert shares(0, 1, [0, 0]) == [None, None]
    assert sum(shares(30_000_000_000, 20_000_000_000, [10_000_000_000] * 3)) == 20_000_000_000


def test_processing_day_and_console(spark):
    day = spark.range(1).select(processing_day().alias("d")).first().d
    assert re.fullmatch(r"\d{4}-\d{2}-\d{2}|\d{8}", str(day))
    writer = console(spark.readStream.format("rate").load(), num_rows=3)
    assert isinstance(writer, DataStreamWriter)
