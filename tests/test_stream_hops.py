"""Chained hops, late rows, expiry, ledgers, replays after a crash, admission."""

from datetime import datetime, timedelta
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.operators.offsets import merge_ledgers, offset_ledger, starting_offsets
from strata.operators.wide import retained_join
from strata.plans.catalog import sink_archive
from strata.schemas import DIMENSIONS, TOPIC_RECORD
from strata.sources.dimstore import DimensionStore
from strata.sources.ledger import OffsetLedger, with_ledger
from strata.sources.sinks import DayIndex, read_order_wide
from strata.sources.testdata import TestData
from strata.sources.topics import read_topic, write_topic_batch
from strata.streaming import jobs
from strata.streaming.apportion_state import make_state_fn
from strata.streaming.late import LateGate, folder_sink, late_gate_job
from strata.streaming.twins import CLOCK_SHIFT_S, DELAY, order_wide_chain, run, stream_archive, with_order_share

T0 = datetime(2024, 1, 1)
INFO = "id long, final_total_amount double, arrive_ts timestamp"
DETAIL = "id long, order_id long, sku_id long, arrive_ts timestamp"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def feed(spark, path, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def put(spark, path, schema, rows):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def few_envelopes(spark):
    td = TestData(spark, SF_SMALL)
    env = td.cdc_order_envelopes().where("arrive_s < 6000")
    return env.withColumn("timestamp", F.timestamp_seconds(F.col("arrive_s") + CLOCK_SHIFT_S)).persist()


def test_chain_goes_on_after_a_stop(spark, scratch):
    """All three hops stopped half-way and started again give what one run gives."""
    env = few_envelopes(spark)

    def chain(base, parts):
        for p in parts:
            p.coalesce(2).write.mode("append").parquet(f"{base}/in")
            stream = spark.readStream.schema(env.schema).parquet(f"{base}/in").drop("arrive_s")
            out = order_wide_chain(spark, SF_SMALL, base, stream)
        return _rows(with_order_share(out))

    whole = chain(f"{scratch}/a", [env])
    halves = chain(f"{scratch}/b", [env.where("arrive_s < 3000"), env.where("arrive_s >= 3000")])
    assert whole and halves == whole
    wide = read_order_wide(spark, f"{scratch}/a/wide")
    assert wide.where("province_name is null and user_age_group is null").count() < wide.count()
    assert wide.where("tm_name is null or spu_name is null or category3_name is null").count() == 0


def test_topics_of_the_chain_are_keyed(spark, scratch):
    td = TestData(spark, SF_SMALL)
    rows = td.order_detail.limit(20).withColumn("timestamp", F.timestamp_seconds("arrive_s"))
    jobs.topic_sink(scratch, jobs.DWD_ORDER_DETAIL, "order_id")(rows, 3)
    back = read_topic(spark, jobs.DWD_ORDER_DETAIL, root=scratch)
    assert back.where("key = get_json_object(value, '$.order_id') and timestamp is not null").count() == 20
    bad = back.limit(1).withColumn("value", F.lit("{no json"))
    bad.write.parquet(f"{scratch}/bad")
    run(jobs.dwd_rejects_job(spark.readStream.schema(TOPIC_RECORD).parquet(f"{scratch}/bad"), jobs.ORDER_DETAIL, f"{scratch}/out", f"{scratch}/ck"))
    assert spark.read.parquet(f"{scratch}/out").count() == 1


def test_late_gate_splits_by_its_watermark_and_replays(spark, scratch):
    src = f"{scratch}/in"
    schema = "id long, arrive_ts timestamp"
    put(spark, src, schema, [(1, at(0)), (2, at(1000))])
    put(spark, src, schema, [(3, at(400)), (4, at(401)), (5, at(5000)), (6, None)])
    put(spark, src, schema, [(7, at(4400)), (8, at(4401)), (9, at(10))])
    gate = LateGate(spark, f"{scratch}/gate", "arrive_ts", 600)
    crash = {1: True}

    def late(rows, batch_id):
        folder_sink(f"{scratch}/late")(rows, batch_id)
        if crash.pop(batch_id, False):
            raise RuntimeError("after the sink, before the commit")

    def job():
        return late_gate_job(feed(spark, src, schema), gate, folder_sink(f"{scratch}/ontime"), late, f"{scratch}/ck")

    with pytest.raises(Exception, match="before the commit"):
        run(job())
    run(job())
    ids = lambda p: sorted(r.id for r in spark.read.parquet(f"{scratch}/{p}").collect())
    assert ids("late") == [3, 6, 7, 9] and ids("ontime") == [1, 2, 4, 5, 8]


def test_state_falls_and_unmatched_rows_come_out_once(spark, scratch):
    infos = [[(1, 10.0, at(0)), (2, 20.0, at(5))], [(3, 30.0, at(4000))], [(4, 40.0, at(90_000))], [(5, 1.0, at(200_000))]]
    lines = [[(11, 1, 7, at(10)), (12, 1, 7, at(590)), (13, 1, 7, at(601)), (91, 9, 7, at(3))], [(31, 3, 7, at(4600)), (32, 3, 7, at(4601))],
             [(42, 4, 7, at(90_000))], [(52, 6, 7, at(200_000))]]
    for i, d in zip(infos, lines, strict=True):
        put(spark, f"{scratch}/info", INFO, i)
        put(spark, f"{scratch}/detail", DETAIL, d)
    job = jobs.retained_pairs_job(feed(spark, f"{scratch}/info", INFO), feed(spark, f"{scratch}/detail", DETAIL), folder_sink(f"{scratch}/pairs"),
                                  folder_sink(f"{scratch}/expired"), f"{scratch}/ck", delay="10 minutes", retention_s=600)
    q = job.trigger(availableNow=True).start()
    q.awaitTermination()
    pairs = spark.read.parquet(f"{scratch}/pairs").select("i_id", "d_id")
    expired = spark.read.parquet(f"{scratch}/expired").select("side", "order_id", "order_detail_id")
    assert _rows(pairs) == [(1, 11), (1, 12), (3, 31), (4, 42)]
    assert _rows(expired) == sorted([("detail", 1, 13), ("detail", 3, 32), ("detail", 9, 91), ("info", 2, None)], key=str)
    join = [p.stateOperators[0] for p in q.recentProgress if p.stateOperators]
    held = [op.numRowsTotal for op in join]
    assert max(held) > held[-1] and held[-1] <= 4  # only rows of the last hour are held
    # The batch form agrees, but for the rows whose time has not run out.
    info = spark.createDataFrame([r for x in infos for r in x], INFO)
    detail = spark.createDataFrame([r for x in lines for r in x], DETAIL)
    outer = retained_join(info, detail, retention_s=600, how="full_outer")
    assert outer.where("i_id is not null and d_id is not null").count() == 4 and outer.count() == 4 + 4 + 2


def test_a_new_query_starts_from_the_stored_ledger(spark, scratch):
    rec = TestData(spark, SF_SMALL).app_log_records()
    first, second = rec.where("offset < 300"), rec.where("offset >= 300")
    got = []

    def consume(checkpoint, resume=False):
        ledger = OffsetLedger(spark, f"{scratch}/ledger", "g")
        ledger = ledger.resume() if resume else ledger
        stream = read_topic(spark, "APP_LOG", root=f"{scratch}/in", stream=True, ledger=ledger.read())
        sink = with_ledger(lambda rows, i: got.extend(r.offset for r in rows.collect()), ledger)
        run(stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{scratch}/{checkpoint}"))
        return ledger

    write_topic_batch(first, root=f"{scratch}/in")
    ledger = consume("a")
    assert _rows(ledger.read()) == _rows(offset_ledger(first).select("topic", "partition", "next_offset"))
    write_topic_batch(second, root=f"{scratch}/in")
    ledger = consume("b")
    assert sorted(got) == sorted(r.offset for r in rec.select("offset").collect())
    assert _rows(ledger.read()) == _rows(offset_ledger(rec).select("topic", "partition", "next_offset"))
    # A replayed batch leaves the ledger as it is, and a ledger never goes back.
    ledger.save(first, 0)
    assert _rows(merge_ledgers(ledger.read(), offset_ledger(rec))) == _rows(offset_ledger(rec).select("topic", "partition", "next_offset"))
    assert starting_offsets(ledger.read()).startswith('{"APP_LOG": {"0":')


def test_admission_bounds_a_batch(spark, scratch):
    rec = TestData(spark, SF_SMALL).app_log_records().limit(60).repartition(6)
    write_topic_batch(rec, root=scratch)
    sizes = []
    stream = read_topic(spark, "APP_LOG", root=scratch, stream=True, max_per_trigger=2)
    writer = stream.writeStream.foreachBatch(lambda rows, i: sizes.append((rows.count(), len(set(rows.inputFiles())))))
    q = jobs.service(writer.option("checkpointLocation", f"{scratch}/_ck"), every="1 second").start()
    q.processAllAvailable()
    q.stop()
    assert sum(n for n, _ in sizes) == 60 and len(sizes) >= 3 and max(n for n, _ in sizes) <= 30


def test_archive_stream_equals_batch(spark):
    assert _rows(stream_archive(spark, SF_SMALL)) == _rows(sink_archive(spark, SF_SMALL))


class Crash:
    """Raises once after the ``n``-th call of a sink has done its work."""

    def __init__(self, n=1):
        self.n, self.calls = n, 0

    def after(self, write):
        def call(*args, **kw):
            out = write(*args, **kw)
            self.calls += 1
            if self.calls == self.n:
                raise RuntimeError("after the sink, before the commit")
            return out

        return call


def crashed_and_restarted(job):
    with pytest.raises(Exception, match="before the commit"):
        run(job())
    run(job())


def test_dimension_and_activity_jobs_replay_after_a_crash(spark, scratch, monkeypatch):
    td = TestData(spark, SF_SMALL)
    schema, key, _ = DIMENSIONS["sku"]
    hist = td.dimension_history("sku").persist()
    hist.repartition(4).write.parquet(f"{scratch}/sku")
    monkeypatch.setattr(DimensionStore, "write_batch", Crash(2).after(DimensionStore.write_batch))
    store = DimensionStore(spark, f"{scratch}/dim", key)
    crashed_and_restarted(lambda: jobs.dimension_job(feed(spark, f"{scratch}/sku", hist.schema), store, schema, f"{scratch}/ck", compact_every=2))
    cols = td.sku_info().columns
    assert _rows(store.read().select(*cols)) == _rows(td.sku_info())

    rec = td.app_log_records()
    rec.repartition(3).write.parquet(f"{scratch}/logs")
    monkeypatch.setattr(DayIndex, "write_batch", Crash(2).after(DayIndex.write_batch))
    index = DayIndex(spark, f"{scratch}/dau")
    crashed_and_restarted(lambda: jobs.dau_job(feed(spark, f"{scratch}/logs", rec.schema), index, f"{scratch}/ck2", delay=DELAY, compact_every=1))
    from strata.plans.catalog import dau_dedup

    cols = ["mid", "uid", "ar", "ch", "vc", "dt", "hr", "mi", "ts"]
    assert _rows(index.read().select(*cols)) == _rows(dau_dedup(spark, SF_SMALL).select(*cols))


def test_compaction_bounds_a_day_and_can_be_repeated(spark, scratch, monkeypatch):
    """A crash in the deletion, a second run and a replayed newest batch change no row."""
    index = DayIndex(spark, scratch)
    want = {}

    def write(batch):
        rows = [("d1", f"m{k}", batch) for k in range(batch % 3, 12, 2)] + ([("d2", "x", batch)] if batch < 3 else [])
        index.write_batch(spark.createDataFrame(rows, "day string, mid string, v long"), batch)
        want.update({r[:2]: r[2] for r in rows})

    def read(*days):
        return {(r.day, r.mid): r.v for r in index.read(*days).collect()}

    def folders(day):
        return {p.parent.name.split("=")[1] for p in Path(scratch.split(":", 1)[-1]).glob(f"batch=*/day={day}")}

    for batch in range(10):
        write(batch)
    assert len(folders("d1")) == 10 and len(folders("d2")) == 3
    # The merged rows are written, what they replace is still there, in whole or in part.
    handles = type(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch))
    real, calls = handles.__getattr__, []

    class NoDelete:
        def __init__(self, call):
            self.call = call

        def __call__(self, *args):
            calls.append(args)
            if len(calls) in (1, 4):
                raise RuntimeError("killed in the deletion")
            return self.call(*args)

    monkeypatch.setattr(handles, "__getattr__", lambda self, name: NoDelete(real(self, name)) if name == "delete" else real(self, name))
    for _ in range(2):
        with pytest.raises(RuntimeError, match="killed"):
            index.compact(8)
        assert read() == want
    monkeypatch.setattr(handles, "__getattr__", real)
    assert index.compact(8, at_least=2) == ["d1", "d2"]
    assert folders("d1") == {"8", "9"} and folders("d2") == {"8"} and read() == want
    assert read("d1") == {k: v for k, v in want.items() if k[0] == "d1"}
    write(9)
    assert read() == want and index.compact(8, at_least=2) == []
    for batch in range(10, 13):
        write(batch)
    assert index.compact(11, at_least=2) == ["d1"] and folders("d1") == {"11", "12"} and read() == want


def test_a_hot_day_of_a_micro_batch_has_several_writers(spark, scratch):
    from strata.plans.stored import stored_wide
    from strata.sources.sinks import write_order_wide

    wide = stored_wide(spark, SF_SMALL).limit(2000).withColumn("dt", F.lit("2024-01-01"))
    for _ in range(2):
        write_order_wide(wide, scratch, batch_id=3)
    back = read_order_wide(spark, scratch)
    assert back.count() == wide.count() and 2 <= len(back.inputFiles()) <= 4


def test_enrich_and_wide_jobs_replay_after_a_crash(spark, scratch, monkeypatch):
    """A crash after each sink's write: the enriched topics and the stored fact are as without it."""
    env = few_envelopes(spark)
    env.coalesce(2).write.parquet(f"{scratch}/in")

    def chain(base):
        return order_wide_chain(spark, SF_SMALL, base, spark.readStream.schema(env.schema).parquet(f"{scratch}/in").drop("arrive_s"))

    want = _rows(with_order_share(chain(f"{scratch}/calm")))
    for target, name in ((jobs, "write_topic_batch"), (jobs, "write_topic_batch"), (jobs, "write_order_wide")):
        monkeypatch.setattr(target, name, Crash(1).after(getattr(target, name)))
    left = 3
    while True:
        try:
            out = chain(f"{scratch}/rough")
            break
        except Exception as e:
            left -= 1
            assert left >= 0 and "before the commit" in str(e)
    assert left < 3 and _rows(with_order_share(out)) == want


class State:
    exists, hasTimedOut, kept = False, False, None

    def update(self, value):
        self.exists, self.kept = True, value

    @property
    def get(self):
        return self.kept

    def setTimeoutTimestamp(self, ms):
        self.ms = ms


def frame(first, n, total, final):
    return pd.DataFrame({"order_detail_id": range(first, first + n), "final_total_amount": final, "original_total_amount": total,
                         "sku_price": 1.25, "sku_num": 2, "arrive_ts": pd.Timestamp("2024-01-01")})


@pytest.mark.parametrize("scale", [2, 4, None])
def test_a_million_lines_of_one_order_by_frames(scale):
    """Frames are worked off one by one; the shares of an order add up to its amount."""
    lines, size = (1_000_000, 10_000) if scale == 2 else (3_000, 500)
    held = []

    def frames():
        for i in range(0, lines, size):
            held.append(i)
            yield frame(i, size, lines * 2.5, lines * 1.2345)

    state, total, seen = State(), 0.0, 0
    for out in make_state_fn(scale, 600)((1,), frames(), state):
        assert len(held) == seen // size + 1  # none read ahead
        seen += len(out)
        total += out["final_detail_amount"].sum()
        assert out["final_detail_amount"].iloc[0] == pytest.approx(1.2345, abs=0.006)
    assert seen == lines and total == pytest.approx(round(lines * 1.2345, 2), abs=1e-4)
    assert state.kept[0] == str(lines * 250)


def test_frames_give_the_shares_of_one_frame():
    rnd = __import__("random").Random(4)
    rows = [(i, rnd.randint(0, 900) / 100, rnd.randint(1, 5)) for i in range(40)]
    total = round(sum(p * n for _, p, n in rows), 2)
    pdf = pd.DataFrame(rows, columns=["order_detail_id", "sku_price", "sku_num"]).assign(final_total_amount=99.99, original_total_amount=total, arrive_ts=pd.Timestamp("2024-01-01"))
    one = pd.concat(make_state_fn(2, 600)((1,), iter([pdf]), State()))
    many = pd.concat(make_state_fn(2, 600)((1,), iter([pdf[:7], pdf[7:8], pdf[8:]]), State()))
    assert one["final_detail_amount"].tolist() == many["final_detail_amount"].tolist()
    assert round(one["final_detail_amount"].sum(), 2) == 99.99
