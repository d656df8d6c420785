"""What keeps a stream's time and state in proportion to its input."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from strata.schemas import ORDER_WIDE
from strata.sources.sinks import read_order_wide, write_order_wide
from strata.streaming.apportion_state import make_bucket_fn, make_state_fn
from strata.streaming.jobs import wide_pairs_stream
from strata.streaming.twins import ORDERED_DELAY, read_staged, stage


class State:
    def __init__(self):
        self.exists, self.hasTimedOut, self.kept, self.ms, self.mark = False, False, None, None, 0

    def update(self, value):
        self.exists, self.kept = True, value

    def remove(self):
        self.exists, self.kept = False, None

    @property
    def get(self):
        return self.kept

    def setTimeoutTimestamp(self, ms):
        assert ms > self.mark
        self.ms = ms

    def getCurrentWatermarkMs(self):
        return self.mark


def lines(orders, per_order, minute=0):
    rnd = np.random.default_rng(minute + 7)
    rows = [(o, o * 100 + minute * 10 + i, rnd.integers(0, 900) / 100, int(rnd.integers(0, 5))) for o in orders for i in range(per_order)]
    pdf = pd.DataFrame(rows, columns=["order_id", "order_detail_id", "sku_price", "sku_num"])
    total = (pdf.sku_price * pdf.sku_num).groupby(pdf.order_id).transform("sum").round(2)
    at = pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=minute)
    return pdf.assign(_bucket=1, final_total_amount=77.77, original_total_amount=total, arrive_ts=at).sample(frac=1, random_state=1)


def test_a_bucket_of_orders_gives_the_shares_of_each_order():
    for scale in (2, None):
        pdf, state = lines(range(9), 7), State()
        got = pd.concat(make_bucket_fn(scale, 600)((1,), iter([pdf[:20], pdf[20:]]), state))
        assert "_bucket" not in got
        # the frames of an order are worked off one by one, so each order gets the same cuts
        want = pd.concat([out for o in range(9) for out in make_state_fn(scale, 600)((o,), iter([f[f.order_id == o] for f in (pdf[:20], pdf[20:])]), State())])
        key = ["order_id", "order_detail_id", "final_detail_amount"]
        assert got.sort_values(key)[key].values.tolist() == want.sort_values(key)[key].values.tolist()


def test_an_order_of_a_bucket_expires_on_its_own():
    fn, state = make_bucket_fn(2, 600), State()
    list(fn((1,), iter([lines([1, 2], 2)]), state))
    first = state.ms
    state.mark = first - 1
    list(fn((1,), iter([lines([2, 3], 2, minute=5)]), state))
    assert state.ms == first  # the order 1 is still due
    state.mark, state.hasTimedOut = first + 1, True
    list(fn((1,), iter([]), state))
    assert set(__import__("json").loads(state.kept[0])) == {"2", "3"} and state.ms == first + 300_000
    state.mark = first + 300_001
    list(fn((1,), iter([]), state))
    assert not state.exists


def test_staged_files_come_in_order_and_state_expires(spark, scratch):
    """The state of a join holds a trigger's rows, not the whole feed's."""
    at = F.timestamp_seconds(F.col("id") * 60 + 86_400)
    info = spark.range(20_000).repartition(7).withColumns({"arrive_s": F.col("id") * 60, "arrive_ts": at})
    detail = info.select(F.col("id").alias("order_id"), (F.col("id") * 10).alias("id"), "arrive_s", "arrive_ts")
    files = stage(detail, f"{scratch}/detail", "arrive_s", files=12)
    assert files == 12 and stage(info, f"{scratch}/info", "arrive_s", files=files) == 12
    seen = spark.read.parquet(f"{scratch}/detail").select("arrive_s", "_metadata.file_modification_time").groupBy(
        "file_modification_time").agg(F.min("arrive_s").alias("a"), F.max("arrive_s").alias("b")).orderBy("file_modification_time").collect()
    assert len(seen) == 12 and all(x["b"] < y["a"] for x, y in zip(seen, seen[1:]))
    feeds = [read_staged(spark, f"{scratch}/{name}", df.schema) for name, df in (("info", info), ("detail", detail))]
    pairs = wide_pairs_stream(*feeds, "window", delay=ORDERED_DELAY).select("i_id", "d_id")
    q = pairs.writeStream.format("parquet").option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ck").trigger(
        availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(f"{scratch}/out").distinct().count() == 20_000
    held = [s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"] if s["operatorName"] == "symmetricHashJoin"]
    assert max(held) < 30_000 and held[-1] < 100


def test_a_micro_batch_of_many_days_has_few_files(spark, scratch):
    """A few rows of each day: a folder a month, and a day's read opens that month's files only."""
    day = F.date_format(F.date_add(F.lit("2023-12-17").cast("date"), (F.col("id") % 60).cast("int")), "yyyy-MM-dd")
    given = {"dt": F.when(F.col("id") != 7, day), "order_id": F.col("id"), "order_detail_id": F.col("id")}
    wide = spark.range(600).select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ORDER_WIDE.fields])
    for batch in (0, 1, 1):
        write_order_wide(wide, scratch, batch_id=batch)
    back = read_order_wide(spark, scratch)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, wide.union(wide).collect()), key=str)
    assert len(back.inputFiles()) <= 2 * (4 + int(spark.conf.get("spark.sql.shuffle.partitions")))
    one = read_order_wide(spark, scratch, ["2024-02-03"])
    assert one.count() == 20 and read_order_wide(spark, scratch, ["1999-01-01"]).count() == 0
