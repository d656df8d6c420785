"""Physical-plan properties the design relies on (pushdown, pruning, broadcast, no window in A6)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.operators import dashboard as dash
from strata.operators.apportion import apportion
from strata.operators.enrich import join_detail_dims, join_user_profile, users_needed
from strata.operators.wide import inner_pairs, merge_wide
from strata.plans.catalog import dau_hour, dau_total, detail_dims, hourly_compare_amount, hourly_compare_dau, kpi_list, \
    order_amount_hour, order_amount_total, order_province, order_wide, range_search
from strata.plans.stored import stored_dau, stored_wide
from strata.plans.warehouse import Warehouse
from strata.sources.buckets import read_bucketed, write_bucketed
from strata.sources.sinks import read_order_wide, write_order_wide


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_predicate_reaches_scan(spark):
    plan = _plan(range_search(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(p_size), GreaterThanOrEqual(p_size,6), LessThanOrEqual(p_size,10)]" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_size:int>" in plan


def test_no_job_while_a_query_is_built(spark):
    """Apart from queries that write, building a query runs nothing but Parquet footer reads."""
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    wh = Warehouse(spark, SF_SMALL)
    _ = wh.td.order_info, wh.td.order_detail, wh.td.sku_info()  # footers of the tables
    sc.setJobGroup("build", "build")
    try:
        for build in (order_province, detail_dims, order_wide):
            build(spark, SF_SMALL)
        names = [tracker.getStageInfo(s).name for j in tracker.getJobIdsForGroup("build")
                 for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert all("parquet" in n for n in names), names


def _text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_fact_is_pruned_by_day(spark):
    """Also for a day that has no folder (sf0.001 has no order on the catalogue's day)."""
    for build in (order_amount_hour, order_amount_total, hourly_compare_amount):
        plan = _text(build(spark, SF_SMALL))
        assert "PartitionFilters: [isnotnull(dt" in plan or "PartitionFilters: [dt#" in plan, plan
        assert "lineitem" not in plan and "orders" not in plan


def test_dashboards_read_the_day_index(spark):
    for build in (dau_total, dau_hour, hourly_compare_dau, kpi_list):
        plan = _text(build(spark, SF_SMALL))
        assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [day#" in plan, plan
        assert "events" not in plan
        scan = next(line for line in plan.splitlines() if "PartitionFilters" in line and "day#" in line)
        assert "ReadSchema: struct<mid:string" in scan


def test_order_amounts_of_a_day_that_has_orders(spark):
    wide = stored_wide(spark, SF_SMALL)
    day, n = wide.groupBy("dt").count().orderBy(F.desc("count"), "dt").first()
    one = stored_wide(spark, SF_SMALL, day)
    assert n == one.count() > 0
    total = dash.order_amount_total(one, day).first()["amount"]
    hours = dash.order_amount_hour(one, day).collect()
    assert hours and sum(r["amount"] for r in hours) == total > 0
    both = dash.hourly_compare("order_amount", stored_wide(spark, SF_SMALL, day, dash.yesterday(day)), day).where("day = 'today'")
    assert sum(r["value"] for r in both.collect()) == total
    assert dash.order_amount_total(stored_wide(spark, SF_SMALL, "1900-01-01"), "1900-01-01").first()["amount"] == 0


def test_a_hot_day_is_written_by_many_tasks(spark, scratch):
    wide = stored_wide(spark, SF_SMALL).where("dt like '1996-0%'")
    hot = wide.withColumn("dt", F.when(F.col("order_id") % 2 == 0, F.lit("2024-01-01")).otherwise(F.substring("dt", 1, 7)))
    write_order_wide(hot, scratch)
    back = read_order_wide(spark, scratch)
    files = back.select("dt", F.input_file_name().alias("file")).distinct().groupBy("dt").count().collect()
    by_day = {r["dt"]: r["count"] for r in files}
    assert by_day["2024-01-01"] >= 2
    assert sum(by_day.values()) <= len(by_day) + int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert back.count() == wide.count()


def test_stored_tables_follow_their_sources(spark, tmp_path):
    for name in ("a", "b"):
        events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
        events.where("event_id % 2 = 0" if name == "a" else "true").write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
        dau = stored_dau(spark, str(tmp_path))
        assert sorted(map(tuple, dau.select("day", "mid").collect())) == sorted(
            map(tuple, Warehouse(spark, str(tmp_path)).dau.select("day", "mid").collect()))
    again = stored_dau(spark, str(tmp_path))
    assert sorted(again.inputFiles()) == sorted(dau.inputFiles())


def test_bucketed_users_are_not_shuffled(spark, scratch):
    """Only the batch moves: one Exchange, on the orders' side, and no sort of the users."""
    td = Warehouse(spark, SF_SMALL).td
    users = read_bucketed(spark, write_bucketed(td.user_info(), scratch, "id"))
    batch = spark.createDataFrame([(1, 3), (2, 22), (3, None)], "id long, user_id long")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        profile, needed = join_user_profile(batch, users, as_of_year=2024), users_needed(users, batch)
        for df in (profile, needed):
            lines = _text(df).splitlines()
            scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
            above, depth = [], len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
            for line in lines[scan - 1 :: -1]:
                if (at := len(line) - len(line.lstrip(" :+-"))) < depth:
                    above.append(line)
                    depth = at
            assert "Bucketed: true" in lines[scan] and "SelectedBucketsCount" in lines[scan]
            assert not any("Exchange" in line for line in above), "\n".join(lines)
        want = {r["id"]: r["name"] for r in td.user_info().collect()}
        assert {r["id"] for r in needed.collect()} == {str(u) for u in (3, 22) if str(u) in want}
        assert [r["user_gender"] is None for r in profile.orderBy("id").collect()][2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_sku_snowflake_scans_part_seven_times_at_most(spark):
    plan = detail_dims(spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") <= 8  # seven of part, one of lineitem


def test_apportion_uses_aggregates_not_a_window(spark):
    wh = Warehouse(spark, SF_SMALL)
    from strata.operators.wide import inner_pairs, merge_wide

    wide = merge_wide(inner_pairs(wh.td.order_info, wh.td.order_detail))
    plan = _plan(apportion(wide, scale=2))
    assert "Window" not in plan
    assert "HashAggregate" in plan


def _above(lines: list[str], at: int) -> list[str]:
    """The operators above a line of a plan's text."""
    above, depth = [], len(lines[at]) - len(lines[at].lstrip(" :+-"))
    for line in lines[at - 1 :: -1]:
        if (d := len(line) - len(line.lstrip(" :+-"))) < depth:
            above.append(line)
            depth = d
    return above


def test_the_wide_fact_moves_lines_twice(spark):
    """By sku for the products and by order: no line passes a third Exchange, whatever is too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = Warehouse(spark, SF_SMALL).order_wide(scale=2)
        lines = _text(wide).splitlines()
        scans = [i for i, line in enumerate(lines) if "FileScan" in line and "l_linenumber" in line]
        assert scans
        for scan in scans:
            assert sum("Exchange" in line for line in _above(lines, scan)) <= 2, "\n".join(lines)
        assert wide.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _wide_step_by_step(wh: Warehouse):
    """The wide fact by one operator after the other."""
    td = wh.td
    header = td.order_info.select(F.col("id").alias("order_id"), "final_total_amount", "original_total_amount")
    shares = apportion(td.order_detail.join(header, "order_id").withColumnRenamed("order_price", "sku_price"), scale=2, order_col="id")
    details = join_detail_dims(shares.withColumnRenamed("sku_price", "order_price"), td.sku_info(), td.spu_info(),
                               td.trademark_info(), td.category3_info()).rows
    wide = merge_wide(inner_pairs(wh.orders_enriched, details), keep=("d_final_detail_amount",))
    return wide.withColumn("final_detail_amount", F.col("d_final_detail_amount")).drop("d_final_detail_amount")


def test_the_wide_fact_on_odd_rows(spark, tmp_path):
    """Products and orders that come twice, lines without a product or an order, null keys, prices and names."""
    for name in ("nation", "customer"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.createDataFrame([(1, "nut", "Brand#11", "TIN", 9.5), (1, "bolt", "Brand#12", "TIN", 9.5), (2, None, "Brand#13", None, 1.0),
                           (3, "nut", None, "ZINC", None), (None, "cap", "Brand#11", "TIN", 2.0)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(7, 1, "O", 100.0, "1996-09-17"), (7, 2, "F", 60.0, "1996-09-18"), (8, 3, "O", None, "1996-09-17"),
                           (9, 4, None, 10.0, None), (None, 5, "O", 1.0, "1996-09-17")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(7, 1, 1, 1, 10.0, 2.0), (7, 1, 1, 1, 10.0, 2.0), (7, 2, 2, 1, 5.0, 1.0), (7, 2, 3, 1, 4.0, 1.0), (7, 3, 4, 1, 3.0, 1.0),
                           (8, 1, None, 1, 2.0, 1.0), (8, 2, 3, 2, None, 1.0), (8, 3, 3, 2, 6.0, 1.0), (9, 1, 3, None, 0.0, 1.0), (9, 2, 2, 1, 10.0, None),
                           (None, 1, 1, 1, 1.0, 1.0), (6, 1, 1, 1, 1.0, 1.0)],
                          "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    wh = Warehouse(spark, str(tmp_path))
    got, want = wh.order_wide(scale=2), _wide_step_by_step(wh)
    assert got.columns == want.columns and got.count() == want.count() > 10
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
