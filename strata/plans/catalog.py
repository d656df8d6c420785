"""Query catalogue: name -> (spark, sf_dir) -> DataFrame.

Every query reads the whole generated tables through ``Warehouse`` /
``TestData`` and calls the library operators.  Output columns are aliased and
cast to match ``strata.plans.oracle`` column for column; computed doubles are
rounded to 4 places (money to cents where the operator works in cents).
Queries that exercise sinks write under the session's checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.json import encode_row
from strata.functions.money import money
from strata.functions.text import row_text
from strata.operators import dashboard as dash
from strata.operators.apportion import apportion
from strata.operators.decode import decode_json
from strata.operators.dedup import first_per_key
from strata.operators.dims import decode_dimension
from strata.operators.enrich import join_detail_dims, join_province, join_user_profile, users_needed, \
    with_create_parts
from strata.operators.offsets import offset_ledger
from strata.operators.route import EVENT_TOPIC, START_TOPIC, flatten_cdc_batch, route_app_log, route_cdc_rows, \
    start_log_rejects
from strata.operators.search import range_text_search
from strata.operators.wide import full_outer, inner_pairs, merge_wide, retained_join, unmatched
from strata.plans.stored import stored_dau, stored_wide
from strata.plans.warehouse import AS_OF_YEAR, Warehouse
from strata.schemas import DIMENSIONS, ORDER_INFO_WIRE
from strata.session import shared_path
from strata.sources.buckets import read_bucketed, write_bucketed
from strata.sources.dimstore import DimensionStore
from strata.sources.sinks import DayIndex, append_documents, archive_text, read_archive, read_order_wide, \
    write_order_wide
from strata.sources.topics import as_records, read_topic, write_topic_batch

# The parameters of the catalogue's dashboard and search queries.
DAU_DATE = "2024-01-07"
ORDER_DATE = "1996-09-17"
RETAINED_BOUND_S = 10
SEARCH = ("p_size", 6, 10, "p_name", "red")
CORRUPT_EVERY = 97          # order rows with id % 97 == 0 are sent truncated (malformed JSON)
BAD_NUMBER_EVERY = 89       # order rows with id % 89 == 0 are sent with an amount that is no number
QUOTED_TS_EVERY = 101       # start logs with event_id % 101 == 0 have their time quoted
NO_TS_EVERY = 103           # app logs with event_id % 103 == 0 are sent without a time
REJECT_SKU_MOD = 13         # sku rows with id % 13 == 0 are missing from the sku view

Query = Callable[[SparkSession, str], DataFrame]


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spark, sf_dir)


# ---- ODS: routing and decoding ------------------------------------------------

def route_app_logs(spark, sf_dir):
    rec = route_app_log(_wh(spark, sf_dir).td.app_log_records())
    return rec.select("topic", F.col("key").cast("bigint").alias("event_id"))


def cdc_batch_flatten(spark, sf_dir):
    env = _wh(spark, sf_dir).td.cdc_batch_envelopes()
    rows = flatten_cdc_batch(env)
    return rows.select("topic", F.get_json_object("value", "$.id").cast("bigint").alias("id"))


def cdc_row_route(spark, sf_dir):
    routed = route_cdc_rows(_wh(spark, sf_dir).td.cdc_row_envelopes())
    key = F.coalesce(F.get_json_object("value", "$.id"), F.get_json_object("value", "$.tm_id"))
    return routed.select("topic", key.alias("key"))


def _decoded_orders(spark, sf_dir):
    oi = _wh(spark, sf_dir).td.order_info
    text = encode_row(*[c for c in oi.columns if c != "arrive_s"], as_text=True)
    no_number = F.regexp_replace(text, r'"final_total_amount":"[^"]*"', '"final_total_amount":"12,5"')
    value = (F.when(F.col("id") % CORRUPT_EVERY == 0, F.substring(text, 1, 20))
             .when(F.col("id") % BAD_NUMBER_EVERY == 0, no_number).otherwise(text))
    return decode_json(oi.select("id", value.alias("value")), ORDER_INFO_WIRE)


def decode_order_info(spark, sf_dir):
    return _decoded_orders(spark, sf_dir).rows


def decode_quarantine(spark, sf_dir):
    return _decoded_orders(spark, sf_dir).quarantine.select("id")


def start_log_rejects_q(spark, sf_dir):
    rec = _wh(spark, sf_dir).td.app_log_records()
    quoted = F.regexp_replace("value", r'"ts":(\d+)', '"ts":"$1"')
    value = (F.when(F.col("offset") % NO_TS_EVERY == 0, F.regexp_replace("value", r',"ts":\d+', ""))
             .when(F.col("offset") % QUOTED_TS_EVERY == 0, quoted).otherwise(F.col("value")))
    starts = route_app_log(rec.withColumn("value", value)).where(F.col("topic") == START_TOPIC)
    return start_log_rejects(starts).select(F.col("offset").alias("event_id"))


def _dim_upsert(dim: str) -> Query:
    def q(spark, sf_dir):
        td = _wh(spark, sf_dir).td
        schema, key, _table = DIMENSIONS[dim]
        hist = decode_dimension(td.dimension_history(dim), schema, key).rows
        store = DimensionStore(spark, shared_path(spark, "dims", dim, unique=True), key)
        # The first batch has both versions of every second key, the second batch the rest of the newer ones.
        early = F.pmod(F.xxhash64(key), F.lit(2)) == 0
        store.write_batch(hist.where((F.col("offset") == 0) | early), 0)
        store.write_batch(hist.where((F.col("offset") == 1) & ~early), 1)
        view_cols = td.dimension(dim).columns
        return store.read().select(*view_cols)

    q.__name__ = f"dim_upsert_{dim}"
    return q


def offset_ledger_q(spark, sf_dir):
    rec = route_app_log(_wh(spark, sf_dir).td.app_log_records())
    led = offset_ledger(rec)
    return led.select("topic", F.col("partition").cast("bigint").alias("partition"), "next_offset")


def start_log_project(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return wh.start_logs.select(F.col("offset").alias("event_id"), "mid", "uid", "ar", "ch", "vc", "dt", "hr",
                                "mi", "ts")


# ---- DWD: enrichment ------------------------------------------------------------

def order_date_parts(spark, sf_dir):
    return with_create_parts(_wh(spark, sf_dir).td.order_info).select("id", "create_date", "create_hour")


def order_province(spark, sf_dir):
    td = _wh(spark, sf_dir).td
    return join_province(td.order_info, td.province_info()).select(
        "id", "province_id", "province_name", "province_area_code", "province_3166_2_code")


def order_user_profile(spark, sf_dir):
    td = _wh(spark, sf_dir).td
    return join_user_profile(td.order_info, td.user_info(), as_of_year=AS_OF_YEAR).select(
        "id", "user_id", "user_age_group", "user_gender")


def order_user_profile_bucketed(spark, sf_dir):
    """J2 against the user table in buckets of its id."""
    td = _wh(spark, sf_dir).td
    users = write_bucketed(td.user_info(), shared_path(spark, "users", unique=True), "id")
    return join_user_profile(td.order_info, read_bucketed(spark, users), as_of_year=AS_OF_YEAR).select(
        "id", "user_id", "user_age_group", "user_gender")


def order_users_needed(spark, sf_dir):
    td = _wh(spark, sf_dir).td
    return users_needed(td.user_info(), td.order_info).select("id", "name")


def detail_dims(spark, sf_dir):
    return _wh(spark, sf_dir).details_enriched.select(
        "id", "order_id", "sku_id", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name")


def detail_dims_rejects(spark, sf_dir):
    td = _wh(spark, sf_dir).td
    sku = td.sku_info().where(F.col("id").try_cast("bigint") % REJECT_SKU_MOD != 0)
    res = join_detail_dims(td.order_detail, sku, td.spu_info(), td.trademark_info(), td.category3_info(),
                           on_missing="reject")
    return res.rejects.select("id", "order_id", "sku_id")


# ---- DWS: the wide fact ------------------------------------------------------------

def wide_window_join(spark, sf_dir):
    pairs = _wh(spark, sf_dir).window_pairs()
    return pairs.select(F.col("i_id").alias("order_id"), F.col("d_id").alias("order_detail_id"))


def wide_retained_join(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    pairs = retained_join(wh.with_arrival(wh.td.order_info), wh.with_arrival(wh.td.order_detail),
                          retention_s=RETAINED_BOUND_S)
    return pairs.select(F.col("i_id").alias("order_id"), F.col("d_id").alias("order_detail_id"))


def wide_full_outer(spark, sf_dir):
    td = _wh(spark, sf_dir).td
    j = full_outer(td.order_info, td.order_detail)
    return j.select(F.coalesce("i_id", "d_order_id").alias("order_id"), F.col("d_id").alias("order_detail_id"),
                    F.col("i_final_total_amount").alias("final_total_amount"))


def order_wide(spark, sf_dir):
    w = _wh(spark, sf_dir).order_wide(scale=None, as_double=False)
    return w.withColumn("final_detail_amount", F.round("final_detail_amount", 4).cast("double"))


def order_wide_dedup(spark, sf_dir):
    td = _wh(spark, sf_dir).td
    raw = td.order_detail_raw()
    info = td.order_info.select(F.col("id").alias("_oid"))
    pairs = info.join(raw, info["_oid"] == raw["order_id"]).select(
        "order_id", F.col("id").alias("order_detail_id"), "sku_id", F.col("order_price").alias("sku_price"),
        "sku_num", "tie_break")
    first = first_per_key(pairs, ["order_id", "order_detail_id"], ["sku_id", "tie_break", "sku_price", "sku_num"])
    return first.select("order_id", "order_detail_id", "sku_id", "sku_price", "sku_num")


def apportion_exact(spark, sf_dir):
    td = _wh(spark, sf_dir).td
    wide = merge_wide(inner_pairs(td.order_info, td.order_detail))
    out = apportion(wide, scale=None, as_double=False)
    return out.select("order_id", "order_detail_id",
                      F.round("final_detail_amount", 4).cast("double").alias("final_detail_amount"))


def apportion_cents(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    pairs = wh.window_pairs()
    out = apportion(merge_wide(pairs), scale=2)
    return out.select("order_id", "order_detail_id", "final_detail_amount")


def wide_row_text(spark, sf_dir):
    td = _wh(spark, sf_dir).td
    wide = merge_wide(inner_pairs(td.order_info, td.order_detail))
    amounts = ("sku_price", "original_total_amount", "final_total_amount", "final_detail_amount")
    text = row_text("order_id", "order_detail_id", "sku_price", "sku_num", *amounts[1:])
    return wide.withColumns({c: money(c) for c in amounts}).select("order_detail_id", text.alias("text"))


# ---- activity and dashboard ---------------------------------------------------------

_DAU_OUT = ["mid", "uid", "ar", "ch", "vc", "dt", "hr", "mi", "ts"]


def dau_dedup(spark, sf_dir):
    return _wh(spark, sf_dir).dau.select(*_DAU_OUT)


def dau_total(spark, sf_dir):
    return dash.dau_total(stored_dau(spark, sf_dir, dash.compact(DAU_DATE)), DAU_DATE)


def dau_hour(spark, sf_dir):
    return dash.dau_hour(stored_dau(spark, sf_dir, dash.compact(DAU_DATE)), DAU_DATE)


def sink_order_wide(spark, sf_dir):
    path = shared_path(spark, "order_wide", unique=True)
    write_order_wide(_wh(spark, sf_dir).order_wide(scale=2), path)
    return read_order_wide(spark, path)


def order_amount_total(spark, sf_dir):
    out = dash.order_amount_totals(stored_wide(spark, sf_dir, ORDER_DATE), ORDER_DATE,
                                   ("final_total_amount", "final_detail_amount"))
    return out.select(F.col("final_total_amount").cast("double").alias("amount_order_total"),
                      F.col("final_detail_amount").cast("double").alias("amount_line_share"))


def order_amount_hour(spark, sf_dir):
    out = dash.order_amount_hour(stored_wide(spark, sf_dir, ORDER_DATE), ORDER_DATE)
    return out.select(F.col("hr").cast("bigint").alias("hr"), F.col("amount").cast("double").alias("amount"))


def order_amount_day_hour(spark, sf_dir):
    out = dash.order_amount_by_day_hour(stored_wide(spark, sf_dir))
    return out.select("dt", F.col("hr").cast("bigint").alias("hr"), F.col("amount").cast("double").alias("amount"))


def hourly_compare_dau(spark, sf_dir):
    days = dash.compact(DAU_DATE), dash.compact(dash.yesterday(DAU_DATE))
    return dash.hourly_compare("dau", stored_dau(spark, sf_dir, *days), DAU_DATE)


def hourly_compare_amount(spark, sf_dir):
    out = dash.hourly_compare("order_amount", stored_wide(spark, sf_dir, ORDER_DATE, dash.yesterday(ORDER_DATE)), ORDER_DATE)
    return out.select("day", "hr", F.col("value").cast("double").alias("value"))


def kpi_list(spark, sf_dir):
    dau = stored_dau(spark, sf_dir, dash.compact(DAU_DATE))
    return dash.kpi_list(dau, stored_wide(spark, sf_dir, ORDER_DATE), DAU_DATE, order_date=ORDER_DATE)


def range_search(spark, sf_dir):
    col, lo, hi, text, term = SEARCH
    part = _wh(spark, sf_dir).td.table("part")
    return range_text_search(part, col, lo, hi, text, term).select(
        "p_partkey", "p_name", F.col("p_size").cast("bigint").alias("p_size"))


# ---- sinks: written, then read back ---------------------------------------------------

def sink_archive(spark, sf_dir):
    logs = _wh(spark, sf_dir).td.app_log_json().withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    path = shared_path(spark, "archive", unique=True)
    archive_text(logs, path, batch_id=0)
    back = read_archive(spark, path)
    return back.select("dt", F.get_json_object("value", "$.common.mid").alias("mid"),
                       F.get_json_object("value", "$.ts").cast("bigint").alias("ts"))


def sink_upsert(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    from strata.operators.activity import with_index_day
    index = DayIndex(spark, shared_path(spark, "dau_index", unique=True))
    index.write_batch(with_index_day(wh.start_logs), 0, order=("ts", "offset"))
    index.write_batch(wh.dau, 1)
    return index.read().select(*_DAU_OUT)


def sink_append(spark, sf_dir):
    a = _wh(spark, sf_dir).td.app_log()
    path = shared_path(spark, "append", unique=True)
    append_documents(a.where("has_start").select("event_id", "ch"), path)
    append_documents(a.where("not has_start").select("event_id", "ch"), path)
    return spark.read.parquet(path).select("event_id", "ch")


def wide_retained_outer(spark, sf_dir):
    """J5 with the headers and lines that met no partner, in batch."""
    wh = _wh(spark, sf_dir)
    pairs = retained_join(wh.with_arrival(wh.td.order_info), wh.with_arrival(wh.td.order_detail),
                          retention_s=RETAINED_BOUND_S, how="full_outer")
    matched = pairs.where("i_id is not null and d_id is not null").select(
        F.lit("pair").alias("side"), F.col("i_id").alias("order_id"), F.col("d_id").alias("order_detail_id"))
    return matched.unionByName(unmatched(pairs))


def sink_topic(spark, sf_dir):
    rec = route_app_log(_wh(spark, sf_dir).td.app_log_records())
    root = shared_path(spark, "topics", unique=True)
    write_topic_batch(as_records(rec, key_col="key"), root=root, batch_id=0)
    both = read_topic(spark, START_TOPIC, root=root).unionByName(read_topic(spark, EVENT_TOPIC, root=root))
    return both.select("topic", F.col("key").cast("bigint").alias("event_id"),
                       F.get_json_object("value", "$.common.mid").alias("mid"))


def catalog() -> dict[str, Query]:
    q: dict[str, Query] = {
        "route_app_logs": route_app_logs,
        "cdc_batch_flatten": cdc_batch_flatten,
        "cdc_row_route": cdc_row_route,
        "decode_order_info": decode_order_info,
        "decode_quarantine": decode_quarantine,
        "start_log_rejects": start_log_rejects_q,
    }
    for dim in DIMENSIONS:
        q[f"dim_upsert_{dim}"] = _dim_upsert(dim)
    q.update({
        "offset_ledger": offset_ledger_q,
        "start_log_project": start_log_project,
        "order_date_parts": order_date_parts,
        "order_province": order_province,
        "order_user_profile": order_user_profile,
        "order_user_profile_bucketed": order_user_profile_bucketed,
        "order_users_needed": order_users_needed,
        "detail_dims": detail_dims,
        "detail_dims_rejects": detail_dims_rejects,
        "wide_window_join": wide_window_join,
        "wide_retained_join": wide_retained_join,
        "wide_full_outer": wide_full_outer,
        "wide_retained_outer": wide_retained_outer,
        "order_wide": order_wide,
        "order_wide_dedup": order_wide_dedup,
        "apportion_exact": apportion_exact,
        "apportion_cents": apportion_cents,
        "dau_dedup": dau_dedup,
        "dau_total": dau_total,
        "dau_hour": dau_hour,
        "order_amount_total": order_amount_total,
        "order_amount_hour": order_amount_hour,
        "order_amount_day_hour": order_amount_day_hour,
        "hourly_compare_dau": hourly_compare_dau,
        "hourly_compare_amount": hourly_compare_amount,
        "kpi_list": kpi_list,
        "range_text_search": range_search,
        "sink_archive": sink_archive,
        "sink_upsert": sink_upsert,
        "sink_append": sink_append,
        "sink_topic": sink_topic,
        "sink_order_wide": sink_order_wide,
        "wide_row_text": wide_row_text,
    })
    return q
