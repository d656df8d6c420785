"""JSON decoding (S13), app-log routing (R1), CDC flattening."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.decode import decode_json, pick_columns
from strata.operators.route import EVENT_TOPIC, START_TOPIC, cdc_rejects, flatten_cdc_batch, project_start_log, \
    route_app_log, route_cdc_rows, start_log_rejects

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("amt", T.DoubleType()),
                       T.StructField("name", T.StringType())])


def test_decode_quoted_missing_malformed(spark):
    rows = [('{"id":"7","amt":"1.5","name":"a"}',), ('{"id":8}',), ("not json",), ('{"id":"x"}',),
            ('{"id":9,"amt":"12,5"}',), (None,)]
    res = decode_json(spark.createDataFrame(rows, "value string"), SCHEMA)
    got = sorted(tuple(r) for r in res.rows.collect())
    assert got == [(7, 1.5, "a"), (8, 0.0, None)]
    assert {r.value for r in res.quarantine.collect()} == {"not json", '{"id":"x"}', '{"id":9,"amt":"12,5"}', None}


def test_dimension_rows_need_their_key(spark):
    rows = [('{"id":"1","name":"a"}',), ("{}",), ('{"name":"b"}',), (None,), ("[",)]
    res = pick_columns(spark.createDataFrame(rows, "value string"), SCHEMA, "id")
    assert [(r.id, r.name) for r in res.rows.collect()] == [("1", "a")]
    assert res.quarantine.count() == 4


def test_start_logs_with_quoted_or_no_time(spark):
    rows = [('{"common":{"mid":"m1"},"ts":"1598351203000"}',), ('{"common":{"mid":"m2"},"ts":1598351203000}',),
            ('{"common":{"mid":"m3"}}',), ('{"common":{},"ts":1}',), ("{",), (None,), ('{"common":{"mid":"m4"},"ts":"x"}',)]
    df = spark.createDataFrame(rows, "value string")
    got = sorted((r.mid, r.dt, r.hr, r.ts) for r in project_start_log(df).collect())
    assert got == [("m1", "2020-8-25", "10", 1598351203000), ("m2", "2020-8-25", "10", 1598351203000)]
    assert start_log_rejects(df).count() == 5


def test_cdc_rejects(spark):
    good = '{"type":"insert","table":"t","data":{"id":1}}'
    rows = [(good,), ('{"type":"insert"}',), ("nope",), (None,)]
    df = spark.createDataFrame(rows, "value string")
    assert cdc_rejects(df).count() == 3 and route_cdc_rows(df).count() == 1


def test_route_five_cases(spark):
    cases = {
        '{"common":{},"start":{"entry":"icon"},"ts":1}': START_TOPIC,
        '{"common":{},"start":{},"ts":1}': START_TOPIC,
        '{"common":{},"start":"","ts":1}': EVENT_TOPIC,
        '{"common":{},"start":null,"ts":1}': EVENT_TOPIC,
        '{"common":{},"ts":1}': EVENT_TOPIC,
    }
    df = spark.createDataFrame([(k,) for k in cases], "value string")
    got = {r.value: r.topic for r in route_app_log(df).collect()}
    assert got == cases


def test_cdc_batch_flatten(spark):
    env = [
        {"type": "INSERT", "table": "order_info", "data": [{"id": "1"}, {"id": "2"}]},
        {"type": "UPDATE", "table": "order_info", "data": [{"id": "3"}]},
        {"type": "INSERT", "table": "comment_info", "data": [{"id": "4"}]},
        {"type": "INSERT", "table": "order_detail", "data": []},
        {"type": "INSERT", "table": "order_detail"},
    ]
    df = spark.createDataFrame([(json.dumps(e),) for e in env], "value string")
    out = flatten_cdc_batch(df).select("topic", F.get_json_object("value", "$.id").alias("id")).collect()
    assert sorted(tuple(r) for r in out) == [("ODS_T_ORDER_INFO", "1"), ("ODS_T_ORDER_INFO", "2")]


def test_cdc_row_route_bootstrap(spark):
    env = [
        {"type": "bootstrap-start", "table": "base_province", "data": {}},
        {"type": "insert", "table": "base_province", "data": {"id": "1"}},
        {"type": "delete", "table": "user_info", "data": {"id": "2"}},
    ]
    df = spark.createDataFrame([(json.dumps(e),) for e in env], "value string")
    got = sorted(r.topic for r in route_cdc_rows(df).collect())
    assert got == ["ODS_T_BASE_PROVINCE", "ODS_T_USER_INFO"]
    kept = route_cdc_rows(df, drop_bootstrap=False, upper=False).collect()
    assert sorted(r.topic for r in kept) == ["ODS_T_base_province", "ODS_T_base_province", "ODS_T_user_info"]
