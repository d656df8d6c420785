"""Scalar functions on the hand-made edge rows of FIXTURES.md §D."""


from strata.functions import (age, age_group, compact_day, day_str, gender_label, hour_of, hour_str, minute_str,
                              prev_day, row_text, split_create_time, ts_from_millis)
from strata.functions.people import (AGE_CHILD, AGE_INFANT, AGE_MIDDLE, AGE_SENIOR, AGE_TEEN, AGE_YOUTH,
                                     GENDER_FEMALE, GENDER_MALE)


def test_age_groups(spark):
    ages = [0, -1, 1, 6, 7, 12, 13, 17, 18, 45, 46, 69, 70, None]
    df = spark.createDataFrame([(a,) for a in ages], "a int")
    got = [r[0] for r in df.select(age_group("a")).collect()]
    assert got == [AGE_CHILD, AGE_CHILD, AGE_INFANT, AGE_INFANT, AGE_CHILD, AGE_CHILD, AGE_TEEN, AGE_TEEN,
                   AGE_YOUTH, AGE_YOUTH, AGE_MIDDLE, AGE_MIDDLE, AGE_SENIOR, None]


def test_age_from_birthday(spark):
    df = spark.createDataFrame([("1990-06-15",), ("bad",), (None,)], "b string")
    assert [r[0] for r in df.select(age("b", 2024)).collect()] == [34, None, None]


def test_gender(spark):
    df = spark.createDataFrame([("F",), ("M",), ("U",), (None,)], "g string")
    assert [r[0] for r in df.select(gender_label("g")).collect()] == [GENDER_FEMALE, GENDER_MALE, None, None]


def test_sample_log_time(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.createDataFrame([(1598351203000,)], "ts long").select(ts_from_millis("ts").alias("t"))
    r = df.select(day_str("t"), hour_str("t"), minute_str("t")).first()
    assert tuple(r) == ("2020-8-25", "10", "26")


def test_day_boundary(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.createDataFrame([(1704153599999,), (1704153600000,)], "ts long")
    assert [r[0] for r in df.select(day_str(ts_from_millis("ts"))).collect()] == ["2024-1-1", "2024-1-2"]


def test_day_params(spark):
    df = spark.createDataFrame([("2024-03-01",)], "d string")
    assert tuple(df.select(prev_day("d"), compact_day("d")).first()) == ("2024-02-29", "20240301")


def test_create_time_parts(spark):
    df = spark.createDataFrame([("2020-08-25 10:26:43",), ("2020-08-25",), (None,)], "c string")
    d, h = split_create_time("c")
    assert [tuple(r) for r in df.select(d, h, hour_of("c")).collect()] == [
        ("2020-08-25", "10", 10), ("2020-08-25", None, None), (None, None, None)]


def test_row_text(spark):
    df = spark.createDataFrame([(1, 12, None)], "order_id long, order_detail_id long, sku_num long")
    assert df.select(row_text("order_id", "order_detail_id", "sku_num")).first()[0] == \
        "order_id:1|order_detail_id:12|sku_num:null"
