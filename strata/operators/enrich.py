"""Order and order-line enrichment from dimensions.

Dimension keys are strings; facts carry numeric foreign keys, so every lookup
compares ``cast(fk as string)`` with the dimension key, as the reference does.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import split_create_time
from strata.functions.people import age, age_group, gender_label


def with_create_parts(orders: DataFrame) -> DataFrame:
    """Add ``create_date`` and ``create_hour`` split from ``create_time``."""
    d, h = split_create_time("create_time")
    return orders.withColumn("create_date", d).withColumn("create_hour", h)


def join_province(orders: DataFrame, provinces: DataFrame) -> DataFrame:
    """Left lookup of province name, area code and ISO 3166-2 code.

    No hint: the planner broadcasts the side whose size it knows to be small,
    and AQE the side it measures as small.  In a stream the caller re-reads the current snapshot per micro-batch.
    """
    p = provinces.select(
        F.col("id").alias("_prov_id"),
        F.col("name").alias("province_name"),
        F.col("area_code").alias("province_area_code"),
        F.col("iso_3166_2").alias("province_3166_2_code"),
    )
    out = orders.join(p, orders["province_id"].cast("string") == p["_prov_id"], "left")
    return out.drop("_prov_id")


def user_profile(users: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """C6-C8 on the user dimension: id, user_age_group, user_gender."""
    return users.select(
        F.col("id").alias("_user_id"),
        age_group(age("birthday", as_of_year)).alias("user_age_group"),
        gender_label("gender").alias("user_gender"),
    )


def join_user_profile(orders: DataFrame, users: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """Left lookup of age group and gender label by ``user_id``.

    The user table grows with the business, so no hint: the planner shuffles
    both sides on the key, or AQE broadcasts the side it measures as small.
    """
    prof = user_profile(users, as_of_year)
    out = orders.join(prof, orders["user_id"].cast("string") == prof["_user_id"], "left")
    return out.drop("_user_id")


def users_needed(users: DataFrame, orders: DataFrame) -> DataFrame:
    """R11 + A8: the user rows whose id occurs among the orders' user ids (semi join)."""
    keys = distinct_keys(orders.select(F.col("user_id").cast("string").alias("_uid")), "_uid")
    return users.join(keys, users["id"] == keys["_uid"], "left_semi")


def distinct_keys(df: DataFrame, col: str) -> DataFrame:
    """The set of values of one column."""
    return df.select(col).distinct()


class Enriched(NamedTuple):
    rows: DataFrame
    rejects: DataFrame | None


def sku_profile(sku: DataFrame, spu: DataFrame, trademark: DataFrame, category3: DataFrame) -> DataFrame:
    """The snowflake sku -> (spu, trademark, category3) joined once, keyed by sku id.

    Joining the dimensions to each other first means the (much larger) order
    lines are shuffled once, on ``sku_id``, instead of once per dimension.
    """
    s = sku.select(
        F.col("id").alias("_sku_key"),
        F.col("spu_id").try_cast("bigint").alias("spu_id"),
        F.col("tm_id").try_cast("bigint").alias("tm_id"),
        F.col("category3_id").try_cast("bigint").alias("category3_id"),
    )
    sp = spu.select(F.col("id").alias("_spu_key"), "spu_name")
    tm = trademark.select(F.col("tm_id").alias("_tm_key"), "tm_name")
    c3 = category3.select(F.col("id").alias("_c3_key"), F.col("name").alias("category3_name"))
    return (
        s.join(sp, s["spu_id"].cast("string") == sp["_spu_key"], "left")
        .join(tm, s["tm_id"].cast("string") == tm["_tm_key"], "left")
        .join(c3, s["category3_id"].cast("string") == c3["_c3_key"], "left")
        .select(
            "_sku_key", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name",
            (sp["_spu_key"].isNotNull() & tm["_tm_key"].isNotNull() & c3["_c3_key"].isNotNull()).alias("_complete"),
        )
    )


def join_detail_dims(details: DataFrame, sku: DataFrame, spu: DataFrame, trademark: DataFrame,
                     category3: DataFrame, on_missing: str = "left") -> Enriched:
    """Add spu/trademark/category3 ids and names to order lines.

    ``on_missing``:
      - ``left``   (default) lines without a full match keep null names;
      - ``strict`` the reference's behaviour: a missing lookup fails the query;
      - ``reject`` matched lines in ``rows``, the others in ``rejects``.
    """
    if on_missing not in ("left", "strict", "reject"):
        raise ValueError(f"on_missing must be left, strict or reject, not {on_missing!r}")
    prof = sku_profile(sku, spu, trademark, category3)
    base = [c for c in details.columns if c not in ("spu_id", "tm_id", "category3_id", "spu_name", "tm_name",
                                                    "category3_name")]
    d = details.select(*base)
    joined = d.join(prof, d["sku_id"].cast("string") == prof["_sku_key"], "left")
    found = F.coalesce(F.col("_complete"), F.lit(False))
    names = ["spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name"]
    if on_missing == "left":
        return Enriched(joined.select(*base, *names), None)
    if on_missing == "strict":
        # the check is a filter, which no later projection or aggregate can prune
        known = F.when(found, F.lit(True)).otherwise(
            F.raise_error(F.lit("order line with no dimension match")).cast("boolean"))
        return Enriched(joined.where(known).select(*base, *names), None)
    rows = joined.where(found).select(*base, *names)
    rejects = joined.where(~found).select(*base)
    return Enriched(rows, rejects)
