"""Row types of the warehouse (FIXTURES.md §A)."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
          "timestamp": T.TimestampType(), "boolean": T.BooleanType()}


def _ddl(ddl: str) -> T.StructType:
    """Flat ``name type, ...`` -> StructType, without needing a running session."""
    fields = []
    for part in ddl.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name, _TYPES[typ], True))
    return T.StructType(fields)


# Record of a topic, as the Spark Kafka source yields it.
TOPIC_RECORD = _ddl("key string, value string, topic string, partition int, offset bigint, timestamp timestamp")

APP_COMMON = _ddl("ar string, ba string, ch string, md string, mid string, os string, uid string, vc string")
APP_START = _ddl("entry string, loading_time bigint, open_ad_id bigint, open_ad_ms bigint, open_ad_skip_ms bigint")

START_LOG = _ddl("mid string, uid string, ar string, ch string, vc string, dt string, hr string, mi string, ts bigint")

ORDER_INFO = _ddl(
    "id bigint, province_id bigint, order_status string, user_id bigint, final_total_amount double, "
    "benefit_reduce_amount double, original_total_amount double, feight_fee double, expire_time string, "
    "create_time string, operate_time string, create_date string, create_hour string, if_first_order string, "
    "province_name string, province_area_code string, province_3166_2_code string, user_age_group string, "
    "user_gender string"
)

# Fields that arrive on the ODS order topic (the rest are filled by enrichment).
ORDER_INFO_WIRE = _ddl(
    "id bigint, province_id bigint, order_status string, user_id bigint, final_total_amount double, "
    "benefit_reduce_amount double, original_total_amount double, feight_fee double, expire_time string, "
    "create_time string, operate_time string"
)

ORDER_DETAIL = _ddl(
    "id bigint, order_id bigint, sku_id bigint, order_price double, sku_num bigint, sku_name string, "
    "create_time string, spu_id bigint, tm_id bigint, category3_id bigint, spu_name string, tm_name string, "
    "category3_name string"
)

ORDER_DETAIL_WIRE = _ddl(
    "id bigint, order_id bigint, sku_id bigint, order_price double, sku_num bigint, sku_name string, "
    "create_time string"
)

ORDER_WIDE = _ddl(
    "order_detail_id bigint, order_id bigint, order_status string, create_time string, user_id bigint, "
    "sku_id bigint, sku_price double, sku_num bigint, sku_name string, benefit_reduce_amount double, "
    "original_total_amount double, feight_fee double, final_total_amount double, final_detail_amount double, "
    "if_first_order string, province_name string, province_area_code string, user_age_group string, "
    "user_gender string, dt string, spu_id bigint, tm_id bigint, category3_id bigint, spu_name string, "
    "tm_name string, category3_name string"
)

PROVINCE_INFO = _ddl("id string, name string, area_code string, iso_code string, iso_3166_2 string")
USER_INFO = _ddl(
    "id string, login_name string, nick_name string, name string, phone_num string, email string, "
    "user_level string, birthday string, gender string, create_time string, operate_time string"
)
SKU_INFO = _ddl(
    "id string, spu_id string, price string, sku_name string, sku_desc string, weight string, tm_id string, "
    "category3_id string, sku_default_img string, create_time string"
)
SPU_INFO = _ddl("id string, spu_name string, descripition string, category3_id string, tm_id string")
TRADEMARK_INFO = _ddl("tm_id string, tm_name string")
CATEGORY3_INFO = _ddl("id string, name string, category2_id string")

# Dimension name -> (schema, key column, ODS source table name on the row-style CDC feed)
DIMENSIONS: dict[str, tuple[T.StructType, str, str]] = {
    "province": (PROVINCE_INFO, "id", "base_province"),
    "user": (USER_INFO, "id", "user_info"),
    "sku": (SKU_INFO, "id", "sku_info"),
    "spu": (SPU_INFO, "id", "spu_info"),
    "trademark": (TRADEMARK_INFO, "tm_id", "base_trademark"),
    "category3": (CATEGORY3_INFO, "id", "base_category3"),
}
