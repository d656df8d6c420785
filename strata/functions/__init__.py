"""Column -> Column scalar functions."""

from strata.functions.dates import (
    compact_day,
    day_str,
    hour_of,
    hour_str,
    minute_str,
    prev_day,
    processing_day,
    split_create_time,
    ts_from_millis,
)
from strata.functions.json import encode_row, is_corrupt, json_text, parse_text_fields, typed_fields
from strata.functions.money import line_amount, money, share_of, sum_money
from strata.functions.people import age, age_group, gender_label
from strata.functions.text import has_word, ods_topic, row_text, word_tokens

__all__ = [
    "age",
    "age_group",
    "compact_day",
    "day_str",
    "encode_row",
    "gender_label",
    "has_word",
    "hour_of",
    "hour_str",
    "is_corrupt",
    "json_text",
    "line_amount",
    "minute_str",
    "money",
    "ods_topic",
    "parse_text_fields",
    "prev_day",
    "processing_day",
    "row_text",
    "share_of",
    "split_create_time",
    "sum_money",
    "ts_from_millis",
    "typed_fields",
    "word_tokens",
]
