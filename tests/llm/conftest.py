import os
import sys

import pytest
from pyspark.sql import types as T

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Python workers import the package by path.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# Rows that every operator has to take: nulls in any column, empty and very long texts, ties and repeated rows,
# and other columns with names that an operator uses itself.
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(40_000))
ODD = [
    (1, None, "en", "a", 0),
    (2, "", None, None, None),
    (None, "no id here, yet a text", "en", "a", 3),
    (3, "Same text for several rows.", "en", "a", 5),
    (3, "Same text for several rows.", "en", "a", 5),
    (4, "Same text for several rows.", "de", "b", 5),
    (5, LONG, "en", "c", len(LONG)),
    (6, "x" * 100_000 + "@" + "7" * 100_000, None, "c", 1),
    (7, " \t\n ", "fr", "c", 1),
    (8, "zwölf Boxkämpfer 日本語 \U0001f600 é", "de", "c", 1),
]
CLASH = {
    "fp": 1, "key": 2, "score": 3, "component_id": 4, "rank": 5, "cell": 6, "bucket": 7, "kind": 8, "ids": 9, "n": 10,
    "count": 11, "item": 12, "spans": 13, "pii_row": 14, "segment": 15, "held_out": 16, "start": 17, "_key": 18, "id": 19,
    "lang_pred": 20, "label": 21, "prompt": 22,
}


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows over several partitions, with columns of clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, DOCS).repartition(3)
    return df.withColumns({c: F.lit(v) for c, v in CLASH.items()})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], T._parse_datatype_string(DOCS))


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
