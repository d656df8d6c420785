"""Tables bucketed and sorted by their key.

A micro-batch that looks up users in a plain table shuffles the whole user
table by id each time.  A table written in buckets of the key is read in that
partitioning and order, so a join on the key moves the batch only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None) -> str:
    """Stores ``df`` under ``path`` in buckets of ``key``, sorted by it; gives the name by which the session knows the table.

    At least as many buckets as a shuffle has partitions: with fewer, the
    planner may rather shuffle both sides of a join.
    """
    spark = df.sparkSession
    n = max(buckets or 0, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"bucketed_{uuid.uuid4().hex[:12]}"
    # One task a bucket, so a bucket is one file and its order can be used.
    df.repartition(n, key).write.option("path", path).bucketBy(n, key).sortBy(key).saveAsTable(name)
    return name


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
