"""Helpers shared by the training-data operators: table reads, tables written in the shared folder, hash folds."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession, name: str) -> str:
    return shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(n)


def texts(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Each Arrow batch with its texts as Python strings, null as empty."""
    for batch in batches:
        if batch.num_rows:
            yield batch, [t or "" for t in batch.column(column).to_pylist()]
