"""The corpus pipeline: language ID, SimHash near-dedup, benchmark decontamination, PII masking, packing.

``STAGES`` are (name, function) pairs in order; a function takes (spark, docs,
sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's docs.  All but the last return the columns of ``documents``.

No stage fails on null or empty texts, repeated rows, an empty table or more
columns; what becomes of such rows is said with each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontam, langid, packing, pii, simhash
from strata.llm.common import new_path, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null texts and texts without a letter.

    The models are learned from the stage's own labelled rows of the learning
    folds; without any, every text with a letter stays.
    """
    docs = docs.select(*COLUMNS)
    model = langid.train(docs.filter(langid.learned_from(docs)))
    if not model.langs:
        return docs.filter(langid.has_letter())
    return langid.predict(docs, model).filter(F.col("lang_pred") != langid.UNKNOWN).select(*COLUMNS)


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows with a hash of id and text, by which a stage's verdicts find their rows; equal rows share it."""
    return docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("_key"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: a row of the id that names the group.

    Of different texts with that id the one with the least hash stays, of
    equal rows one; a group without any id keeps one row as well.
    """
    docs = _keyed(docs)
    groups = simhash.near_duplicates(docs, keep=["_key"])
    named = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # A group without ids has no component id; its fingerprint's own rows stand for it.
    kept = named.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp"))).agg(F.min("_key").alias("_key"))
    return docs.join(kept.select("_key").distinct(), "_key").dropDuplicates(["_key"]).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that a benchmark contaminates."""
    docs = _keyed(docs)
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"), id_col="_key")
    bad = found.filter("contaminated").select(F.col("doc_id").alias("_key")).distinct()
    return docs.join(bad, "_key", "left_anti").select(*COLUMNS)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; n_chars follows the text."""
    masked = pii.redact(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences, with their ids."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mask_pii", mask_pii),
    ("pack", pack),
]

#: Language models, iterated links and token ids are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
