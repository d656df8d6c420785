"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has a bit set where over half of its word shingles'
XXH64 values (seed 42) have it set.  Fingerprints within ``max_bits`` = 3 of
each other are linked.  The 64 bits are cut into two 32-bit segments: of two
linked fingerprints at least one segment differs in at most one bit, so every
fingerprint is filed under both segments and looks up the Hamming ball of
radius one around both; what the tables return is verified on all 64 bits.

Work is done on distinct fingerprints, so a group of exact copies counts once.
Of a ball only the value itself and those with one more bit set are looked
up: of two values one bit apart exactly one has that bit clear, so each pair
is met once.  A segment value shared by many distinct fingerprints would make
a table of all their pairs; such a full bucket is filed once more under the
other segment's four bytes (of two fingerprints at most three bits apart, one
byte at least is the same), which keeps every link.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.common import table, texts, written
from strata.llm.components import components

SEED = 42
MAX_BITS = 3
#: A bucket with more distinct fingerprints than this is split by the other segment's bytes.
FULL_BUCKET = 64
_CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a text as a signed long; 0 when it has no words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    n = max(1, len(words) - shingle + 1)
    hashed = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        bits = np.unpackbits(hashed[i : i + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()
) -> DataFrame:
    """``(doc_id, fp)`` and the ``keep`` columns, a row per row of ``docs``; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, strings in texts(batches):
            fps = pa.array([fingerprint(t, shingle) for t in strings], pa.int64())
            columns = [batch.column("doc_id"), fps, *(batch.column(c) for c in keep)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", *keep])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *keep)
    return picked.mapInArrow(run, StructType([*StructType.fromDDL("doc_id long, fp long").fields, *picked.select(*keep).schema.fields]))


def _segment(which: int) -> Column:
    return F.shiftrightunsigned("fp", 32) if which else F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))


def _key(which: int, value: Column) -> Column:
    """A segment's number and value in one long."""
    return value + F.lit(which << 32)


def _filed(fps: DataFrame) -> DataFrame:
    keys = [F.struct(F.lit(w).alias("seg"), _key(w, _segment(w)).alias("key")) for w in (0, 1)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.seg", "k.key")


def links(fps: DataFrame, max_bits: int = MAX_BITS, full_bucket: int = FULL_BUCKET) -> DataFrame:
    """``(fp_a, fp_b)``: the pairs of distinct fingerprints at most ``max_bits`` (0 to 3) apart, a pair perhaps twice."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments with balls of radius one hold up to 3 bits")
    filed = written(_filed(fps.select("fp").distinct()), "simhash-filed")
    full = filed.groupBy("key").count().filter(F.col("count") > full_bucket).select("key")
    lookups = filed.select(
        "fp",
        "seg",
        F.explode(
            F.expr("concat(array(key), transform(filter(sequence(0, 31), i -> (key & (1L << i)) = 0), i -> key | (1L << i)))")
        ).alias("key"),
        F.col("key").alias("own"),
    )
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits
    once = (F.col("key") != F.col("own")) | (F.col("fp") < F.col("other"))
    held = filed.join(full, "key", "left_anti").select("key", F.col("fp").alias("other"))
    plain = lookups.join(held, "key").filter(near & once)
    # Full buckets: the same lookups, filed and fetched under (key, one byte of the other segment).
    byte = "transform(sequence(0, 3), j -> (j << 8) | ((shiftrightunsigned(fp, 8 * j + if(seg = 0, 32, 0))) & 255))"
    heavy = filed.join(full, "key").select("key", F.explode(F.expr(byte)).alias("part"), F.col("fp").alias("other"))
    asked = lookups.join(full, "key").select("key", "own", "fp", F.explode(F.expr(byte)).alias("part"))
    split = asked.join(heavy, ["key", "part"]).filter(near & once)
    return plain.select(F.col("fp").alias("fp_a"), F.col("other").alias("fp_b")).union(
        split.select(F.col("fp").alias("fp_a"), F.col("other").alias("fp_b"))
    )


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(doc_id, fp, component_id)`` and the ``keep`` columns, a row per row of ``docs``.

    component_id is the smallest doc_id reachable over links.  Null and empty
    texts have fingerprint 0 and are linked like any other; repeated rows each
    give a row; a null doc_id gives a row and is never a component id unless
    all of its component is null.  Other columns are not looked at.
    """
    fps = written(fingerprints(docs, shingle, id_col, text_col, keep), "simhash-fps")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    roots = written(components(links(classes, max_bits), "fp_a", "fp_b"), "simhash-roots")
    labelled = classes.join(roots, classes.fp == roots.node).select("fp", "root", "least")
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = labelled.join(least, "root").select("fp", F.col("component_id").alias("linked_id"))
    every = classes.join(linked, "fp", "left").select("fp", F.coalesce("linked_id", "least").alias("component_id"))
    # Written, so that both sides of the last join are plain shuffles and a fingerprint of many copies can be split.
    every = written(every, "simhash-every")
    return fps.join(every, "fp").select("doc_id", "fp", "component_id", *keep)


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
