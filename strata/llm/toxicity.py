"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are its distinct words, word pairs and pairs with one word
skipped, hashed to 2^20 coordinates.  Training is online FTRL-proximal, with a
rate per coordinate and an L1 term that leaves most weights at zero; it sees at
most about ``rows`` labelled rows, picked by a hash of the id, and of these at
most ``entries`` coordinates, in one task, which so holds a known number of bytes.
The non-zero weights, at most one per coordinate, are broadcast; every row of
the input is scored over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from strata.llm.common import fold, table, texts
from strata.llm.decontam import words

DIMENSION = 1 << 20
ROWS = 20_000
ENTRIES = 1 << 26
THRESHOLD = 0.7
_KINDS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_CHUNK = 1 << 18


@dataclass(frozen=True)
class Rates:
    alpha: float = 10.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.01
    passes: int = 8


class _Words(dict):
    """Word hashes; started anew when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _Words()


def _mix(h: np.ndarray, kind: int) -> np.ndarray:
    h = h * _KINDS[kind]
    return ((h ^ (h >> np.uint64(29))) * _KINDS[0] >> np.uint64(44)).astype(np.uint32)


def features(text: str) -> np.ndarray:
    """The distinct coordinates (below 2^20) of a text's words, pairs and skip-pairs."""
    found = words(text.lower())
    h = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    turned = (h << np.uint64(17)) | (h >> np.uint64(47))
    got = np.zeros(0, np.uint32)
    for a in range(0, len(h), _CHUNK):
        b = min(a + _CHUNK, len(h))
        parts = [got, _mix(h[a:b], 0)]
        for kind, gap in ((1, 1), (2, 2)):
            second = h[a + gap : b + gap]
            parts.append(_mix(turned[a : a + len(second)] + second, kind))
        got = np.unique(np.concatenate(parts))
    return got


class Ftrl:
    """Per-coordinate FTRL-proximal; coordinate DIMENSION is the bias, which has no L1 term."""

    def __init__(self, rates: Rates):
        self.r = rates
        self.z, self.n = np.zeros(DIMENSION + 1), np.zeros(DIMENSION + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, r = self.z[at], self.r
        w = -(z - np.sign(z) * r.l1) / ((r.beta + np.sqrt(self.n[at])) / r.alpha + r.l2)
        return np.where(np.abs(z) <= r.l1, 0.0, w)

    def bias(self) -> float:
        return float(-self.z[-1] / ((self.r.beta + np.sqrt(self.n[-1])) / self.r.alpha + self.r.l2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w, b = self.weights(at), self.bias()
        g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.r.alpha * w
        self.n[at] = n + g * g
        n = self.n[-1]
        self.z[-1] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.r.alpha * b
        self.n[-1] = n + g * g


@dataclass
class Model:
    at: np.ndarray
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        w = np.zeros(DIMENSION, np.float32)
        w[self.at] = self.weight
        return w


def train(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = ROWS,
    entries: int = ENTRIES,
    rates: Rates | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Fits on about ``rows`` of the rows of ``docs`` that have a 0 or 1 in ``labels`` (all, if fewer).

    They are taken in the order of a hash of their ids until their features
    would pass ``entries`` (4 bytes each).  An id labelled more than once takes
    its largest label, one with several rows its row of the least text hash.
    No labelled rows: all weights and the bias are zero, and every score is a half.
    """
    rates = rates or Rates()
    marked = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .filter("label in (0, 1) and id is not null")
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    total = marked.count()
    place = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 20)) / float(1 << 20)
    picked = marked.filter(place < min(1.0, rows / max(1, total)))
    # About ``rows`` ids, so a broadcast of a known size, and the texts stay where they are.
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")
    marked_texts = sample.select("id", "label", F.xxhash64("text").alias("h"), "text")
    schema = StructType([*marked_texts.drop("text").schema.fields, StructField("at", BinaryType())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, strings in texts(batches):
            at = pa.array((features(t).tobytes() for t in strings), pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("id", "label", "h")], at], ["id", "label", "h", "at"])

    found = marked_texts.mapInArrow(extract, schema).groupBy("id", "label").agg(F.min_by("at", "h").alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, left = [], entries
        for batch in batches:
            for at, y in zip(batch.column("at"), batch.column("label").to_pylist(), strict=True):
                left -= len(at.as_buffer()) // 4
                if left >= 0:
                    seen.append((np.frombuffer(at.as_py(), np.uint32), y))
        fit = Ftrl(rates)
        for _ in range(rates.passes):
            for at, label in seen:
                fit.learn(at, label)
        w = fit.weights(slice(0, DIMENSION))
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w[at])], ["at", "weight"])
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([fit.bias()])], ["at", "weight"])

    # One task fits the bounded sample, in an order that a hash of the ids gives.
    ordered = found.repartition(1).sortWithinPartitions(F.xxhash64(F.lit("order"), "id"), "label")
    got = ordered.select("at", "label").mapInArrow(run, "at long, weight double").toArrow()
    at, weight = got.column("at").to_numpy(), got.column("weight").to_numpy()
    return Model(at[at >= 0], weight[at >= 0].astype(np.float32), float(weight[at < 0].sum()))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (a column of that name is replaced); null and empty texts get the bias's score."""
    keep = [c for c in docs.columns if c != "score"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.select(*keep).schema.fields, StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, bias = shared.value.dense(), shared.value.bias
        for batch, strings in texts(batches, text_col):
            logits = np.array([float(w[features(t)].sum(dtype=np.float64)) for t in strings]) + bias
            scores = pa.array(1 / (1 + np.exp(-np.clip(logits, -700, 700))), pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], scores], [*keep, "score"])

    return docs.select(*keep).mapInArrow(run, schema)


def learned_from(docs: DataFrame) -> Column:
    """The rows whose labels may be learned: id fold 1 of 3 is held out."""
    return F.coalesce(fold("doc_id", 3) != 1, F.lit(False))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = train(docs.filter(learned_from(docs)), labels.filter(learned_from(labels)))
    return score(docs, model).select(
        "doc_id",
        F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
