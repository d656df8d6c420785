"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are gathered from all training texts: every
task counts in blocks of documents, the blocks' counts meet by hash bucket,
and each bucket's task sums them.  Buckets follow the size of the texts, so
that one fits a task.  A count c of an n-gram is kept as its level
1 + floor(log_b(c / least)): the bucket's slice of the filter holds the n-gram
with each level up to its own, and a reader finds the level by asking for
level 1, 2, ... until one is not there.  A bucket also answers each block with
the exact counts of the block's words in it, as many numbers as the block sent
words, and a block's answers and its kept postings give its documents' exact
add-one word scores.

The slices are broadcast in pieces of at most ``piece_bytes``; a worker looks
at one piece after the other and then forms the smoothed probabilities

    p(w | v) = l * c(v w) / c(v) + (1 - l) * (c(w) + 1) / (N + V + 1),   l = weight * c(v) / (c(v) + damping)

All words and pairs are in the filter, also those seen once; it grows with
them, about ``bits`` bits a level.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import fold, table, texts, written

BLOCK_BYTES = 8 << 20
#: Bytes of text to a bucket.
BUCKET_BYTES = 32 << 20
PIECE_BYTES = 64 << 20
_END, _BEGIN = xxhash.xxh64_intdigest(b""), xxhash.xxh64_intdigest(b" ")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOW32 = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class Config:
    base: float = 1.5
    least_word: int = 1
    least_pair: int = 1
    bits: int = 12
    probes: int = 5
    weight: float = 0.5
    damping: float = 10.0


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """48-bit keys of word pairs."""
    return _mixed(((first << np.uint64(23)) | (first >> np.uint64(41))) * _A + second) >> np.uint64(16)


class _Stream:
    """Documents' words as numbers: ``hashes`` by number, ``number`` by token (an end after each document), ``sizes``."""

    def __init__(self, strings: list[str]):
        names, parts = _Numbers(), []
        for t in strings:
            found = words(t)
            found.append(b"")
            parts.append(np.fromiter(map(names.__getitem__, found), np.int32, len(found)))
        self.sizes = np.array([len(x) for x in parts], np.int64)
        self.number = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))

    def before(self) -> np.ndarray:
        """The hash of the word before each token, or of the beginning."""
        h = np.empty(len(self.number), np.uint64)
        h[1:] = self.hashes[self.number[:-1]]
        h[np.cumsum(self.sizes) - self.sizes] = _BEGIN
        return h


def _six(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _narrow(numbers: np.ndarray) -> bytes:
    """Whole numbers in as many bytes each as the largest needs: 1, 2 or 4."""
    most = numbers.max(initial=0)
    return numbers.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4").tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // max(1, n)}" if n else "<u4")


def _runs(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by bucket, and where each bucket begins in it."""
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


#: kind "words" and "pairs": keys and counts of a block's words or pairs in a bucket; "blocks": its words' postings
#: (documents and times, words in the order of their buckets, ``ends`` by word) and its documents.
COUNTED = "bucket int, kind string, block string, keys binary, counts binary, ends binary, docs binary, times binary, doc_keys array<long>, sizes array<long>"
_COUNTED = ("bucket", "kind", "block", "keys", "counts", "ends", "docs", "times", "doc_keys", "sizes")
_TYPES = dict(
    zip(
        _COUNTED,
        [pa.int32(), pa.string(), pa.string(), *[pa.binary()] * 5, pa.list_(pa.int64()), pa.list_(pa.int64())],
        strict=True,
    )
)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], _TYPES[c]) for c in _COUNTED], list(_COUNTED))


def _count_block(name: str, keys: list, strings: list[str], train: list[bool], buckets: int) -> Iterator[pa.RecordBatch]:
    s = _Stream(strings)
    n_docs = len(strings)
    learns = np.repeat(np.array(train, bool), s.sizes)
    counts = np.bincount(s.number[learns], minlength=len(s.hashes))
    doc = np.repeat(np.arange(n_docs), s.sizes)
    posting, times = np.unique(s.number.astype(np.int64) * n_docs + doc, return_counts=True)
    word_of, doc_of = posting // n_docs, posting % n_docs
    first = np.searchsorted(word_of, np.arange(len(s.hashes) + 1))
    order, cut = _runs((s.hashes % np.uint64(buckets)).astype(np.int64), buckets)
    length = first[order + 1] - first[order]
    at = np.repeat(first[order] - np.cumsum(length) + length, length) + np.arange(length.sum())
    yield _batch(
        [
            {
                "kind": "blocks",
                "block": name,
                "ends": np.cumsum(length).astype("<u4").tobytes(),
                "docs": _narrow(doc_of[at]),
                "times": _narrow(times[at]),
                "doc_keys": keys,
                "sizes": s.sizes.tolist(),
            }
        ]
    )
    yield _batch(
        [
            {"bucket": b, "kind": "words", "block": name, "keys": s.hashes[w].astype("<u8").tobytes(), "counts": counts[w].astype("<u4").tobytes()}
            for b in range(buckets)
            if len(w := order[cut[b] : cut[b + 1]])
        ]
    )
    pairs, n = np.unique(_pairs(s.before()[learns], s.hashes[s.number[learns]]), return_counts=True)
    order, cut = _runs((pairs % np.uint64(buckets)).astype(np.int64), buckets)
    yield _batch(
        [
            {"bucket": b, "kind": "pairs", "block": name, "keys": _six(pairs[p]), "counts": n[p].astype("<u4").tobytes()}
            for b in range(buckets)
            if len(p := order[cut[b] : cut[b + 1]])
        ]
    )


def _count(docs: DataFrame, buckets: int, block_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n = TaskContext.get().partitionId(), 0
        keys: list = []
        held: list[str] = []
        train: list[bool] = []
        size = 0
        for batch, strings in texts(batches):
            for key, learn, text in zip(batch.column("key").to_pylist(), batch.column("train").to_pylist(), strings, strict=True):
                keys.append(key)
                held.append(text)
                train.append(learn)
                size += len(text)
                if size >= block_bytes:
                    yield from _count_block(f"{task}-{n}", keys, held, train, buckets)
                    keys, held, train, size, n = [], [], [], 0, n + 1
        if held:
            yield from _count_block(f"{task}-{n}", keys, held, train, buckets)

    return docs.mapInArrow(run, COUNTED)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, their summed counts, and the place of each key given."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64), place


def _levels(counts: np.ndarray, least: int, base: float) -> np.ndarray:
    """A count's level, 0 below ``least``; a relative 1e-9 keeps exact powers on their own level."""
    return np.where(counts >= least, 1 + np.floor(np.log(np.maximum(counts, least) / least) / math.log(base) + 1e-9), 0).astype(np.int64)


def _places(keys: np.ndarray, level: np.ndarray | int, words_in: np.ndarray | int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Of (key, level): the filter word within a slice of ``words_in`` words, and the bits in it."""
    h = _mixed(keys * _A + np.asarray(level, np.uint64) * _B)
    at = ((h >> np.uint64(32)) * np.asarray(words_in, np.uint64)) >> np.uint64(32)
    bits = np.zeros(len(keys), np.uint64)
    for i in range(probes):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
    return at.astype(np.int64), bits


def _word_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of words in the filter, apart from those of pairs."""
    return hashes | np.uint64(1 << 63)


def _slice(entries: list[tuple[np.ndarray, np.ndarray]], config: Config) -> np.ndarray:
    total = int(sum(levels.sum() for _, levels in entries))
    words_in = np.zeros(max(1, -(-total * config.bits // 64)), np.uint64)
    for keys, levels in entries:
        for j in range(1, int(levels.max(initial=0)) + 1):
            at, bits = _places(keys[levels >= j], j, len(words_in), config.probes)
            np.bitwise_or.at(words_in, at, bits)
    return words_in


#: kind "filter": a slice; "sizes": tokens and distinct words in training; "answers": the counts of a block's words in a bucket.
REDUCED = "kind string, bucket int, block string, data binary, tokens long, types long"
_REDUCED = {"kind": pa.string(), "bucket": pa.int32(), "block": pa.string(), "data": pa.binary(), "tokens": pa.int64(), "types": pa.int64()}


def _reduce(counted: DataFrame, config: Config) -> DataFrame:
    def run(group: pa.Table) -> pa.Table:
        rows: list[dict] = []
        kinds = group["kind"].to_pylist()
        bucket = group["bucket"][0].as_py()
        blocks, keys, counts = (group[c].to_pylist() for c in ("block", "keys", "counts"))
        words_at = [i for i, k in enumerate(kinds) if k == "words"]
        hashes = [np.frombuffer(keys[i], "<u8") for i in words_at]
        total, count, place = _summed(hashes, [np.frombuffer(counts[i], "<u4") for i in words_at])
        rows.append({"kind": "sizes", "bucket": bucket, "tokens": int(count.sum()), "types": int((count > 0).sum())})
        begin = 0
        for i, h in zip(words_at, hashes, strict=True):
            mine, begin = place[begin : begin + len(h)], begin + len(h)
            rows.append({"kind": "answers", "bucket": bucket, "block": blocks[i], "data": count[mine].astype("<u8").tobytes()})
        pairs_at = [i for i, k in enumerate(kinds) if k == "pairs"]
        pairs, pair_count, _ = _summed([_from_six(keys[i]) for i in pairs_at], [np.frombuffer(counts[i], "<u4") for i in pairs_at])
        levels = _levels(pair_count, config.least_pair, config.base)
        entries = [(_word_keys(total), _levels(count, config.least_word, config.base)), (pairs[levels > 0], levels[levels > 0])]
        rows.append({"kind": "filter", "bucket": bucket, "data": _slice(entries, config).astype("<u8").tobytes()})
        return pa.Table.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in _REDUCED.items()], list(_REDUCED))

    sent = counted.filter("kind <> 'blocks'").select("bucket", "kind", "block", "keys", "counts")
    return sent.groupBy("bucket").applyInArrow(run, REDUCED)


def _base(counted: DataFrame, reduced: DataFrame) -> DataFrame:
    """(key, n_tokens, n_known, logs): a row per counted document."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        got = sorted(zip(answers["bucket"].to_pylist(), answers["data"].to_pylist(), strict=True))
        count = np.concatenate([np.frombuffer(data, "<u8") for _, data in got])
        ends = np.frombuffer(block["ends"][0].as_py(), "<u4")
        doc, times = (_wide(block[c][0].as_py(), int(ends[-1])) for c in ("docs", "times"))
        keys, sizes = block["doc_keys"][0].as_py(), block["sizes"][0].as_py()
        length = np.diff(ends.astype(np.int64), prepend=0)
        logs = np.bincount(doc, times * np.repeat(np.log10(count + 1.0), length), len(keys))
        known = np.bincount(doc, times * np.repeat((count > 0).astype(float), length), len(keys)).astype(np.int64)
        return pa.table({"key": pa.array(keys, pa.int64()), "n_tokens": pa.array(sizes, pa.int64()), "n_known": known, "logs": logs})

    blocks = counted.filter("kind = 'blocks'").select("block", "ends", "docs", "times", "doc_keys", "sizes")
    answers = reduced.filter("kind = 'answers'").select("block", "bucket", "data")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, "key long, n_tokens long, n_known long, logs double")


class Piece:
    """Some buckets' slices, one after the other."""

    def __init__(self, slices: dict[int, bytes], buckets: int):
        self.words = np.frombuffer(b"".join(slices.values()), "<u8")
        self.sizes, self.starts = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        at = 0
        for b, data in slices.items():
            self.starts[b], self.sizes[b] = at, len(data) // 8
            at += len(data) // 8

    def levels(self, keys: np.ndarray, bucket: np.ndarray, out: np.ndarray, probes: int) -> None:
        """Fills in the level of the keys whose bucket is in this piece: asks for one level after the other."""
        rows = np.flatnonzero(self.sizes[bucket] > 0)
        level = 1
        while len(rows):
            b = bucket[rows]
            at, bits = _places(keys[rows], level, self.sizes[b], probes)
            rows = rows[self.words[self.starts[b] + at] & bits == bits]
            out[rows] = level
            level += 1


@dataclass
class Model:
    """A trained model on the driver: numbers, the pieces' broadcasts, and the documents' exact word scores."""

    config: Config
    buckets: int
    tokens: int
    types: int
    pieces: list
    documents: DataFrame


def train(docs: DataFrame, config: Config, buckets: int | None = None, block_bytes: int = BLOCK_BYTES, piece_bytes: int = PIECE_BYTES) -> Model:
    """Counts ``docs`` (key, text, train) and builds the filter from the rows with ``train``."""
    spark = docs.sparkSession
    if not buckets:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    counted = written(_count(docs, buckets, block_bytes), "lm-counted", partition_by="kind")
    reduced = written(_reduce(counted, config), "lm-counts", partition_by="kind")
    sizes = reduced.filter("kind = 'sizes'").agg(F.sum("tokens").alias("n"), F.sum("types").alias("v")).first()
    pieces, held, size = [], {}, 0
    for r in reduced.filter("kind = 'filter'").select("bucket", "data").toLocalIterator():
        if held and size + len(r["data"]) > piece_bytes:
            pieces.append(spark.sparkContext.broadcast(Piece(held, buckets)))
            held, size = {}, 0
        held[r["bucket"]] = bytes(r["data"])
        size += len(r["data"])
    if held:
        pieces.append(spark.sparkContext.broadcast(Piece(held, buckets)))
    return Model(config, buckets, sizes["n"] or 0, sizes["v"] or 0, pieces, _base(counted, reduced))


def _counts(levels: np.ndarray, least: int, base: float) -> np.ndarray:
    """The count that stands for a level: 0, an exact small count, or the middle of the level's range."""
    low = least * base ** (levels - 1.0)
    whole = np.ceil(low - 1e-9)
    last = np.ceil(low * base - 1e-9) - 1
    return np.where(levels == 0, 0.0, (whole + np.maximum(whole, last)) / 2)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(key, score)``: log10 probability of each row's text under the model."""
    c, buckets, pieces = model.config, model.buckets, model.pieces
    space = float(model.tokens + model.types + 1)

    def group(strings: list[str]) -> np.ndarray:
        s = _Stream(strings)
        word_key = np.append(_word_keys(s.hashes), _word_keys(np.array([_BEGIN], np.uint64)))
        word_bucket = (np.append(s.hashes, np.uint64(_BEGIN)) % np.uint64(buckets)).astype(np.int64)
        pair = _pairs(s.before(), s.hashes[s.number])
        pair_bucket = (pair % np.uint64(buckets)).astype(np.int64)
        word_level, pair_level = np.zeros(len(word_key), np.int64), np.zeros(len(pair), np.int64)
        for p in pieces:
            p.value.levels(word_key, word_bucket, word_level, c.probes)
            p.value.levels(pair, pair_bucket, pair_level, c.probes)
        word = _counts(word_level, c.least_word, c.base)
        both = _counts(pair_level, c.least_pair, c.base)
        first = np.cumsum(s.sizes) - s.sizes
        end = word[s.number[first + s.sizes - 1]]
        before = np.empty(len(pair))
        before[1:] = word[s.number[:-1]]
        before[first] = end  # as many texts begin as end
        weight = c.weight * before / (before + c.damping)
        share = np.minimum(1.0, np.divide(both, before, out=np.zeros(len(pair)), where=before > 0))
        p = weight * share + (1 - weight) * (word[s.number] + 1) / space
        return np.add.reduceat(np.log10(p), first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, strings in texts(batches):
            out, begin, size = [], 0, 0
            for i, t in enumerate(strings):
                size += len(t)
                if size >= 1 << 21 or i == len(strings) - 1:
                    out.append(group(strings[begin : i + 1]))
                    begin, size = i + 1, 0
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(np.concatenate(out))], ["key", "score"])

    return docs.select("key", "text").mapInArrow(run, "key long, score double")


def score_texts(
    docs: DataFrame, learn: Column, config: Config | None = None, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    The model is learned from the rows where ``learn`` holds (null: not).
    Null and empty texts are a lone end; repeated rows count each time; with
    nothing to learn from, all tokens are unknown and N and V are 0.  Other
    columns are not looked at.
    """
    config = config or Config()
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    rows = docs.select(key.alias("key"), F.col(text_col).alias("text"), F.coalesce(learn, F.lit(False)).alias("train"))
    model = train(rows, config, **options)
    space = math.log10(model.tokens + model.types + 1)
    # Equal rows have equal scores, so one of each is enough on the looked-up sides.
    base = model.documents.dropDuplicates(["key"])
    scored = score(rows, model).dropDuplicates(["key"])
    return (
        docs.select(F.col(id_col).alias("doc_id"), key.alias("key"))
        .join(base, "key")
        .join(scored, "key")
        .select(
            "doc_id",
            "n_tokens",
            "n_known",
            F.lit(model.tokens).cast("long").alias("train_tokens"),
            (F.col("logs") - F.col("n_tokens") * space).alias("base_score"),
            "score",
        )
    )


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_texts(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)
    return scored.select("doc_id", F.coalesce(fold("doc_id", 7) == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
