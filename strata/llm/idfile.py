"""Token ids in patched frame-of-reference blocks.

A file row holds whole documents' ids as blocks of 128: the block's minimum is
subtracted, the differences are packed at the width that holds the chosen
percentile of them, and the high bits of those that need more are patched from
a list of exceptions.  A block's bits are stored plane by plane (bit 0 of all
its ids, then bit 1, ...).  An index holds where each block starts, so a range
of ids is read without decoding what comes before it.

    header   magic "PFR1", number of ids and of blocks (unsigned 32-bit each)
    index    per block: start of its planes in the body, number of exceptions before it (unsigned 32-bit each)
    blocks   per block: minimum (unsigned 32-bit), width (one byte)
    body     the planes, 16 bytes each
    patches  per exception: place in its block (one byte); then high bits (unsigned 32-bit each)

All numbers are little-endian.  The files are Parquet tables of such rows in
ascending (doc_id, hash of text) order, so that any store Spark can write takes
them: Spark ranges the documents, and each task (a part) encodes its range.  A
row also holds the number of its part's ids before it.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import new_path, table, texts
from strata.llm.tokens import Handle

TOKENIZER = "word_bpe_49k.json"
END = 2
BLOCK = 128
PERCENTILE = 90
#: A row is closed after the document with which it has this many ids or more.
ROW_IDS = 1 << 18
MAGIC = b"PFR1"
_PLANE = BLOCK // 8


def _widths(x: np.ndarray) -> np.ndarray:
    """Bits that each unsigned number needs."""
    return np.frexp(x.astype(np.float64))[1]


def encode(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """The file row of an array of unsigned 32-bit ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return MAGIC + struct.pack("<II", 0, 0)
    full = np.empty(blocks * BLOCK, np.uint32)
    full[:n], full[n:] = ids, ids[-1]
    full = full.reshape(blocks, BLOCK)
    low = full.min(axis=1)
    diff = full - low[:, None]
    rank = min(BLOCK - 1, max(0, int(np.ceil(percentile / 100 * BLOCK)) - 1))
    width = _widths(np.partition(diff, rank, axis=1)[:, rank])
    starts = np.concatenate([[0], np.cumsum(width * _PLANE)])
    body = np.zeros(starts[-1], np.uint8)
    for bit in range(int(width.max())):
        rows = np.flatnonzero(width > bit)
        planes = np.packbits((diff[rows] >> np.uint32(bit)).astype(np.uint8) & 1, axis=1, bitorder="little")
        body[(starts[rows] + bit * _PLANE)[:, None] + np.arange(_PLANE)] = planes
    high = (diff.astype(np.uint64) >> width.astype(np.uint64)[:, None]).astype(np.uint32)
    row, place = np.nonzero(high)
    before = np.searchsorted(row, np.arange(blocks))
    index = np.stack([starts[:-1], before], axis=1).astype("<u4")
    return b"".join(
        [
            MAGIC,
            struct.pack("<II", n, blocks),
            index.tobytes(),
            low.astype("<u4").tobytes(),
            width.astype(np.uint8).tobytes(),
            body.tobytes(),
            place.astype(np.uint8).tobytes(),
            high[row, place].astype("<u4").tobytes(),
        ]
    )


def decode(data: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a file row; only the blocks that hold them are unpacked."""
    if data[:4] != MAGIC:
        raise ValueError("not a row of patched frame-of-reference blocks")
    n, blocks = struct.unpack_from("<II", data, 4)
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, np.uint32)
    index = np.frombuffer(data, "<u4", 2 * blocks, 12).reshape(blocks, 2)
    low = np.frombuffer(data, "<u4", blocks, 12 + 8 * blocks)
    width = np.frombuffer(data, np.uint8, blocks, 12 + 12 * blocks)
    at = 12 + 13 * blocks
    size = int(index[-1, 0]) + int(width[-1]) * _PLANE
    body = np.frombuffer(data, np.uint8, size, at)
    patches = (len(data) - at - size) // 5
    place = np.frombuffer(data, np.uint8, patches, at + size)
    high = np.frombuffer(data, "<u4", patches, at + size + patches)
    a, b = start // BLOCK, -(-stop // BLOCK)
    out = np.zeros((b - a, BLOCK), np.uint32)
    for bit in range(int(width[a:b].max())):
        rows = np.flatnonzero(width[a:b] > bit)
        planes = body[(index[a + rows, 0].astype(np.int64) + bit * _PLANE)[:, None] + np.arange(_PLANE)]
        out[rows] |= np.unpackbits(planes, axis=1, bitorder="little").astype(np.uint32) << np.uint32(bit)
    first, last = int(index[a, 1]), int(index[b, 1]) if b < blocks else patches
    row = np.searchsorted(index[:, 1], np.arange(first, last), "right") - 1
    # Blocks without exceptions share the count of the next one; the last of those with it holds them.
    out[row - a, place[first:last]] |= (high[first:last].astype(np.uint64) << width[row].astype(np.uint64)).astype(np.uint32)
    out += low[a:b, None]
    return out.ravel()[start - a * BLOCK : stop - a * BLOCK]


FILE_SCHEMA = "part int, start long, doc_ids array<long>, doc_sizes array<int>, data binary"


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str = TOKENIZER,
    end: int = END,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_ids: int = ROW_IDS,
) -> None:
    """Writes every row's ids, with ``end`` after each, in ascending order of id (then a hash of the text).

    Null texts count as empty, null ids come first, repeated rows follow one
    another.  Other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Handle(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        last = np.array([end], "<u4")
        ids: list = []
        held: list[np.ndarray] = []
        size = 0

        def row() -> pa.RecordBatch:
            columns = [
                pa.array([part], pa.int32()),
                pa.array([before], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([[len(x) for x in held]], pa.list_(pa.int32())),
                pa.array([encode(np.concatenate(held))], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["part", "start", "doc_ids", "doc_sizes", "data"])

        code = shared.value.encoder.encode
        for batch, strings in texts(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), strings, strict=True):
                ids.append(doc_id)
                held.append(np.concatenate([code(text), last]))
                size += len(held[-1])
                if size >= row_ids:
                    yield row()
                    ids, held, size, before = [], [], 0, before + size
        if ids:
            yield row()

    spark = docs.sparkSession
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), picked.rdd.getNumPartitions())
    ranged = picked.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged.mapInArrow(run, FILE_SCHEMA).write.option("compression", "uncompressed").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of each document from the files; start counts the ids of all documents before it."""
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    # The ids before each part: a total per part, summed in order on the driver (as many numbers as the write had tasks).
    total = F.expr("start + aggregate(doc_sizes, 0L, (a, n) -> a + n)")
    by_part = sorted(rows.groupBy("part").agg(F.max(total).alias("n")).collect())
    begins = np.concatenate([[0], np.cumsum([r["n"] for r in by_part], dtype=np.int64)]).tolist()
    before = {r["part"]: begins[i] for i, r in enumerate(by_part)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part, doc_ids, sizes, data, at = (batch.column(c)[k].as_py() for c in ("part", "doc_ids", "doc_sizes", "data", "start"))
                ids, cuts = decode(data), np.cumsum([0, *sizes])
                held = [ids[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
                starts = cuts[:-1] + at + before[part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(held, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def op9_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "ids")
    write_ids(table(spark, sf_dir, "documents"), path)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
