"""Vector bin packing of documents or instruction examples into training sequences.

A sequence has three limits at once: tokens, segments (pieces) and
loss-bearing tokens.  The next piece of an open sequence is the waiting
example with the largest dot product of its demand and the room left, both as
shares of the limits; when none fits whole, the one with the largest product
is cut to fit.  Examples longer than a sequence are cut into full sequences
first.  A sequence is closed early only when its segments or loss-bearing
tokens are used up or no examples are left; it is then cut back to a power of
two, at which sequences need no padding, and what is cut off waits again.

Every task packs its own rows, with at most ``pool`` examples waiting, so
nothing is shuffled; a task leaves a handful of short sequences at its end.
A task's sequence ids start with its partition number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table, texts
from strata.llm.tokens import Handle

TOKENIZER = "byte_bpe_50k.json"
END = 0
LENGTH = 1024
SEGMENTS = 64
POOL = 2048


@dataclass(frozen=True)
class Limits:
    tokens: int = LENGTH
    segments: int = SEGMENTS
    loss: int = LENGTH


@dataclass
class Example:
    """An example's tokens; from token ``prompt`` on they bear loss.  ``start``: what is placed already."""

    key: object
    ids: np.ndarray
    prompt: int = 0
    start: int = 0

    @property
    def left(self) -> int:
        return len(self.ids) - self.start

    def loss(self, n: int) -> int:
        """Loss-bearing tokens among the next n."""
        return max(0, self.start + n - max(self.start, self.prompt))

    def fitting(self, tokens: int, loss: int) -> int:
        """The most next tokens within a room of tokens and loss-bearing tokens."""
        return min(self.left, tokens, max(0, self.prompt - self.start) + loss)


Piece = tuple[Example, int, int]  # example, start, length


class Packer:
    """Takes examples, gives full sequences as lists of pieces."""

    def __init__(self, limits: Limits, pool: int = POOL):
        if min(limits.tokens, limits.segments, limits.loss) < 1:
            raise ValueError("limits are at least 1")
        self.limits, self.pool = limits, pool
        self.waiting: list[Example] = []
        self.demand = np.zeros((0, 3))
        self.scale = np.array([limits.tokens, limits.segments, limits.loss], float)

    def add(self, example: Example) -> Iterator[list[Piece]]:
        while example.left >= self.limits.tokens and example.loss(self.limits.tokens) <= self.limits.loss:
            yield [(example, example.start, self.limits.tokens)]
            example.start += self.limits.tokens
        if example.left:
            self.waiting.append(example)
            if len(self.waiting) >= self.pool:
                yield from self._drain(self.pool // 2)

    def finish(self) -> Iterator[list[Piece]]:
        yield from self._drain(0)

    def _need(self, e: Example) -> tuple[int, int, int]:
        return e.left, 1, e.loss(e.left)

    def _drain(self, leave: int) -> Iterator[list[Piece]]:
        while len(self.waiting) > leave:
            # The demands of a drain are held as an array, a row per limit; a taken example's column becomes infinite.
            demand = np.array([self._need(e) for e in self.waiting], float).T.copy()
            gone = 0
            while len(self.waiting) - gone > leave and gone <= len(self.waiting) // 2:
                sequence, taken = self._fill(demand)
                gone += taken
                back = self._trim(sequence)
                yield sequence
                if back:
                    break
            else:
                back = []
            self.waiting = [e for e, d in zip(self.waiting, demand[0], strict=True) if d < np.inf] + back

    def _fill(self, demand: np.ndarray) -> tuple[list[Piece], int]:
        room, sequence, taken = self.scale.copy(), [], 0
        while room.min() >= 1:
            fits = (demand[0] <= room[0]) & (demand[1] <= room[1]) & (demand[2] <= room[2])
            among = np.flatnonzero(fits)
            whole = len(among) > 0
            if not whole:
                among = np.flatnonzero(demand[0] < np.inf)
                if not len(among):
                    break
            best = int(among[np.argmax((room / self.scale**2) @ demand[:, among])])
            e = self.waiting[best]
            n = e.left if whole else e.fitting(int(room[0]), int(room[2]))
            if n == 0:
                break
            room -= (n, 1, e.loss(n))
            sequence.append((e, e.start, n))
            e.start += n
            if e.left:
                demand[:, best] = self._need(e)
            else:
                demand[:, best] = np.inf
                taken += 1
        return sequence, taken

    def _trim(self, sequence: list[Piece]) -> list[Example]:
        """Cuts a short sequence back to a power of two; gives the examples that are to wait again."""
        total = sum(n for _, _, n in sequence)
        if total == self.limits.tokens or total & (total - 1) == 0:
            return []
        extra, back = total - (1 << (total.bit_length() - 1)), []
        while extra:
            e, start, n = sequence.pop()
            cut = min(n, extra)
            if n > cut:
                sequence.append((e, start, n - cut))
            extra -= cut
            back.append(Example(e.key, e.ids[: start + n], e.prompt, start + n - cut))
        return back


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _rows(sequence: list[Piece], number: int, with_ids: bool) -> Iterator[tuple]:
    offset = 0
    for e, start, n in sequence:
        data = e.ids[start : start + n].astype("<u4", copy=False).tobytes()
        yield (e.key[0], start, n, zlib.crc32(data), e.key[1], number, offset, *([data] if with_ids else []))
        offset += n


def pack(
    docs: DataFrame,
    limits: Limits | None = None,
    tokenizer: str = TOKENIZER,
    end: int = END,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    with_ids: bool = False,
    pool: int = POOL,
) -> DataFrame:
    """A row per piece of every row of ``docs``; with ``with_ids`` also its ids, little-endian unsigned 32-bit.

    A row's tokens are its text's ids and ``end``; with ``prompt_col``, the
    ids of that text come first and bear no loss.  Null texts count as empty
    (one token); repeated rows are packed one by one; an empty table gives no
    rows.  Other columns are not looked at.
    """
    limits = limits or Limits()
    schema = PIECES + (", ids binary" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int64()] * 7 + [pa.binary()]
    shared = docs.sparkSession.sparkContext.broadcast(Handle(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, packer = shared.value.encoder.encode, Packer(limits, pool)
        number, out = TaskContext.get().partitionId() << 33, []

        def flush() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names)

        def examples() -> Iterator[list[Piece]]:
            last = np.array([end], "<u4")
            for batch, strings in texts(batches):
                prompts = batch.column("prompt").to_pylist()
                for doc_id, p, t in zip(batch.column("doc_id").to_pylist(), prompts, strings, strict=True):
                    before = encode(p) if p else last[:0]
                    ids = np.concatenate([before, encode(t), last])
                    yield from packer.add(Example((doc_id, len(ids)), ids, len(before)))
            yield from packer.finish()

        for sequence in examples():
            out += _rows(sequence, number, with_ids)
            number += 1
            if len(out) >= 4096:
                yield flush()
                out = []
        if out:
            yield flush()

    prompt = F.col(prompt_col) if prompt_col else F.lit(None).cast("string")
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), prompt.alias("prompt"))
    return picked.mapInArrow(run, schema)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
