"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` cuts the corpus into segments of whole documents and writes,
for each, the dictionary of its words and each word's postings (word positions
in the segment, ascending, stored as gaps).  Between two documents one
position stays empty, so no phrase runs across them.  ``search`` takes the
benchmark's windows to every segment: a window with a word that a segment
lacks is done at once; else the postings of its rarest word there, shifted by
the word's offset, are intersected with the shifted postings of its next rarer
words.  What is left are the exact phrase matches.  Proximity matches are
windows whose words all occur within ``near`` positions of an occurrence of
the rarest one, in the same document.

A segment holds all postings of its documents, so postings are not shuffled
and a frequent word costs each segment its own share.  The benchmark is
broadcast in blocks of at most ``block_windows`` windows, some 30 MB, one of
which at a time is built on the driver; the blocks' matches are put together by
a document's place in the index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table, texts, written

WINDOW = 13
NEAR = 26
SEGMENT_BYTES = 8 << 20
BLOCK_WINDOWS = 200_000
#: ASCII letters in lower case and digits stay, other ASCII becomes a space, all other bytes stay.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

INDEX_SCHEMA = (
    "segment string, ids array<long>, starts binary, sizes binary, words binary, word_starts binary, gaps binary"
)
MATCH_SCHEMA = "segment string, place int, doc_id long, n_words long, spans array<int>, items array<string>, near_items array<string>"


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORDS).split()


class _Numbers(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _segment(name: str, ids: list, stream: list[np.ndarray], names: dict) -> pa.RecordBatch:
    sizes = np.array([len(x) for x in stream], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    word = np.concatenate(stream)
    position = np.arange(len(word)) + np.repeat(np.arange(len(stream)), sizes)
    order = np.argsort(word, kind="stable")
    gaps = np.diff(position[order], prepend=0)
    word_starts = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(names)))])
    as_bytes = lambda x: pa.array([x.astype("<i4").tobytes()], pa.binary())
    columns = [
        pa.array([name], pa.string()),
        pa.array([ids], pa.list_(pa.int64())),
        as_bytes(starts),
        as_bytes(sizes),
        pa.array([b"\n".join(names)], pa.binary()),
        as_bytes(word_starts),
        as_bytes(gaps),
    ]
    return pa.RecordBatch.from_arrays(columns, ["segment", "ids", "starts", "sizes", "words", "word_starts", "gaps"])


def build_index(
    docs: DataFrame, segment_bytes: int = SEGMENT_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The written index, a row per segment.  A null text has no words; repeated rows are documents of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n = TaskContext.get().partitionId(), 0
        ids: list = []
        stream: list[np.ndarray] = []
        names, size = _Numbers(), 0
        for batch, strings in texts(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), strings, strict=True):
                found = words(text)
                ids.append(doc_id)
                stream.append(np.fromiter(map(names.__getitem__, found), np.int32, len(found)))
                size += len(text)
                if size >= segment_bytes:
                    yield _segment(f"{task}-{n}", ids, stream, names)
                    ids, stream, names, size, n = [], [], _Numbers(), 0, n + 1
        if ids:
            yield _segment(f"{task}-{n}", ids, stream, names)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return written(picked.mapInArrow(run, INDEX_SCHEMA), "positional-index")


class Windows:
    """A block of benchmark windows: words as numbers, a row per distinct window, and the items each belongs to."""

    def __init__(self, parts: list[tuple[str, list[bytes]]], size: int):
        names, rows, owners = _Numbers(), [], []
        for n, (_, found) in enumerate(parts):
            number = np.fromiter(map(names.__getitem__, found), np.int32, len(found))
            if len(number) < size:  # one short window, padded
                number = np.concatenate([number, np.full(size - len(number), -1, np.int32)])
            rows.append(np.lib.stride_tricks.sliding_window_view(number, size))
            owners.append(np.full(len(rows[-1]), n, np.int32))
        every = np.concatenate(rows) if rows else np.zeros((0, size), np.int32)
        self.words, self.names = list(names), [item for item, _ in parts]
        self.terms, window = np.unique(every, axis=0, return_inverse=True)
        self.sizes = (self.terms >= 0).sum(axis=1).astype(np.int32)
        # Of each window the parts it occurs in, one after the other.
        pairs = np.unique(window.ravel().astype(np.int64) * max(1, len(parts)) + np.concatenate([*owners, np.zeros(0, np.int32)]))
        self.owner = (pairs % max(1, len(parts))).astype(np.int32)
        self.first = np.searchsorted(pairs // max(1, len(parts)), np.arange(len(self.terms) + 1)).astype(np.int32)

    def items(self, window: int) -> set[str]:
        return {self.names[p] for p in self.owner[self.first[window] : self.first[window + 1]]}

    def match(self, row: dict, near: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per window with a match in a segment: its number, exact starts, places of its proximity matches."""
        number = {w: i for i, w in enumerate(row["words"].split(b"\n"))}
        starts = np.frombuffer(row["word_starts"], "<i4")
        place = np.cumsum(np.frombuffer(row["gaps"], "<i4"), dtype=np.int64)
        doc_starts = np.frombuffer(row["starts"], "<i4")
        here = np.array([number.get(w, -1) for w in self.words] + [-1], np.int32)
        count = np.where(here >= 0, starts[here + 1] - starts[here], 0).astype(np.int32)
        count[-1] = np.iinfo(np.int32).max  # the padding of a short window
        often = count[self.terms]
        for i in np.flatnonzero((often > 0).all(axis=1)):
            order = np.argsort(often[i], kind="stable")[: self.sizes[i]]
            lists = [place[starts[t] : starts[t + 1]] for t in here[self.terms[i, order]]]
            found = lists[0] - order[0]
            close = lists[0]
            close_doc = np.searchsorted(doc_starts, close, "right")
            for offset, postings in zip(order[1:], lists[1:], strict=True):
                if len(found):
                    at = np.searchsorted(postings, found + offset)
                    found = found[postings[np.minimum(at, len(postings) - 1)] == found + offset]
                if len(close):
                    # The nearest occurrence on either side that lies in the same document.
                    at = np.searchsorted(postings, close)
                    after, before = postings[np.minimum(at, len(postings) - 1)], postings[np.maximum(at - 1, 0)]
                    ok = np.zeros(len(close), bool)
                    for other in (after, before):
                        same = np.searchsorted(doc_starts, other, "right") == close_doc
                        ok |= same & (np.abs(other - close) <= near)
                    close, close_doc = close[ok], close_doc[ok]
            if len(found) or len(close):
                yield i, found, np.unique(close_doc - 1), np.searchsorted(doc_starts, found, "right") - 1


def _blocks(items: DataFrame, size: int, most: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items' words in blocks of at most ``most`` windows; a longer item is cut, its parts sharing size - 1 words."""
    block, room = [], most
    for row in items.toLocalIterator():
        found, begin = words(row["text"] or ""), 0
        while begin < (max(1, len(found) - size + 1) if found else 0):
            take = min(room, max(1, len(found) - size + 1) - begin)
            block.append((row["item"], found[begin : begin + take + size - 1]))
            begin, room = begin + take, room - take
            if not room:
                yield block
                block, room = [], most
    if block:
        yield block


def _spans(starts: np.ndarray, sizes: np.ndarray) -> list[int]:
    """The union of [start, start + size) as a flat list of disjoint, ascending bounds."""
    order = np.argsort(starts, kind="stable")
    lo, hi = starts[order], np.maximum.accumulate((starts + sizes)[order])
    new = np.concatenate([[True], lo[1:] > hi[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(lo) - 1]])
    return np.stack([lo[first], hi[last]], axis=1).ravel().tolist()


def _search_block(index: DataFrame, block: list[tuple[str, list[bytes]]], window: int, near: int) -> DataFrame:
    asked = index.sparkSession.sparkContext.broadcast(Windows(block, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = asked.value
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                starts, sizes = np.frombuffer(row["starts"], "<i4"), np.frombuffer(row["sizes"], "<i4")
                hits: dict[int, list] = {}
                items: dict[int, set] = {}
                close: dict[int, set] = {}
                for i, found, near_docs, docs in w.match(row, near):
                    for at, d in zip(found.tolist(), docs.tolist(), strict=True):
                        hits.setdefault(d, []).append((at - int(starts[d]), int(w.sizes[i])))
                        items.setdefault(d, set()).update(w.items(i))
                    for d in near_docs.tolist():
                        close.setdefault(d, set()).update(w.items(i))
                spans = [_spans(*np.array(hits[d]).T) if d in hits else [] for d in range(len(sizes))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["segment"]] * len(sizes), pa.string()),
                        pa.array(np.arange(len(sizes)), pa.int32()),
                        pa.array(row["ids"], pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(spans, pa.list_(pa.int32())),
                        pa.array([sorted(items.get(d, ())) for d in range(len(sizes))], pa.list_(pa.string())),
                        pa.array([sorted(close.get(d, ())) for d in range(len(sizes))], pa.list_(pa.string())),
                    ],
                    ["segment", "place", "doc_id", "n_words", "spans", "items", "near_items"],
                )

    return index.mapInArrow(run, MATCH_SCHEMA)


def _merge(spans: list[list[int]]) -> list[int]:
    pairs = np.array([x for s in spans for x in s], np.int64).reshape(-1, 2)
    return _spans(pairs[:, 0], pairs[:, 1] - pairs[:, 0]) if len(pairs) else []


def search(
    index: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    near: int = NEAR,
    block_windows: int = BLOCK_WINDOWS,
    item_col: str = "item_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per indexed document: doc_id, n_words, spans (word bounds of the exact matches' union, flat), items, near_items.

    Items are given as strings, ascending as strings; a null item id is the
    empty string.  Items without words match nothing; an empty benchmark or
    index gives documents without matches, or no rows.
    """
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    parts = [_search_block(index, b, window, near) for b in _blocks(items, window, block_windows)] or [_search_block(index, [], window, near)]
    if len(parts) == 1:
        return parts[0].drop("segment", "place")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    merge = F.udf(_merge, "array<int>")  # only for documents that several blocks have matched
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    return (
        every.groupBy("segment", "place")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.collect_list(F.when(F.size("spans") > 0, F.col("spans"))).alias("spans"),
            flat("items").alias("items"),
            flat("near_items").alias("near_items"),
        )
        .select(
            "doc_id",
            "n_words",
            F.when(F.size("spans") > 1, merge("spans")).when(F.size("spans") == 1, F.col("spans")[0]).otherwise(F.array().cast("array<int>")).alias("spans"),
            "items",
            "near_items",
        )
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_words, n_hit, n_items, n_near_items, items, contaminated.

    A word inside any occurrence of a window is hit; a document is contaminated
    when words are hit and they are a twentieth of its words or more.
    """
    found = search(build_index(docs, id_col=id_col, text_col=text_col), benchmark, window, **options)
    hit = F.aggregate(
        F.col("spans"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("sign")),
        lambda a, x: F.struct((a["n"] + a["sign"] * x).alias("n"), (-a["sign"]).alias("sign")),
    )["n"]
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.size("near_items").cast("long").alias("n_near_items"),
        "items",
    ).withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated", "n_near_items"
    )
