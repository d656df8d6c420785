"""Hard negatives by inner-product search in STR-packed R-trees.

For an anchor, positives are the rows of its label with the largest inner
products; for each positive, the negatives are the best rows of other labels
whose score lies in a window set by the positive's score.  Both are searches
for the best rows within a window of scores.

Rows are tiled by sort-tile-recursive cuts: first by label, then by one
coordinate after the other, widest first.  The tiles come from a bounded
sample, hold every row and are cut further by a hash where one is too full.  In
the task that holds a tile its rows are packed into pages by the same
recursion, exactly, and pages into nodes.  A node's minimum bounding box gives
an interval for each coordinate's product with the anchor and so, summed, one
for the inner product.  A best-first queue takes nodes by the upper end; those
whose interval lies outside all windows, or strictly below the k-th best found
so far, are pruned.  The sample also gives each anchor a first k-th best, with
which it is sent only to tiles that may hold something for it.

Equal rows of a label are one point with their smallest ids, as many as an
anchor can use, so copies neither fill a tile nor are searched twice.  The
search is exact.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import table, written

POSITIVES, NEGATIVES = 5, 3
#: Per cent of the positive's score between which a negative's lies.
WINDOW = (50, 95)
SAMPLE = 8192
TILE = 2048
MAX_TILES = 1024
ANCHORS = 4096
PAGE = 64
FAN = 16
SEED = 11
_MOST = (1 << 63) - 1
_EXACT = float(1 << 53)

OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
KEY = "struct<anchor_id:long,a:long,b:long>"


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _exact(x: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as they are if doubles hold all their inner products exactly, else as Python integers."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(other).max(initial=0)) * max(1, x.shape[-1])
    if most < _EXACT:
        return x, other
    whole = np.frompyfunc(int, 1, 1)
    return whole(x).astype(object), whole(other).astype(object)


def _slabs(pages: int, axes: int) -> int:
    """Slabs along the next of ``axes`` axes, that all of them together cut into ``pages``."""
    return max(2, math.ceil(pages ** (1 / max(1, axes)) - 1e-9)) if pages > 1 else 1


def _widest(vectors: np.ndarray) -> np.ndarray:
    return np.argsort(-np.ptp(vectors, axis=0), kind="stable") if len(vectors) else np.arange(vectors.shape[1])


class Tiles:
    """Sort-tile-recursive cuts learned from a sample; every row has a tile."""

    def __init__(self, labels: np.ndarray, vectors: np.ndarray, tiles: int):
        self.axes, self.n = _widest(vectors), 0
        self.root = self._cut(labels, vectors, np.arange(len(vectors)), 0, tiles)

    def _cut(self, labels: np.ndarray, vectors: np.ndarray, rows: np.ndarray, axis: int, tiles: int) -> tuple | int:
        """(axis, cuts, parts), or a tile's number; axis 0 is the label."""
        if tiles <= 1 or axis > len(self.axes) or not len(rows):
            self.n += 1
            return self.n - 1
        values = np.sort(labels[rows] if axis == 0 else vectors[rows, self.axes[axis - 1]])
        slabs = min(tiles, len(np.unique(values))) if axis == 0 else _slabs(tiles, len(self.axes) - axis + 1)
        # A slab ends with the value at its share of the rows; the last one has no end.
        cuts = np.unique(values[[len(values) * i // slabs - 1 for i in range(1, slabs) if len(values) * i // slabs]])
        cuts = cuts[cuts < values[-1]]
        part = np.searchsorted(cuts, labels[rows] if axis == 0 else vectors[rows, self.axes[axis - 1]], "left")
        share = [rows[part == i] for i in range(len(cuts) + 1)]
        return axis, cuts, [self._cut(labels, vectors, r, axis + 1, math.ceil(tiles * len(r) / len(rows))) for r in share]

    def place(self, labels: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros(len(vectors), np.int32)
        todo = [(self.root, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if isinstance(node, int):
                out[rows] = node
            elif len(rows):
                axis, cuts, parts = node
                part = np.searchsorted(cuts, labels[rows] if axis == 0 else vectors[rows, self.axes[axis - 1]], "left")
                todo += [(p, rows[part == i]) for i, p in enumerate(parts)]
        return out


def _packed(vectors: np.ndarray, rows: np.ndarray, axes: np.ndarray, page: int) -> Iterator[np.ndarray]:
    """The rows in pages of at most ``page``: sorted by an axis, cut into slabs of whole pages, each by the next axis."""
    pages = -(-len(rows) // page)
    if pages <= 1 or not len(axes):
        yield from (rows[i : i + page] for i in range(0, len(rows), page))
        return
    rows = rows[np.argsort(vectors[rows, axes[0]], kind="stable")]
    step = page * -(-pages // _slabs(pages, len(axes)))
    for i in range(0, len(rows), step):
        yield from _packed(vectors, rows[i : i + step], axes[1:], page)


class RTree:
    """An R-tree over points (label, vector), packed bottom up."""

    def __init__(self, labels: np.ndarray, vectors: np.ndarray, page: int = PAGE, fan: int = FAN):
        axes, order = _widest(vectors), np.argsort(labels, kind="stable")
        cuts = np.flatnonzero(np.diff(labels[order])) + 1
        if len(cuts) > len(order) // page:
            cuts = np.arange(page, len(order), page)  # too many labels for pages of their own
        leaves = [p for run in np.split(order, cuts) for p in _packed(vectors, run, axes, page)]
        self.rows = np.concatenate(leaves)
        self.labels, self.vectors = labels[self.rows], vectors[self.rows]
        ends = np.cumsum([len(x) for x in leaves])
        level = [(int(e) - len(x), int(e)) for x, e in zip(leaves, ends, strict=True)]
        low = np.array([vectors[x].min(axis=0) for x in leaves])
        high = np.array([vectors[x].max(axis=0) for x in leaves])
        first, last = np.array([labels[x].min() for x in leaves]), np.array([labels[x].max() for x in leaves])
        #: Of each node: its rows (a page) or its children's numbers; pages come first.
        self.pages, self.spans = len(leaves), level
        parts = [(low, high, first, last)]
        begin = 0
        while len(level) > 1:
            cut = np.arange(0, len(level), fan)
            spans = [(begin + int(a), begin + min(int(a) + fan, len(level))) for a in cut]
            begin += len(level)
            low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            first, last = np.minimum.reduceat(first, cut), np.maximum.reduceat(last, cut)
            parts.append((low, high, first, last))
            self.spans, level = self.spans + spans, spans
        self.low, self.high, self.first, self.last = (np.concatenate(x) for x in zip(*parts, strict=True))

    def intervals(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product that each node's box allows each query."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T

    def search(self, query: np.ndarray, least: np.ndarray, most: np.ndarray, label: int, same: bool, windows: list, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (low, high) the scores and rows of the k best points in it, with all ties of the k-th.

        ``least`` and ``most`` are the query's intervals; points are of the label, or (not ``same``) of any other.
        """
        floors, tops = [w[0] for w in windows], [w[1] for w in windows]
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, self.vectors.dtype), np.zeros(0, np.int64)) for _ in windows]

        def useful(node: int) -> bool:
            if (not self.first[node] <= label <= self.last[node]) if same else (self.first[node] == label == self.last[node]):
                return False
            return any(most[node] >= f and least[node] <= t for f, t in zip(floors, tops, strict=True))

        root = len(self.spans) - 1
        heap, held, step = [(-most[root], root)], [], 1
        while heap or held:
            while heap and len(held) < step:
                _, node = heapq.heappop(heap)
                if not useful(node):
                    continue
                if node < self.pages:
                    held.append(self.spans[node])
                else:
                    for child in range(*self.spans[node]):
                        if useful(child):
                            heapq.heappush(heap, (-most[child], child))
            if held:
                rows = np.concatenate([np.arange(a, b) for a, b in held])
                rows = rows[(self.labels[rows] == label) == same]
                score = self.vectors[rows] @ query
                for w, top in enumerate(tops):
                    ok = (score >= floors[w]) & (score <= top)
                    if ok.any():
                        found, at = np.concatenate([best[w][0], score[ok]]), np.concatenate([best[w][1], rows[ok]])
                        if len(found) > k:
                            floors[w] = max(floors[w], np.sort(found)[-k])
                            found, at = found[found >= floors[w]], at[found >= floors[w]]
                        best[w] = found, at
                held, step = [], 2 * step
        return [(s, self.rows[at]) for s, at in best]


def _points(rows: DataFrame, copies: int) -> DataFrame:
    """(a, b, ids, label, vector): the distinct (label, vector), with their smallest ids, ascending."""
    # The limit on the rank is applied before the shuffle as well, so copies don't meet in one task.
    few = rows.withColumn("_n", F.row_number().over(Window.partitionBy("a", "b").orderBy("id"))).filter(F.col("_n") <= copies)
    return few.groupBy("a", "b").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.first("label").alias("label"), F.first("vector").alias("vector"))


def whole_rows(vectors: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """(id, label, vector, a, b): the rows that take part, components as floor(scale * x) in doubles; a and b hash label and vector."""
    scaled = F.transform(F.col(vector_col), lambda x: x.cast("double") * F.lit(float(scale)))
    whole = F.transform(scaled, lambda y: F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter("id is not null and label is not null and vector is not null").filter(fine).distinct()
    return rows.withColumns({"a": F.xxhash64("label", "vector"), "b": F.xxhash64(F.lit(SEED), "label", "vector")})


class _Index:
    """The tiles of the points of one length, written, and what is known of them on the driver."""

    def __init__(self, points: DataFrame, n: int, dim: int, sample: int, tile: int):
        spark = points.sparkSession
        self.dim, self.spark, self.tile = dim, spark, tile
        place = F.pmod(F.xxhash64(F.lit("sample"), "a", "b"), F.lit(1 << 20)) / float(1 << 20)
        # About ``sample`` points: a bounded share of the driver and of a broadcast.
        some = points.filter(place < min(1.0, sample / n)).select("label", "vector").toArrow().combine_chunks()
        known = _matrix(some["vector"].combine_chunks(), dim) if len(some) else np.zeros((0, dim))
        labels = some["label"].to_numpy()
        tiles = Tiles(labels, known, min(MAX_TILES, -(-n // tile)))
        self.shared = spark.sparkContext.broadcast((labels, known, tiles))

        def put(batches: Iterator[pa.RecordBatch], shared=self.shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    at = shared.value[2].place(batch.column("label").to_numpy(), _matrix(batch.column("vector"), dim))
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], [*batch.schema.names, "tile"])

        self.placed = written(points.mapInArrow(put, "a long, b long, ids array<long>, label long, vector array<double>, tile int"), "rtree-placed")
        # A row per tile, and one per tile and coordinate: at most MAX_TILES times dim.
        size = self.placed.groupBy("tile").agg(F.count("*").alias("n"), F.min("label").alias("first"), F.max("label").alias("last")).toArrow().to_pydict()
        self.tiles = np.array(size["tile"])
        self.parts = np.array([-(-x // tile) for x in size["n"]])
        number = {t: i for i, t in enumerate(size["tile"])}
        low, high = np.zeros((len(number), dim)), np.zeros((len(number), dim))
        sides = self.placed.select("tile", F.posexplode("vector").alias("pos", "x")).groupBy("tile", "pos").agg(F.min("x").alias("low"), F.max("x").alias("high"))
        box = sides.toArrow()
        at = np.array([number[t] for t in box["tile"].to_pylist()], int), box["pos"].to_numpy().astype(int)
        low[at], high[at] = box["low"].to_numpy(), box["high"].to_numpy()
        self.boxes = spark.sparkContext.broadcast((self.tiles, self.parts, low, high, np.array(size["first"]), np.array(size["last"])))

    def search(self, asked: DataFrame, anchors: int, same: bool, k: int, windows) -> DataFrame:
        """(key, mark, score, id): for each window of each row of ``asked`` (key, label, vector, marks) the best k rows, tile by tile.

        ``windows(marks)`` gives a row's windows as (mark, low, high).
        """
        dim, shared, boxes = self.dim, self.shared, self.boxes
        chunks = max(1, -(-anchors // ANCHORS))

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            labels, known, _ = shared.value
            tiles, parts, low, high, first, last = boxes.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                take, to, sub, wide = [], [], [], []
                vectors = _matrix(batch.column("vector"), dim)
                for i, (label, marks) in enumerate(zip(batch.column("label").to_pylist(), batch.column("marks").to_pylist(), strict=True)):
                    q, of = _exact(vectors[i], known)
                    scores = np.sort((of @ q)[(labels == label) == same])
                    held = []
                    for mark, least, most in windows(marks):
                        inside = scores[np.searchsorted(scores, least, "left") : np.searchsorted(scores, most, "right")]
                        held.append((mark, max(least, int(inside[-k])) if len(inside) >= k else least, most))
                    q, ends = _exact(vectors[i], np.concatenate([low, high]))
                    up, down = np.maximum(q, 0), np.minimum(q, 0)
                    least, most = ends[: len(low)] @ up + ends[len(low) :] @ down, ends[len(low) :] @ up + ends[: len(low)] @ down
                    may = np.zeros(len(tiles), bool)
                    for _, a, b in held:
                        may |= (most >= a) & (least <= b)
                    may &= (first <= label) & (last >= label) if same else ~((first == label) & (last == label))
                    for t in np.flatnonzero(may):
                        for s in range(parts[t]):
                            take.append(i)
                            to.append(int(tiles[t]))
                            sub.append(s)
                            wide.append([{"mark": m, "low": a, "high": b} for m, a, b in held])
                sent = batch.take(pa.array(take, pa.int64()))
                columns = [*(sent.column(c) for c in ("key", "label", "vector")), pa.array(to, pa.int32()), pa.array(sub, pa.int32())]
                kind = pa.list_(pa.struct([("mark", pa.int64()), ("low", pa.int64()), ("high", pa.int64())]))
                yield pa.RecordBatch.from_arrays([*columns, pa.array(wide, kind)], ["key", "label", "vector", "tile", "sub", "windows"])

        schema = f"key {KEY}, label long, vector array<double>, tile int, sub int, windows array<struct<mark:long,low:long,high:long>>"
        chunk = F.pmod(F.xxhash64("key"), F.lit(chunks)).cast("int").alias("chunk")
        sent = written(asked.mapInArrow(send, schema).select("*", chunk), "rtree-sent")
        # A tile's points go to each chunk of anchors that was sent to it.
        sizes = self.spark.createDataFrame([(int(t), int(p)) for t, p in zip(self.tiles, self.parts, strict=True)], "tile int, parts int")
        needed = sent.select(F.col("tile").alias("tile"), F.col("chunk").alias("chunk")).distinct().join(sizes, "tile")
        part = F.pmod(F.xxhash64("a", "b"), F.col("parts")).cast("int")
        held = self.placed.select("tile", "a", "b", "ids", "label", "vector").join(needed, "tile").withColumn("sub", part)

        def look(left: pa.Table, right: pa.Table) -> pa.Table:
            out: list[tuple] = []
            keys = pa.array([], right.schema.field("key").type)
            if left.num_rows and right.num_rows:
                left, right = left.combine_chunks(), right.combine_chunks()
                ids, q = left["ids"].to_pylist(), _matrix(right["vector"].combine_chunks(), dim)
                q, vectors = _exact(q, _matrix(left["vector"].combine_chunks(), dim))
                tree = RTree(left["label"].to_numpy(), vectors)
                least, most = tree.intervals(q)
                for i, (label, wide) in enumerate(zip(right["label"].to_pylist(), right["windows"].to_pylist(), strict=True)):
                    found = tree.search(q[i], least[i], most[i], label, same, [(w["low"], w["high"]) for w in wide], k)
                    for w, (scores, rows) in zip(wide, found, strict=True):
                        pairs = sorted((-int(s), x) for s, r in zip(scores.tolist(), rows.tolist(), strict=True) for x in ids[r][:k])
                        out += [(i, w["mark"], max(-_MOST, min(_MOST, -s)), x) for s, x in pairs[:k]]
                keys = right["key"].combine_chunks().take(pa.array([o[0] for o in out], pa.int64()))
            columns = [pa.array([o[c] for o in out], pa.int64()) for c in (1, 2, 3)]
            return pa.Table.from_arrays([keys, *columns], ["key", "mark", "score", "id"])

        by = ("tile", "sub", "chunk")
        left = held.select(*by, "ids", "label", "vector").groupBy(*by)
        return left.cogroup(sent.groupBy(*by)).applyInArrow(look, f"key {KEY}, mark long, score long, id long")


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    label: str | Column = "label",
    every: int = 50,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: int = 256,
    sample: int = SAMPLE,
    tile: int = TILE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows whose id is divisible by ``every``; scores are inner
    products of the vectors floor(scale * x), higher ones first, ties to the
    smaller id.  An anchor's positives are its best rows of the same label and
    another id; a positive's negatives the best rows of other labels with
    window[0] * positive <= 100 * negative <= window[1] * positive.

    Null ids, labels and vectors, vectors with null or non-finite components
    (also after scaling) take no part.  Vectors are compared with those of
    their own length; those without components score 0.  Equal rows count
    once; an id with several vectors or labels has a row for each.  Scores are
    exact; those beyond 64 bits are given as the nearest 64-bit number.  An
    empty table gives no rows; other columns are not looked at.
    """
    spark = vectors.sparkSession
    by = F.col(label) if isinstance(label, str) else label
    rows = written(whole_rows(vectors, id_col, vector_col, by, scale), "rtree-rows")
    points = written(_points(rows, max(positives + 1, negatives)), "rtree-points")
    key = F.struct(F.col("id").alias("anchor_id"), "a", "b").alias("key")
    anchors = rows.filter(F.col("id") % every == 0).select(key, "label", "vector")
    low, high = window
    parts = []
    # A length is an index of its own; lengths come to the driver.
    asked = {r["d"]: r["n"] for r in anchors.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).collect()}
    for r in points.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).collect():
        if r["d"] not in asked:
            continue
        of_length = F.size("vector") == r["d"]
        index = _Index(points.filter(of_length), r["n"], r["d"], sample, tile)
        mine = anchors.filter(of_length)
        everywhere = mine.withColumn("marks", F.array(F.lit(0).cast("long")))
        near = index.search(everywhere, asked[r["d"]], True, positives + 1, lambda marks: [(0, -_MOST, _MOST)])
        others = near.filter(F.col("id") != F.col("key.anchor_id"))
        chosen = written(_best(others, ["key"], positives).select("key", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "rtree-positives")
        marks = chosen.groupBy("key").agg(F.collect_set("positive_score").alias("marks"))

        def windows(marks: list[int]) -> list[tuple[int, int, int]]:
            """The whole scores s with low * mark <= 100 * s <= high * mark."""
            ends = [(m, -(-low * m // 100), high * m // 100) for m in sorted(marks)]
            return [e for e in ends if e[1] <= e[2]]

        far = index.search(mine.join(marks, "key"), asked[r["d"]], False, negatives, windows)
        kept = _best(far.withColumnRenamed("mark", "positive_score"), ["key", "positive_score"], negatives)
        parts.append(chosen.join(kept, ["key", "positive_score"]))
    out = None
    for p in parts:
        p = p.select("key.anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = p if out is None else out.unionByName(p)
    return spark.createDataFrame([], OUT) if out is None else out


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, label)


def oracle() -> str:
    return """
with rows_ as (
  select distinct vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.id as anchor_id, r.id, a.label = r.label as same, cast(list_dot_product(a.v, r.v) as bigint) as score
  from rows_ a join rows_ r on len(a.v) = len(r.v) and a.id <> r.id where a.id % 50 = 0
), positives as (
  select anchor_id, id as positive_id, score as positive_score
  from scored where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
), found as (
  select p.anchor_id, p.positive_id, s.id as negative_id, p.positive_score, s.score as negative_score,
    row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.id) as rank
  from positives p join scored s on s.anchor_id = p.anchor_id and not s.same
    and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from found where rank <= 3"""
