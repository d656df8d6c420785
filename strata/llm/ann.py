"""Nearest neighbours by cosine over low-dimensional stable projections.

Unit vectors are projected on ``m`` Gaussian directions.  For a vector at
distance d, (projected distance / d)^2 * m follows a chi-square law with m
degrees of freedom, so once the next projected neighbour of a query is farther
than d_k * sqrt(quantile(p) / m), d_k being its k-th best verified distance, a
true neighbour is still unseen with probability 1 - p at most: the search
stops there.  Projected neighbours come in order from a kd-tree.

The tree's top is split on a bounded sample of projections: its leaves are
cells, cut further by a hash where a cell is full, and every cell's vectors
make the tree's lower part in the task that holds them.  The sample also gives
each query a first d_k, with which it is sent only to cells that its ball
reaches.  Equal vectors are one point with their smallest ids, as many as a
query can use, so copies neither crowd a cell nor are searched twice.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import table, written

NEIGHBOURS = 5
PROJECTIONS = 8
CONFIDENCE = 0.97
SAMPLE = 4096
CELL = 2048
QUERIES = 4096
LEAF = 32
MAX_CELLS = 256
SEED = 8
#: Cosines closer than this may have been parted by rounding.
_ROUNDING = 1e-9


def chi_square_quantile(p: float, m: int) -> float:
    """For an even number of degrees of freedom, by bisection on the closed form of the distribution."""
    below, above = 0.0, 1000.0
    for _ in range(100):
        x = (below + above) / 2
        term = total = 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        if 1 - math.exp(-x / 2) * total < p:
            below = x
        else:
            above = x
    return (below + above) / 2


def _matrix(column: pa.Array, dtype: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class _Tree:
    """Median splits on the widest side, down to leaves of at most ``leaf`` points."""

    def __init__(self, points: np.ndarray, leaf: int, most: int = 1 << 30):
        self.split: list[tuple[int, float, int, int]] = []
        self.leaves: list[np.ndarray] = []
        self.root = self._grow(points, np.arange(len(points)), leaf, most)

    def _grow(self, points: np.ndarray, rows: np.ndarray, leaf: int, most: int) -> int:
        """The node's number: a split's, or -1 - a leaf's."""
        wide = np.ptp(points[rows], axis=0) if len(rows) else np.zeros(1)
        axis = int(np.argmax(wide))
        if len(rows) > leaf and most > 1 and wide[axis] > 0:
            side = points[rows, axis]
            cut = float(np.median(side))
            left = side <= cut if (side > cut).any() else side < cut
            at = len(self.split)
            self.split.append((axis, cut, 0, 0))
            cut = float(side[left].max())
            a = self._grow(points, rows[left], leaf, most // 2)
            b = self._grow(points, rows[~left], leaf, most // 2)
            self.split[at] = (axis, cut, a, b)
            return at
        self.leaves.append(rows)
        return -len(self.leaves)

    def place(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        out = np.zeros(len(points), np.int32)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                axis, cut, a, b = self.split[node]
                left = points[rows, axis] <= cut
                todo += [(a, rows[left]), (b, rows[~left])]
        return out


def _gap(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point to boxes."""
    away = np.maximum(np.maximum(low - point, point - high), 0)
    return (away * away).sum(axis=-1)


class _Cell:
    """A cell's points under a kd-tree in projected space."""

    def __init__(self, ids: list[list[int]], original: np.ndarray, projected: np.ndarray):
        leaves = _Tree(projected, LEAF).leaves
        order = np.concatenate(leaves)
        self.ids = [ids[i] for i in order]
        self.original, self.unit = original[order], _unit(original[order])
        self.norm = np.sqrt((self.original * self.original).sum(axis=1))
        ends = np.cumsum([len(x) for x in leaves])
        self.bounds = np.stack([ends - [len(x) for x in leaves], ends], axis=1)
        self.low = np.array([projected[x].min(axis=0) for x in leaves])
        self.high = np.array([projected[x].max(axis=0) for x in leaves])
        self.projected = projected[order]

    def search(self, q: np.ndarray, point: np.ndarray, bound: float, k: int, reach: float) -> list[tuple[float, int]]:
        """Up to k (cosine, id) pairs, best first; ``bound``: squared distance known to hold k others."""
        unit = q / np.sqrt((q * q).sum())
        gaps = _gap(point, self.low, self.high)
        order = np.argsort(gaps, kind="stable")
        best = np.zeros((0, 2))  # cosine, row
        at, step = 0, 2
        while at < len(order) and gaps[order[at]] <= bound * reach:
            take = order[at : at + step]
            rows = np.concatenate([np.arange(*self.bounds[i]) for i in take])
            away = self.projected[rows] - point
            rows = rows[(away * away).sum(axis=1) <= bound * reach]
            if len(rows):
                found = np.stack([self.unit[rows] @ unit, rows], axis=1)
                best = np.concatenate([best, found])
                if len(best) >= k:
                    kth = np.partition(best[:, 0], -k)[-k]
                    bound = min(bound, 2 - 2 * kth + 2 * _ROUNDING)
                    # All that may tie with the k-th stay to the end, however many.
                    best = best[best[:, 0] >= kth - _ROUNDING]
            at, step = at + step, 2 * step
        rows = best[:, 1].astype(int)
        cosine = (self.original[rows] * q).sum(axis=1) / (self.norm[rows] * np.sqrt((q * q).sum()))
        pairs = sorted((-c, i) for c, r in zip(cosine.tolist(), rows, strict=True) for i in self.ids[r])
        return [(-c, i) for c, i in pairs[:k]]


def _points(vectors: DataFrame, id_col: str, vector_col: str, copies: int) -> DataFrame:
    """(point, ids, vector): distinct vectors that take part, with their smallest ids, ascending."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("vector"))
        .filter(F.col("id").isNotNull() & F.col("vector").isNotNull())
        .filter(fine)
        .withColumn("point", F.struct(F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(SEED), "vector").alias("b")))
    )
    # The limit on the rank is applied before the shuffle as well, so copies of a vector don't meet in one task.
    few = rows.distinct().withColumn("n", F.row_number().over(Window.partitionBy("point").orderBy("id"))).filter(F.col("n") <= copies)
    return few.groupBy("point").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.first("vector").alias("vector"))


def neighbours(
    vectors: DataFrame,
    every: int = 50,
    k: int = NEIGHBOURS,
    m: int = PROJECTIONS,
    confidence: float = CONFIDENCE,
    sample: int = SAMPLE,
    cell: int = CELL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of each row whose id is divisible by ``every``.

    Nearest by cosine of the original vectors in double precision, ties to the
    smaller id; a query's own row is no candidate.  Null ids and vectors,
    vectors of zeros, and those with null or non-finite components take no
    part.  Vectors are compared with those of their own length, each length
    being an index of its own.  Repeated rows count once; an empty table, or a
    single vector, gives no rows.
    """
    points = written(_points(vectors, id_col, vector_col, k + 1), "ann-points")
    queries = _queries(vectors, id_col, vector_col, every)
    # A row per length of vectors.
    sizes = sorted(points.groupBy(F.size("vector").alias("d")).count().collect())
    out = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for dim, n in sizes:
        out_of = _of_length(points.filter(F.size("vector") == dim), queries, n, dim, k, m, confidence, sample, cell)
        out = out_of if len(sizes) == 1 else out.unionByName(out_of)
    return out


def _of_length(
    points: DataFrame, queries: DataFrame, n: int, dim: int, k: int, m: int, confidence: float, sample: int, cell: int
) -> DataFrame:
    """The neighbours among the ``n`` points, all of length ``dim``."""
    spark = points.sparkSession
    place = F.pmod(F.xxhash64(F.lit("sample"), "point"), F.lit(1 << 20)) / float(1 << 20)
    # About ``sample`` vectors: a bounded share of the driver and of a broadcast.
    some = points.filter(place < min(1.0, sample / n)).select("point", "vector").orderBy("point").collect()
    known = np.array([r["vector"] for r in some], float).reshape(len(some), dim)
    known_points = np.array([(r["point"]["a"], r["point"]["b"]) for r in some], np.int64).reshape(len(some), 2)
    directions = np.random.default_rng(SEED).standard_normal((dim, m)) / math.sqrt(m)
    cells = min(MAX_CELLS, max(1, 1 << math.ceil(math.log2(max(1, n / cell)))))
    tree = _Tree(_unit(known) @ directions if len(known) else np.zeros((0, m)), max(1, len(known) // cells), cells)
    reach = chi_square_quantile(confidence, m) / m
    shared = spark.sparkContext.broadcast((directions, tree, _unit(known), known_points))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, tree, *_ = shared.value
        for batch in batches:
            if batch.num_rows:
                p = _unit(_matrix(batch.column("vector"), float)) @ directions
                yield pa.RecordBatch.from_arrays([*batch.columns, _lists(p), pa.array(tree.place(p))], [*batch.schema.names, "projected", "cell"])

    placed = written(
        points.select(F.col("point.a").alias("a"), F.col("point.b").alias("b"), "ids", "vector").mapInArrow(
            project, "a long, b long, ids array<long>, vector array<double>, projected array<double>, cell int"
        ),
        "ann-placed",
    )
    # A row per cell, of which there are at most MAX_CELLS.
    low, high = ([f(F.get("projected", F.lit(i))).alias(f"{s}{i}") for i in range(m)] for f, s in ((F.min, "l"), (F.max, "h")))
    boxes = sorted(placed.groupBy("cell").agg(F.count("*").alias("n"), *low, *high).collect())
    parts = {r["cell"]: -(-r["n"] // cell) for r in boxes}
    box = np.array([list(r)[2:] for r in boxes]).reshape(len(boxes), 2, m)
    asked = written(placed.join(queries.select("a", "b").distinct(), ["a", "b"], "left_semi"), "ann-asked")
    chunks = max(1, -(-asked.count() // QUERIES))
    sent_boxes = spark.sparkContext.broadcast((np.array([r["cell"] for r in boxes]), box, np.array([parts[r["cell"]] for r in boxes])))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, known, names = shared.value
        cell_ids, box, parts = sent_boxes.value
        for batch in batches:
            if not batch.num_rows:
                continue
            q, p = _unit(_matrix(batch.column("vector"), float)), _matrix(batch.column("projected"), float)
            own = np.stack([batch.column(c).to_numpy() for c in ("a", "b")], axis=1)
            take, cells, subs, bounds = [], [], [], []
            for i in range(batch.num_rows):
                cosine = np.where((names == own[i]).all(axis=1), -2.0, known @ q[i])
                bound = 2 - 2 * np.partition(cosine, -k)[-k] + 1e-12 if len(cosine) > k else 4.1
                for c in np.flatnonzero(_gap(p[i], box[:, 0], box[:, 1]) <= bound * reach):
                    for s in range(parts[c]):
                        take.append(i)
                        cells.append(cell_ids[c])
                        subs.append(s)
                        bounds.append(bound)
            sent = batch.take(pa.array(take, pa.int64()))
            columns = [sent.column(c) for c in ("a", "b", "vector", "projected")]
            columns += [pa.array(cells, pa.int32()), pa.array(subs, pa.int32()), pa.array(bounds, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "vector", "projected", "cell", "sub", "bound"])

    chunk = F.pmod(F.xxhash64("b", "a"), F.lit(chunks)).cast("int")
    sent = written(
        asked.select("a", "b", "vector", "projected")
        .mapInArrow(send, "a long, b long, vector array<double>, projected array<double>, cell int, sub int, bound double")
        .withColumn("chunk", chunk),
        "ann-sent",
    )
    part_of = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])
    # A cell's vectors go to those chunks of queries that were sent to it.
    needed = sent.select(F.col("cell").alias("cell"), F.col("chunk").alias("chunk")).distinct()
    held = placed.withColumn("sub", F.pmod(F.xxhash64("a", "b"), F.element_at(part_of, F.col("cell"))).cast("int")).join(needed, "cell")

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            left = left.combine_chunks()
            here = _Cell(left["ids"].to_pylist(), _matrix(left["vector"].combine_chunks(), float), _matrix(left["projected"].combine_chunks(), float))
            right = right.combine_chunks()
            q, p = _matrix(right["vector"].combine_chunks(), float), _matrix(right["projected"].combine_chunks(), float)
            for i, (a, b, bound) in enumerate(zip(*(right[c].to_pylist() for c in ("a", "b", "bound")), strict=True)):
                out += [(a, b, i_, c) for c, i_ in here.search(q[i], p[i], bound, k + 1, reach)]
        columns = list(zip(*out, strict=True)) or [()] * 4
        types = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["a", "b", "vec_id", "score"])

    key = ("cell", "sub", "chunk")
    found = held.select(*key, "ids", "vector", "projected").groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(
        look, "a long, b long, vec_id long, score double"
    )
    best = Window.partitionBy("a", "b").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n")
    ranked = queries.join(top, ["a", "b"]).filter("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _queries(vectors: DataFrame, id_col: str, vector_col: str, every: int) -> DataFrame:
    """(query_id, a, b): the point of each query's vector."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    return (
        vectors.filter(F.col(id_col).cast("long") % every == 0)
        .select(F.col(id_col).cast("long").alias("query_id"), v.alias("vector"))
        .select("query_id", F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(SEED), "vector").alias("b"))
        .distinct()
    )


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"))
