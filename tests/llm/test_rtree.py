import math
import random

import duckdb
import numpy as np
import pytest

from .conftest import SF

from strata.llm import rtree

VECTORS = "vec_id long, embedding array<double>, label int"


def brute(rows, every=50, positives=5, negatives=3, low=50, high=95):
    """rows: (id, vector, label as compared) -> result rows."""
    fine = {
        (i, lab, tuple(math.floor(256 * x) for x in v))
        for i, v, lab in rows
        if None not in (i, lab, v) and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v)
    }
    out = []
    for a, lab, v in fine:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, n) for i, n, w in fine if len(v) == len(w))
        for s, p, _ in [x for x in scored if x[2] == lab and x[1] != a][:positives]:
            inside = [x for x in scored if x[2] != lab and low * -s <= 100 * -x[0] <= high * -s]
            out += [(a, p, r + 1, x[1], -s, -x[0]) for r, x in enumerate(inside[:negatives])]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


def changed(rows):
    return [(i, v, lab if lab is None or i is None or i % 7 else (lab + 1) % 10) for i, v, lab in rows]


def cloud(rnd, n, dim, labels=4):
    centre = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(3)]
    return [(i, [c + rnd.gauss(0, 0.4) for c in rnd.choice(centre)], rnd.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize(("n", "dim", "tile", "sample"), [(40, 3, 8, 16), (300, 5, 32, 64), (300, 2, 1000, 8192), (260, 6, 5, 20)])
def test_search_is_exact(spark, n, dim, tile, sample):
    rows = cloud(random.Random(n), n, dim)
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    assert got(rtree.hard_negatives(df, every=10, tile=tile, sample=sample)) == brute(rows, every=10)


def test_copies_ties_and_odd_rows(spark, tmp_path):
    rnd = random.Random(1)
    rows = cloud(rnd, 120, 3, 3)
    rows += [(1000 + i, [0.5, 0.25, -0.125], i % 2) for i in range(300)]  # one hot vector
    rows += [(2000 + i, [0.5 * (i % 3), 0.25, 0.0], 1) for i in range(60)]
    rows += [(3000, None, 1), (3050, [1.0, None, 2.0], 1), (None, [1.0, 2.0, 3.0], 1), (3100, [1.0, 2.0, 3.0], None)]
    rows += [(3150, [float("nan"), 0.0, 0.0], 1), (3200, [float("inf"), 0.0, 1.0], 2), (3250, [0.0, 0.0, 0.0], 2)]
    rows += [(50 * i, [1.0, float(i)], i % 2) for i in range(90, 100)] + [(5000, [], 1), (5050, [], 2), (5001, [], 1)]
    rows += rows[:9]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 as key", "2 as tile", "3 as score", "4 as a").repartition(4)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    assert got(rtree.op11_hard_negatives(spark, str(tmp_path))) == brute(changed(rows))
    assert got(rtree.hard_negatives(df, tile=16, sample=50)) == brute(rows)


def test_scores_are_exact_beyond_doubles(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([-1, 1]) * rnd.randrange(1 << 21) * 4.0 + rnd.random() for _ in range(3)], i % 2) for i in range(0, 400, 5)]
    df = spark.createDataFrame(rows, VECTORS)
    assert got(rtree.hard_negatives(df, tile=16)) == brute(rows)


def test_empty_and_lone(spark):
    none = spark.createDataFrame([], VECTORS)
    assert rtree.hard_negatives(none).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0], 1)], VECTORS)
    assert rtree.hard_negatives(one).count() == 0 and rtree.hard_negatives(one).columns == rtree.hard_negatives(none).columns


def test_boxes_hold_their_points_and_bound_their_products():
    rnd = np.random.default_rng(3)
    labels, vectors = rnd.integers(0, 5, 700), np.floor(rnd.normal(size=(700, 4)) * 50)
    tree = rtree.RTree(labels, vectors, page=8, fan=4)
    assert sorted(tree.rows.tolist()) == list(range(700)) and all(b - a <= 8 for a, b in tree.spans[: tree.pages])
    q = np.floor(rnd.normal(size=(20, 4)) * 50)
    least, most = tree.intervals(q)

    def rows_of(node):
        a, b = tree.spans[node]
        return list(range(a, b)) if node < tree.pages else [r for c in range(a, b) for r in rows_of(c)]

    for node in range(len(tree.spans)):
        rows = rows_of(node)
        s = q @ tree.vectors[rows].T
        assert (s.min(axis=1) >= least[:, node]).all() and (s.max(axis=1) <= most[:, node]).all()
        assert set(tree.labels[rows]) <= set(range(tree.first[node], tree.last[node] + 1))
    assert len(rows_of(len(tree.spans) - 1)) == 700


def test_pruning_skips_pages():
    """On clustered points the queue looks at a few pages only."""
    rnd = np.random.default_rng(4)
    centre = rnd.normal(size=(40, 8)) * 300
    vectors = np.floor(np.repeat(centre, 50, axis=0) + rnd.normal(size=(2000, 8)) * 3)
    tree = rtree.RTree(np.zeros(2000, int), vectors, page=16)
    least, most = tree.intervals(vectors[:1])
    pages = tree.pages
    seen = []
    spans = tree.spans
    tree.spans = type("Seen", (list,), {"__getitem__": lambda self, i: (seen.append(i), list.__getitem__(self, i))[1]})(spans)
    (scores, _), = tree.search(vectors[0], least[0], most[0], 0, True, [(-(2**62), 2**62)], 5)
    assert sorted(scores)[-5:] == sorted((vectors @ vectors[0]).tolist())[-5:]
    assert sum(i < pages for i in seen) < pages / 3


def test_query_is_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from read_parquet('{SF}/embeddings.parquet')")
    mine = got(rtree.op11_hard_negatives(spark, SF))
    assert mine and mine == sorted(con.sql(rtree.oracle()).fetchall())
