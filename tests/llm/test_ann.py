import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from .conftest import SF

from strata.llm import ann


def brute(rows, k=5, every=50):
    """{query: [(id, score)]} over all valid vectors; rows: distinct (id, vector)."""
    ok = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in ok:
        if q % every == 0:
            scored = sorted((-float(v @ w / (np.linalg.norm(v) * np.linalg.norm(w))), i) for i, w in ok if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return {q: x for q, x in out.items() if x}


def lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    assert got.keys() == want.keys()
    return sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))


@pytest.mark.parametrize("sf", [SF, SF.replace("0.001", "0.1")])
def test_query_recall(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got, want = lists(ann.op8_neighbours(spark, sf)), brute(rows)
    assert recall(got, want) >= 0.9
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, found in got.items():
        for i, s in found:
            exact = vectors[q] @ vectors[i] / (np.linalg.norm(vectors[q]) * np.linalg.norm(vectors[i]))
            assert abs(s - exact) < 1e-12
        assert found == sorted(found, key=lambda x: (-x[1], x[0])) and len(found) == 5 and q not in dict(found)


def test_small_cells_and_samples_keep_recall(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 24))
    x = centres[rng.integers(0, 20, 1500)] + 0.3 * rng.normal(size=(1500, 24))
    rows = list(enumerate(x.tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert recall(lists(ann.neighbours(df, sample=100, cell=64)), brute(rows)) >= 0.9


def test_odd_vectors_copies_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(0, 400, 3)]  # copies: ties go to the smaller id
    rows += [(1000, [0.0, 1.0]), (1001, [0.0, 2.0]), (1050, [1.0, 0.0]), (1100, [-1.0, -2.0])]
    bad = [(1150, None), (1200, []), (1250, [0.0, 0.0]), (1300, [nan, 1.0]), (1350, [inf, 1.0]), (1400, [None, 1.0]), (None, [1.0, 1.0]), (1450, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows + rows[:5] + bad, "vec_id long, embedding array<float>").repartition(4)
    df = df.withColumns({c: F.lit(1) for c in ("a", "b", "cell", "rank", "score", "ids", "point")})
    got, want = lists(ann.neighbours(df)), brute(rows)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert 1450 not in got


def test_few_vectors(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert ann.neighbours(make([])).count() == 0
    assert ann.neighbours(make([(0, [1.0])])).count() == 0
    assert lists(ann.neighbours(make([(0, [1.0, 0.0]), (7, [0.0, 3.0])]))) == {0: [(7, 0.0)]}


def test_chi_square_quantiles():
    for p, m, x in ((0.95, 8, 15.50731), (0.5, 2, 1.386294), (0.99, 10, 23.20925)):
        assert abs(ann.chi_square_quantile(p, m) - x) < 1e-4


def test_all_ties_are_looked_at(spark):
    """300 scaled copies of one vector: all as near as can be, so the smallest ids win."""
    rows = [(i, [0.5 * 2.0 ** (i % 40), 1.0 * 2.0 ** (i % 40)]) for i in range(1, 301)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = lists(ann.neighbours(df))
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i in range(1, 7) if i != q][:5] for q in range(50, 301, 50)}
    odd = [(i, [0.3 * (1 + i % 37), 0.7 * (1 + i % 37)]) for i in range(300)]  # parted by rounding
    scores = lists(ann.neighbours(spark.createDataFrame(odd, "vec_id long, embedding array<double>"), cell=64))
    assert all(s >= 1 - 1e-12 for x in scores.values() for _, s in x) and all(len(x) == 5 for x in scores.values())


def test_each_length_of_vectors_is_searched(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=2 + i % 3).tolist()) for i in range(300)] + [(350, [1.0]), (351, [-2.0]), (400, [0.5] * 9)]
    got = lists(ann.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    want = {}
    for d in {len(v) for _, v in rows}:
        want |= brute([(i, v) for i, v in rows if len(v) == d])
    assert recall(got, want) >= 0.95 and [i for i, _ in got[350]] == [351] and 400 not in got
