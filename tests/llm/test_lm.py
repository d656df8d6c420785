import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from .conftest import ODD, SF

from strata.llm import lm

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)), None]


def brute(rows, learn):
    counts = collections.Counter(w for (i, t) in rows if learn(i) for w in split(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        w = split(t)
        out.append((i, len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4] for r in got], [r[4] for r in want], rtol=1e-9, atol=1e-9)


def test_query_matches_brute_force(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = lm.op7_lm_scores(spark, SF).collect()
    same([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], brute(rows, lambda i: zlib.crc32(str(i).encode()) % 7 != 2))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 1, "buckets": 3, "piece_bytes": 1}])
def test_odd_rows(odd, options):
    got = lm.score_texts(odd, F.col("doc_id") != 4, **options).collect()
    want = brute([r[:2] for r in ODD], lambda i: i is not None and i != 4)
    same([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], want)


def test_blocks_and_pieces_do_not_change_scores(spark, odd):
    a = lm.score_texts(odd, F.lit(True), buckets=5)
    b = lm.score_texts(odd, F.lit(True), buckets=5, block_bytes=1, piece_bytes=1)
    pick = lambda d: sorted((r.doc_id is None, r.doc_id or 0, round(r.score, 6)) for r in d.collect())
    assert pick(a) == pick(b)


def test_nothing_to_learn_from(odd, none):
    got = lm.score_texts(odd, F.lit(False)).collect()
    assert len(got) == len(ODD) and {(r.n_known, r.train_tokens, r.base_score, r.score) for r in got} == {(0, 0, 0.0, 0.0)}
    assert lm.score_texts(none, F.lit(True)).count() == 0


def test_filter_holds_every_level_and_little_else():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 48, 20_000).astype(np.uint64))
    counts = rng.zipf(1.6, len(keys)).clip(1, 10**6)
    config = lm.Config()
    levels = lm._levels(counts, 2, config.base)
    held = keys[levels > 0]
    piece = lm.Piece({0: lm._slice([(held, levels[levels > 0])], config).astype("<u8").tobytes()}, 1)
    found = np.zeros(len(keys), np.int64)
    piece.levels(keys, np.zeros(len(keys), np.int64), found, config.probes)
    assert (found >= levels).all() and (found > levels).mean() < 0.05
    other = np.zeros(50_000, np.int64)
    piece.levels(rng.integers(1 << 48, 1 << 60, 50_000).astype(np.uint64), np.zeros(50_000, np.int64), other, config.probes)
    assert (other > 0).mean() < 0.05


def test_levels_stand_for_their_counts():
    counts = np.arange(1, 3000)
    for least in (1, 2):
        levels = lm._levels(counts, least, 1.5)
        assert (levels[counts < least] == 0).all() and (np.diff(levels) >= 0).all()
        middle = lm._counts(levels, least, 1.5)
        known = counts >= least
        assert (np.abs(middle[known] / counts[known] - 1) <= 0.5).all()
    assert (lm._from_six(lm._six(np.array([0, 5, 2**48 - 1], np.uint64))) == [0, 5, 2**48 - 1]).all()


def test_pairs_seen_once_count(spark):
    rows = [(1, "one two three"), (2, "two one four"), (3, "one two three"), (4, "three two four")]
    learn = [split(t) for i, t in rows if i < 3]
    word = collections.Counter(w for x in learn for w in x)
    pair = collections.Counter(p for x in learn for p in zip([None, *x], x))
    assert set(pair.values()) == {1}
    n, v, c = sum(word.values()), len(word), lm.Config()

    def p(a, b):
        weight = c.weight * word[a] / (word[a] + c.damping)
        return weight * pair[a, b] / max(word[a], 1) + (1 - weight) * (word[b] + 1) / (n + v + 1)

    got = {r.doc_id: r.score for r in lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") < 3).collect()}
    for i, t in rows[:3]:
        assert math.isclose(got[i], sum(math.log10(p(a, b)) for a, b in zip([None, *split(t)], split(t))), rel_tol=1e-9)


def middle(count, base):
    """The number that stands for a count: the middle of the whole numbers of its level."""
    if not count:
        return 0.0
    level = math.floor(math.log(count, base) + 1e-9)
    inside = [n for n in range(1, 10_000) if base**level - 1e-9 <= n < base ** (level + 1) - 1e-9]
    return (inside[0] + inside[-1]) / 2


def test_scores_are_the_brute_force_bigram_model(spark):
    rng = np.random.default_rng(7)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(vocabulary[min(59, int(x))] for x in rng.zipf(1.5, rng.integers(0, 120)) - 1)) for i in range(80)]
    rows += [(100, None), (101, "unseen words only"), (102, "")]
    learn = [split(t) for i, t in rows if i % 3]
    config = lm.Config(bits=64)  # hardly a false hit
    word = collections.Counter(w for x in learn for w in x)
    pair = collections.Counter(p for x in learn for p in zip([None, *x], x))
    n, v = sum(word.values()), len(word)
    assert max(word.values()) > 50 and max(pair.values()) > 10

    def text(t):
        total, before = 0.0, len(learn)
        for a, b in zip([None, *split(t)], split(t)):
            # A text begins as often as texts end; counts stand as their levels' middles.
            c = middle(before if a is None else word[a], config.base)
            weight = config.weight * c / (c + config.damping)
            share = min(1.0, middle(pair[a, b], config.base) / c) if c else 0.0
            total += math.log10(weight * share + (1 - weight) * (middle(word[b], config.base) + 1) / (n + v + 1))
        return total

    df = spark.createDataFrame(rows, "doc_id long, text string")
    for options in ({}, {"buckets": 7, "block_bytes": 300, "piece_bytes": 64}):
        got = {r.doc_id: r.score for r in lm.score_texts(df, F.col("doc_id") % 3 != 0, config, **options).collect()}
        assert all(math.isclose(got[i], text(t), rel_tol=1e-6) for i, t in rows)


def test_what_is_sent_does_not_grow_with_the_buckets(spark, docs):
    """Keys, counts and answers are as many bytes over 8 buckets as over 800."""
    rows = docs.selectExpr("xxhash64(doc_id, text) as key", "text", "doc_id % 7 <> 2 as train")
    sent = []
    for buckets in (8, 800):
        counted = lm._count(rows, buckets, 1 << 20).persist()
        size = counted.selectExpr("sum(length(keys)) + sum(length(counts))", "sum(length(docs)) + sum(length(times)) + sum(length(ends))").first()
        answers = lm._reduce(counted, lm.Config()).filter("kind = 'answers'").selectExpr("sum(length(data))").first()
        sent.append((*size, *answers))
        counted.unpersist()
    assert sent[0] == sent[1]
