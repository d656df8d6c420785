import random

import xxhash
from .conftest import ODD, SF

from strata.llm import simhash
from strata.llm.components import components


def brute_fingerprint(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    """{place: smallest id} by comparing all pairs of distinct fingerprints."""
    fps = [brute_fingerprint(t) for _, t in rows]
    kinds = sorted(set(fps))
    root = {f: f for f in kinds}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(kinds):
        for b in kinds[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for (doc_id, _), f in zip(rows, fps, strict=True):
        if doc_id is not None:
            least[find(f)] = min(least.get(find(f), doc_id), doc_id)
    return fps, [least.get(find(f)) for f in fps]


def expected(rows):
    fps, comps = brute_components(rows)
    key = lambda r: (r[0] is None, r)
    return sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, comps, strict=True)), key=key)


def test_query_matches_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in simhash.op5_simhash_dedup(spark, SF).collect()]
    assert sorted(got) == expected(rows)


def test_odd_rows(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    fps, comps = brute_components([(r[0], r[1]) for r in ODD])
    want = sorted(((i is None, i or 0, f if f < 1 << 63 else f - (1 << 64), c) for (i, *_), f, c in zip(ODD, fps, comps, strict=True)))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fp, r.component_id) for r in got) == want
    assert simhash.near_duplicates(none).count() == 0


def test_full_buckets_lose_no_link(spark):
    rng = random.Random(4)
    values = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(120):
            v = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                v ^= 1 << b
            values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    for full in (4, 10_000):
        got = {(min(r), max(r)) for r in map(tuple, simhash.links(fps, full_bucket=full).collect())}
        assert got == want


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, x) for x in range(101, 160)] + [(300, 300), (7, 3), (205, 203), (203, 209), (209, 205)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()))
    want = {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 160)} | {i: 203 for i in (203, 205, 209)}
    assert got == want
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0
