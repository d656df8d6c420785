import hashlib
import re

from .conftest import ODD, SF

from strata.llm import decontam

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(docs, items, window=13):
    windows = {}
    for item, text in items:
        w = split(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = split(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if its := windows.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= its
        out.append((doc_id, len(w), len(hit), len(found), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def rows(df):
    return [(r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in df.collect()]


def by_id(x):
    return sorted(x, key=lambda r: (r[0] is None, r))


def test_query_matches_brute_force(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], items)
    want = [(a, b, c, d, hashlib.sha256(",".join(e).encode()).hexdigest(), f) for a, b, c, d, e, f in want]
    got = decontam.op6_decontamination(spark, SF).drop("n_near_items").collect()
    assert by_id(map(tuple, got)) == by_id(want)


BENCH = [
    (10, "some text for several rows"), (9, "TEXT"), (None, "text for"), (11, None), (12, " ,. "),
    (13, " ".join(f"word{i % 977} and{i % 31}" for i in range(500, 520))), (14, "Same text, for several -- rows!"), (9, "same"),
]


def test_odd_rows_in_one_block_and_in_many(spark, odd, none):
    bench = spark.createDataFrame([(i, t, 1) for i, t in BENCH], "item_id long, text string, item int")
    want = by_id(brute([r[:2] for r in ODD], BENCH))
    assert by_id(rows(decontam.contamination(odd, bench))) == want
    assert by_id(rows(decontam.contamination(odd, bench, block_windows=2))) == want
    assert by_id(rows(decontam.contamination(odd, bench, window=3))) == by_id(brute([r[:2] for r in ODD], BENCH, 3))
    assert decontam.contamination(none, bench).count() == 0
    assert all(r[2:4] == (0, 0) for r in rows(decontam.contamination(odd, bench.limit(0))))


def test_segments_end_between_documents(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e f"), (3, "c d")], "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(1, "c d")], "item_id long, text string")
    for size in (1, 1 << 20):
        found = decontam.search(decontam.build_index(docs, segment_bytes=size), bench, near=5).collect()
        assert {r.doc_id: list(r.spans) for r in found} == {1: [], 2: [], 3: [0, 2]}


def test_proximity_needs_all_words_near_the_rarest(spark):
    texts = ["x rare y common z", "rare " + "pad " * 40 + "common", "rare", "common common"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(1, "common rare")], "item_id long, text string")
    found = decontam.contamination(docs, bench, near=10).collect()
    assert {r.doc_id: (r.n_hit, r.n_near_items) for r in found} == {0: (0, 1), 1: (0, 0), 2: (0, 0), 3: (0, 0)}


def test_blocks_are_bounded_by_windows(spark):
    """A long item is cut over several blocks without losing a window."""
    items = [(1, " ".join(f"w{i % 50}" for i in range(300))), (2, "w1 w2"), (3, "w7 " * 40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    blocks = [decontam.Windows(b, 13) for b in decontam._blocks(bench.selectExpr("cast(item_id as string) item", "text"), 13, 25)]
    assert len(blocks) > 10 and all(len(b.terms) <= 25 and b.terms.dtype == "int32" for b in blocks)
    docs = [(i, " ".join(f"w{(k * (1 + i % 2) + i) % 50}" for k in range(60))) for i in range(20)] + [(50, "x w1 w2 y"), (51, "w7 " * 13)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert by_id(rows(decontam.contamination(df, bench, block_windows=25))) == by_id(brute(docs, items))
