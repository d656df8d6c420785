import collections
import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from .conftest import ODD, SF

from strata.llm import langid


def model(data, order=3):
    grams = [np.unique(langid._grams(d, order), return_counts=True) for d in data.values()]
    return langid.Model(list(data), [k for k, _ in grams], [n for _, n in grams], order)


class Brute:
    """PPM with escape method C and exclusion, symbol by symbol."""

    def __init__(self, data, order):
        self.order = order
        self.total, self.seen = collections.Counter(), [collections.defaultdict(collections.Counter) for _ in data]
        for lang, texts in enumerate(data.values()):
            for t in texts:
                s = [256] * order + list(t)
                for i in range(order, len(s)):
                    for k in range(order + 1):
                        self.total[tuple(s[i - k : i])] += 1
                        self.seen[lang][tuple(s[i - k : i])][s[i]] += 1

    def bits(self, lang, before, byte):
        k = self.order
        while k and not self.total[tuple(before[-k:])]:
            k -= 1
        gone, bits = set(), 0.0
        for k in range(k, -1, -1):
            counts = self.seen[lang].get(tuple(before[len(before) - k :]), {})
            live = {s: n for s, n in counts.items() if s not in gone}
            whole = sum(live.values()) + len(live)
            if byte in live:
                return bits - math.log2(live[byte] / whole)
            if live:
                bits -= math.log2(len(live) / whole)
            gone |= set(live)
        return bits + math.log2(256 - len(gone))


def test_code_lengths_are_exact():
    rng = random.Random(5)
    data = {k: [bytes(rng.choice(a) for _ in range(rng.randint(0, 60))) for _ in range(40)] for k, a in (("x", b"abcab "), ("y", b"bcd e\xc3"))}
    m, brute = model(data), Brute(data, 3)
    asked = [bytes(rng.choice(b"abcde \xc3z") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    got = m.tables.lengths([*asked, b""])
    for t, bits in zip(asked, got, strict=False):
        s = [256] * 3 + list(t)
        want = [sum(brute.bits(lang, s[i - 3 : i], s[i]) for i in range(3, len(s))) for lang in range(2)]
        assert np.allclose(bits, want, rtol=1e-4, atol=1e-2)


def test_long_texts_are_cut_into_windows_without_a_trace(monkeypatch):
    data = {"x": [b"abc abc ab " * 9], "y": [b"bca cab bb " * 9]}
    asked = [b"abc cab " * 50, b"", b"b", b"ab " * 200]
    want = model(data).tables.lengths(asked)
    monkeypatch.setattr(langid, "_WINDOW", 37)
    assert np.allclose(model(data).tables.lengths(asked), want)


def test_held_out_accuracy(spark, docs):
    got = langid.op10_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id")
    row = got.filter("held_out").agg(F.count("*").alias("n"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).first()
    assert row["n"] > 20 and row["right"] >= 0.95
    assert got.filter("score < 0 or score > 1 or score is null").count() == 0


def test_odd_rows(spark, odd, none, docs):
    m = langid.train(docs.unionByName(odd.select(docs.columns)))
    got = langid.predict(odd, m)
    assert got.columns[-2:] == ["lang_pred", "score"] and got.count() == len(ODD)
    for r in got.collect():
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1
    assert langid.predict(none, m).count() == 0
    nothing = langid.train(none)
    assert nothing.langs == [] and {r.lang_pred for r in langid.predict(odd, nothing).collect()} == {"und"}
    no_text = langid.train(spark.createDataFrame([(1, None, "xx"), (2, "abc", None)], "doc_id long, text string, lang string"))
    assert no_text.langs == ["xx"]


def test_predictions_take_no_label_as_input(spark, docs):
    m = langid.train(docs.filter(langid.learned_from(docs)))
    a = langid.predict(docs.select("doc_id", "text"), m)
    b = langid.predict(docs.select("doc_id", "text", F.lit("zz").alias("lang"), F.lit("s").alias("source")), m)
    assert sorted(map(tuple, a.select("doc_id", "lang_pred", "score").collect())) == sorted(map(tuple, b.select("doc_id", "lang_pred", "score").collect()))


def test_the_query_is_the_brute_force_version(spark, tmp_path):
    """op10 on a small table: learned rows, code lengths, the best language and its posterior."""
    rng = random.Random(3)
    words = {"x": ["abc", "bca", "dé", "c"], "y": ["bcd", "cab", "zo", "é!"], "z": ["aa", "ab ba", "b1"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=rng.randint(1, 9))), lang if i % 7 else None) for i in range(90) for lang in [rng.choice("xyz")]]
    rows += [(90, None, "x"), (91, "", "y"), (92, "12 !", "z"), (None, "abc dé", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    frame.withColumn("_letter", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in langid.op10_language_id(spark, str(tmp_path)).collect()}
    learned = [r for r in rows if r[0] is not None and r[2] and zlib.crc32(str(r[0]).encode()) % 4 != 2]
    names = sorted({r[2] for r in learned})
    brute = Brute({n: [(t or "").encode() for _, t, lang in learned if lang == n] for n in names}, langid.ORDER)
    for doc_id, text, _ in rows:
        r = got[doc_id]
        assert r.held_out == (doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2)
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        s = [256] * langid.ORDER + list(text.encode())
        bits = [sum(brute.bits(n, s[i - langid.ORDER : i], s[i]) for i in range(langid.ORDER, len(s))) for n in range(len(names))]
        assert math.isclose(r.score, 1 / sum(2 ** (min(bits) - b) for b in bits), rel_tol=1e-2)
        assert bits[names.index(r.lang_pred)] <= min(bits) + 1e-2


def test_columns_with_the_operators_own_names(spark):
    m = langid.train(spark.createDataFrame([(1, "abc", "xx"), (2, "zyx", "yy")], "doc_id long, text string, lang string"))
    rows = spark.createDataFrame([(1, "abc", 5, 6, 7)], "doc_id long, text string, _letter int, _letter1 int, lang_pred int")
    got = langid.predict(rows, m).collect()
    assert [(r._letter, r._letter1, r.lang_pred) for r in got] == [(5, 6, "xx")]


def test_every_learned_context_counts(spark):
    rng = random.Random(9)
    data = {k: ["".join(rng.choice(a) for _ in range(rng.randint(1, 40))) for _ in range(12)] for k, a in (("x", "abcd é"), ("y", "bcdef "))}
    rows = [(i, t, lang) for lang, texts in data.items() for i, t in enumerate(texts)]
    m = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    brute = Brute({k: [t.encode() for t in texts] for k, texts in data.items()}, langid.ORDER)
    asked = [data["x"][0].encode(), data["y"][1].encode(), b"abcdef \xffz"]
    for t, bits in zip(asked, m.tables.lengths(asked), strict=True):
        s = [256] * langid.ORDER + list(t)
        want = [sum(brute.bits(lang, s[i - langid.ORDER : i], s[i]) for i in range(langid.ORDER, len(s))) for lang in range(2)]
        assert np.allclose(bits, want, rtol=1e-4, atol=1e-2)
