import re
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from strata.llm import packing
from strata.llm.common import new_path

from .conftest import ODD, SF
from .test_decontam import brute as brute_contamination
from .test_packing import P, check
from .test_pii import brute as brute_pii
from .test_simhash import brute_components

NAMES = ("EMAIL", "IP", "CARD", "PHONE")


def masked(text):
    out, at = [], 0
    for a, kind, b in brute_pii(text):
        if a >= at:
            out += [text[at:a], f"[{NAMES[kind]}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def brute(rows, bench):
    """[(doc_id, text)] that reach packing, for rows with distinct ids; base spans stand for all personal data."""
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    _, comps = brute_components(rows)
    rows = [r for r, c in zip(rows, comps, strict=True) if c == r[0]]
    bad = {r[0] for r in brute_contamination(rows, bench) if r[5]}
    return [(i, masked(t)) for i, t in rows if i not in bad]


def test_run_matches_brute_force(spark, docs):
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], bench)
    t = Tokenizer.from_file(P.path(packing.TOKENIZER))
    wanted = {i: [[*t.encode(x, add_special_tokens=False).ids, 0]] for i, x in kept}
    rows = pipeline.run(spark, SF).collect()
    check(rows, wanted)
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == wanted[r.doc_id][0][r.start : r.start + r.length]
        assert zlib.crc32(r.ids) == r.ids_crc32
    assert len(kept) < docs.count()


def stages(spark, docs, sf_dir):
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        path = new_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        yield name, docs


def test_odd_rows(spark, odd):
    texts = {}
    for name, out in stages(spark, odd, SF):
        if name != "pack":
            assert tuple(out.columns) == pipeline.COLUMNS
        texts[name] = sorted((r.doc_id is None, r.doc_id or 0) for r in out.select("doc_id").collect())
    letters = sorted((r[0] is None, r[0] or 0) for r in ODD if re.search(r"[^\W\d_]", r[1] or ""))
    assert texts["language_id"] == letters
    # Of the three rows with one text the first id's stays, once; the row without an id stays too.
    assert texts["near_dedup"] == texts["mask_pii"] == [(False, 3), (False, 5), (False, 6), (False, 8), (True, 0)]


def test_empty_tables(spark, none):
    for name, out in stages(spark, none, SF):
        assert out.count() == 0


def test_stages_keep_clean_documents(spark):
    rows = [(i, f"Clean text number {i} about {w} and nothing else at all.", "en", "s", 1) for i, w in enumerate(["sea", "sky", "wood", "iron"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = dict(stages(spark, docs, SF))
    assert {r.doc_id for r in out["decontaminate"].collect()} <= {0, 1, 2, 3} and out["language_id"].count() == 4
    after = {r.doc_id: r.text for r in out["mask_pii"].collect()}
    assert all(after[i] == t for i, t, *_ in rows if i in after)
    assert out["mask_pii"].filter(F.col("n_chars") != F.length("text")).count() == 0
