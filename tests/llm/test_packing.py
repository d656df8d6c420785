import collections
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from .conftest import ODD, SF

from strata.llm import packing, tokens

P = pytest.importorskip("public_tokenizers")


def whole(name, texts):
    t = Tokenizer.from_file(P.path(name))
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def check(rows, wanted, limits=packing.Limits(), short=0):
    """Each document is covered once, each sequence is gapless and within the limits."""
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for s in sequences.values():
        assert len(s) <= limits.segments and sum(n for _, n in s) <= limits.tokens
        at = 0
        for offset, n in sorted(s):
            assert offset == at and n > 0
            at += n
        assert at == limits.tokens or at & (at - 1) == 0
    assert {k: sum(n for _, n, *_ in v) for k, v in pieces.items()} == {k: sum(map(len, v)) for k, v in wanted.items()}
    for k, v in pieces.items():
        if len(wanted[k]) == 1:
            at = 0
            for start, n, crc, total in sorted(v):
                assert start == at and total == len(wanted[k][0])
                assert crc == zlib.crc32(np.array(wanted[k][0][start : start + n], "<u4").tobytes())
                at += n
    return sequences


def test_query_matches_the_tokenizer(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    ids = whole(packing.TOKENIZER, [r.text for r in rows])
    sequences = check(packing.op4_packing(spark, SF).collect(), {r.doc_id: [[*i, 0]] for r, i in zip(rows, ids, strict=True)})
    full = sum(sum(n for _, n in s) == packing.LENGTH for s in sequences.values())
    assert full >= len(sequences) - 10 * docs.rdd.getNumPartitions()


def test_odd_rows(odd, none):
    ids, wanted = whole(packing.TOKENIZER, [r[1] for r in ODD]), collections.defaultdict(list)
    for r, i in zip(ODD, ids, strict=True):
        wanted[r[0]].append([*i, 0])
    check(packing.pack(odd).collect(), wanted)
    assert packing.pack(none).count() == 0
    r = packing.pack(odd, with_ids=True).first()
    assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32


@pytest.mark.parametrize("limits", [packing.Limits(64, 3, 64), packing.Limits(64, 64, 20), packing.Limits(50, 2, 17), packing.Limits(8, 1, 1)])
def test_limits_hold_together(limits):
    rng, packer = random.Random(7), packing.Packer(limits, pool=32)
    sizes, sequences = {}, []
    for key in range(600):
        n = rng.choice([1, 1, 2, 5, 30, 200])
        sizes[key] = n
        sequences += packer.add(packing.Example(key, np.arange(n, dtype=np.uint32), rng.randint(0, n)))
    sequences += packer.finish()
    placed = collections.defaultdict(list)
    for s in sequences:
        total = sum(n for _, _, n in s)
        assert 0 < total <= limits.tokens and len(s) <= limits.segments and (total == limits.tokens or total & (total - 1) == 0)
        assert sum(max(0, start + n - max(start, e.prompt)) for e, start, n in s) <= limits.loss
        for e, start, n in s:
            placed[e.key].append((start, n))
    for key, n in sizes.items():
        at = 0
        for start, m in sorted(placed[key]):
            assert start == at
            at += m
        assert at == n


def test_prompts_bear_no_loss(spark):
    df = spark.createDataFrame([(i, "ask " * 30, "answer " * 20) for i in range(20)], "doc_id long, q string, a string").coalesce(1)
    rows = packing.pack(df, packing.Limits(128, 8, 40), text_col="a", prompt_col="q").collect()
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())


def test_cached_ids_equal_the_tokenizers():
    rng = random.Random(3)
    marks = [*" \n\t'abcDEF éßİ²½ñ.,!?0123日本́ǅ\x1c\xa0 Σσ", "  ", " a", "<|endoftext|>", "<|startoftext|>"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        e = tokens.Encoder(P.path(name), cache=64)
        assert e.kind != "whole"
        assert [list(e.encode(t)) for t in texts] == whole(name, texts)
