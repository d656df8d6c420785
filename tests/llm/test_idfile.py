import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from .conftest import ODD, SF

from strata.llm import idfile
from strata.llm.common import new_path

P = pytest.importorskip("public_tokenizers")


def expected(rows):
    t, at, out = Tokenizer.from_file(P.path(idfile.TOKENIZER)), 0, []
    for doc_id, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, idfile.END], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 1000, 5000])
@pytest.mark.parametrize("percentile", [0, 50, 90, 100])
def test_round_trip_and_ranges(n, percentile):
    rng = np.random.default_rng(n)
    for high in (1, 2, 50_000, 1 << 32):
        x = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
        x[rng.random(n) < 0.03] = high - 1
        data = idfile.encode(x, percentile)
        assert (idfile.decode(data) == x).all()
        for a, b in np.sort(rng.integers(0, n + 1, (5, 2)), axis=1).tolist():
            assert (idfile.decode(data, a, b) == x[a:b]).all()


def test_outliers_are_patched_not_packed():
    x = np.arange(1280, dtype=np.uint32) % 16
    y = x.copy()
    y[::128] = 1 << 31
    assert len(idfile.encode(y)) == len(idfile.encode(x)) + 10 * 5
    with pytest.raises(ValueError):
        idfile.decode(b"....")


def test_query_matches_the_tokenizer(spark, docs):
    want = expected(sorted(map(tuple, docs.select("doc_id", "text").collect())))
    assert sorted(map(tuple, idfile.op9_id_files(spark, SF).collect())) == want


def test_odd_rows_and_small_file_rows(spark, odd, none):
    for size in (1, 1 << 18):
        path = new_path(spark, "ids")
        idfile.write_ids(odd, path, row_ids=size)
        got = idfile.read_ids(spark, path).selectExpr("doc_id", "start", "n_tokens", "crc32(ids) as crc").orderBy("start").collect()
        # Repeated rows are equal, so the order within an id is free here.
        assert [tuple(r) for r in got] == expected(sorted((r[:2] for r in ODD), key=lambda r: (r[0] is not None, r[0] or 0)))
    path = new_path(spark, "ids")
    idfile.write_ids(none, path)
    assert idfile.read_ids(spark, path).count() == 0
