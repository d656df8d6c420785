import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from .conftest import ODD, SF

from strata.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_over(nodes, fanout):
    """All levels, from the leaves to the root."""
    every = [nodes]
    while len(every[-1]) > 1:
        every.append([digest(*every[-1][i : i + fanout]) for i in range(0, len(every[-1]), fanout)])
    return every


def proof_of(every, place, fanout):
    out = []
    for level in every[:-1]:
        run = place // fanout * fanout
        out.append((place - run, [x for i, x in enumerate(level[run : run + fanout]) if i != place - run]))
        place //= fanout
    return out


def fold_up(leaf, proof):
    for digit, others in proof:
        leaf = digest(*others[:digit], leaf, *others[digit:])
    return leaf


def brute(rows, fanout=2):
    """rows: (doc_id, source, lang, n_chars, text) -> sorted result rows of op12."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    at = {}
    for t in names:
        trees[t].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        at[t] = levels_over([leaf_of(r) for r in trees[t]], fanout)
    top = levels_over([at[t][-1][0] for t in names], fanout)
    out = []
    for i, t in enumerate(names):
        for j, r in enumerate(trees[t]):
            proof = proof_of(at[t], j, fanout) + proof_of(top, i, fanout)
            claimed = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                claimed = (*r[:3], r[3] + 1, r[4])
            root, up = top[-1][0], fold_up(leaf_of(claimed), proof)
            out.append((r[0], leaf_of(r), at[t][-1][0], root, digest(*[x for _, o in proof for x in o]), up, up == root))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def table(rnd, n):
    langs = [None, "", "en", "é", "zz", "=x"]
    return [(rnd.choice([None, rnd.randrange(n)]) if i % 9 == 0 else i, rnd.choice([None, "a", "b:1"]), rnd.choice(langs[:2] + ["en"] * 9 + langs[3:]), rnd.choice([None, i]), rnd.choice([None, "", "t" * i, f"ü{i}"])) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 7, 150])
def test_query_is_the_brute_force_version(spark, tmp_path, n):
    rows = table(random.Random(n), n)
    rows += rows[:40] + rows[:1] * 20 + [(n, "a", "alone", 4, "x")]
    spark.createDataFrame(rows, DOCS).repartition(3).withColumn("digest", F.lit(1)).withColumn("tree", F.lit("x")).write.parquet(f"{tmp_path}/documents.parquet")
    assert got(merkle.op12_merkle_manifest(spark, str(tmp_path))) == brute(rows)


@pytest.mark.parametrize(("fanout", "levels"), [(2, 1), (3, 2), (5, 1), (4, 10)])
def test_fanouts_and_segments(spark, fanout, levels):
    rows = table(random.Random(fanout), 140)
    df = spark.createDataFrame(rows, DOCS)
    m = merkle.manifest(df, DOCS.replace(" long", "").replace(" string", "").split(", "), F.col("lang"), [F.col("doc_id")], {"id": F.col("doc_id")}, fanout, levels)
    want = brute(rows, fanout)
    found = merkle.prove(m).select("keep.id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")), merkle.folded(F.col("leaf"), F.col("proof")), F.lit(True))
    assert got(found) == sorted([(*w[:5], w[3], True) for w in want], key=str)
    # Some leaves only, and what is stored: every inner node once, under its own digest.
    some = merkle.prove(m, F.col("keep.id") % 10 == 3).select("keep.id", "leaf", merkle.proof_digest(F.col("proof"))).collect()
    assert sorted(map(tuple, some)) == sorted((w[0], w[1], w[4]) for w in want if w[0] is not None and w[0] % 10 == 3)
    for store in m.trees.stores:
        for r in store.select(F.explode("records").alias("r")).select("r.*").collect():
            assert digest(*r["children"]) == r["digest"] and len(r["children"]) <= fanout


def test_odd_rows(spark, odd, none, tmp_path):
    odd.write.parquet(f"{tmp_path}/a/documents.parquet")
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in ODD]
    assert got(merkle.op12_merkle_manifest(spark, f"{tmp_path}/a")) == brute(rows)
    none.write.parquet(f"{tmp_path}/b/documents.parquet")
    empty = merkle.op12_merkle_manifest(spark, f"{tmp_path}/b")
    assert empty.count() == 0 and empty.columns[-1] == "verified"
    largest = spark.createDataFrame([(i, None, None, 2**63 - 1, "x") for i in range(30)], DOCS)
    largest.write.parquet(f"{tmp_path}/c/documents.parquet")
    assert got(merkle.op12_merkle_manifest(spark, f"{tmp_path}/c")) == brute([(i, None, None, 2**63 - 1, "x") for i in range(30)])


def test_query_is_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    mine = merkle.op12_merkle_manifest(spark, SF)
    assert got(mine) == sorted(con.sql(merkle.oracle()).fetchall(), key=str)
    assert mine.filter("verified").count() > 0 and mine.filter("not verified").count() > 0
