import numpy as np
from pyspark.sql import functions as F

from .conftest import ODD, SF

from strata.llm import toxicity


def test_features_are_words_pairs_and_skip_pairs():
    assert len(toxicity.features("A b c")) == 3 + 2 + 1
    assert (toxicity.features("A b, c!") == toxicity.features("a B c")).all()
    assert len(toxicity.features("")) == 0 and len(toxicity.features("one")) == 1
    assert toxicity.features("a b").tolist() != toxicity.features("b a").tolist()


def test_chunks_leave_no_gap(monkeypatch):
    text = " ".join(f"w{i % 53}" for i in range(1000))
    want = toxicity.features(text)
    monkeypatch.setattr(toxicity, "_CHUNK", 7)
    assert (toxicity.features(text) == want).all()


def test_l1_keeps_noise_at_zero():
    rng, fit = np.random.default_rng(0), toxicity.Ftrl(toxicity.Rates(l1=2.0))
    for i in range(2000):
        noise = rng.choice(toxicity.DIMENSION, 40, replace=False)
        fit.learn(np.unique(np.append(noise[noise > 9], [i % 2])), i % 2)
    w = fit.weights(slice(0, toxicity.DIMENSION))
    assert w[1] > 1 > -0.5 > w[0] and (w != 0).mean() < 0.001


def test_query_catches_held_out_toxic_texts(spark):
    d = SF.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic")
    got = toxicity.op3_toxicity(spark, d).join(labels, "doc_id").filter("held_out")
    row = got.agg(
        F.sum("toxic").alias("toxic"),
        F.sum(F.expr("toxic * predicted")).alias("caught"),
        F.sum(F.expr("(1 - toxic) * predicted")).alias("wrong"),
    ).first()
    # A third of some thousand labels; words that training never saw bound what can be caught.
    assert row["caught"] >= 0.6 * row["toxic"] and row["wrong"] <= 0.05 * row["caught"]


def test_held_out_labels_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(toxicity.learned_from(labels), F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = (toxicity.train(docs.filter(toxicity.learned_from(docs)), x.filter(toxicity.learned_from(x))) for x in (labels, flipped))
    assert a.bias == b.bias and (a.weight == b.weight).all()


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, 0), (5, 0), (8, None), (None, 1), (9, 2)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if not (r.text or "").strip()}
    assert len(empty) == 1
    nothing = toxicity.train(none, labels.limit(0))
    assert {r.score for r in toxicity.score(odd, nothing).collect()} == {0.5}
    assert toxicity.score(none, model).count() == 0


def test_fit_is_the_update_rule_by_hand(spark):
    """The learned weights against FTRL-proximal over dictionaries, one row an id, in the order of the ids' hashes."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(60):
        y = int(rng.integers(0, 2))
        rows.append((i, " ".join([*rng.choice([f"w{k}" for k in range(30)], 6), "bad" if y else "good"])))
        labels.append((i, y))
    rates = toxicity.Rates(alpha=0.5, beta=1.0, l1=0.2, l2=0.01, passes=3)
    docs = spark.createDataFrame([*rows, *rows[:7], *rows[:7]], "doc_id long, text string").repartition(3)
    marked = spark.createDataFrame([*labels, (0, 0), (900, 1), (1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, marked, rates=rates)
    order = [r.doc_id for r in spark.createDataFrame(rows, "doc_id long, text string").orderBy(F.xxhash64(F.lit("order"), "doc_id")).collect()]
    z, n = {}, {}

    def weight(k):
        if k != "bias" and abs(z.get(k, 0)) <= rates.l1:
            return 0.0
        pull = rates.l1 * (1 if z.get(k, 0) > 0 else -1) if k != "bias" else 0.0
        return -(z.get(k, 0) - pull) / ((rates.beta + n.get(k, 0) ** 0.5) / rates.alpha + rates.l2)

    for _ in range(rates.passes):
        for i in order:
            keys = [*toxicity.features(dict(rows)[i]).tolist(), "bias"]
            w = {k: weight(k) for k in keys}
            g = 1 / (1 + np.exp(-sum(w.values()))) - dict(labels)[i]
            for k in keys:
                before = n.get(k, 0)
                z[k] = z.get(k, 0) + g - ((before + g * g) ** 0.5 - before**0.5) / rates.alpha * w[k]
                n[k] = before + g * g
    want = {k: weight(k) for k in z if k != "bias" and weight(k)}
    assert dict(zip(model.at.tolist(), model.weight.tolist(), strict=True)).keys() == want.keys() and len(want) > 10
    assert np.allclose(model.weight, [want[k] for k in model.at.tolist()], rtol=1e-5, atol=1e-7)
    assert abs(model.bias - weight("bias")) < 1e-9
    scored = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for i, t in rows:
        total = weight("bias") + sum(weight(k) for k in toxicity.features(t).tolist())
        assert abs(scored[i] - 1 / (1 + np.exp(-total))) < 1e-5


def test_the_fit_holds_a_bounded_number_of_features(spark):
    """Rows in the order of their ids' hashes, until the next one would pass the bound."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(40)) + (" bad" if i % 2 else " good")) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    rates = toxicity.Rates(alpha=0.5, l1=0.01, passes=2)
    order = [r.doc_id for r in docs.orderBy(F.xxhash64(F.lit("order"), "doc_id")).collect()]
    sizes = [len(toxicity.features(dict(rows)[i])) for i in order]
    for n in (0, 7, 50):
        first = docs.filter(F.col("doc_id").isin(order[:n]))
        got, want = toxicity.train(docs, labels, entries=sum(sizes[:n]) + 5, rates=rates), toxicity.train(first, labels, rates=rates)
        assert got.bias == want.bias and (got.at == want.at).all() and (got.weight == want.weight).all()
        assert (len(got.at) > 0) == (n > 0)
