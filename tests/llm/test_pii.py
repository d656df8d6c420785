import hashlib
import random
import re

from .conftest import ODD, SF

from strata.llm import pii


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_match_plain_patterns():
    rng = random.Random(1)
    for _ in range(30_000):
        text = "".join(rng.choice("ab01259..@@+ -( )%é") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" * 100_000, "a@" * 150_000, "1 " * 150_000):
        pii.mentions(text)


def test_query_matches_brute_force(spark, docs):
    got = {r.doc_id: r for r in pii.op1_pii(spark, SF).collect()}
    assert len(got) == docs.count()
    for r in docs.select("doc_id", "text").collect():
        base, row = brute(r.text), got[r.doc_id]
        names = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert row.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert set(names) <= set(filter(None, row.spans.split(",")))


CONTACTS = [(i, f"Please call my desk: +1 (20{i}) 555-010{i} today, thanks {i}") for i in range(8)]
HIDDEN = [(50, "So call my desk: 555 0199 today"), (51, "It made 555 0188 points"), (52, "room 12 is free and 3 chairs"), (53, "we sold 555 0199 in all")]


def test_patterns_discover_what_the_shapes_miss(spark):
    docs = spark.createDataFrame(CONTACTS + HIDDEN, "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find_pii(docs).collect()}
    # The look-alike in the seeds' context, and the same number where it is met again; no other number.
    assert got[50] == [(17, pii.PHONE, 25)] and got[53] == [(8, pii.PHONE, 16)]
    assert got[51] == [] and got[52] == []
    text = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert text[50] == "So call my desk: [PHONE] today" and text[0].startswith("Please call my desk: [PHONE] today")
    assert text[51] == HIDDEN[1][1]


def test_few_seeds_teach_nothing(spark):
    docs = spark.createDataFrame(CONTACTS[:2] + HIDDEN, "doc_id long, text string")
    assert {r.doc_id: len(r.spans) for r in pii.find_pii(docs).collect()} == {0: 1, 1: 1, 50: 0, 51: 0, 52: 0, 53: 0}


def test_odd_rows(odd, none):
    key = lambda r: (r[0] is None, r)
    got = sorted(((r.doc_id, [tuple(s) for s in r.base]) for r in pii.find_pii(odd).collect()), key=key)
    assert got == sorted(((r[0], brute(r[1]) if (r[1] or "")[:1] != "x" else []) for r in ODD), key=key)
    masked = pii.redact(odd)
    assert masked.columns == odd.columns and masked.count() == len(ODD) and masked.filter("text is null").count() == 1
    assert pii.find_pii(none).count() == 0 and pii.redact(none).count() == 0


def test_overlapping_spans_are_masked_once():
    text = "x +411111111111 y 1.2.3.4"
    spans = pii.base_spans(text)
    assert [k for _, k, _ in spans] == [pii.PHONE, pii.IP] or [k for _, k, _ in spans] == [pii.PHONE, pii.CARD, pii.IP]
    assert pii._mask(text, spans) == "x [PHONE] y [IP]"
    assert pii._mask("mail a@b.cd now", pii.base_spans("mail a@b.cd now")) == "mail [EMAIL] now"
    assert pii._mask(None, []) is None


def test_patterns_decide_the_kind_of_a_long_number(spark):
    # 14 digits: loosely a phone as much as a card.
    hidden = [(60, "So call my desk: 0044 20 7946 0958 today"), (61, "It paid by card 0044 20 7946 0959 yesterday")]
    cards = [(70 + i, f"Money paid by card {n} yesterday, {i}") for i, n in enumerate(("411111111111" + str(k) for k in range(1000, 2000)))]
    cards = [c for c in cards if any(k == pii.CARD for _, k, _ in pii.base_spans(c[1]))][:9]
    docs = spark.createDataFrame(CONTACTS + cards + hidden, "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find_pii(docs).collect()}
    assert got[60] == [(17, pii.PHONE, 34)] and got[61] == [(16, pii.CARD, 33)]
    assert {r.doc_id: r.text for r in pii.redact(docs).collect()}[60] == "So call my desk: [PHONE] today"


def test_whole_addresses_and_far_contexts(spark):
    """Nothing is cut: an address of any length is one mention, and blanks of any length part words only."""
    long = "a" * 300 + "!@" + "b" * 400 + "_c"
    _, found = pii.mentions(f"to {long}, now")
    assert [(m["start"], m["end"]) for m in found if m["kind"] == pii.EMAIL] == [(3, 3 + len(long))]
    near, far = (pii.mentions(f"call my desk:{' ' * n}555 0199{' ' * n}today")[1][0] for n in (1, 500))
    assert near["patterns"] == far["patterns"] and near["broad"] == far["broad"]
    digits = "1 " * 40
    assert {m["kind"] for m in pii.mentions(digits + "x")[1]} == {pii.NUMBER}


def brute_bootstrap(texts, confidence=pii.CONFIDENCE, support=pii.MIN_SUPPORT):
    """The rounds over dictionaries: {instance: kind} of what is discovered."""
    edges = {}
    for t in texts:
        for m in pii.mentions(t or "")[1]:
            for p in [(x, False) for x in m["patterns"]] + [(m["broad"], True)]:
                key = p, m["instance"], m["kind"]
                edges[key] = edges.get(key, False) or m["seed"]
    seeds = {(i, k): 1.0 for (_, i, k), seed in edges.items() if seed}
    size, accepted = {}, {}
    for p, i, _ in edges:
        size.setdefault(p, set()).add(i)
    while True:
        held = {}
        for p, i, k in edges:
            if k != pii.NUMBER and (i, k) in seeds | accepted:
                held[p, k] = held.get((p, k), 0) + (seeds | accepted)[i, k]
        sure = {}
        for (p, k), h in held.items():
            n = len(size[p])
            s = h / n
            low = (s + 3.84 / (2 * n) - (3.84 * (max(0, s * (1 - s)) / n + 3.84 / (4 * n * n))) ** 0.5) / (1 + 3.84 / n)
            if h >= support and (conf := low if p[1] else h / (n + 1)) >= confidence:
                sure[p, k] = conf
        miss = {}
        for (p, i, k), seed in edges.items():
            if not seed and (p, k) in sure and (i, k) not in seeds:
                miss[i, k] = miss.get((i, k), 1.0) * (1 - sure[p, k])
        old = dict(accepted)
        accepted |= {x: max(1 - m, accepted.get(x, 0)) for x, m in miss.items()}
        if accepted.keys() == old.keys() and sum(accepted.values()) <= 1.01 * sum(old.values()):
            break
    out = {}
    for (i, k), s in sorted(accepted.items(), key=lambda x: (x[1], -x[0][1])):
        out[i] = k
    return out


def corpus(rng):
    """Contacts in a labelled context, the same context with numbers that the shapes miss, and a second context that only those have."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    local = lambda: f"{rng.randint(200, 999)} {rng.randint(1000, 9999)}"
    docs, truth = [], {}
    hidden = [local() for _ in range(27)]
    for i in range(150):
        docs.append(f"{word()} {word()} phone: +1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)} {word()}")
    docs += [f"{word()} {word()} phone: {h} {word()}" for h in hidden[:24]]
    # All are met in a second context, which the first 24 bring in, and so the last three.
    docs += [f"{word()} dial {h} please, {word()}" for h in hidden]
    truth = {f"{h}" for h in hidden}
    for i in range(60):
        docs.append(f"{word()} sold {local()} of {word()} and {rng.randint(1, 99)} more")
    for i in range(40):
        docs.append(f"mail: {word()}@{word()}.example.com {word()}")
    docs += [f"mail: {word()}@localhost {word()}" for _ in range(5)]
    return docs, truth


def test_discovery_spreads_and_is_the_brute_force_version(spark):
    rng = random.Random(6)
    texts, truth = corpus(rng)
    rows = list(enumerate(texts))
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    want = brute_bootstrap(texts)
    added = {}
    for i, t in rows:
        base, found = pii.mentions(t)
        mine = sorted({(m["start"], m["kind"], m["end"]) for m in found if not m["seed"] and want.get(m["instance"]) == m["kind"]})
        assert got[i] == sorted([*base, *mine])
        added |= {t[a:b]: k for a, k, b in mine}
    phones = {x for x, k in added.items() if k == pii.PHONE}
    # Numbers met only in the second context are found through those that the first one brought in; nothing sold is.
    assert len(phones & truth) == len(truth) and not phones - truth
    assert sum(k == pii.EMAIL and "localhost" in x for x, k in added.items()) == 5
