import collections
import functools
import hashlib
import math
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from .conftest import ODD, SF

from strata.llm import secrets

DOCS = "doc_id long, text string"
KINDS = ("assign", "access", "hex")


def base_of(text):
    """The contract's patterns, as they stand."""
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    found = []
    for m in re.finditer(rf"""({word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 12:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(found)


@functools.lru_cache
def law_of(n):
    return [math.exp(math.lgamma(n) - math.lgamma(i + 1) - math.lgamma(n - i) - (n - 1) * math.log(2)) for i in range(n)]


def p_value(numbers, size):
    n, counts = len(numbers), collections.Counter(numbers)
    mean, var = size - 1, 2 * (size - 1) * (n - 1) / n
    free, x2 = 2 * mean**2 / var, size / n * sum(c * c for c in counts.values()) - n
    z = (math.copysign(abs(x2 / mean) ** (1 / 3), x2) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    p1 = math.erfc(z / math.sqrt(2)) / 2
    changes = sum((a >= size // 2) != (b >= size // 2) for a, b in zip(numbers, numbers[1:], strict=False))
    law = law_of(n)
    p2 = min(1.0, 2 * min(sum(law[: changes + 1]), sum(law[changes:])))
    m = sum(numbers) / n
    spread = sum((x - m) ** 2 for x in numbers)
    p3 = math.erfc(abs(sum((a - m) * (b - m) for a, b in zip(numbers, numbers[1:], strict=False)) / spread + 1 / n) * math.sqrt(n / 2)) if spread else 0.0
    half = -sum(math.log(max(p, 1e-100)) for p in (p1, p2, p3))
    return math.exp(-half) * (1 + half + half**2 / 2)


def bin_of(p):
    return min(secrets.BINS - 1, int(-20 * math.log10(max(p, 1e-300))))


def brute(rows, q=secrets.Q):
    """rows: (doc_id, text) -> sorted (doc_id, spans)."""
    names = [a for _, a, _ in secrets.ENCODINGS]
    tokens, ordinary, held = {}, collections.Counter(), []
    for _, text in rows:
        text = text or ""
        base, mine, plain = base_of(text), [], list(text)
        for a, _, b in base:
            plain[a:b] = ["\0"] * (b - a)
        for m in re.finditer(r"([A-Za-z0-9+/_-]{16,})={0,2}", text):
            clear = not any(a < m.end() and m.start() < b for a, _, b in base)
            plain[m.start() : m.end()] = ["\0"] * (m.end() - m.start())
            if not clear:
                continue
            whole = any(set(m.group(1)) <= set(a) for a in names)
            parts = [(m.start(), m.end(), m.group(1))] if whole else [(m.start() + x.start(), m.start() + x.end(), x.group()) for x in re.finditer(r"[A-Za-z0-9]{16,}", m.group(1))]
            for a, b, t in parts:
                code = next(i for i, alphabet in enumerate(names) if set(t) <= set(alphabet))
                length = max(i for i, n in enumerate(secrets.LENGTHS) if len(t) >= n)
                tokens[t] = ((code, length), bin_of(p_value([names[code].index(c) for c in t], len(names[code]))))
                mine.append((a, b, t))
        held.append((base, mine))
        data = re.sub("\0+", " ", "".join(plain)).encode()
        for code, (_, alphabet, space) in enumerate(secrets.ENCODINGS):
            numbers = []  # of the whole text
            for byte in data:
                c = chr(byte)
                c = space if c in "\t\n\v\f\r " else c if c in alphabet else c.swapcase() if byte < 128 and c.isalpha() and c.swapcase() in alphabet else ""
                numbers += [alphabet.index(c)] if c else []
            for k, n in enumerate(secrets.LENGTHS):
                for at in range(0, len(numbers) - n + 1, n):
                    ordinary[(code, k), bin_of(p_value(numbers[at : at + n], len(alphabet)))] += 1
    last = {}
    for stratum in {s for s, _ in tokens.values()}:
        bins = sorted(b for s, b in tokens.values() if s == stratum)
        total = sum(n for (s, _), n in ordinary.items() if s == stratum)
        for b in range(secrets.BINS):
            p = (1 + sum(n for (s, x), n in ordinary.items() if s == stratum and x <= b)) / (1 + total)
            if (k := sum(x <= b for x in bins)) and p * len(bins) <= q * k:
                last[stratum] = b
    out = []
    for (doc_id, _), (base, mine) in zip(rows, held, strict=True):
        added = [(a, 3, b) for a, b, t in mine if tokens[t][1] <= last.get(tokens[t][0], -1)]
        out.append((doc_id, sorted(base + added)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in df.collect()), key=str)


WORDS = "the of and value report under market system house time people water number sound place little after great form think same right move".split()


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def token(rnd, alphabet, n):
    return "".join(rnd.choice(alphabet) for _ in range(n))


ALNUM = string.ascii_letters + string.digits
SHAPES = [("0123456789ABCDEF", 40), (ALNUM, 32), (ALNUM + "+/", 40), (ALNUM + "-_", 22), (string.ascii_uppercase + "234567", 64), (string.ascii_lowercase + string.digits, 80)]


def planted(rnd, n=90):
    rows, where = [], {}
    for i in range(n):
        a, b = prose(rnd, rnd.randint(100, 900)), prose(rnd, rnd.randint(5, 60))
        alphabet, length = SHAPES[i % len(SHAPES)]
        t = token(rnd, alphabet, length)
        long_word = "".join(rnd.choice(WORDS) for _ in range(5))
        rows.append((i, f"{a} {t} {b} {long_word} {rnd.choice(WORDS)}/{long_word}-{rnd.choice(WORDS)}" if i % 3 else f"{a} {long_word}"))
        if i % 3:
            where[i] = (len(a) + 1, len(a) + 1 + len(t))
    return rows, where


def test_base_is_the_contracts():
    cases = [
        "token = 'abcdefghijkl' PASSWORD:short secret==abcdefghijkl=x api_key: AKIA0123456789ABCD apikey=" + "x" * 12,
        "AKIAAKIAAKIA AKIA" + "Z" * 14 + " zAKIA" + "Z" * 13 + " 0123456789abcdef 0123456789abcde ABCDEF0123456789 x0123456789abcdef0x",
        "toKen = \x20\x20 = abcdefghijklmnop ſecret=abcdefghijklmnop toKen=abcdefghijklmnop secret_token: \"deadbeefdeadbeef\"",
        "token=token=token=abcdefghijkl é=token:\"a.b-c_d/e+f=g", "", "token", "token:" + "=" * 30, "passwd" * 500 + "=" + "q" * 20,
    ]
    rnd = random.Random(1)
    cases += ["".join(rnd.choice(["token", "=", ":", " ", "AKIA", "a", "0123456789abcdef", "X" * 9, "'", "secret", "é"]) for _ in range(40)) for _ in range(300)]
    for text in cases:
        assert secrets.base_spans(text) == base_of(text), text


@pytest.mark.parametrize("seed", [1, 2])
def test_spans_are_the_brute_force_version(spark, seed):
    rnd = random.Random(seed)
    rows, where = planted(rnd)
    rows += [(500, f"{prose(rnd, 40)} token: {token(rnd, ALNUM, 30)} {token(rnd, '0123456789abcdef', 32)}"), (501, None), (None, rows[1][1]), *rows[:3]]
    frame = spark.createDataFrame(rows, DOCS).repartition(4)
    found = got(secrets.find_secrets(frame))
    assert found == brute(rows)
    spans = {d: {(a, b) for a, k, b in s if k == secrets.RANDOM} for d, s in found}
    assert sum(where[d] in spans[d] for d in where) >= 0.9 * len(where)
    assert sum(len(s) for s in spans.values()) - sum(where[d] in spans[d] for d in where) <= 6


def test_random_tokens_have_uniform_p_values():
    rnd = random.Random(3)
    for _, alphabet, _ in secrets.ENCODINGS:
        for n in (24, 64):
            x = secrets.battery(secrets.np.array([[rnd.randrange(len(alphabet)) for _ in range(n)] for _ in range(600)]), len(alphabet))
            assert 0.35 < x.mean() < 0.65 and (x < 0.01).mean() < 0.05
    words = secrets.np.array([[secrets.ENCODINGS[8][1].index(c) for c in "".join(rnd.choices(WORDS, k=20))[:48]] for _ in range(200)])
    assert secrets.battery(words, 62).max() < 1e-6


def test_query(spark, docs):
    result = secrets.op13_secrets(spark, SF).collect()
    texts = dict(map(tuple, docs.select("doc_id", "text").collect()))
    assert len(result) == docs.count()
    for r in result:
        base = base_of(texts[r.doc_id] or "")
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3))
        joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r.spans.split(",")) and r.n_random == r.spans.count("random")


def test_odd_rows(spark, odd, none):
    found = got(secrets.find_secrets(odd))
    assert found == brute([r[:2] for r in ODD])
    assert secrets.find_secrets(none).count() == 0
    with_more = odd.withColumn("tokens", F.lit(1)).withColumn("ordinary", F.lit(2)).withColumn("base", F.lit(3))
    assert got(secrets.find_secrets(with_more)) == found


def test_every_ordinary_symbol_is_tested_in_every_encoding_and_length():
    """Thresholds come from all ordinary text: no stretch of it is left to one encoding, no piece to one length."""
    data = ("the report of 1984 under market water " * 300).encode()
    counter = secrets._Counter()
    counter.add(data)
    n = collections.Counter()
    for cell in counter.take():
        n[cell["cell"] // secrets.BINS] += cell["n"]
    letters = sum(chr(c).isalpha() for c in data)
    digits = sum(chr(c).isdigit() for c in data)
    held = {"decimal": digits, "lower": letters, "UPPER": letters, "lower36": letters + digits, "base62": letters + digits, "base64": len(data)}
    for i, (name, _, _) in enumerate(secrets.ENCODINGS):
        if name in held:
            assert [n[i * len(secrets.LENGTHS) + k] for k in range(len(secrets.LENGTHS))] == [held[name] // x for x in secrets.LENGTHS]
