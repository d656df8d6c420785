"""Secrets by a battery of randomness tests under false-discovery control.

Strictly shaped secrets (``base_spans``) are found by their patterns.  Any
other long token is a candidate: its encoding is inferred, the smallest of
``ENCODINGS`` whose alphabet holds all its characters, and three tests ask
whether it could be drawn uniformly from that alphabet: chi-squared uniformity
of the symbols, the number of runs in the alphabet's lower and upper half, and
the serial correlation of neighbouring symbols.  Fisher's method joins their
p-values into one, near 0 for words and uniform for random tokens.

How often ordinary text reaches a p-value depends on the encoding and on the
length, so the same battery is run over the ordinary text of all documents,
all of it written in each encoding and cut into pieces of each length.  That
gives every candidate the share of ordinary pieces of its encoding and length
that look as random as it does: its p-value against being ordinary.  In each
encoding and length class the Benjamini-Hochberg rule over the distinct
candidates picks those to report, at most a share ``q`` of them false.

Spark carries counts only: the candidates and the ordinary pieces are counted
by (encoding, length class, bin of the p-value), a fixed number of cells, and
a candidate's cell says whether it is reported.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table, texts, written

KINDS = ("assign", "access", "hex", "random")
ASSIGN, ACCESS, HEX, RANDOM = range(4)
#: The share of false ones among the reported tokens of an encoding and length class.
Q = 0.05
#: Shortest length of each class; shorter tokens are no candidates.
LENGTHS = (16, 24, 32, 48, 64, 128)
#: Bins of a p-value: twenty to a decade.
BINS = 240
#: Symbols of ordinary text that are tested at once.
BLOCK = 1 << 17

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
#: Name, alphabet in its own order, and what stands for white space between ordinary words; smaller alphabets first.
ENCODINGS = (
    ("decimal", _DIGITS, ""),
    ("hex", _DIGITS + "abcdef", ""),
    ("HEX", _DIGITS + "ABCDEF", ""),
    ("lower", _LOWER, ""),
    ("UPPER", _UPPER, ""),
    ("base32", _UPPER + "234567", ""),
    ("lower36", _DIGITS + _LOWER, ""),
    ("UPPER36", _DIGITS + _UPPER, ""),
    ("base62", _DIGITS + _UPPER + _LOWER, ""),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/", "/"),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_", "-"),
)
_NONE = 255

_ASSIGN = re.compile(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_TOKEN = re.compile(r"([A-Za-z0-9+/_-]{16,})={0,2}")
_PART = re.compile(r"[A-Za-z0-9]{16,}")


def _symbols(alphabet: str) -> np.ndarray:
    """The number of each byte in an alphabet."""
    out = np.full(256, _NONE, np.uint8)
    out[np.frombuffer(alphabet.encode(), np.uint8)] = np.arange(len(alphabet))
    return out


def _written_in(alphabet: str, space: str) -> np.ndarray:
    """The number of the symbol that stands for each byte of ordinary text: letters in a case that the alphabet has."""
    out = _symbols(alphabet)
    for a, b in zip(_LOWER, _UPPER, strict=True):
        for one, other in ((a, b), (b, a)):
            if one not in alphabet and other in alphabet:
                out[ord(one)] = alphabet.index(other)
    if space:
        out[[9, 10, 11, 12, 13, 32]] = alphabet.index(space)
    return out


_OWN = [_symbols(a) for _, a, _ in ENCODINGS]
_TEXT = [_written_in(a, s) for _, a, s in ENCODINGS]
# Encodings in which ordinary text has the same symbols are tested once.
_ALIKE: dict[tuple[int, bytes], list[int]] = {}
for _i, (_, _a, _) in enumerate(ENCODINGS):
    _ALIKE.setdefault((len(_a), _TEXT[_i].tobytes()), []).append(_i)
# Chebyshev's coefficients of the complementary error function, right to 1.2e-7 of its value (Numerical Recipes, 6.2).
_CHEBYSHEV = (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223)


def _erfc(x: np.ndarray) -> np.ndarray:
    far = np.abs(x)
    t, power = 1 / (1 + 0.5 * far), 0.0
    for c in _CHEBYSHEV:
        power = power * t + c
    tail = t * np.exp(np.maximum(power - far * far, -700))
    return np.where(x >= 0, tail, 2 - tail)


def _evidence(p: np.ndarray) -> np.ndarray:
    return -np.log(np.maximum(p, 1e-100))


@lru_cache(maxsize=1024)
def _run_tail(length: int) -> np.ndarray:
    """Evidence, the negative log of the two-sided p-value, of each number of changes between the halves of ``length`` random symbols."""
    n = length - 1
    log = np.array([math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(n + 1)]) - n * math.log(2)
    p = np.exp(log)
    return _evidence(np.minimum(1.0, 2 * np.minimum(np.cumsum(p), np.cumsum(p[::-1])[::-1])))


def _uniform(squares: np.ndarray, n: int, size: int) -> np.ndarray:
    """Evidence of sums of squared counts of ``n`` symbols."""
    # The statistic's exact mean and variance for n symbols, as a chi-squared law by the Wilson-Hilferty cube root.
    mean, var = size - 1, 2 * (size - 1) * (n - 1) / n
    free = 2 * mean * mean / var
    statistic = squares * (size / n) - n
    z = (np.cbrt(statistic / mean) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    return _evidence(0.5 * _erfc(z / math.sqrt(2)))


@lru_cache(maxsize=128)
def _uniform_tail(n: int, size: int) -> np.ndarray:
    return _uniform(np.arange(n * n + 1), n, size)


def battery(symbols: np.ndarray, size: int) -> np.ndarray:
    """The p-value of each row of ``symbols`` (numbers below ``size``) against uniform, independent symbols."""
    rows, n = symbols.shape
    counts = np.bincount((symbols + (np.arange(rows) * size)[:, None]).ravel(), minlength=rows * size).reshape(rows, size)
    squares = np.einsum("ij,ij->i", counts, counts)
    uniform = _uniform_tail(n, size)[squares] if n in LENGTHS else _uniform(squares, n, size)
    # Runs: changes between the halves follow a binomial law.
    upper = symbols >= size // 2
    changes = (upper[:, 1:] != upper[:, :-1]).view(np.uint8)
    runs = _run_tail(n)[np.einsum("ij->i", changes if n in LENGTHS else changes.astype(np.int64))]
    # Serial correlation: about normal, with mean -1/n and variance 1/n.  Sums of the short rows are whole in 32 bits.
    x = symbols.astype(np.float32 if n in LENGTHS else np.float64)
    mean = np.einsum("ij->i", x).astype(float) / n
    spread = np.einsum("ij,ij->i", x, x) - n * mean * mean
    pairs = np.einsum("ij,ij->i", x[:, 1:], x[:, :-1]) - mean * ((n + 1) * mean - x[:, 0] - x[:, -1])
    varied = squares < n * n
    r = pairs / np.where(varied, spread, 1)
    serial = np.where(varied, _evidence(_erfc(np.abs(r + 1 / n) * math.sqrt(n / 2))), 100 * math.log(10))
    half = uniform + runs + serial
    return np.exp(-half) * (1 + half + half * half / 2)


def _bins(p: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(-20 * np.log10(np.maximum(p, 1e-300))).astype(np.int64), BINS - 1)


def _class(length: int) -> int:
    return sum(length >= n for n in LENGTHS) - 1


def _cells(encoding: int, length_class: int, p: np.ndarray) -> np.ndarray:
    return (encoding * len(LENGTHS) + length_class) * BINS + _bins(np.maximum(p, 0))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` in code points, ascending: leftmost non-overlapping matches of each kind that hold."""
    found = [(m.start(), ASSIGN, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 12]
    if "AKIA" in text:
        found += [(m.start(), ACCESS, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), HEX, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _encoding(body: bytes) -> int | None:
    seen = np.frombuffer(body, np.uint8)
    return next((i for i, own in enumerate(_OWN) if (own[seen] != _NONE).all()), None)


def candidates(text: str, base: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int, str]], list[tuple[int, int]]]:
    """The tokens that touch no base span, (start, end, encoding, token without padding), and all that is no ordinary text."""
    far, taken = 0, []
    for a, _, b in base:
        if a < far:
            taken[-1] = (taken[-1][0], far := max(far, b))
        else:
            taken.append((a, far := b))
    found, odd, i = [], list(taken), 0
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        odd.append((a, b))
        if i < len(taken) and taken[i][0] < b:
            continue
        encoding = _encoding(m.group(1).encode())
        if encoding is not None:
            found.append((a, b, encoding, m.group(1)))
        else:  # marks of several alphabets: its parts
            for part in _PART.finditer(m.group(1)):
                found.append((a + part.start(), a + part.end(), _encoding(part.group().encode()), part.group()))
    return found, odd


def _ordinary(text: str, odd: list[tuple[int, int]]) -> bytes:
    if odd:
        at, parts = 0, []
        for a, b in sorted(odd):
            parts.append(text[at : max(a, at)])
            at = max(at, b)
        text = " ".join([*parts, text[at:]])
    return text.encode("utf-8", "surrogatepass")


def pieces(data: bytes) -> Iterator[tuple[list[int], int, np.ndarray]]:
    """All ordinary text as (encodings, length class, symbols): in each encoding, and in each cut into pieces of each length."""
    raw = np.frombuffer(data, np.uint8)
    for (_, table), encodings in _ALIKE.items():
        symbols = np.frombuffer(table, np.uint8)[raw]
        symbols = symbols[symbols != _NONE]
        for k, n in enumerate(LENGTHS):
            if len(symbols) < n:
                break
            yield encodings, k, symbols[: len(symbols) // n * n]


SPAN = "struct<start:int,kind:int,end:int>"
FOUND = f"doc_id long, base array<{SPAN}>, tokens array<struct<start:int,end:int,cell:int,instance:long>>, ordinary array<struct<cell:int,n:long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
_TOKENS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cell", pa.int32()), ("instance", pa.int64())]))
_COUNTS = pa.list_(pa.struct([("cell", pa.int32()), ("n", pa.int64())]))


class _Counter:
    """Counts the cells of ordinary pieces, a block of one shape at a time."""

    def __init__(self):
        self.held: dict[tuple[int, int], list[np.ndarray]] = {}
        self.size: dict[tuple[int, int], int] = {}
        self.n = np.zeros((len(ENCODINGS), len(LENGTHS), BINS), np.int64)

    def add(self, data: bytes) -> None:
        for encodings, k, symbols in pieces(data):
            key = encodings[0], k
            self.held.setdefault(key, []).append(symbols)
            self.size[key] = self.size.get(key, 0) + len(symbols)
            if self.size[key] >= BLOCK:
                self.flush(key, encodings)

    def flush(self, key: tuple[int, int], encodings: list[int]) -> None:
        symbols, k, size = np.concatenate(self.held.pop(key)), key[1], len(ENCODINGS[key[0]][1])
        self.size.pop(key)
        step = BLOCK // LENGTHS[k] * LENGTHS[k]
        for at in range(0, len(symbols), step):
            p = battery(symbols[at : at + step].reshape(-1, LENGTHS[k]), size)
            self.n[encodings, k] += np.bincount(_bins(np.maximum(p, 0)), minlength=BINS)

    def take(self) -> list[dict]:
        for encodings in _ALIKE.values():
            for key in [key for key in self.held if key[0] == encodings[0]]:
                self.flush(key, encodings)
        n = self.n.ravel()
        out = [{"cell": int(c), "n": int(n[c])} for c in np.flatnonzero(n)]
        self.n[:] = 0
        return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A written row per row of ``docs``: its base spans, its tokens with their cells, and (on some rows) counts of ordinary cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter()
        for batch, strings in texts(batches):
            base, tokens = [], []
            for t in strings:
                spans = base_spans(t)
                found, odd = candidates(t, spans)
                counter.add(_ordinary(t, odd))
                base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
                rows = []
                for a, b, encoding, token in found:
                    symbols = _OWN[encoding][np.frombuffer(token.encode(), np.uint8)]
                    cell = _cells(encoding, _class(len(token)), battery(symbols[None], len(ENCODINGS[encoding][1])))[0]
                    rows.append({"start": a, "end": b, "cell": int(cell), "instance": xxhash.xxh64_intdigest(token.encode()) - (1 << 63)})
                tokens.append(rows)
            ordinary = [counter.take(), *[[]] * (len(strings) - 1)]
            columns = [batch.column("doc_id"), pa.array(base, _SPANS), pa.array(tokens, _TOKENS), pa.array(ordinary, _COUNTS)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "tokens", "ordinary"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return written(picked.mapInArrow(run, FOUND), "secrets-found")


def _histogram(cells: DataFrame, n: Column) -> np.ndarray:
    """Counts by (stratum, bin): a fixed number of cells."""
    out = np.zeros(len(ENCODINGS) * len(LENGTHS) * BINS, np.int64)
    for r in cells.groupBy("cell").agg(n.alias("n")).collect():
        out[r["cell"]] = r["n"]
    return out.reshape(-1, BINS)


def last_bins(tokens: np.ndarray, ordinary: np.ndarray, q: float) -> list[int]:
    """Of each stratum the last bin that is reported (-1: none), by the Benjamini-Hochberg rule over its tokens."""
    p = (1 + np.cumsum(ordinary, axis=1)) / (1 + ordinary.sum(axis=1, keepdims=True))
    found, every = np.cumsum(tokens, axis=1), tokens.sum(axis=1, keepdims=True)
    ok = (found > 0) & (p * every <= q * found)
    return [int(np.flatnonzero(row)[-1]) if row.any() else -1 for row in ok]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = Q) -> DataFrame:
    """A row per row of ``docs``: doc_id, base and spans, arrays of (start, kind, end) ascending by start and kind.

    Null and empty texts have no spans; repeated rows are looked at one by one
    (a token counts once as evidence however often it occurs); without ordinary
    text of an encoding and length none of its tokens is reported; an empty
    table gives no rows; other columns are not looked at.
    """
    found = scan(docs, id_col, text_col)
    ordinary = _histogram(found.select(F.explode("ordinary").alias("o")).select("o.cell", "o.n"), F.sum("n"))
    distinct = found.select(F.explode("tokens").alias("t")).select("t.instance", "t.cell").distinct()
    last = last_bins(_histogram(distinct, F.count("*")), ordinary, q)
    reported = F.array(*[F.lit(x) for x in last])
    random = F.filter("tokens", lambda t: t["cell"] % BINS <= F.get(reported, F.floor(t["cell"] / BINS).cast("int")))
    added = F.transform(random, lambda t: F.struct(t["start"].alias("start"), F.lit(RANDOM).alias("kind"), t["end"].alias("end")))
    return found.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    )


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_assign to n_hex count the base spans; the spans that the tests add are of the kind ``random``, n_random of them."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{KINDS[k]}") for k in (ASSIGN, ACCESS, HEX)],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_random"),
    )
