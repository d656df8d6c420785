"""Personal data by bootstrapped contextual extraction.

Strictly shaped identifiers (``base_spans``) are the seeds.  Each seed, and
each other identifier-like token, is a mention with lexical patterns: the two
words before it, the words on both sides, the word before it, its own form
(digit groups by their lengths) with the label before it, and, broadest, its
form with the shapes of its neighbours.  Spark scores the
graph of patterns and instances in rounds: a pattern's confidence for a kind is
the summed score of its distinct instances of that kind over all its distinct
instances plus one (of a broad pattern the lower bound of that share's interval);
an instance that is no seed takes the noisy-or of its
confident patterns.  A mention is a candidate for every kind that it loosely
looks like.  Instances scored over the threshold are accepted: they count as
evidence in the next round, which may bring in further patterns, until a round
accepts nothing new and scores have settled.  They are added wherever they are
mentioned, as the kind with the best score.

Patterns and instances travel as 64-bit hashes, so no identifier is written
outside the documents.  The graph steps are aggregates and joins on pattern or
instance; nothing is gathered by either.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from strata.llm.common import table, texts, written

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
NUMBER = -1
CONFIDENCE = 0.8
#: Summed score of distinct instances of a kind that a pattern needs.
MIN_SUPPORT = 3
#: Scores have settled when a round raises their sum by no more than this share.
SETTLED = 0.01
#: Squared normal quantile of the interval (95 %) in which a broad pattern's share lies.
_Z2 = 3.84

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_GROUPS = re.compile(r"[0-9]++(?:[ .:()/-]{1,3}[0-9]++)*+")
_DIGITS = re.compile(r"[0-9]+")
_FOUR = re.compile(r"[0-9]{1,3}([.:-])[0-9]{1,3}\1[0-9]{1,3}\1[0-9]{1,3}")

_WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")

MENTION = "struct<kind:int,start:int,end:int,instance:long,seed:boolean,patterns:array<long>,broad:long>"
SPAN = "struct<start:int,kind:int,end:int>"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, (end := domain.end())
        at = text.find("@", max(at + 1, end))


def _luhn(digits: list[int]) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(odd) + sum(2 * d - 9 * (d > 4) for d in even)) % 10 == 0


def _card(text: str) -> bool:
    digits = [int(c) for c in text if c not in " -"] if len(text) < 40 else []
    return 12 <= len(digits) <= 19 and _luhn(digits)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` in code points, ascending: leftmost non-overlapping matches of each kind that hold."""
    found = [(a, EMAIL, b) for a, b in _emails(text)] if "@" in text else []
    first = _DIGIT.search(text)
    if first:
        at = max(0, first.start() - 1)
        for m in _IP.finditer(text, at):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
                found.append((m.start(), IP, m.end()))
        found += [(m.start(), CARD, m.end()) for m in _CARD.finditer(text, at) if _card(m.group())]
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    found.append((m.start(), PHONE, m.end()))
    return sorted(found)


def _loose(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Identifier-like tokens that touch no base span: (start, kind, end) for each kind they look like, or NUMBER for none."""
    # Merged bounds, so that a token needs one look at the last span that starts before its end.
    starts, ends, far = [], [], 0
    for a, _, b in base:
        far = max(far, b)
        starts.append(a)
        ends.append(far)

    def free(a: int, b: int) -> bool:
        i = bisect_right(starts, b - 1) - 1
        return i < 0 or ends[i] <= a

    for token in re.finditer(r"\S+", text) if "@" in text else ():
        parts = list(re.finditer("[^@]+", token.group()))
        for left, right in zip(parts, parts[1:], strict=False):
            if right.start() == left.end() + 1:
                a, b = token.start() + left.start(), token.start() + right.start() + len(right.group().rstrip(".,;:!?)\"'"))
                if b > token.start() + right.start() and free(a, b):
                    yield a, EMAIL, b
    for m in _GROUPS.finditer(text):
        if free(m.start(), m.end()):
            n = sum(c.isdigit() for c in m.group())
            like = ((IP, _FOUR.fullmatch(m.group())), (CARD, 12 <= n <= 19), (PHONE, 7 <= n <= 15))
            for kind in [k for k, ok in like if ok] or [NUMBER]:
                yield m.start(), kind, m.end()


def _hash(*parts: str) -> int:
    h = xxhash.xxh64_intdigest("\0".join(parts).encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def _form(kind: int, mention: str) -> str:
    """Digit groups by their lengths and what stands between them; of an address only whether its host has a dot."""
    if kind == EMAIL:
        return "@." if "." in mention.partition("@")[2] else "@"
    return _DIGITS.sub(lambda m: str(len(m.group())), mention)


def _shape(word: str) -> str:
    """A word's case, a digit group, or the mark itself."""
    if word[:1].isalpha():
        return "A" if word.isupper() else "Aa" if word[0].isupper() else "a"
    return "d" if word[:1].isdigit() else word


class _Words:
    """A text's words, digit groups and marks, by their places."""

    def __init__(self, text: str):
        self.text, self.spans = text, [m.span() for m in _WORD.finditer(text)]
        self.starts, self.ends = [a for a, _ in self.spans], [b for _, b in self.spans]

    def around(self, start: int, end: int) -> tuple[str, str, str]:
        """The two before a mention and the one after it; empty where there is none."""
        i, j = bisect_right(self.ends, start), bisect_left(self.starts, end)
        word = lambda k: self.text[slice(*self.spans[k])] if 0 <= k < len(self.spans) else ""
        return word(i - 2), word(i - 1), word(j)


def _patterns(kind: int, text: str, words: _Words, start: int, end: int) -> tuple[list[int], int]:
    """Hashes of the patterns around a mention, and of its broadest one."""
    second, first, after = words.around(start, end)
    form, low = _form(kind, text[start:end]), [w.lower() for w in (second, first, after)]
    label = low[0] if first in (":", "=", "#") else low[1]
    exact = [_hash("2", *low[:2]), _hash("lr", *low[1:]), _hash("1", low[1]), _hash("label", form, label)]
    return exact, _hash("shape", form, _shape(first), _shape(after))


def mentions(text: str) -> tuple[list[tuple[int, int, int]], list[dict]]:
    base = base_spans(text)
    if not base and not _DIGIT.search(text) and "@" not in text:
        return base, []
    spans = [(*s, True) for s in base] + [(*s, False) for s in _loose(text, base)]
    words, out = _Words(text), []
    for a, k, b, seed in spans:
        patterns, broad = _patterns(k, text, words, a, b)
        out.append({"kind": k, "start": a, "end": b, "instance": _hash(text[a:b].lower()), "seed": seed, "patterns": patterns, "broad": broad})
    return base, out


def extract(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns of every row, as c0, c1, ..., with pii_row, pii_base and pii_mentions, written.

    A null text counts as empty.
    """
    fields = [f for f in docs.select(*keep).schema.fields]
    more = StructType.fromDDL(f"pii_row long, pii_base array<{SPAN}>, pii_mentions array<{MENTION}>")
    schema = StructType([*[StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)], *more.fields])
    types = [pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))]
    types.append(pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("instance", pa.int64()), ("seed", pa.bool_()), ("patterns", pa.list_(pa.int64())), ("broad", pa.int64())])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, strings in texts(batches):
            found = [mentions(t) for t in strings]
            base = [[{"start": a, "kind": k, "end": b} for a, k, b in x[0]] for x in found]
            columns = [batch.column(f"c{i}") for i in range(len(fields))]
            columns += [batch.column("pii_row"), pa.array(base, types[0]), pa.array([x[1] for x in found], types[1])]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    picked = docs.select(
        *[F.col(f.name).alias(f"c{i}") for i, f in enumerate(fields)],
        F.col(text_col).alias("text"),
        F.monotonically_increasing_id().alias("pii_row"),
    )
    return written(picked.mapInArrow(run, schema), "pii-found")


def _confidence(edges: DataFrame, scores: DataFrame, min_support: float) -> DataFrame:
    """(pattern, kind, conf): of patterns with enough support."""
    size = edges.groupBy("pattern", "broad").agg(F.count_distinct("instance").alias("size"))
    held = (
        edges.filter(f"kind <> {NUMBER}")
        .join(scores, ["instance", "kind"])
        .groupBy("pattern", "kind")
        .agg(F.sum("score").alias("held"))
        .filter(F.col("held") >= min_support)
    )
    share, n = F.col("held") / F.col("size"), F.col("size")
    spread = F.sqrt(F.lit(_Z2) * (F.greatest(share * (1 - share), F.lit(0.0)) / n + F.lit(_Z2) / (4 * n * n)))
    low = (share + F.lit(_Z2) / (2 * n) - spread) / (1 + F.lit(_Z2) / n)
    conf = F.when(F.col("broad"), low).otherwise(F.col("held") / (n + 1))
    return held.join(size, "pattern").select("pattern", "kind", conf.alias("conf"))


def bootstrap(found: DataFrame, rounds: int | None = None, confidence: float = CONFIDENCE, min_support: float = MIN_SUPPORT) -> DataFrame:
    """``(instance, kind)`` of the identifiers that the patterns discover, seeds not included.

    Rounds go on until one accepts nothing new and the scores have settled (or for ``rounds`` rounds).
    """
    pattern = F.concat(
        F.transform("m.patterns", lambda p: F.struct(p.alias("pattern"), F.lit(False).alias("broad"))),
        F.array(F.struct(F.col("m.broad").alias("pattern"), F.lit(True).alias("broad"))),
    )
    edges = written(
        found.select(F.explode("pii_mentions").alias("m"))
        .select("m.kind", "m.instance", "m.seed", F.explode(pattern).alias("p"))
        .groupBy("p.pattern", "p.broad", "instance", "kind")
        .agg(F.max("seed").alias("seed")),
        "pii-edges",
    )
    seeds = edges.filter("seed").select("instance", "kind", F.lit(1.0).alias("score")).distinct()
    accepted, n, total = seeds.limit(0), 0, 0.0
    while rounds is None or rounds > 0:
        sure = _confidence(edges, seeds.unionByName(accepted), min_support).filter(F.col("conf") >= confidence)
        new = (
            edges.filter("not seed")
            .join(sure, ["pattern", "kind"])
            .groupBy("instance", "kind")
            .agg((1 - F.exp(F.sum(F.log1p(-F.col("conf"))))).alias("score"))
            .join(seeds, ["instance", "kind"], "left_anti")
        )
        # What was accepted once stays, with the best score that it has had.
        accepted = written(accepted.unionByName(new).groupBy("instance", "kind").agg(F.max("score").alias("score")), "pii-accepted")
        now = accepted.agg(F.count("*").alias("n"), F.coalesce(F.sum("score"), F.lit(0.0)).alias("total")).first()
        if now["n"] == n and now["total"] <= total * (1 + SETTLED):
            break
        n, total = now["n"], now["total"]
        rounds = None if rounds is None else rounds - 1
    best = F.max(F.struct("score", (-F.col("kind")).alias("order"), "kind"))
    return accepted.groupBy("instance").agg(best.alias("best")).select("instance", "best.kind")


def _added(found: DataFrame, accepted: DataFrame) -> DataFrame:
    """(pii_row, pii_added): the added spans of rows that have any."""
    loose = (
        found.select("pii_row", F.explode(F.filter("pii_mentions", lambda m: ~m["seed"] & (m["kind"] != NUMBER))).alias("m"))
        .select("pii_row", "m.kind", "m.instance", "m.start", "m.end")
    )
    return (
        loose.join(accepted, ["instance", "kind"])
        .groupBy("pii_row")
        .agg(F.collect_list(F.struct("start", "kind", "end")).alias("pii_added"))
    )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    )


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """A row per row of ``docs``: doc_id, base and spans, arrays of (start, kind, end) ascending by start and kind.

    Null and empty texts have no spans; repeated rows are looked at one by one
    (their instances count once as evidence); other columns are not looked at.
    """
    found = extract(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), ["doc_id"])
    added = _added(found, bootstrap(found, **options))
    return found.join(added, "pii_row", "left").select(
        F.col("c0").alias("doc_id"),
        F.col("pii_base").alias("base"),
        F.array_sort(F.concat("pii_base", F.coalesce("pii_added", F.array().cast(f"array<{SPAN}>")))).alias("spans"),
    )


def _mask(text: str | None, spans: list) -> str | None:
    """Spans, overlapping ones as one, replaced by the first one's kind in brackets."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for a, kind, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with all personal data found in ``text_col`` replaced by its kind in brackets.

    Only rows with a discovered identifier's look-alike take part in a join;
    a null text stays null.
    """
    columns = [f"c{i}" for i in range(len(docs.columns))]
    text = columns[docs.columns.index(text_col)]
    found = extract(docs, docs.columns, text_col)
    added = _added(found, bootstrap(found, **options))
    loose = F.exists("pii_mentions", lambda m: ~m["seed"] & (m["kind"] != NUMBER))
    some = found.filter(loose).join(added, "pii_row", "left").drop("pii_row", "pii_mentions")
    none = found.filter(~loose).drop("pii_row", "pii_mentions").withColumn("pii_added", F.array().cast(f"array<{SPAN}>"))
    every = some.unionByName(none).withColumn(
        "pii_spans", F.array_sort(F.concat("pii_base", F.coalesce("pii_added", F.array().cast(f"array<{SPAN}>"))))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[(s["start"], s["kind"], s["end"]) for s in x] for x in batch.column("pii_spans").to_pylist()]
            masked = [_mask(t, s) for t, s in zip(batch.column(text).to_pylist(), spans, strict=True)]
            arrays = [pa.array(masked, pa.string()) if c == text else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, docs_columns)

    docs_columns, schema = docs.columns, docs.schema
    return every.select(*columns, "pii_spans").mapInArrow(run, schema)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_email to n_phone count the base spans; n_discovered the spans that the method adds."""
    found = find_pii(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_discovered"),
    )
