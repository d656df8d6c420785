"""Language identification by prediction by partial matching (PPM).

One byte-context tree per language, contexts of up to ``order`` bytes, escape
method C with full exclusion.  The statistics are frozen after training, so a
byte's exact code length depends only on the ``order`` bytes before it.  A tree
is kept as the sorted keys of its contexts and of the bytes seen in them, all
that were learned; each distinct (context, byte) of a group of texts is looked
up once in each language.  The language with the shortest code wins.

Training sees at most about ``rows_per_lang`` labelled rows of each language
(a hash of the id picks them, so the sample does not depend on how rows are
stored); that bound also bounds the counts brought to the driver and the
broadcast trees.  Every row of the input is scored over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from strata.llm.common import fold, table, texts

ORDER = 4
ROWS_PER_LANG = 800
UNKNOWN = "und"
#: Symbol before a text's first byte; not a byte.
_START = 256
_BITS = 9
#: Bytes coded at once; what a step holds besides the trees is a fixed multiple of this.
_WINDOW = 1 << 18


def _grams(data: list[bytes], order: int) -> np.ndarray:
    """Per byte of the texts: its context of ``order`` symbols and itself, 9 bits each, the byte lowest."""
    pad = np.full(order, _START, np.int64)
    sym = np.concatenate([x for b in data for x in (pad, np.frombuffer(b, np.uint8).astype(np.int64))])
    key = np.zeros(len(sym) - order, np.int64)
    for back in range(order, -1, -1):
        key = (key << _BITS) | sym[order - back : len(sym) - back]
    return key[sym[order:] != _START]


def sample(docs: DataFrame, label: str, id_col: str, rows: int) -> DataFrame:
    """About ``rows`` rows of each label (all, if there are fewer), picked by a hash of the id.

    The labels' counts come to the driver, as their models will.
    """
    counts = docs.groupBy(label).count().collect()
    if not counts:
        return docs
    share = F.create_map(*[F.lit(x) for r in counts for x in (r[label], min(1.0, rows / r["count"]))])
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1 << 20)) / float(1 << 20)
    return docs.filter(place < F.element_at(share, F.col(label)))


class Model:
    """The language names, sorted, and the trees of their learned contexts.

    ``keys`` and ``counts`` hold for each language its (context, byte) keys, ascending, and how often each was seen;
    they are dropped once the trees are built from them, one language after the other.
    """

    def __init__(self, langs: list[str], keys: list[np.ndarray], counts: list[np.ndarray], order: int):
        self.langs, self.keys, self.counts, self.order = langs, list(keys), list(counts), order
        self._tables: _Tables | None = None

    @property
    def tables(self) -> _Tables:
        if self._tables is None:
            self._tables = _Tables(self)
        return self._tables


def _last(key: np.ndarray, symbols: int) -> np.ndarray:
    return key & ((1 << (_BITS * symbols)) - 1)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and of each key its place among them in 32 bits."""
    grams, place = np.unique(keys, return_inverse=True)
    return grams, place.astype(np.int32)


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each key: its place (any, if it is not there), and whether it is there."""
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


class _Level:
    """One language's contexts of k bytes (``names``) and the bytes seen in them (``grams``), with code lengths.

    ``own`` is a gram's code in its context, ``log`` that of its count.  Of a context: ``escape`` from it when nothing
    is ruled out, and, with the bytes seen in it ruled out, the log of what is left of the context one byte shorter
    (``whole``) and the escape from that one (``out``).
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, k: int, shorter: _Level | None):
        grams, place = np.unique(_last(keys, k + 1), return_inverse=True)
        n = np.bincount(place, counts, len(grams))
        names, node = np.unique(grams >> _BITS, return_inverse=True)
        total, kinds = np.bincount(node, n, len(names)), np.bincount(node, minlength=len(names))
        self.grams, self.names, self.n, self.total, self.kinds = grams, names, n, total, kinds
        bits = np.log2(total + kinds)
        self.log = np.log2(n).astype(np.float32)
        self.own = (bits[node] - np.log2(n)).astype(np.float32)
        self.escape = (bits - np.log2(kinds)).astype(np.float32)
        if shorter is not None and len(names):
            up = np.searchsorted(shorter.names, _last(names, k - 1))
            ruled_out = np.bincount(node, shorter.n[np.searchsorted(shorter.grams, _last(grams, k))], len(names))
            others = shorter.kinds[up] - kinds
            whole = np.log2(np.maximum(shorter.total[up] - ruled_out + others, 1))
            self.whole = whole.astype(np.float32)
            self.out = np.where(others > 0, whole - np.log2(np.maximum(others, 1)), 0).astype(np.float32)


class _Asked:
    """The distinct grams of some texts, by length of the context: ``grams``, their contexts, the place one byte shorter."""

    def __init__(self, keys: np.ndarray, order: int):
        self.levels: list[tuple] = []
        grams = keys
        for k in range(order, -1, -1):
            names, node = _distinct(grams >> _BITS)
            less, down = _distinct(_last(grams, k)) if k else (grams, None)
            self.levels.append((grams, names, node, down))
            grams = less
        self.levels.reverse()


class _Tables:
    """The languages' trees, by length of the context."""

    def __init__(self, m: Model):
        self.order, self.trees = m.order, []
        for lang in range(len(m.langs)):
            levels: list[_Level] = []
            for k in range(m.order + 1):
                levels.append(_Level(m.keys[lang], m.counts[lang], k, levels[-1] if k else None))
            for level in levels:
                del level.n, level.total
            self.trees.append(levels)
            m.keys[lang] = m.counts[lang] = None

    @staticmethod
    def _code(tree: list[_Level], asked: _Asked) -> np.ndarray:
        """One language's code lengths of the asked grams, shorter contexts first.

        ``below`` holds the code of a gram's byte after an escape from its
        context: bytes seen there are ruled out further down.
        """
        cost = below = log = seen = None
        for level, (grams, names, node, down) in zip(tree, asked.levels, strict=True):
            if down is not None:
                cost, below, log, seen = cost[down], below[down], log[down], seen[down]
            else:
                cost = np.full(len(grams), 8, np.float32)
                below = np.full(len(grams), np.log2(max(256 - level.kinds.sum(), 1)), np.float32)
            if not len(level.names):
                log, seen = np.zeros(len(grams), np.float32), np.zeros(len(grams), bool)
                continue
            at, known = _find(level.names, names)
            at, known = at[node], known[node]
            if down is not None:
                below = np.where(seen, level.whole[at] - log, level.out[at] + below)
            place, seen = _find(level.grams, grams)
            log = level.log[place]
            # A language without this context goes on as its shorter context would.
            cost = np.where(known, np.where(seen, level.own[place], level.escape[at] + below), cost)
        return cost

    def lengths(self, data: list[bytes]) -> np.ndarray:
        """Code length in bits of each text (rows) in each language (columns)."""
        total = np.zeros((len(data), len(self.trees)))
        first = 0
        while first < len(data):
            last, size = first + 1, len(data[first])
            while last < len(data) and size + len(data[last]) <= _WINDOW:
                size += len(data[last])
                last += 1
            self._group(data[first:last], total[first:last])
            first = last
        return total

    def _group(self, data: list[bytes], total: np.ndarray) -> None:
        k = self.order
        begin = np.concatenate([[0], np.cumsum([len(b) + k for b in data])])
        # ``order`` starts before each text, and as many before all, so that every place has symbols before it.
        sym = np.full(begin[-1] + k, _START, np.uint16)
        for at, b in zip(begin, data, strict=False):
            sym[at + 2 * k : at + 2 * k + len(b)] = np.frombuffer(b, np.uint8)
        for lo in range(0, int(begin[-1]), _WINDOW):
            hi = min(lo + _WINDOW, int(begin[-1]))
            key = np.zeros(hi - lo, np.int64)
            for back in range(k, -1, -1):
                key <<= _BITS
                key |= sym[lo + k - back : hi + k - back]
            grams, place = _distinct(key)
            asked, start = _Asked(grams, k), _last(grams, 1) == _START
            first = np.searchsorted(begin, lo, "right") - 1
            last = np.searchsorted(begin, hi, "left")
            edges = np.maximum(begin[first:last], lo) - lo
            for lang, tree in enumerate(self.trees):
                cost = self._code(tree, asked)
                cost[start] = 0
                total[first:last, lang] += np.add.reduceat(cost[place], edges, dtype=np.float64)


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = ORDER,
    rows_per_lang: int = ROWS_PER_LANG,
) -> Model:
    """Byte-context counts per language over a bounded sample of the rows with a language and a text."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter("lang is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, strings in texts(batches):
            by_lang: dict[str, list[bytes]] = {}
            for lang, t in zip(batch.column("lang").to_pylist(), strings, strict=True):
                by_lang.setdefault(lang, []).append(t.encode("utf-8", "surrogatepass"))
            for lang, data in by_lang.items():
                keys, n = np.unique(_grams(data, order), return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(keys), pa.string()), "gram": keys, "n": n})
                yield pa.RecordBatch.from_pydict({"lang": [lang], "gram": pa.array([None], pa.int64()), "n": [0]})

    grams = sample(rows, "lang", "id", rows_per_lang).mapInArrow(run, "lang string, gram long, n long")
    got = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(got.column("lang").to_pylist()))
    known = ~np.asarray(got.column("gram").is_null())
    lang = pc.index_in(got.column("lang"), value_set=pa.array(langs, pa.string())).to_numpy()[known]
    gram, n = got.column("gram").fill_null(0).to_numpy()[known], got.column("n").to_numpy()[known]
    order_of = np.lexsort((gram, lang))
    cut = np.searchsorted(lang[order_of], np.arange(1, len(langs)))
    return Model(langs, np.split(gram[order_of], cut), np.split(n[order_of], cut), order)


def has_letter(text_col: str = "text") -> Column:
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))


def _groups(ask: list[int], strings: list[str]) -> Iterator[list[int]]:
    """Texts to be coded together: about a window's characters, or one longer text."""
    group, size = [], 0
    for i in ask:
        if group and size + len(strings[i]) > _WINDOW:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(strings[i])
    if group:
        yield group


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (any columns of these names are replaced).

    score is the language's posterior under equal priors, from the exact code
    lengths.  Null texts, texts without a letter, and all texts when nothing
    was learned get ``und`` and 0.0.  Equal lengths go to the first name.
    """
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c not in (lang_out, "score")]
    shared = spark.sparkContext.broadcast(model)
    types = [f for f in docs.select(*keep).schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch, strings in texts(batches, text_col):
            names, scores = [UNKNOWN] * len(strings), [0.0] * len(strings)
            ask = [i for i, ok in enumerate(batch.column(len(keep)).to_pylist()) if ok and m.langs]
            for group in _groups(ask, strings):
                bits = m.tables.lengths([strings[i].encode("utf-8", "surrogatepass") for i in group])
                best = bits.argmin(axis=1)
                odds = np.exp2(np.maximum(bits.min(axis=1)[:, None] - bits, -1000)).sum(axis=1)
                for i, b, o in zip(group, best, odds, strict=True):
                    names[i], scores[i] = m.langs[b], 1.0 / float(o)
            columns = [batch.column(c) for c in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*keep, lang_out, "score"]
            )

    schema = StructType([*types, StructField(lang_out, StringType()), StructField("score", DoubleType())])
    letter = next(c for i in range(len(keep) + 1) if (c := f"_letter{i or ''}") not in keep)
    return docs.select(*keep, has_letter(text_col).alias(letter)).mapInArrow(run, schema)


def learned_from(docs: DataFrame) -> Column:
    """The rows that may be learned from: id fold 2 of 4 is held out."""
    return F.coalesce(fold("doc_id", 4) != 2, F.lit(False))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.filter(learned_from(docs)))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
