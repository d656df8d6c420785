"""Merkle manifest of a dataset: a content-addressed DAG of digests, and inclusion proofs by descent.

Every row is a leaf, the SHA-256 of its fields.  The leaves of a tree (say, of
a language) stand in order; runs of ``fanout`` consecutive nodes are hashed
into the nodes of the next level until one is left, the tree's subroot.  The
subroots, in order of their trees, are hashed likewise into the root.

The DAG is stored as records from a digest to its children's digests, those of
``levels`` levels in one row under the digest of the segment's top, equal
segments once.  A request for a leaf starts at the root with the digits of the
leaf's rank: at each node it looks up the record, goes on to the child that
the digit selects and collects the others.  Requests that share a segment go
down it together, one lookup for all, so the root's record is looked up once
however many leaves are asked for.  The path segments found on the way down
are put in reverse, and so give the proof from the leaf up.

Ranks come from a range sort: each sorted task numbers its rows, and the rows
of a tree in the tasks before are added.  A group is a segment, so at most
``fanout ** levels`` nodes meet in one place, whatever the size of a tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.common import fold, table, written

FANOUT = 2
LEVELS = 10
PATH = "array<struct<digit:int,siblings:array<string>>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ROW = (1 << 33) - 1


def field(value: Column) -> Column:
    """A field as a leaf hashes it: ``-`` for null, else its UTF-8 byte count, ``:`` and its text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def _digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def depth(n: int, fanout: int) -> int:
    """The levels over ``n`` leaves."""
    d, width = 0, 1
    while width < n:
        d, width = d + 1, width * fanout
    return d


def _ranked(rows: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """``rows`` (tree, ...) with ``idx``, the rank in the tree from 0, and ``n``, the tree's size; written."""
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = rows.repartitionByRange(tasks, "tree", *order).sortWithinPartitions("tree", *order)
    placed = written(
        ranged.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW)).alias("_at")), f"{name}-sorted"
    )
    # A row per task and tree in it.
    runs = placed.groupBy("_part", "tree").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    of_tree = Window.partitionBy("tree")
    before = F.sum("_rows").over(of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = written(
        runs.select("_part", "tree", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(of_tree).alias("n")), f"{name}-runs"
    )
    ranked = placed.join(runs, ["_part", "tree"]).withColumn("idx", F.col("_at") + F.col("_shift"))
    return written(ranked.drop("_part", "_at", "_shift"), f"{name}-ranked")


RECORDS = "array<struct<digest:string,children:array<string>>>"


def _rise(digests: list[str], fanout: int, steps: int) -> tuple[str, dict[str, list[str]]]:
    """The top over the digests of a segment, and its records."""
    records: dict[str, list[str]] = {}
    for _ in range(steps):
        runs = [digests[i : i + fanout] for i in range(0, len(digests), fanout)]
        digests = [_digest(r) for r in runs]
        records.update(zip(digests, runs, strict=True))
    return digests[0], records


@dataclass
class Forest:
    """Trees over ``leaves`` (tree, n, idx, digest, keep): their ``roots`` (tree, n, digest) and the records of each tier of segments."""

    leaves: DataFrame
    roots: DataFrame
    stores: list[DataFrame]
    fanout: int
    levels: int


def grow(leaves: DataFrame, fanout: int = FANOUT, levels: int = LEVELS, name: str = "merkle") -> Forest:
    """Hashes the trees of ``leaves`` and writes their records, a tier of ``levels`` levels at a time."""
    if fanout < 2 or levels < 1:
        raise ValueError("a fanout of at least 2, and 1 level")
    span, largest = fanout**levels, leaves.agg(F.max("n")).first()[0] or 0
    nodes, stores = leaves.filter("n > 1").select("tree", "n", "idx", "digest"), []
    roots = leaves.filter("n = 1").select("tree", "n", "digest")
    while largest > span ** len(stores):
        tier = len(stores)

        def run(batches: Iterator[pa.RecordBatch], tier: int = tier) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                tops, kept = [], []
                for n, held in zip(batch.column("n").to_pylist(), batch.column("held").to_pylist(), strict=True):
                    top, records = _rise([x["digest"] for x in held], fanout, min(levels, depth(n, fanout) - tier * levels))
                    tops.append(top)
                    kept.append([{"digest": d, "children": c} for d, c in records.items()])
                records_type = pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))]))
                columns = [*(batch.column(c) for c in ("tree", "n", "idx")), pa.array(tops, pa.string()), pa.array(kept, records_type)]
                yield pa.RecordBatch.from_arrays(columns, ["tree", "n", "idx", "digest", "records"])

        segments = nodes.groupBy("tree", "n", F.expr(f"idx div {span}").alias("idx")).agg(
            F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("held")
        )
        store = written(segments.mapInArrow(run, f"tree string, n long, idx long, digest string, records {RECORDS}"), f"{name}-records")
        stores.append(store)
        done, more = F.col("n") <= span ** (tier + 1), F.col("n") > span ** (tier + 1)
        roots = roots.unionByName(store.filter(done).select("tree", "n", "digest"))
        nodes = store.filter(more).select("tree", "n", "idx", "digest")
    return Forest(leaves, written(roots, f"{name}-roots"), stores, fanout, levels)


def _paths(found: list[list[tuple[int, list[str]]]]) -> pa.Array:
    """Paths as an Arrow column."""
    ends, digits, cuts, siblings = [0], [], [0], []
    for path in found:
        for digit, others in path:
            digits.append(digit)
            siblings += others
            cuts.append(len(siblings))
        ends.append(len(digits))
    held = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(siblings, pa.string()))
    steps = pa.StructArray.from_arrays([pa.array(digits, pa.int32()), held], ["digit", "siblings"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps)


def _down(top: str, records: dict[str, list[str]], place: int, fanout: int, steps: int) -> tuple[str, list[tuple[int, list[str]]]]:
    """From a segment's top to the node at ``place`` below it: the node, and the others passed, lowest first."""
    node, passed = top, []
    for step in range(steps - 1, -1, -1):
        digit, children = place // fanout**step % fanout, records[node]
        node = children[digit]
        passed.append((digit, children[:digit] + children[digit + 1 :]))
    return node, passed[::-1]


def _descend(at: DataFrame, store: DataFrame, asked: DataFrame, forest: Forest, tier: int) -> DataFrame:
    """A tier down: of the segments reached (tree, n, idx, digest, start, path) the asked nodes, with ``keep`` if they have it."""
    fanout, levels = forest.fanout, forest.levels
    span = fanout**levels
    records = store.select("digest", "records").dropDuplicates(["digest"])
    reached = at.join(records, "digest").join(asked, ["tree", "idx"])
    kept = [f for f in asked.schema["asked"].dataType.elementType.fields if f.name == "keep"]
    schema = StructType([*StructType.fromDDL(f"tree string, n long, idx long, digest string, start string, path {PATH}").fields, *kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, top = batch.column("n")[i].as_py(), batch.column("digest")[i].as_py()
                found = {r["digest"]: r["children"] for r in batch.column("records")[i].as_py()}
                above = [(p["digit"], p["siblings"]) for p in batch.column("path")[i].as_py()]
                wanted = batch.column("asked").slice(i, 1).flatten()
                idx = wanted.field("idx")
                steps = min(levels, depth(n, fanout) - tier * levels)
                ends = [_down(top, found, x % span, fanout, steps) for x in idx.to_pylist()]
                same = [pa.array([batch.column(c)[i].as_py()] * len(ends), t) for c, t in (("tree", pa.string()), ("n", pa.int64()), ("start", pa.string()))]
                columns = [*same[:2], idx, pa.array([e[0] for e in ends], pa.string()), same[2], _paths([e[1] + above for e in ends])]
                yield pa.RecordBatch.from_arrays([*columns, *(wanted.field("keep") for _ in kept)], schema.names)

    return reached.select("tree", "n", "digest", "start", "path", "records", "asked").mapInArrow(run, schema)


def paths(forest: Forest, starts: DataFrame, wanted: Column | None = None) -> DataFrame:
    """(tree, n, idx, digest, start, path, keep) of the ``wanted`` leaves (all by default), descended from ``starts``.

    ``starts`` (tree, n, digest, path) are the trees' roots with the path above
    them; ``path`` goes from the leaf up.
    """
    span = forest.fanout**forest.levels
    leaves = forest.leaves.filter(wanted) if wanted is not None else forest.leaves
    starts = starts.withColumn("start", F.col("digest")).withColumn("idx", F.lit(0).cast("long"))
    below = None
    for tier in range(len(forest.stores) - 1, -1, -1):
        here = starts.filter((F.col("n") > span**tier) & (F.col("n") <= span ** (tier + 1)))
        at = here if below is None else here.unionByName(below)
        ask = leaves.select("tree", "idx", "keep") if tier == 0 else leaves.select("tree", F.expr(f"idx div {span**tier}").alias("idx")).distinct()
        asked = ask.groupBy("tree", F.expr(f"idx div {span}").alias("at")).agg(
            F.collect_list(F.struct(*[c for c in ask.columns if c != "tree"])).alias("asked")
        )
        below = _descend(at, forest.stores[tier], asked.withColumnRenamed("at", "idx"), forest, tier)
    alone = leaves.filter("n = 1").select("tree", "idx", "digest", "keep").join(starts.drop("idx", "digest"), "tree")
    alone = alone.select("tree", "n", "idx", "digest", "start", "path", "keep")
    return alone if below is None else below.unionByName(alone)


@dataclass
class Manifest:
    """``root`` of a dataset (None: no rows), the trees' forest, and that of their subroots."""

    root: str | None
    trees: Forest
    top: Forest


def manifest(
    docs: DataFrame,
    fields: Sequence[str | Column],
    tree: Column,
    order: Sequence[Column],
    keep: dict[str, Column] | None = None,
    fanout: int = FANOUT,
    levels: int = LEVELS,
) -> Manifest:
    """The manifest of ``docs``: a leaf per row, trees by the text of ``tree`` (null first, then bytewise).

    In a tree, leaves ascend by ``order`` (nulls first), then by digest, so equal
    rows are leaves side by side.  ``keep`` holds columns by which proofs name
    their leaves.
    """
    key = tree.cast("string")
    columns = [F.col(c) if isinstance(c, str) else c for c in fields]
    by = {f"o{i}": c for i, c in enumerate(order)}
    rows = docs.select(
        F.when(key.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), key)).alias("tree"),
        leaf(*columns).alias("digest"),
        F.struct(*[c.alias(k) for k, c in (keep or {"leaf": F.lit(None).cast("string")}).items()]).alias("keep"),
        F.struct(*[c.alias(k) for k, c in by.items()]).alias("by"),
    )
    # Written before the sort, which looks at its input twice: texts are hashed once.
    rows = written(rows, "merkle-leaves")
    leaves = _ranked(rows, ["by", "digest"], "merkle").drop("by")
    trees = grow(leaves, fanout, levels)
    tops = trees.roots.select(F.lit("").alias("tree"), F.col("digest"), F.struct("tree", "n").alias("keep"))
    top = grow(_ranked(tops, ["keep.tree"], "merkle-top"), fanout, levels, "merkle-top")
    root = top.roots.select("digest").first()
    return Manifest(root["digest"] if root else None, trees, top)


def prove(m: Manifest, wanted: Column | None = None) -> DataFrame:
    """(keep, leaf, subroot, root, proof) of the wanted leaves (a condition on ``keep``; all by default).

    ``proof`` has a step for each level from the leaf to the root: the node's
    digit in its run, and the digests of the run's other nodes.
    """
    empty = F.array().cast(PATH)
    starts = m.top.roots.select("tree", "n", "digest", empty.alias("path"))
    subroots = paths(m.top, starts).select("keep.tree", "keep.n", "digest", "path")
    found = paths(m.trees, written(subroots, "merkle-subroots"), wanted)
    return found.select("keep", F.col("digest").alias("leaf"), F.col("start").alias("subroot"), F.lit(m.root).cast("string").alias("root"), F.col("path").alias("proof"))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def step(node: Column, p: Column) -> Column:
        others, digit = p["siblings"], p["digit"]
        return F.sha2(F.concat(F.array_join(F.slice(others, 1, digit), ""), node, F.array_join(F.slice(others, digit + 1, F.size(others)), "")), 256)

    return F.aggregate(proof, leaf, step)


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof."""
    return F.sha2(F.array_join(F.flatten(F.transform(proof, lambda p: p["siblings"])), ""), 256)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, and whether a tampered copy of some still leads to the root.

    A null field is hashed as ``-``; a document without an id is never
    tampered with; repeated rows are leaves of their own; an empty table gives
    no rows; other columns are not looked at.
    """
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.coalesce(fold("doc_id", 7) == 0, F.lit(False)) & F.col("n_chars").isNotNull()
    claimed = F.when(tampered, leaf(*[more if c == "n_chars" else F.col(c) for c in FIELDS]))
    m = manifest(docs, FIELDS, F.col("lang"), [F.col("doc_id")], {"doc_id": F.col("doc_id"), "claimed": claimed})
    found = prove(m).withColumn("folded_root", folded(F.coalesce("keep.claimed", "leaf"), F.col("proof")))
    return found.select(
        "keep.doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def oracle() -> str:
    """op12 in SQL: levels by recursion, a proof by the neighbours of the rank's halves."""
    part = lambda c: f"case when {c} is null then '-' else concat(strlen(cast({c} as varchar)), ':', {c}) end"
    whole = lambda chars: "sha256(concat(" + ", ".join(part(chars if c == "n_chars" else c) for c in FIELDS) + "))"
    # crc32 of the id's decimal text, bit by bit.
    shifted = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda s: cast(ascii(s) as bigint))), lambda c, b: {shifted}), 4294967295)"
    rise = """select {key} level + 1, idx // 2, (n + 1) // 2, sha256(concat(digest, coalesce(after, '')))
  from (select *, lead(digest) over ({by} order by idx) as after from {nodes} where n > 1) x where idx % 2 = 0"""
    step = "case when s.digest is null then 'N' when {place} % 2 = 1 then concat('L', s.digest) else concat('R', s.digest) end"
    return f"""
with recursive leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as rank, count(*) over (partition by lang) as n
  from (select doc_id, lang, {whole('n_chars')} as leaf,
          case when {crc} % 7 = 0 and n_chars is not null then {whole('(n_chars + 1)')} end as claimed from documents) d
), nodes(lang, level, idx, n, digest) as (
  select lang, 0, rank, n, leaf from leaves union all {rise.format(key='lang,', by='partition by lang', nodes='nodes')}
), trees as (
  select lang, digest as subroot, level as height, row_number() over (order by lang nulls first) - 1 as place, count(*) over () as n_trees
  from nodes where n = 1
), tops(level, idx, n, digest) as (
  select 0, place, n_trees, subroot from trees union all {rise.format(key='', by='', nodes='tops')}
), numbered as (select *, row_number() over (order by lang nulls first, rank) as id from leaves
), steps as (
  select l.id, k.level, {step.format(place='(l.rank >> k.level)')} as step
  from numbered l
  join (select distinct lang, level from nodes where n > 1) k on k.lang is not distinct from l.lang
  left join nodes s on s.lang is not distinct from l.lang and s.level = k.level and s.idx = xor(l.rank >> k.level, 1)
), top_steps as (
  select t.lang, k.level, {step.format(place='(t.place >> k.level)')} as step
  from trees t join (select distinct level from tops where n > 1) k on true
  left join tops s on s.level = k.level and s.idx = xor(t.place >> k.level, 1)
), proofs as (
  select l.doc_id, l.leaf, l.claimed, t.subroot,
    list_concat(coalesce((select list(step order by level) from steps s where s.id = l.id), []),
                coalesce((select list(step order by level) from top_steps s where s.lang is not distinct from l.lang), [])) as steps
  from numbered l join trees t on t.lang is not distinct from l.lang
), roots as (select digest as root from tops where n = 1),
found as (
  select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) as proof_sha256,
    list_reduce(list_prepend(coalesce(claimed, leaf), steps),
      lambda a, s: sha256(case s[1] when 'L' then concat(s[2:], a) when 'R' then concat(a, s[2:]) else a end)) as folded_root
  from proofs, roots
)
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified from found"""
