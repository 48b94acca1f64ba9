"""Filter interaction audit: forward-backward path counting on the lattice of applied filters.

A state is the set of filters applied so far; an edge applies one more. An order of the filters is
a path from the empty state to the full one. Counting paths forwards gives how many orders reach a
state, backwards how many leave it; their product over an edge is the number of orders that use it.

The corpus enters once: each document is reduced to the mask of the filters it fails, and masks are
counted per part. What a filter removes on an edge follows from those counts, so each edge is
evaluated once instead of once per order. Weighting an edge's removals by its orders gives the
Shapley share of its filter; the steps of every order are read from the same edges.

Defined cases: a null text is empty; a null part is the empty string; a null id is neither smaller
nor larger than another, so its text repeats none; rows of one id repeat each other's text only
through smaller ids; an id counts as good or toxic if any of its labels says so; null ids have no
label; an empty table has no parts and gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventmart.llm.shared import binary_texts, table

# Paths are listed one by one, so their number bounds the filters: eight have 40,320 orders.
MOST_FILTERS = 8
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ODD = re.compile(rb"[#$%&*|]")
# Bytes inside a character: all but its first.
INSIDE = bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class Edge:
    """Applying filter number ``bit`` in ``state``, and the orders before and behind it."""

    state: int
    bit: int
    reaching: int
    leaving: int


def _may_follow(state: int, bit: int, needs: Sequence[int]) -> bool:
    return not state >> bit & 1 and state & needs[bit] == needs[bit]


def _needs(names: Sequence[str], after: Mapping[str, Sequence[str]]) -> list[int]:
    """Per filter, the filters that must come before it, as a mask."""
    place = {name: i for i, name in enumerate(names)}
    return [sum(1 << place[b] for b in set(after.get(name, ()))) for name in names]


def lattice(names: Sequence[str], after: Mapping[str, Sequence[str]] | None = None) -> list[Edge]:
    """The edges that some order uses. ``after`` names what must come before a filter.

    Forward: one order reaches the empty state, and a state is reached by what reaches its
    predecessors. Backward: the same from the full state.
    """
    if not 0 < len(names) <= MOST_FILTERS or len(set(names)) < len(names):
        raise ValueError(f"1 to {MOST_FILTERS} filters of different names are needed")
    needs, full = _needs(names, after or {}), (1 << len(names)) - 1
    bits = range(len(names))
    reaching, leaving = {0: 1}, {full: 1}
    for state in range(full + 1):  # a larger set is a larger number
        for bit in bits:
            if state in reaching and _may_follow(state, bit, needs):
                target = state | 1 << bit
                reaching[target] = reaching.get(target, 0) + reaching[state]
    for state in range(full, -1, -1):
        for bit in bits:
            if _may_follow(state, bit, needs) and state | 1 << bit in leaving:
                leaving[state] = leaving.get(state, 0) + leaving[state | 1 << bit]
    return [
        Edge(state, bit, reaching[state], leaving[state | 1 << bit])
        for state in sorted(reaching)
        for bit in bits
        if _may_follow(state, bit, needs) and state | 1 << bit in leaving
    ]


def orders(names: Sequence[str], edges: Sequence[Edge]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """(order, its edges as (state, bit)) of every path through the lattice."""
    out: dict[int, list[int]] = {}
    for e in edges:
        out.setdefault(e.state, []).append(e.bit)
    full = (1 << len(names)) - 1

    def walk(state: int, path: list[tuple[int, int]]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        if state == full:
            yield "".join(names[bit] for _, bit in path), path
        for bit in out.get(state, ()):
            yield from walk(state | 1 << bit, [*path, (state, bit)])

    yield from walk(0, [])


def audit(
    counts: DataFrame,
    names: Sequence[str],
    lost: Sequence[str] = (),
    after: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """A row per part, order and step, from (part, mask, n, ``lost``...) counts of documents.

    Bit i of a mask says that filter i fails. ``lost`` are further counts, reported for what a
    step removes as ``<name>_lost``. No part without counts appears.
    """
    edges = lattice(names, after)
    used: dict[tuple[int, int], list[tuple[str, int]]] = {}
    for order, path in orders(names, edges):
        for step, edge in enumerate(path, 1):
            used.setdefault(edge, []).append((order, step))
    as_struct = [
        F.struct(
            F.lit(e.state).alias("state"),
            F.lit(e.bit).alias("bit"),
            F.lit(1 << e.bit).alias("own"),
            F.lit(e.reaching * e.leaving).cast("long").alias("paths"),
        )
        for e in edges
    ]
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    earlier = F.col("mask").bitwiseAND(F.col("state")) != 0
    only = F.col("mask") == F.col("own")

    def total(condition: Column, name: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(name)).otherwise(F.lit(0).cast("long")))

    # A part has at most 256 masks, and the lattice at most 1,024 edges.
    each = counts.withColumn("edge", F.explode(F.array(*as_struct)))
    each = each.select(*counts.columns, "edge.*")
    on_edge = each.groupBy("part", "state", "bit", "paths").agg(
        total(~fails & ~earlier).alias("kept"),
        total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(only).alias("unique_fails"),
        *[total(fails & ~earlier, c).alias(f"{c}_lost") for c in lost],
    )
    weighted = F.sum(F.col("removed") * F.col("paths"))
    share = weighted.over(Window.partitionBy("part", "bit"))
    listed = counts.sparkSession.createDataFrame(
        [(*edge, steps) for edge, steps in used.items()],
        "state int, bit int, steps array<struct<filter_order: string, step: int>>",
    )
    rows = on_edge.withColumn("shapley", share).join(F.broadcast(listed), ["state", "bit"])
    own = ["kept", "removed", "redundant", "unique_fails", *[f"{c}_lost" for c in lost], "shapley"]
    return rows.select("part", F.explode("steps").alias("at"), *own).select(
        "part", "at.filter_order", "at.step", *own
    )


def text_mask(text: bytes) -> int:
    """What a text in UTF-8 fails: bit 0 for few words, then few distinct words, many capitals,
    and odd signs."""
    words = text.split()  # bytes are split at these six: blank, \t, \n, \v, \f, \r
    n_chars = len(text.translate(None, INSIDE))
    n_capitals = len(text) - len(text.translate(None, CAPITALS))
    fails = (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * n_capitals > 3 * n_chars,
        _ODD.search(text) is not None,
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def masked(docs: DataFrame, part: str, mask: Callable[[bytes], int]) -> DataFrame:
    """(doc_id, part, digest, own): a text as its digest and the filters that it fails."""
    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text")
    schema = StructType([*rows.schema[:2], *StructType.fromDDL("digest binary, own int")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = binary_texts(batch.column(2))
            digests = pa.array([hashlib.sha256(t).digest() for t in found], pa.binary())
            masks = pa.array([mask(t) for t in found], pa.int32())
            kept = [batch.column(0), batch.column(1), digests, masks]
            yield pa.RecordBatch.from_arrays(kept, names=schema.names)

    return rows.mapInArrow(run, schema)


def masks(
    docs: DataFrame, labels: DataFrame, part: str, mask: Callable[[bytes], int], filters: int
) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail, the last of which is
    that a smaller id has the same text; ``good`` and ``toxic`` count those with such a label.

    ``mask`` gives the first ``filters`` bits of a text. Texts are reduced to digests in the
    tasks that read them, and rows are added up before each shuffle, so copies of one text, however
    many, reach a task as a few lines: one per part and label, with the smallest id of each.
    """
    rows = masked(docs, part, mask)
    rows = rows.groupBy("doc_id", "digest", "part", "own").agg(F.count("*").alias("rows"))
    flags = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        *[F.max(F.coalesce(flag, F.lit(False))).alias(name) for name, flag in flags.items()]
    )
    known = known.select(F.col("doc_id").cast("string").alias("key"), "good", "toxic")
    # Rows without an id match no label; keys of their own keep them out of one task.
    none = F.concat(F.lit("none "), F.hex("digest"))
    rows = rows.withColumn("key", F.coalesce(F.col("doc_id").cast("string"), none))
    rows = rows.join(known, "key", "left").withColumns(
        {name: F.coalesce(name, F.lit(False)) for name in flags}
    )
    alike = rows.groupBy("digest", "part", "own", "good", "toxic").agg(
        F.sum("rows").alias("rows"),
        F.min("doc_id").alias("least"),
        F.min_by("rows", "doc_id").alias("at_least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("rows")).otherwise(0)).alias("nameless"),
    )
    first = F.min("least").over(Window.partitionBy("digest"))
    is_first = F.coalesce(F.col("least") == first, F.lit(False))
    alone = F.col("nameless") + F.when(is_first, F.col("at_least")).otherwise(0)
    alike = alike.withColumn("alone", alone)
    repeated = 1 << filters
    split = F.array(
        F.struct(F.col("own").alias("mask"), F.col("alone").alias("n")),
        F.struct((F.col("own") + repeated).alias("mask"), (F.col("rows") - F.col("alone")).alias("n")),
    )
    split = alike.select("part", "good", "toxic", F.explode(split).alias("at"))
    split = split.select("part", "good", "toxic", "at.mask", "at.n").where("n > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in flags],
    )


def op12_audit_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Five filters in all their orders over every document, per language."""
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    labels = table(spark, folder, "labels", "doc_id", "quality", "toxic")
    counts = masks(docs, labels, "lang", text_mask, 4)
    return audit(counts, "ABCDE", ["good", "toxic"])


SQL = r"""
WITH texts AS (
       SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
     words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
     marked AS (
       SELECT part,
              len(w) < 200 AS a,
              100 * len(list_distinct(w)) < 50 * len(w) AS b,
              100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) AS c,
              regexp_matches(t, '[#$%&*|]') AS d,
              coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e,
              doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
              doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS bad
       FROM words),
     masks AS (
       SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask,
              count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS toxic
       FROM marked GROUP BY ALL),
     f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(l, bit)),
     orders AS (
       SELECT f1.l || f2.l || f3.l || f4.l || f5.l AS filter_order,
              [f1.bit, f2.bit, f3.bit, f4.bit, f5.bit] AS bits
       FROM f f1, f f2, f f3, f f4, f f5
       WHERE f1.bit + f2.bit + f3.bit + f4.bit + f5.bit = 31
         AND len(list_distinct([f1.bit, f2.bit, f3.bit, f4.bit, f5.bit])) = 5),
     steps AS (
       SELECT filter_order, i AS step, bits[i] AS bit,
              coalesce(list_sum(bits[1:i - 1]), 0)::INT AS before
       FROM orders, range(1, 6) r(i)),
     counted AS (
       SELECT part, filter_order, step::INT AS step, bit,
              coalesce(sum(n) FILTER (mask & (bit | before) = 0), 0) AS kept,
              coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS removed,
              coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0) AS redundant,
              coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
              coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS good_lost,
              coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS toxic_lost
       FROM masks, steps GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""
