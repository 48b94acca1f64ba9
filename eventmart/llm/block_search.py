"""Exact top-k search by inner product: block-at-a-time pruning.

A vector is a document whose terms are its components, with whole-number weights of either sign.
Documents are put in an order that keeps like ones together, and cut into ranges of blocks. The
maxima (for negative query weights, the minima) of a block's terms, weighted and summed over a
query's terms, bound every score in the block. Per query, blocks are visited in the order of their
bounds and scored through their forward index, the matrix of their weights, until the bounds fall
below the k-th best score so far. Blocks whose bound equals it are still visited, for ties go by id.

A query starts in the range it lies in itself, which gives a first k-th score. The bounds of whole
ranges then say which others it must visit, and inside a range the bounds of blocks. Queries and
ranges meet in groups of bounded size. Results are exact whatever the order; how much is pruned
depends on the vectors: much for clustered ones, nothing for random directions, where every bound
is far above every score.

Defined cases: null ids, and vectors that are null or hold nulls or non-finite numbers, take no
part; a component that a vector lacks weighs 0; an empty vector scores 0; repeated rows count once;
rows of one id are one document, whose score with another is the best of their vectors; ties go to
the smaller id; weights and scores beyond a long are its bound; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.llm.shared import table
from eventmart.session import settle

BEST, SCALE = 5, 256
# Documents of a block and of a range; queries that meet a range, and ranges that queries meet.
BLOCK, RANGE, TURN, RANGES = 64, 4096, 8192, 1024
# Documents by whose directions the others are ordered: those of least digest.
PIVOTS = 256
LONG = 2**63 - 1


def weighted(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, weights, digest) of the rows that take part, each once: ``floor(scale * x)``."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col(key).isNotNull() & v.isNotNull() & ~odd)
    weights = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    rows = rows.select(F.col(key).cast("long").alias("id"), weights.alias("weights"))
    rows = rows.withColumn("digest", F.md5(F.concat_ws(",", "weights")))
    return rows.groupBy("id", "digest").agg(F.any_value("weights").alias("weights"))


def matrix(column: pa.ChunkedArray | pa.Array, width: int = 0) -> np.ndarray:
    """Weights as rows, with zeros up to the longest or to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, int)
    width = max(width, int(lengths.max(initial=0)), 1)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def both(left: pa.ChunkedArray, right: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Two sets of weights in a type whose products are exact: doubles if all sums of products
    are whole numbers below 2 ** 53, else Python's numbers."""
    a = matrix(left)
    b = matrix(right, a.shape[1])
    a = np.pad(a, ((0, 0), (0, b.shape[1] - a.shape[1])))
    top = [max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (a, b)]
    kind = np.float64 if top[0] * top[1] * a.shape[1] < 2**53 else object
    return a.astype(kind), b.astype(kind)


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, within the bounds of a long."""
    scores = queries @ vectors.T
    return scores if scores.dtype != object else np.clip(scores, -LONG - 1, LONG)


def upper_bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each query and block, the sum over terms of the most that a document there can add."""
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def best_in_range(
    queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, floor: np.ndarray, most: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, scores) of up to ``most`` best ids of a range that reach a query's ``floor``.

    Rounds of 1, 2, 4, ... blocks per query, the highest bounds first; in a round, queries that
    want the same block are scored together.
    """
    starts = np.arange(0, len(vectors), BLOCK)
    low = np.minimum.reduceat(vectors, starts, axis=0)
    high = np.maximum.reduceat(vectors, starts, axis=0)
    bounds = upper_bounds(queries, low, high)
    order = np.argsort(-bounds, axis=1, kind="stable")
    bounds = np.take_along_axis(bounds, order, 1)
    # An id that repeats fills several places, so as many more are held.
    keep = most * int(np.unique(ids, return_counts=True)[1].max(initial=1))
    scores = np.full((len(queries), keep), -np.inf, vectors.dtype)
    names = np.zeros((len(queries), keep), np.int64)
    kth = floor.copy()
    active, at, step = np.arange(len(queries)), 0, 1
    while at < len(starts):
        active = active[bounds[active, at] >= kth[active]]
        if not len(active):
            break
        wanted = order[active, at : at + step]
        allowed = bounds[active, at : at + step] >= kth[active, None]
        for block in np.unique(wanted[allowed]):
            asking = active[((wanted == block) & allowed).any(1)]
            here = slice(starts[block], starts[block] + BLOCK)
            found = products(queries[asking], vectors[here])
            reach = found.max(1) >= kth[asking]
            asking, found = asking[reach], found[reach]
            if not len(asking):
                continue
            each = np.broadcast_to(ids[here], found.shape)
            all_scores = np.concatenate([scores[asking], found], 1)
            all_names = np.concatenate([names[asking], each], 1)
            first = np.lexsort((all_names, -all_scores), axis=1)[:, :keep]
            scores[asking] = np.take_along_axis(all_scores, first, 1)
            names[asking] = np.take_along_axis(all_names, first, 1)
            kth[asking] = np.maximum(floor[asking], scores[asking, -1])
        at, step = at + step, step * 2
    for q in range(len(queries)):
        enough = (scores[q] >= floor[q]) & (scores[q] > -np.inf)
        near, value = names[q][enough], scores[q][enough]
        _, once = np.unique(near, return_index=True)  # the first of an id is its best
        once = np.sort(once)[:most]
        yield q, near[once], value[once]


def _order(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Rows with ``key``: the two pivots whose directions they are nearest to."""
    length = np.sqrt((pivots**2).sum(1))
    pivots = pivots / np.where(length, length, 1)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column(1), pivots.shape[1]).astype(float)
            near = vectors[:, : pivots.shape[1]] @ pivots.T
            best = np.argsort(-near, axis=1, kind="stable")[:, :2]
            key = pa.array(best[:, 0] * len(pivots) + best[:, -1], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, key], names=names)

    names = ["id", "weights", "digest", "key"]
    schema = "id long, weights array<long>, digest string, key long"
    return rows.select(names[:3]).mapInArrow(run, schema)


def place(rows: DataFrame) -> DataFrame:
    """(range, place, id, weights, digest): documents in order, cut into ranges.

    Pivots are a bounded sample; every document is placed.
    """
    some = rows.orderBy("digest", "id").limit(PIVOTS).collect()
    width = max([1, *(len(r["weights"]) for r in some)])
    pivots = np.zeros((len(some) or 1, width))
    for i, row in enumerate(some):
        pivots[i, : len(row["weights"])] = row["weights"]
    keyed = settle(_order(rows, pivots))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "digest", "id"]
    dealt = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            numbers = np.arange(at, at + batch.num_rows)
            at += batch.num_rows
            ranges = pa.array((part << 32) + numbers // RANGE, pa.int64())
            places = pa.array(numbers % RANGE, pa.int64())
            columns = [ranges, places, *batch.columns]
            yield pa.RecordBatch.from_arrays(columns, names=["range", "place", "id", "weights", "digest"])

    schema = "range long, place long, id long, weights array<long>, digest string"
    return settle(dealt.select("id", "weights", "digest").mapInArrow(run, schema))


def _summaries(placed: DataFrame) -> DataFrame:
    """(range, low, high): least and greatest weight of each term in a range."""

    def run(rows: pa.Table) -> pa.Table:
        vectors = matrix(rows["weights"])
        ends = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (vectors.min(0), vectors.max(0))]
        return pa.table([rows["range"].slice(0, 1), *ends], names=["range", "low", "high"])

    schema = "range long, low array<long>, high array<long>"
    return placed.select("range", "weights").groupBy("range").applyInArrow(run, schema)


def _floors(column: pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    """First k-th scores; without one, nothing is below."""
    return np.array([-np.inf if x is None else x for x in column.to_pylist()], kind)


def _meet(members: DataFrame, asked: DataFrame, most: int) -> DataFrame:
    """(digest, id, score): the best of each (range, digest, weights, floor) in its range.

    The queries of a range are dealt to turns of bounded size; its documents go to each turn.
    """
    turns = asked.groupBy("range").agg(F.ceil(F.count("*") / TURN).alias("turns"))
    turns = settle(turns)
    own = F.pmod(F.xxhash64("digest"), F.col("turns"))
    asked = asked.join(turns, "range").withColumn("turn", own).drop("turns")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1))
    members = members.join(turns, "range").withColumn("turn", every)
    members = members.select("range", "turn", "place", "id", "weights")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        digest, near, score = [], [], []
        if left.num_rows and right.num_rows:
            left = left.sort_by("place")
            vectors, queries = both(left["weights"], right["weights"])
            floor = _floors(right["floor"], vectors.dtype)
            names = right["digest"].to_pylist()
            for q, ids, values in best_in_range(queries, vectors, left["id"].to_numpy(), floor, most):
                digest += [names[q]] * len(ids)
                near += ids.tolist()
                score += [int(v) for v in values]
        return pa.table(
            {"digest": pa.array(digest, pa.string()), "id": pa.array(near, pa.int64()),
             "score": pa.array(score, pa.int64())}
        )

    met = members.groupBy("range", "turn").cogroup(asked.groupBy("range", "turn"))
    return met.applyInArrow(run, "digest string, id long, score long")


def _to_visit(summaries: DataFrame, queries: DataFrame) -> DataFrame:
    """(range, digest): other ranges than its own whose bound reaches a query's floor.

    Summaries and queries meet in groups of bounded size.
    """
    parts = max(1, -(-summaries.count() // RANGES))
    turns = max(1, -(-queries.count() // TURN))

    def dealt(rows: DataFrame, key: str, own: str, n: int, other: str, m: int) -> DataFrame:
        rows = rows.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n)))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    left = dealt(summaries, "range", "part", parts, "turn", turns)
    right = dealt(queries, "digest", "turn", turns, "part", parts)

    def run(known: pa.Table, asked: pa.Table) -> pa.Table:
        ranges, names = [], []
        if known.num_rows and asked.num_rows:
            ends = pa.chunked_array([*known["low"].chunks, *known["high"].chunks])
            ends, queries = both(ends, asked["weights"])
            bounds = upper_bounds(queries, *np.split(ends, 2))
            floor = _floors(asked["floor"], bounds.dtype)
            there = known["range"].to_numpy()
            visit = (bounds >= floor[:, None]) & (asked["home"].to_numpy()[:, None] != there)
            digests = asked["digest"].to_pylist()
            for q, r in zip(*np.nonzero(visit)):
                ranges.append(int(there[r]))
                names.append(digests[q])
        return pa.table({"range": pa.array(ranges, pa.int64()), "digest": pa.array(names, pa.string())})

    met = left.groupBy("part", "turn").cogroup(right.groupBy("part", "turn"))
    return met.applyInArrow(run, "range long, digest string")


def _first(found: DataFrame, group: str, name: str, most: int) -> DataFrame:
    """The ``most`` best ``name`` of each ``group``, with their rank."""
    once = found.groupBy(group, name).agg(F.max("score").alias("score"))
    best = Window.partitionBy(group).orderBy(F.desc("score"), name)
    return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)


def search(
    rows: DataFrame, is_query: str, key: str, vector: str, best: int = BEST, scale: int = SCALE
) -> DataFrame:
    """(query_id, rank, vec_id, score): the highest inner products of each row for which
    ``is_query``, an expression over ``id``, holds, with all rows of other ids."""
    rows = settle(weighted(rows, key, vector, scale))
    most = best + 1  # one may be the query itself
    # Of equal vectors, those with the smallest ids come first in every answer.
    alike = Window.partitionBy("digest").orderBy("id")
    few = rows.withColumn("copy", F.row_number().over(alike)).where(F.col("copy") <= most)
    placed = place(few.drop("copy"))
    asking = settle(rows.where(is_query).select(F.col("id").alias("query_id"), "digest"))
    asked = asking.select("digest").distinct()
    homes = placed.join(asked, "digest").groupBy("digest").agg(
        F.min("range").alias("range"), F.any_value("weights").alias("weights")
    )
    no_floor = F.lit(None).cast("long").alias("floor")
    homes = settle(homes.select("range", "digest", "weights", no_floor))
    near = settle(_meet(placed, homes, most))
    floors = _first(near, "digest", "id", most).where(F.col("rank") == most)
    floors = floors.select("digest", F.col("score").alias("floor"))
    started = homes.drop("floor").withColumnRenamed("range", "home").join(floors, "digest", "left")
    started = settle(started)
    visits = _to_visit(settle(_summaries(placed)), started)
    visits = settle(visits.join(started.drop("home"), "digest"))
    far = _meet(placed, visits.select("range", "digest", "weights", "floor"), most)
    near = settle(_first(near.unionByName(far), "digest", "id", most).drop("rank"))
    pairs = asking.join(near.withColumnRenamed("id", "vec_id"), "digest").where("vec_id <> query_id")
    return _first(pairs, "query_id", "vec_id", best).select("query_id", "rank", "vec_id", "score")


def op11_search_top_products(spark: SparkSession, folder: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector."""
    rows = table(spark, folder, "embeddings", "vec_id", "embedding")
    return search(rows, "id % 50 = 0", "vec_id", "embedding")


SQL = """
WITH rows AS (
       SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS w
       FROM embeddings
       WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
         AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
     scored AS (
       SELECT q.vec_id AS query_id, c.vec_id,
              max(coalesce(list_sum([coalesce(p[1] * p[2], 0) FOR p IN list_zip(q.w, c.w)]), 0)) AS score
       FROM rows q JOIN rows c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
       GROUP BY 1, 2),
     ranked AS (
       SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
       FROM scored)
SELECT query_id, place::INT AS rank, vec_id, score::BIGINT AS score FROM ranked WHERE place <= 5
"""
