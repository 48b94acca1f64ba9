"""Approximate nearest neighbours: multiprobe p-stable hashing.

A vector's bucket in a table is the cells that a few random projections of it fall into. A query
visits its own bucket and then perturbed ones, in the order of how likely a neighbour lies there:
by the sum of squares of the distances to the cell borders that a perturbation crosses. What the
tables give is merged and ranked by exact distance.

Buckets are grouped into cells that one task can hold. A query goes to a cell once, with the
buckets that it visits there. Cells that are too full, or that too many queries visit, are split
into blocks of both. Equal vectors are one entry that carries its smallest ids.

How many projections and visits are needed depends on the data. Both are set from a bounded
sample of queries whose true neighbours are found by a scan: as many projections as still reach
the wanted recall within the allowed visits. A query that finds too few neighbours is scanned.

Defined cases: a null id, and vectors that are null, zero, or hold nulls or non-finite numbers, take
no part; vectors of each length are searched on their own; repeated rows count once; rows of one id
are one neighbour, at the distance of the nearest of their vectors; a distance beyond doubles is
infinite; equal distances go by id; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.llm.shared import random_key, table
from eventmart.session import settle

NEIGHBOURS = 10
TABLES = 2
# Width of a projection's cells, in standard deviations of the projections.
WIDTH = 3.0
# Entries of a bucket on average, of a cell, and the most that a task takes of either side.
BUCKET, CELL, BLOCK = 64, 2048, 4096
# Bounds of the sample, the wanted recall on it, and the most visits over all tables.
SAMPLE, SAMPLE_VECTORS, RECALL, VISITS = 60, 2000, 0.96, 512
SEED = 11
# Places along a projection are cut off here; components above are scaled before they are squared.
PLACES, LARGE = 2.0**60, 1e150


@dataclass
class Hashing:
    """Projections of each table: shape (tables, length, dimension), offsets, and cell width."""

    projections: np.ndarray
    offsets: np.ndarray
    width: float

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """Where vectors fall along each projection, in cells: (tables, vectors, length)."""
        along = np.einsum("nd,tkd->tnk", vectors / self.width, self.projections)
        return np.clip(np.nan_to_num(along), -PLACES, PLACES) + self.offsets[:, None, :]

    def shortened(self, length: int) -> Hashing:
        return Hashing(self.projections[:, :length], self.offsets[:, :length], self.width)


def bucket_keys(cells: np.ndarray) -> np.ndarray:
    """One number for each row of cell numbers; the same cells give the same number."""
    out = np.zeros(cells.shape[:-1], np.uint64)
    for i in range(cells.shape[-1]):
        out = (out ^ cells[..., i].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return (out >> np.uint64(1)).astype(np.int64)


def visits(place: np.ndarray, most: int) -> np.ndarray:
    """Cells of the first ``most`` buckets to visit from a place, the likeliest first.

    A step over the near border of a projection costs the square of the distance to it. Sets of
    steps come out of a heap in the order of their sums: the successors of a set shift its last
    step to the next dearer one, or add that one.
    """
    length = len(place)
    home = np.floor(place).astype(np.int64)
    below = place - home
    cost = np.concatenate([below, 1 - below]) ** 2
    order = np.argsort(cost, kind="stable")
    step = [(int(i) % length, -1 if i < length else 1, float(cost[i])) for i in order]
    out, heap = [home], [(step[0][2], (0,))] if length else []
    while heap and len(out) < most:
        total, chosen = heapq.heappop(heap)
        if len({step[i][0] for i in chosen}) == len(chosen):
            cells = home.copy()
            for i in chosen:
                cells[step[i][0]] += step[i][1]
            out.append(cells)
        last = chosen[-1]
        if last + 1 < len(step):
            more = step[last + 1][2]
            heapq.heappush(heap, (total - step[last][2] + more, (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + more, (*chosen, last + 1)))
    return np.array(out)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of equal length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances; differences whose squares a double does not hold are scaled first."""
    with np.errstate(over="ignore"):
        apart = vectors - query
        out = np.sqrt((apart**2).sum(1))
        most = np.abs(apart).max(1, initial=0.0)
        odd = (most > LARGE) & np.isfinite(most)
        out[odd] = most[odd] * np.sqrt(((apart[odd] / most[odd, None]) ** 2).sum(1))
    return out


def nearest(
    queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, allowed: np.ndarray | None, most: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, distances) of the ``most`` nearest allowed vectors of each query, ties by id.

    A matrix product finds who can be among them; their distances are then taken exactly.
    """
    out = []
    largest = max(np.abs(vectors).max(initial=0.0), np.abs(queries).max(initial=0.0))
    scale = LARGE / largest if largest > LARGE else 1.0
    small, asked = vectors * scale, queries * scale
    squares, own = (small**2).sum(1), (asked**2).sum(1)
    rough = squares - 2 * (asked @ small.T) + own[:, None]
    slack = 1e-9 * (squares.max(initial=0.0) + own)
    for row, query in enumerate(queries):
        near = np.arange(len(vectors)) if allowed is None else np.flatnonzero(allowed[row])
        if len(near) > most:
            limit = np.partition(rough[row, near], most - 1)[most - 1] + slack[row]
            near = near[rough[row, near] <= limit]
        exact = distances(vectors[near], query)
        order = np.lexsort((ids[near], exact))[:most]
        out.append((ids[near][order], exact[order]))
    return out


@dataclass
class Entries:
    """Distinct vectors: (entry, embedding) and (entry, ids); entries are numbered in the order
    of their smallest ids, so ties that go by entry go by id."""

    vectors: DataFrame
    ids: DataFrame
    count: int


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, embedding) of the rows that take part, each once."""
    v = F.col(vector)
    broken = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col(key).isNotNull() & v.isNotNull() & ~broken & F.exists(v, lambda x: x != 0))
    return rows.select(F.col(key).alias("id"), v.alias("embedding")).distinct()


def distinct_vectors(rows: DataFrame, most: int) -> Entries:
    """Entries of (id, embedding), each with its ``most`` smallest ids.

    The limit of ids per vector is applied in the map tasks first, so a vector that a third of
    all rows have does not fill a task.
    """
    by_vector = Window.partitionBy("embedding").orderBy("id")
    few = rows.withColumn("place", F.row_number().over(by_vector)).where(F.col("place") <= most)
    grouped = few.groupBy("embedding").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    # Ranges of the smallest id follow each other, so numbers that grow along them keep its order.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = settle(grouped.withColumn("least", F.col("ids")[0]))
    dealt = grouped.repartitionByRange(parts, "least").sortWithinPartitions("least")
    grouped = settle(dealt.withColumn("entry", F.monotonically_increasing_id()))
    return Entries(grouped.select("entry", "embedding"), grouped.select("entry", "ids"), grouped.count())


def _spread(
    rows: DataFrame, hashing: Hashing, cells: int, most: int, query: bool
) -> DataFrame:
    """Rows (side, cell, entry, embedding, buckets): an entry's bucket in each table, or, for a
    query, the buckets to visit, once for each cell that has any of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = hashing.places(_matrix(batch.column(1)))
            row, side, cell, buckets = [], [], [], []
            for t, table_places in enumerate(places):
                own = None if query else bucket_keys(np.floor(table_places))
                for i, place in enumerate(table_places):
                    keys = bucket_keys(visits(place, most)) if query else own[i : i + 1]
                    in_cell = keys % cells
                    for c in np.unique(in_cell):
                        row.append(i)
                        side.append(t)
                        cell.append(int(c))
                        buckets.append(keys[in_cell == c])
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(side, pa.int32()),
                    pa.array(cell, pa.int64()),
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array(buckets, pa.list_(pa.int64())),
                ],
                names=["side", "cell", "entry", "embedding", "buckets"],
            )

    kind = rows.schema["embedding"].dataType.simpleString()
    schema = f"side int, cell long, entry long, embedding {kind}, buckets array<long>"
    return rows.select("entry", "embedding").mapInArrow(run, schema)


def _blocks(members: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with (part, turn): every part of a cell's members meets every turn of its
    queries exactly once, and neither holds more than about ``BLOCK`` rows."""
    key = ["side", "cell"]
    parts = members.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    turns = queries.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).alias("turns"))
    plan = settle(parts.join(turns, key))  # cells without members or without queries go

    def dealt(rows: DataFrame, own: str, other: str, own_name: str, other_name: str) -> DataFrame:
        rows = rows.join(plan, key)
        rows = rows.withColumn(own_name, F.pmod(F.xxhash64("entry"), F.col(own)))
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))
        return rows.withColumn(other_name, copies).drop("parts", "turns")

    return dealt(members, "parts", "turns", "part", "turn"), dealt(
        queries, "turns", "parts", "turn", "part"
    )


def _search(members: DataFrame, queries: DataFrame, most: int, everything: bool) -> DataFrame:
    """(query, entry, score): per query and block the ``most`` nearest of the visited buckets.

    With ``everything`` all members of a block count.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        query, entry, score = [], [], []
        if left.num_rows and right.num_rows:
            vectors = _matrix(left["embedding"])
            ids = left["entry"].to_numpy()
            own = left["buckets"].combine_chunks().flatten().to_numpy()
            asked, visited = right["entry"].to_numpy(), right["buckets"]
            points = _matrix(right["embedding"])
            for start in range(0, len(points), 256):
                some = slice(start, start + 256)
                allowed = None
                if not everything:
                    lists = visited[some].to_pylist()
                    allowed = np.array([np.isin(own, keys) for keys in lists])
                found = nearest(points[some], vectors, ids, allowed, most)
                for q, (near, distance) in zip(asked[some], found):
                    query += [int(q)] * len(near)
                    entry += near.tolist()
                    score += distance.tolist()
        return pa.table(
            {
                "query": pa.array(query, pa.int64()),
                "entry": pa.array(entry, pa.int64()),
                "score": pa.array(score, pa.float64()),
            }
        )

    key = ["side", "cell", "part", "turn"]
    left, right = _blocks(members, queries)
    met = left.groupBy(*key).cogroup(right.groupBy(*key))
    return met.applyInArrow(run, "query long, entry long, score double")


def _best(found: DataFrame, most: int) -> DataFrame:
    """The ``most`` best (query, entry, score), each entry once."""
    by_query = Window.partitionBy("query").orderBy("score", "entry")
    once = found.groupBy("query", "entry").agg(F.min("score").alias("score"))
    return once.withColumn("place", F.row_number().over(by_query)).where(F.col("place") <= most)


def scan(entries: Entries, queries: DataFrame, most: int) -> DataFrame:
    """(query, entry, score, place): the exact answer, every block of vectors against all of the
    given queries (entry, embedding)."""
    queries = settle(queries)
    cells = max(1, math.ceil(entries.count / CELL))
    cell = F.pmod(F.xxhash64("entry"), F.lit(cells)).cast("long")
    none = F.array(F.lit(0).cast("long")).alias("buckets")
    members = entries.vectors.select(
        F.lit(0).alias("side"), cell.alias("cell"), "entry", "embedding", none
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long")))
    asked = queries.select(F.lit(0).alias("side"), every.alias("cell"), "entry", "embedding", none)
    return _best(_search(members, asked, most, everything=True), most)


def fit(entries: Entries, queries: DataFrame, neighbours: int) -> tuple[Hashing, int]:
    """Projections and visits per table, from bounded samples of entries and queries."""
    keyed = entries.vectors.withColumn("key", random_key("entry"))
    some = keyed.orderBy("key", "entry").limit(SAMPLE_VECTORS).collect()
    vectors = np.array([r["embedding"] for r in some], float)
    asked = queries.withColumn("key", random_key("entry")).orderBy("key", "entry").limit(SAMPLE)
    asked = settle(asked.select("entry", "embedding"))
    rng = np.random.default_rng(SEED)
    longest = 32
    projections = rng.normal(size=(TABLES, longest, vectors.shape[1]))
    largest = float(np.abs(vectors).max(initial=0.0)) or 1.0
    spread = ((vectors / largest) @ projections.reshape(TABLES * longest, -1).T).std()
    width = min(WIDTH * float(spread) * largest, np.finfo(float).max)
    hashing = Hashing(projections, rng.uniform(size=(TABLES, longest)), width or 1.0)
    true = scan(entries, asked, neighbours + 1).join(entries.vectors, "entry")
    pairs = true.join(asked.select(F.col("entry").alias("query"), F.col("embedding").alias("point")), "query")
    pairs = pairs.where("query <> entry").collect()  # at most SAMPLE * neighbours
    cells = np.floor(hashing.places(vectors))
    _, counts = np.unique(cells[0, :, 0], return_counts=True)
    bits = max(0.2, float(-(counts / counts.sum() * np.log2(counts / counts.sum())).sum()))
    wanted = math.log2(max(2.0, entries.count / BUCKET)) / bits
    length = min(longest, max(1, math.ceil(wanted)))
    while length > 1:
        visited = _visits_for(hashing.shortened(length), pairs)
        if visited is not None:
            return hashing.shortened(length), visited
        length -= 1
    return hashing.shortened(1), VISITS


def _visits_for(hashing: Hashing, pairs: list) -> int | None:
    """Visits per table with which enough of the pairs meet, None if the allowed are too few."""
    if not pairs:
        return 1
    most = VISITS // TABLES
    points = {r["query"]: r["point"] for r in pairs}
    order = list(points)
    places = hashing.places(np.array([points[q] for q in order], float))
    seen = [
        {q: {key: n for n, key in reversed(list(enumerate(bucket_keys(visits(p, most)).tolist())))}
         for q, p in zip(order, places[t])}
        for t in range(TABLES)
    ]
    keys = bucket_keys(np.floor(hashing.places(np.array([r["embedding"] for r in pairs], float))))
    first = [
        min(seen[t][r["query"]].get(int(keys[t, i]), most) for t in range(TABLES))
        for i, r in enumerate(pairs)
    ]
    enough = sorted(first)[math.ceil(RECALL * len(first)) - 1]
    return None if enough >= most else enough + 1


def search(
    rows: DataFrame, is_query: str, key: str, vector: str, neighbours: int = NEIGHBOURS
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of each row for which ``is_query``,
    an expression over ``id``, holds; nearest first, ties to the smaller id."""
    found = usable(rows, key, vector)
    lengths = [r[0] for r in found.select(F.size("embedding")).distinct().collect()]
    if len(lengths) < 2:
        return _search_length(found, is_query, neighbours)
    found = settle(found)
    parts = [
        _search_length(found.where(F.size("embedding") == n), is_query, neighbours)
        for n in sorted(lengths)
    ]
    return _nearest_rows(reduce(DataFrame.unionAll, parts), neighbours)


def _search_length(found: DataFrame, is_query: str, neighbours: int) -> DataFrame:
    """``search`` among usable rows whose vectors are equally long."""
    most = neighbours + 1  # one may be the query itself
    entries = distinct_vectors(found, most)
    asking = found.where(is_query).join(entries.vectors, "embedding")
    asking = settle(asking.select(F.col("id").alias("query_id"), F.col("entry").alias("query")))
    points = entries.vectors.join(
        asking.select(F.col("query").alias("entry")).distinct(), "entry", "left_semi"
    )
    points = settle(points)
    if points.isEmpty():
        empty = "query_id long, rank int, vec_id long, score double"
        return found.sparkSession.createDataFrame([], empty)
    hashing, visited = fit(entries, points, neighbours)
    cells = max(1, math.ceil(entries.count / CELL))
    members = _spread(entries.vectors, hashing, cells, visited, query=False)
    asked = _spread(points, hashing, cells, visited, query=True)
    near = settle(_best(_search(settle(members), settle(asked), most, everything=False), most))
    full = near.groupBy("query").agg(F.count("*").alias("n"))
    full = full.where(F.col("n") >= min(most, entries.count))
    short = settle(points.join(full, points["entry"] == full["query"], "left_anti"))
    if not short.isEmpty():
        done = near.join(short, near["query"] == short["entry"], "left_anti")
        near = settle(done.unionByName(scan(entries, short, most)))
    return _ranked(asking, near, entries.ids, neighbours)


def _ranked(asking: DataFrame, near: DataFrame, ids: DataFrame, neighbours: int) -> DataFrame:
    """Entries found become ids; each query row gets the best that are not itself."""
    each = near.join(ids, "entry").select("query", "score", F.explode("ids").alias("vec_id"))
    each = each.groupBy("query", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query").orderBy("score", "vec_id")
    each = each.withColumn("place", F.row_number().over(best))
    each = settle(each.where(F.col("place") <= neighbours + 1).drop("place"))
    rows = asking.distinct().join(each, "query").where("vec_id <> query_id")
    return _nearest_rows(rows, neighbours)


def _nearest_rows(rows: DataFrame, neighbours: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest ids of each query, each id once."""
    own = Window.partitionBy("query_id").orderBy("score", "vec_id")
    once = rows.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    once = once.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= neighbours)
    return once.select("query_id", "rank", "vec_id", "score")


def op8_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest found of every hundredth vector."""
    rows = table(spark, folder, "embeddings", "vec_id", "embedding")
    return search(rows, "id % 100 = 0", "vec_id", "embedding")
