"""Distributed LSD radix sort: final ranks by stable counting-sort passes over key digits.

Composite keys are written as digits, the least significant first. A pass orders all rows by one
digit and keeps the order of equal ones. Rows lie in chunks, which are ranges of places. Each chunk
counts its digits; global prefix sums over (digit, chunk) say where the rows of a digit in a chunk
begin; inside a chunk a stable sort counts on from there. So every row learns its place in the whole
table from its own chunk and a few offsets, and no task ever holds more than a chunk, however often
a key repeats. After the last pass the places are the ranks.

Each pass is written before the next, so a lost executor repeats one pass at most.

Defined cases: null keys come last; rows with equal keys get ranks in any order; an empty table
stays empty; key columns must be whole numbers, over their full range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from eventmart.llm.shared import unused
from eventmart.session import settle

# Bits of a digit, and rows of a chunk: the table of counts has a line per digit that a chunk
# has, so chunks are much longer than a digit has values.
DIGIT_BITS = 9
CHUNK_BITS = 13


@dataclass(frozen=True)
class Key:
    column: str
    descending: bool = False


@dataclass(frozen=True)
class _Range:
    """What a key's values are: least and greatest, and whether some are null."""

    key: Key
    least: int
    most: int
    nulls: bool

    def digits(self, column: pa.Array) -> list[np.ndarray]:
        """The digits of a batch, the least significant first; a last one parts the nulls.

        Differences are taken modulo 2 ** 64, where they are right for any two longs.
        """
        missing = column.is_null().to_numpy(zero_copy_only=False)
        # the bytes of a long are those of its number modulo 2 ** 64
        value = column.fill_null(self.least).to_numpy(zero_copy_only=False).view(np.uint64)
        least, most = (np.uint64(n % 2**64) for n in (self.least, self.most))
        value = most - value if self.key.descending else value - least
        value = np.where(missing, np.uint64(0), value)
        out = []
        for shift in range(0, (self.most - self.least).bit_length(), DIGIT_BITS):
            out.append((value >> np.uint64(shift)) & np.uint64(2**DIGIT_BITS - 1))
        return [*out, missing] if self.nulls else out


def _ranges(rows: DataFrame, keys: Sequence[Key]) -> list[_Range]:
    found = rows.agg(
        *[F.min(k.column).cast("long").alias(f"least{i}") for i, k in enumerate(keys)],
        *[F.max(k.column).cast("long").alias(f"most{i}") for i, k in enumerate(keys)],
        *[F.count_if(F.col(k.column).isNull()).alias(f"nulls{i}") for i, k in enumerate(keys)],
    ).first()
    return [
        _Range(k, found[f"least{i}"] or 0, found[f"most{i}"] or 0, found[f"nulls{i}"] > 0)
        for i, k in enumerate(keys)
    ]


def _with_digits(rows: DataFrame, ranges: Sequence[_Range], place: str, digits: str) -> DataFrame:
    """Add a row's first place, which is any, and its digits in the order of the passes."""
    keys = [unused(rows, f"key{i}") for i in range(len(ranges))]
    own = rows.columns
    rows = rows.select(
        *own,
        F.monotonically_increasing_id().alias(place),
        *[F.col(r.key.column).cast("long").alias(name) for name, r in zip(keys, ranges)],
    )
    schema = StructType(
        [*rows.schema[: len(own) + 1], StructField(digits, ArrayType(IntegerType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i in reversed(range(len(ranges))):
                found += ranges[i].digits(batch.column(len(own) + 1 + i))
            table = np.stack(found, 1).astype(np.int32)
            at = np.arange(batch.num_rows + 1, dtype=np.int32) * len(found)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(table.ravel()))
            kept = [batch.column(i) for i in range(len(own) + 1)]
            yield pa.RecordBatch.from_arrays([*kept, lists], names=schema.names)

    return rows.mapInArrow(run, schema)


def _offsets(rows: DataFrame, chunk: str, digit: str) -> DataFrame:
    """(at, value, first): the place of the first row of a digit in a chunk."""
    counts = rows.groupBy(chunk, digit).agg(F.count("*").alias("n"))

    def ahead(order: str, *group: str):
        spec = Window.partitionBy(*group).orderBy(order) if group else Window.orderBy(order)
        return spec.rowsBetween(Window.unboundedPreceding, -1)

    zero = F.lit(0).cast("long")
    inside = counts.withColumn("inside", F.coalesce(F.sum("n").over(ahead(chunk, digit)), zero))
    totals = counts.groupBy(digit).agg(F.sum("n").alias("n"))  # at most 2 ** DIGIT_BITS rows
    starts = totals.select(digit, F.coalesce(F.sum("n").over(ahead(digit)), zero).alias("start"))
    joined = inside.join(F.broadcast(starts), digit)
    first = F.col("start") + F.col("inside")
    return joined.select(F.col(chunk).alias("at"), F.col(digit).alias("value"), first.alias("first"))


def _pass(rows: DataFrame, number: int, chunk: str, place: str, digits: str) -> DataFrame:
    """Rows with the places that the digit of this pass gives them."""
    digit = unused(rows, "digit")
    shown = rows.withColumn(digit, F.col(digits)[number])
    offsets = _offsets(shown.select(chunk, digit), chunk, digit)
    names, schema = rows.columns, rows.schema

    def move(left: pa.Table, right: pa.Table) -> pa.Table:
        first = np.zeros(2**DIGIT_BITS, np.int64)
        first[right["value"].to_numpy()] = right["first"].to_numpy()
        value = left[digit].to_numpy()
        order = np.argsort(left[place].to_numpy(), kind="stable")
        order = order[np.argsort(value[order], kind="stable")]  # by digit, then by place
        value = value[order]
        count_on = np.arange(len(value)) - np.searchsorted(value, value)
        target = np.empty(len(value), np.int64)
        target[order] = first[value] + count_on
        new = {place: pa.array(target), chunk: pa.array(target >> CHUNK_BITS)}
        return pa.table([new.get(n, left[n]) for n in names], names=names)

    met = shown.groupBy(chunk).cogroup(offsets.groupBy("at"))
    return met.applyInArrow(move, schema)


def ranked(rows: DataFrame, keys: Sequence[Key], rank: str = "rank") -> DataFrame:
    """``rows`` with their rank (from 1) by ``keys``, the most significant first."""
    own = [c for c in rows.columns if c.lower() != rank.lower()]
    rows = settle(rows.select(*own))
    place, chunk, digits = (unused(rows, n) for n in ("place", "chunk", "digits"))
    ranges = _ranges(rows, keys)
    # the lists of digits have one more where a key has nulls
    passes = sum(
        -(-(r.most - r.least).bit_length() // DIGIT_BITS) + r.nulls for r in ranges
    )
    if passes == 0:  # all keys are equal, or there is no row: any order will do
        ranges, passes = [*ranges, _Range(keys[0], 0, 0, True)], 1
    state = _with_digits(rows, ranges, place, digits)
    state = settle(state.withColumn(chunk, F.shiftright(place, CHUNK_BITS)))
    for number in range(passes):
        state = settle(_pass(state, number, chunk, place, digits))
    return state.select(*own, (F.col(place) + 1).cast(LongType()).alias(rank))
