"""Small helpers that several operators use."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

# A word is a run of anything but these six.
WORD = r"[^\x20\x09-\x0D]+"
# Arrow batches handed to Python: few rows, since a text may be long.
BATCH_ROWS = 256
# Buckets of a hash-random key; each is one range of the key, and a source or length has at
# most so many rows in the tables of totals.
KEY_DIGITS = 3


_SHIPPED: set[str] = set()


def ready(spark: SparkSession) -> SparkSession:
    """Set the size of Arrow batches, and hand this package to the Python workers.

    A batch of texts must fit in a worker. Spark's file server gives the package to executors
    that do not have it, as ``--py-files`` would; once per application.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        folder = tempfile.mkdtemp(prefix="package-")  # read by the driver only
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        root = Path(__file__).resolve().parents[2]
        context.addPyFile(shutil.make_archive(f"{folder}/eventmart", "zip", root, "eventmart"))
    return spark


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows for what runs inside."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, rows)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Columns of one of the given tables."""
    return ready(spark).read.parquet(f"{folder}/{name}.parquet").select(*columns)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def binary_texts(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """Texts; null is empty, bytes that are no UTF-8 are replaced."""
    return [x.decode("utf-8", "replace") for x in binary_texts(column)]


def with_columns(
    df: DataFrame, text: str, make: Callable[[pa.Array], dict], added: str, keep: bool = False
) -> DataFrame:
    """Put the columns that ``make`` derives from a batch of texts in the place of ``text``.

    ``added`` is their schema as DDL; a column of the same name, in either case, is replaced. ``keep`` keeps the
    text as well. Rows stay in their task: no shuffle.
    """
    extra = StructType.fromDDL(added)
    new_names = {c.lower() for c in extra.names}
    rest = [c for c in df.columns if (keep or c != text) and c.lower() not in new_names]
    schema = StructType([*(df.schema[c] for c in rest), *extra])
    kinds = [to_arrow_type(field.dataType) for field in extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = make(batch.column(batch.schema.get_field_index(text)))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in rest]
            new = [pa.array(made[c], kind) for c, kind in zip(extra.names, kinds)]
            yield pa.RecordBatch.from_arrays([*kept, *new], names=[*rest, *extra.names])

    return df.select(text, *(c for c in rest if c != text)).mapInArrow(run, schema)


Span = tuple[str, int, int]


def in_order(spans: Iterable[Span], kinds: Sequence[str]) -> list[Span]:
    """Spans by start, then by the place of their kind in ``kinds``, then by end."""
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def written(spans: Iterable[Span]) -> str:
    """``kind:start:end`` joined by commas."""
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def without_overlap(found: Iterable[Span], base: Iterable[Span]) -> list[Span]:
    """Those of ``found`` that share no character with a span of ``base`` or an earlier one.

    One pass over both in order: ``end`` is as far as the spans before reach, so a span that
    starts behind it can only meet the next one of ``base``.
    """
    taken, at, end, out = sorted((s, e) for _, s, e in base), 0, 0, []
    for span in sorted(found, key=lambda s: (s[1], -s[2])):
        _, start, stop = span
        while at < len(taken) and taken[at][0] < start:
            end = max(end, taken[at][1])
            at += 1
        if start < end or (at < len(taken) and taken[at][0] < stop):
            continue
        out.append(span)
        end = max(end, stop)
    return out


def random_key(doc_id: str) -> Column:
    """A hash-random key in hex; its order is the same on every run."""
    return F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))


def key_range(key: str) -> Column:
    """The range of keys that a key falls into: its first digits."""
    return F.substring(F.col(key), 1, KEY_DIGITS)


def range_totals(df: DataFrame, group: list[str], span: str, value: Column) -> DataFrame:
    """Total per group and range of keys, and what the ranges before it hold (``before``).

    The first step of a distributed prefix sum: rows are added up in the map tasks, totals are
    put in order inside wider ranges, and the wider ranges, a few for each group, among
    themselves. So no task puts all ranges of a large group in order.
    """
    def ahead(*columns: str, by: str) -> WindowSpec:
        order = Window.partitionBy(*columns).orderBy(by)
        return order.rowsBetween(Window.unboundedPreceding, -1)

    totals = df.groupBy(*group, span).agg(F.sum(value).alias("total"))
    totals = totals.withColumn("wide", F.substring(span, 1, 1))
    wide = totals.groupBy(*group, "wide").agg(F.sum("total").alias("in_wide"))
    wide = wide.withColumn("wide_before", F.sum("in_wide").over(ahead(*group, by="wide")))
    inside = totals.withColumn("inside", F.sum("total").over(ahead(*group, "wide", by=span)))
    joined = inside.join(wide, same(inside, wide, [*group, "wide"]))
    joined = joined.drop(*(wide[c] for c in [*group, "wide"]))
    zero = F.lit(0)
    before = F.coalesce("inside", zero) + F.coalesce("wide_before", zero)
    return joined.select(*group, span, "total", before.alias("before"))


def same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equality of columns in which null equals null."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    most: int,
    make: Callable[[pa.Array], dict],
    made: str,
) -> DataFrame:
    """(key, doc_id, label, what ``make`` derives) of up to ``most`` documents of each class 0
    and 1: those of least key, a row each, in order when sorted by key and id.

    ``made`` is the schema of what is derived as DDL; it is derived in the tasks, so no text
    leaves them. Of an id with several rows, the text of least hash counts. Null labels, ids and
    texts are left out. At most 2 * ``most`` ids are sent to the tasks.
    """
    known = labels.where(f"doc_id IS NOT NULL AND {label} IN (0, 1)").groupBy("doc_id")
    known = known.agg(F.min(label).alias("label")).withColumn("key", random_key("doc_id"))
    picked = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy("key", "doc_id").limit(most)
        picked = part if picked is None else picked.unionAll(part)
    rows = docs.where("text IS NOT NULL").select("doc_id", "text")
    rows = rows.join(F.broadcast(picked), "doc_id")
    rows = rows.select("key", "doc_id", "label", F.xxhash64("text").alias("which"), "text")
    made_rows = with_columns(rows, "text", make, made)
    derived = StructType.fromDDL(made).names
    once = made_rows.groupBy("key", "doc_id", "label")  # begun in the map tasks
    once = once.agg(F.min_by(F.struct(*derived), "which").alias("made"))
    return once.select("key", "doc_id", "label", "made.*")
