"""Tables as lists of batches: folders beside each other, and a manifest that names the live ones.

A manifest is a small file, numbered, written whole under another name and then renamed; readers use
the one with the greatest number, so a change of a table is one rename, however many folders it
adds and drops. What no manifest names is not part of the table: leftovers of a run that ended
half-way are invisible, and go with the next sweep. A folder that readers may have open is never
written to. A table without a manifest consists of all its batch folders.

Each batch also has the keys of its rows, per set of columns, in buckets of their hash: as many,
always a power of two, as hold about ``KEYS`` keys each. To find which of a feed's keys are stored,
only the buckets that the feed's own keys fall into are opened, and they hold nothing but keys.

A table whose rows are themselves looked up by key is written ``Spread``: the rows lie in the
buckets, and compaction may fold rows of one key into one.

One writer at a time. A table has as many folders as a logarithm of its batches, if it is compacted.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.sources.sinks import write_table
from eventmart.sources.tables import read_table

BATCH = "load_batch"
MANIFESTS = "_manifests"
KEY_FOLDER = "_keys"
# Keys of a bucket, the most buckets of a batch, and how many batches of one size are merged.
KEYS, BUCKETS = 1 << 16, 1 << 16
FAN_IN = 8
BUCKET = "hash_bucket"


@dataclass(frozen=True)
class Batch:
    """What one run wrote: ``index`` names the columns whose keys are in ``buckets`` buckets, and
    ``spread`` those by whose hash the rows themselves are."""

    name: str
    folder: str
    rows: int | None = None
    index: tuple[str, ...] = ()
    buckets: int = 1
    spread: str = ""


@dataclass(frozen=True)
class Spread:
    """Rows in folders by ``folders``, then in buckets by the hash of ``columns``, which hold
    about ``KEYS`` rows each. ``combine`` folds the rows of batches that are merged."""

    columns: tuple[str, ...]
    folders: tuple[str, ...] = ()
    combine: Callable[[DataFrame], DataFrame] | None = None


@dataclass(frozen=True)
class State:
    """The batches of a table, the oldest first, and the last rebuild: its run and its counts."""

    version: int = 0
    batches: tuple[Batch, ...] = ()
    rebuilt: Mapping[str, object] = field(default_factory=dict)

    def but(self, name: str | None) -> State:
        return replace(self, batches=tuple(b for b in self.batches if b.name != name))


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, by name; nothing if there is no such folder."""
    place, files = _place(spark, path)
    if not files.exists(place):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(place))


def _delete(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)


def _folders(spark: SparkSession, path: str) -> list[str]:
    return [n for n in names_in(spark, path) if n.startswith(f"{BATCH}=")]


def state(spark: SparkSession, path: str) -> State | None:
    """The table as of its last manifest; ``None`` when nothing was ever written there."""
    numbers = [n for n in names_in(spark, f"{path}/{MANIFESTS}") if n.isdigit()]
    if not numbers:
        found = _folders(spark, path)
        whole = tuple(Batch(n.removeprefix(f"{BATCH}="), n) for n in found)
        return State(0, whole) if found else None
    place, files = _place(spark, f"{path}/{MANIFESTS}/{numbers[-1]}")
    stream = files.open(place)
    try:
        read = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    batches = tuple(Batch(**b | {"index": tuple(b["index"])}) for b in read["batches"])
    return State(int(numbers[-1]), batches, read["rebuilt"])


def commit(spark: SparkSession, path: str, new: State) -> State:
    """Make ``new`` the state that follows its version, by one rename."""
    new = replace(new, version=new.version + 1)
    text = json.dumps({"batches": [asdict(b) for b in new.batches], "rebuilt": dict(new.rebuilt)})
    folder = f"{path}/{MANIFESTS}"
    draft, files = _place(spark, f"{folder}/.{uuid.uuid4().hex}")
    files.mkdirs(draft.getParent())
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    final, _ = _place(spark, f"{folder}/{new.version:012d}")
    if files.exists(final) or not files.rename(draft, final):
        raise RuntimeError(f"another writer changed {path}")
    return new


def sweep(spark: SparkSession, path: str) -> None:
    """Delete what the last manifest does not name. Run it when nothing reads older states."""
    now = state(spark, path)
    if now is None or not now.version:
        return
    live = {b.folder for b in now.batches}
    for name in _folders(spark, path):
        if name not in live:
            _delete(spark, f"{path}/{name}")
    for columns in names_in(spark, f"{path}/{KEY_FOLDER}"):
        for name in names_in(spark, f"{path}/{KEY_FOLDER}/{columns}"):
            if name.removeprefix("of=") not in live:
                _delete(spark, f"{path}/{KEY_FOLDER}/{columns}/{name}")
    for name in names_in(spark, f"{path}/{MANIFESTS}"):
        if name != f"{now.version:012d}":
            _delete(spark, f"{path}/{MANIFESTS}/{name}")


def read_batches(
    spark: SparkSession, path: str, batches: Sequence[Batch], merge: bool = False
) -> DataFrame | None:
    """Rows of some batches. Without ``merge``, columns that only some have may be missing."""
    if not batches:
        return None
    reader = spark.read.option("mergeSchema", merge).option("basePath", path)
    rows = reader.parquet(*[f"{path}/{b.folder}" for b in batches]).drop(BATCH)
    return rows.drop(BUCKET) if all(b.spread for b in batches) else rows


def _set_name(columns: Sequence[str]) -> str:
    return "+".join(columns)


def hash_of(columns: Sequence[str]) -> Column:
    """The hash of a key, as text whatever its type; its remainder is the bucket."""
    as_text = [F.col(c).cast("string") for c in columns]
    return F.pmod(F.xxhash64(*as_text), F.lit(BUCKETS)).cast("int")


def _buckets(rows: int) -> int:
    return min(BUCKETS, 1 << max(0, -(-rows // KEYS) - 1).bit_length())


def _key_schema(columns: Sequence[str]) -> T.StructType:
    texts = [T.StructField(f"k{i}", T.StringType()) for i in range(len(columns))]
    return T.StructType([*texts, T.StructField("of", T.StringType()), T.StructField("bucket", T.IntegerType())])


def _with_index(
    spark: SparkSession, path: str, batch: Batch, index: Sequence[Sequence[str]]
) -> Batch:
    """Store the keys of a written batch, each once, in their buckets."""
    rows, buckets = read_table(spark, f"{path}/{batch.folder}"), _buckets(batch.rows)
    names = []
    for columns in index:
        if not set(columns) <= set(rows.columns):
            continue
        texts = [F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(columns)]
        keys = rows.select(*texts).dropna().distinct()
        own = F.pmod(hash_of([f"k{i}" for i in range(len(columns))]), F.lit(buckets))
        keys = keys.withColumn("bucket", own)
        keys = keys.coalesce(1) if buckets == 1 else keys.repartition("bucket")
        place = f"{path}/{KEY_FOLDER}/{_set_name(columns)}/of={batch.folder}"
        write_table(keys, place, ["bucket"], whole=True)
        names.append(_set_name(columns))
    return replace(batch, index=tuple(names), buckets=buckets)


def _write_spread(
    path: str, name: str, folder: str, rows: DataFrame, spread: Spread, about: int
) -> Batch:
    buckets = _buckets(about)
    rows = rows.withColumn(BUCKET, F.pmod(hash_of(spread.columns), F.lit(buckets)))
    count = write_table(
        rows.repartition(*spread.folders, BUCKET),
        f"{path}/{folder}",
        [*spread.folders, BUCKET],
        whole=True,
    )
    return Batch(name, folder, count, (), buckets, _set_name(spread.columns))


def write_batch(
    spark: SparkSession,
    path: str,
    name: str,
    rows: DataFrame,
    index: Sequence[Sequence[str]] = (),
    spread: Spread | None = None,
) -> Batch:
    """Write rows and their keys as a batch that no manifest names yet.

    A live folder is left alone: a repeated run writes beside it. With ``spread`` the rows, which
    are counted before they are written and so should be settled, go into buckets instead.
    """
    now = state(spark, path)
    if now is None:  # from now on, what a run leaves half-way is not part of the table
        now = commit(spark, path, State())
    elif not now.version:
        now = commit(spark, path, now)
    folder = f"{BATCH}={name}"
    if folder in {b.folder for b in now.batches}:
        folder = f"{folder}~{now.version}"
    if spread is not None:
        return _write_spread(path, name, folder, rows, spread, rows.count())
    count = write_table(rows, f"{path}/{folder}")
    return _with_index(spark, path, Batch(name, folder, count), index)


def publish(spark: SparkSession, path: str, batch: Batch) -> State:
    """Add a written batch to the table, in the place of one of the same name."""
    now = state(spark, path) or State()
    return commit(spark, path, replace(now, batches=(*now.but(batch.name).batches, batch)))


def _tier(batch: Batch) -> int:
    return int(math.log(max(batch.rows or 1, 1), FAN_IN))


def compact(
    spark: SparkSession,
    path: str,
    index: Sequence[Sequence[str]] = (),
    spread: Spread | None = None,
) -> int:
    """Merge batches of like size, ``FAN_IN`` or more at once, and return how many were merged.

    A row is rewritten once per size class, so as often as a logarithm of the table. The newest
    batch stays, since its run may be repeated; so do the batches of a table without manifest.
    """
    merged = 0
    while (now := state(spark, path)) is not None and now.version:
        known = [
            b if b.rows is not None else replace(b, rows=read_batches(spark, path, [b]).count())
            for b in now.batches[:-1]
        ]
        tiers: dict[int, list[Batch]] = {}
        for batch in known:
            tiers.setdefault(_tier(batch), []).append(batch)
        full = [tier for tier in sorted(tiers) if len(tiers[tier]) >= FAN_IN]
        if not full:
            break
        parts = tiers[full[0]]
        rows = read_batches(spark, path, parts, merge=True)
        folder = f"{BATCH}=merged_{now.version:012d}"
        name = folder.removeprefix(f"{BATCH}=")
        if spread is not None:
            rows = spread.combine(rows) if spread.combine is not None else rows
            about = sum(b.rows for b in parts)
            batch = _write_spread(path, name, folder, rows, spread, about)
        else:
            batch = Batch(name, folder, write_table(rows, f"{path}/{folder}"))
            batch = _with_index(spark, path, batch, index)
        gone = {b.folder for b in parts}
        rest = tuple(b for b in [*known, now.batches[-1]] if b.folder not in gone)
        commit(spark, path, replace(now, batches=(batch, *rest)))
        merged += len(parts)
    return merged


def _opened(
    batches: Mapping[str, Batch], df: DataFrame, own: Sequence[str], of: str, bucket: str
) -> Column:
    """Which buckets hold keys that ``own`` columns of ``df`` may equal, as a filter on folders."""
    hashes = df.select(hash_of(own).alias("hash")).distinct()
    wanted = {r[0] for r in hashes.collect()}  # at most BUCKETS numbers
    opened = F.lit(False)
    for buckets in sorted({b.buckets for b in batches.values()}):
        names = [n for n, b in batches.items() if b.buckets == buckets]
        asked = sorted({h % buckets for h in wanted})
        opened = opened | (F.col(of).isin(names) & F.col(bucket).isin(asked))
    return opened


@dataclass(frozen=True)
class Stored:
    """A table at one state, without the batch that is being written."""

    spark: SparkSession
    path: str
    batches: tuple[Batch, ...]

    def rows(self, merge: bool = False) -> DataFrame:
        return read_batches(self.spark, self.path, self.batches, merge)

    def near(self, columns: Sequence[str], df: DataFrame, own: Sequence[str]) -> DataFrame:
        """Rows of the buckets that ``own`` columns of ``df`` fall into: those whose ``columns``
        equal them, as text, and others. The batches must be spread by ``columns``."""
        if {b.spread for b in self.batches} != {_set_name(columns)}:
            raise ValueError(f"{self.path} is not spread by {_set_name(columns)}")
        reader = self.spark.read.option("basePath", self.path)
        rows = reader.parquet(*[f"{self.path}/{b.folder}" for b in self.batches])
        names = {b.folder.removeprefix(f"{BATCH}="): b for b in self.batches}
        return rows.where(_opened(names, df, own, BATCH, BUCKET)).drop(BATCH, BUCKET)

    def keys(self, columns: Sequence[str], df: DataFrame, own: Sequence[str]) -> DataFrame:
        """``columns``, as text, of the stored rows that may equal ``own`` columns of ``df``.

        Opens the buckets that keys of ``df`` fall into; batches without an index of these
        columns are read themselves.
        """
        name = _set_name(columns)
        indexed = [b for b in self.batches if name in b.index]
        plain = [b for b in self.batches if name not in b.index]
        parts = []
        if indexed:
            base = f"{self.path}/{KEY_FOLDER}/{name}"
            reader = self.spark.read.schema(_key_schema(columns)).option("basePath", base)
            found = reader.parquet(*[f"{base}/of={b.folder}" for b in indexed])
            names = {b.folder: b for b in indexed}
            found = found.where(_opened(names, df, own, "of", "bucket"))
            parts.append(found.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(columns)]))
        if plain:
            found = read_batches(self.spark, self.path, plain)
            parts.append(found.select(*[F.col(c).cast("string").alias(c) for c in columns]))
        return parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])


def stored(spark: SparkSession, path: str, but: str | None = None) -> Stored | None:
    """The table without the batches named ``but``; ``None`` when it has no others."""
    now = state(spark, path)
    rest = now.but(but).batches if now is not None else ()
    return Stored(spark, path, rest) if rest else None
