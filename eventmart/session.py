"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where a later step could have reused the partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Bytes of input files for one shuffle partition; a query shuffles some of their columns.
SHUFFLE_BYTES = 512 * 1024 * 1024
PARTITIONS = "spark.sql.shuffle.partitions"

# Per application: the number of partitions it was given, and the one last set here.
_FITTED: dict[str, tuple[int, int]] = {}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files below the paths that exist, from their listing."""
    total, jvm = 0, spark._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(place):
            total += files.getContentSummary(place).getLength()
    return total


def fit_shuffles(spark: SparkSession, size: int, target: int = SHUFFLE_BYTES) -> int:
    """Set the shuffle partitions for inputs of ``size`` bytes, and return their number.

    At least as many as the session was given, whatever was fitted before: adaptive execution
    joins small partitions while running, but splits none except hot join keys.
    """
    now, app = int(spark.conf.get(PARTITIONS)), spark.sparkContext.applicationId
    given, last = _FITTED.get(app, (now, now))
    if now != last:
        given = now
    fitted = max(given, -(-size // target))
    spark.conf.set(PARTITIONS, fitted)
    _FITTED[app] = (given, fitted)
    return fitted


@contextmanager
def fitted_shuffles(spark: SparkSession, size: int) -> Iterator[int]:
    """Shuffle partitions for inputs of ``size`` bytes, set back afterwards."""
    before = spark.conf.get(PARTITIONS)
    try:
        yield fit_shuffles(spark, size)
    finally:
        spark.conf.set(PARTITIONS, before)


@contextmanager
def open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Writes by partition keep up to ``most`` files open in a task, so rows of so few partitions
    need not be sorted by them; set back afterwards."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def work_dir(spark: SparkSession) -> str:
    """A new folder below the shared folder that the cluster names in ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="eventmart-"))
        shared = context.getCheckpointDir()
    return f"{shared.rstrip('/')}/eventmart-{uuid.uuid4().hex}"


class Workspace:
    """A folder of intermediate tables that live as long as a run.

    ``settle`` writes a table and reads it back: the lineage ends at the files, so a lost
    executor costs no upstream work, several readers share one computation, and the planner
    knows the true size when it picks a join.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = work_dir(spark)
        self._count = 0

    def settle(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/table_{self._count}"
        self._count += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Delete the folder, which only this object writes to."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.close()


# Workspaces that ``settle`` writes to; the last one is in use.
_OPEN: list[Workspace] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Workspace]:
    """What is settled inside goes when this ends, so results must be written before."""
    with Workspace(spark) as space:
        _OPEN.append(space)
        try:
            yield space
        finally:
            _OPEN.remove(space)


def _at_exit(space: Workspace) -> None:
    try:
        space.close()
    except Exception:  # the session may be gone by then
        pass


def settle(df: DataFrame) -> DataFrame:
    """One table settled: within ``scratch`` until that ends, else until Python exits."""
    if _OPEN:
        return _OPEN[-1].settle(df)
    space = Workspace(df.sparkSession)
    atexit.register(_at_exit, space)
    return space.settle(df)
