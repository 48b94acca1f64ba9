"""Writing tables, quarantines and delimited exports."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventmart import fixed_values as fv

log = logging.getLogger(__name__)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation(f"rows_{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    whole: bool = False,
) -> int:
    """Write parquet and return the row count, counted by the write itself.

    An overwrite with ``partition_by`` replaces the partitions that ``df`` has rows for, or
    all of them if ``whole``. ``path`` must not be one that ``df`` reads.
    """
    counted, seen = _counted(df)
    writer = counted.write.mode(mode)
    if partition_by:
        replaced = "static" if whole else "dynamic"
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", replaced)
    writer.parquet(path)
    log.info("wrote %d rows to %s", seen.get["rows"], path)
    return seen.get["rows"]


def export_name(table: str, on: dt.date) -> str:
    return f"OUT_{table.upper()}_{on:%Y%m%d}.csv"


def write_delimited(df: DataFrame, path: str, sep: str = fv.EXPORT_SEPARATOR) -> int:
    """Write a folder of header-first delimited files and return the row count."""
    counted, seen = _counted(df)
    counted.write.mode("overwrite").options(header=True, sep=sep).csv(path)
    log.info("exported %d rows to %s", seen.get["rows"], path)
    return seen.get["rows"]
