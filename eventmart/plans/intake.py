"""Taking feed files in: file checks, one read of all accepted files, malformed lines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart import fixed_values as fv
from eventmart.operators.quality import Settle
from eventmart.session import open_files
from eventmart.sources import (
    CORRUPT,
    FILE_NAME,
    FILE_PATH,
    PLACE,
    file_facts,
    found_headers,
    manifest,
    read_lines,
    read_table,
    write_table,
)
from eventmart.specs import FeedSpec

REASON_MALFORMED = "Malformed record"
KIND = "line_kind"
LINE = "malformed_line"


def name_matches(column: str, pattern: str) -> Column:
    return F.col(column).rlike(f"(?i)^(?:{pattern})")


def _candidates(
    spark: SparkSession, spec: FeedSpec, others: Iterable[FeedSpec], ledger: DataFrame | None
) -> DataFrame:
    """Files with the feed's prefix that no other feed claims and no earlier run handled."""
    files = manifest(spark, spec.inbound, spec.file_prefix)
    files = files.withColumn("name_ok", own_name("file_name", spec))
    files = files.where(F.col("name_ok") | ~foreign_name("file_name", spec, others))
    if ledger is not None:
        same = ["path", "length", "modified_at"]
        done = ledger.where(F.col("feed_type") == spec.feed_type).select(*same).distinct()
        files = files.join(done, same, "left_anti")
    return files.select("path", "file_name", "length", "modified_at", "name_ok")


def own_name(column: str, spec: FeedSpec) -> Column:
    pattern = spec.rules.file_pattern
    return name_matches(column, pattern) if pattern else F.lit(False)


def foreign_name(column: str, spec: FeedSpec, others: Iterable[FeedSpec]) -> Column:
    """Another feed claims files of this name."""
    claims = [
        name_matches(column, o.rules.file_pattern)
        for o in others
        if o.feed_type != spec.feed_type and o.rules.file_pattern
    ]
    return reduce(or_, claims, F.lit(False))


def bad_name(column: str, spec: FeedSpec) -> Column:
    if not spec.rules.file_pattern:
        return F.lit(f"Unknown file type: {spec.feed_type}")
    text = F.lit(f" does not match expected pattern for {spec.feed_type}")
    return F.concat(F.lit("File "), column, text)


def wrong_header(spec: FeedSpec) -> str:
    return f"Column mismatch. Expected: {list(spec.columns)}"


@dataclass(frozen=True)
class Intake:
    """``rows`` and ``malformed`` are ``None`` when no file was accepted."""

    files: DataFrame
    rows: DataFrame | None = None
    malformed: DataFrame | None = None


def stage(lines: DataFrame, path: str) -> DataFrame:
    """Write parsed lines once and return them; well-formed and malformed ones lie in separate
    partitions, so each reader opens its own files only."""
    kind = F.when(F.col(CORRUPT).isNull(), "rows").otherwise("malformed")
    lines = lines.withColumn(KIND, kind).withColumnRenamed(CORRUPT, LINE)
    with open_files(lines.sparkSession, 2):  # rows and malformed ones
        write_table(lines, path, [KIND], whole=True)
    return read_table(lines.sparkSession, path, lines.schema)


def staged_lines(spark: SparkSession, spec: FeedSpec) -> DataFrame:
    """The lines the last intake staged for a feed."""
    columns = [*spec.columns, LINE, FILE_PATH]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    schema.add(PLACE, T.LongType()).add(FILE_NAME, T.StringType())
    schema.add(fv.INTAKE_TIME, T.TimestampType()).add(KIND, T.StringType())
    return read_table(spark, spec.preprocess_path, schema)


def data_lines(lines: DataFrame, files: DataFrame, *kept: str) -> DataFrame:
    """Lines of the ``files`` (path, header_place), without their headers, with the ``kept``
    columns of their file."""
    known = files.select(
        F.col("path").alias("_path"), F.col("header_place").alias("_header"), *kept
    )
    header = F.coalesce(F.col(PLACE) == F.col("_header"), F.lit(False))
    joined = lines.join(known, F.col(FILE_PATH) == F.col("_path")).where(~header)
    return joined.drop("_path", "_header", FILE_PATH, PLACE)


def well_formed(lines: DataFrame) -> DataFrame:
    return lines.where(F.col(KIND) == "rows").drop(KIND, LINE)


def malformed(lines: DataFrame) -> DataFrame:
    bad = lines.where(F.col(KIND) == "malformed").drop(KIND)
    return bad.withColumn(fv.ERROR_REASON, F.lit(REASON_MALFORMED))


def staged_rows(spark: SparkSession, spec: FeedSpec, files: DataFrame) -> DataFrame:
    """Rows of the accepted ones of ``files`` that the last intake staged for a feed."""
    own = files.where((F.col("feed_type") == spec.feed_type) & F.col("reason").isNull())
    return well_formed(data_lines(staged_lines(spark, spec), own))


def check_files(
    spec: FeedSpec, files: DataFrame, lines: DataFrame | None, run_ts: dt.datetime, settle: Settle
) -> DataFrame:
    """One line per file with the ``reason`` it is rejected for, NULL if accepted.

    Checks run in a fixed order: file name, emptiness, header. ``lines`` are the parsed lines of
    the files whose name is right, None if there are none.
    """
    if lines is None:
        none = F.lit(None).cast("long")
        files = files.withColumns(
            {"header_place": none, "header_ok": F.lit(False), "data_lines": F.lit(0)}
        )
    else:
        files = files.join(file_facts(lines, spec.columns, LINE), "path", "left")
    count = F.coalesce("data_lines", F.lit(0)).cast("long")
    reason = (
        F.when(~F.col("name_ok"), bad_name("file_name", spec))
        .when(count <= 0, F.lit("File is empty"))
        .when(~F.col("header_ok"), F.lit(wrong_header(spec)))
    )
    verdicts = settle(
        files.select(
            F.lit(spec.feed_type).alias("feed_type"),
            "path",
            "file_name",
            "length",
            "modified_at",
            F.greatest(count, F.lit(0)).alias("data_lines"),
            "header_place",
            reason.alias("reason"),
            F.lit(run_ts).alias("checked_at"),
        )
    )
    if lines is None:
        return verdicts
    mismatch = F.col("reason") == wrong_header(spec)
    wrong = verdicts.where(mismatch).select("path", "header_place")
    found = found_headers(lines, wrong, spec.columns, spec.sep, LINE)
    names = F.concat(F.lit(", Found: ['"), F.array_join("found", "', '"), F.lit("']"))
    reason = F.when(mismatch, F.concat("reason", F.coalesce(names, F.lit(""))))
    told = verdicts.join(found, "path", "left")
    told = told.withColumn("reason", reason.otherwise(F.col("reason")))
    return settle(told.select(*verdicts.columns))


def take_in(
    spark: SparkSession,
    spec: FeedSpec,
    run_ts: dt.datetime,
    settle: Settle,
    others: Iterable[FeedSpec] = (),
    ledger: DataFrame | None = None,
) -> Intake:
    """Check the waiting files of a feed and stage their lines as one table.

    A file is read once: its lines are parsed and written, and the checks look at what was
    written. ``ledger`` holds the lines of earlier runs; a file it lists unchanged is not looked
    at again, which takes the place of moving or deleting handled files.
    """
    files = settle(_candidates(spark, spec, others, ledger))
    # File names only; the file listing of the scan is as long.
    readable = [r.path for r in files.where("name_ok AND length > 0").select("path").collect()]
    if not readable:
        return Intake(check_files(spec, files, None, run_ts, settle))
    lines = read_lines(spark, readable, spec.columns, spec.sep)
    lines = stage(lines.withColumn(fv.INTAKE_TIME, F.lit(run_ts)), spec.preprocess_path)
    files = check_files(spec, files, lines, run_ts, settle)
    accepted = files.where("reason IS NULL")
    if accepted.isEmpty():
        return Intake(files)
    data = data_lines(lines, accepted)
    return Intake(files, well_formed(data), malformed(data))
