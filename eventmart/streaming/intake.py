"""Continuous intake: the same checks and landing as a batch run, per micro-batch."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmart import fixed_values as fv
from eventmart.plans.intake import (
    KIND,
    LINE,
    bad_name,
    data_lines,
    foreign_name,
    malformed,
    own_name,
    stage,
    well_formed,
    wrong_header,
)
from eventmart.plans.landing import (
    LINES,
    fresh_rows,
    gate_feeds,
    indexed,
    land,
    quarantine,
    tidy,
)
from eventmart.operators.quality import Settle
from eventmart.session import Workspace, fitted_shuffles, stored_bytes
from eventmart.sources import FILE_NAME, file_facts, placed, stored, stream_lines
from eventmart.specs import FeedSpec


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns a checkpoint; it stays the same over restarts."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0]
    return json.loads(text)["id"].replace("-", "")


def checked_lines(
    lines: DataFrame, spec: FeedSpec, settle: Settle
) -> tuple[DataFrame, DataFrame]:
    """Rows of the files that are accepted, and lines to set aside with their reason: malformed
    ones, and those of files with a wrong name or header."""
    facts = settle(file_facts(lines, spec.columns, LINE))
    name = F.element_at(F.split("path", "/"), -1)
    reason = F.when(~own_name("file_name", spec), bad_name("file_name", spec)).when(
        ~F.col("header_ok"), F.lit(wrong_header(spec))
    )
    facts = facts.withColumn("file_name", name).withColumn("reason", reason)
    good = data_lines(lines, facts.where("reason IS NULL"))
    refused = data_lines(lines, facts.where("reason IS NOT NULL"), "reason")
    rejects = malformed(good).unionByName(
        refused.drop(KIND).withColumnRenamed("reason", fv.ERROR_REASON)
    )
    return well_formed(good), rejects


def stream_feed(
    spark: SparkSession,
    spec: FeedSpec,
    table_path: str,
    error_path: str,
    checkpoint: str,
    archive: str | None = None,
    max_files: int | None = None,
    clock: Callable[[], dt.datetime] = _now,
    every: str | None = None,
    others: Iterable[FeedSpec] = (),
) -> StreamingQuery:
    """Take in all waiting files of a feed that has no links, then stop.

    With ``every``, such as "1 minute", keep looking for new files instead.

    Each micro-batch lands as its own batch of the table, named by its query and number, and
    reads only the other batches, so a batch repeated after a failure replaces itself, and none
    of another query. Lines of files with a wrong name or header are quarantined; files that one
    of the ``others`` claims are left to it.
    """
    if spec.rules.links:
        raise ValueError("linked feeds need the others of their family: use stream_family or the batch run")
    if not spec.rules.file_pattern:
        raise ValueError(f"Unknown file type: {spec.feed_type} has no file pattern")
    others = tuple(others)
    stream = stream_lines(
        spark, spec.inbound, spec.columns, spec.sep, spec.file_prefix, max_files, archive
    )

    def handle(rows: DataFrame, number: int) -> None:
        session = rows.sparkSession
        batch = f"stream_{query_id(session, checkpoint)}_{number:09d}"
        with Workspace(session) as work:
            _land_batch(placed(rows), batch, clock(), work)

    def _land_batch(rows: DataFrame, batch: str, now: dt.datetime, work: Workspace) -> None:
        session, folder = rows.sparkSession, f"{work.folder}/staged"
        own = rows.where(own_name(FILE_NAME, spec) | ~foreign_name(FILE_NAME, spec, others))
        lines = stage(own.withColumn(fv.INTAKE_TIME, F.lit(now)), folder)
        with fitted_shuffles(session, stored_bytes(session, folder)):
            good, rejects = checked_lines(lines, spec, work.settle)
            quarantine(rejects, error_path, batch, now, LINES)
            snapshot = stored(session, table_path, but=batch)
            fresh = fresh_rows(good, snapshot, spec.rules, now, work.settle)
            rules = {spec.feed_type: spec.rules}
            tagged = gate_feeds(
                {spec.feed_type: fresh}, {spec.feed_type: snapshot}, rules, work.settle
            )
            index = indexed(spec.feed_type, rules)
            rows = tagged[spec.feed_type]
            land(rows, table_path, error_path, batch, now, spec.rules.types, index)
            tidy(session, table_path, index)

    return _started(stream, handle, checkpoint, every)


def _started(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()
