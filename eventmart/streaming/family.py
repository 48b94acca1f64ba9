"""Continuous intake of linked feeds: rows without their counterpart wait for it.

All feeds of a family are one stream, so a micro-batch sees the same state of each. A row that lacks
a link is not rejected at once: it waits beside the tables, keeps the time since when, and is
offered again with every micro-batch, together with all others. It lands when its counterparts have
come, in whatever order the files arrive, and is set aside with the link's reason when its time is
up. Parents wait for their children as children wait for their parents.

What waits is a table of its own per feed, replaced by each micro-batch through a manifest. The set
before is kept, so a micro-batch that is repeated after a failure starts from the same rows and
gives the same. A micro-batch reads all waiting rows, which the time limit bounds, but of the tables
only the buckets that its keys fall into.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventmart import fixed_values as fv
from eventmart.plans.flow import Counts, Layout, run_name
from eventmart.plans.intake import KIND, LINE, foreign_name, own_name
from eventmart.plans.landing import (
    LINES,
    fresh_rows,
    gate_feeds,
    indexed,
    land,
    quarantine,
    tidy,
)
from eventmart.session import Workspace, fitted_shuffles, stored_bytes
from eventmart.sources import (
    CORRUPT,
    FILE_NAME,
    FILE_PATH,
    PLACE,
    placed,
    read_table,
    state,
    stored,
    stream_lines,
    sweep,
    write_batch,
    write_table,
)
from eventmart.sources.batches import Batch, State, commit, read_batches
from eventmart.specs import FeedSpec
from eventmart.streaming.intake import _now, _started, checked_lines, query_id

SINCE = "waits_since"
FEED, VALUES = "feed_type", "feed_values"

Specs = Mapping[str, FeedSpec]


def _waiting(spark: SparkSession, path: str, batch: str) -> Batch | None:
    """The set that waits when ``batch`` begins, also if that has replaced it already."""
    now = state(spark, path)
    before = now.but(batch).batches if now is not None else ()
    return before[-1] if before else None


def _keep_waiting(rows: DataFrame, path: str, batch: str, before: Batch | None) -> int:
    """Replace the waiting rows; the set before stays until the next batch."""
    spark = rows.sparkSession
    written = write_batch(spark, path, batch, rows)
    kept = (before,) if before is not None else ()
    commit(spark, path, replace(state(spark, path) or State(), batches=(*kept, written)))
    sweep(spark, path)
    return written.rows


def land_family(
    spark: SparkSession,
    specs: Specs,
    layout: Layout,
    feeds: Mapping[str, DataFrame],
    batch: str,
    now: dt.datetime,
    wait: dt.timedelta,
    work: Workspace,
) -> Counts:
    """Land new and waiting rows of linked feeds as one batch; returns the rows that landed, were
    rejected and wait."""
    rules = {name: spec.rules for name, spec in specs.items()}
    snapshots = {n: stored(spark, layout.landing(s.table), but=batch) for n, s in specs.items()}
    before = {n: _waiting(spark, layout.waiting(n), batch) for n in specs}
    fresh = {}
    for name in specs:
        held = before[name] if before[name] is not None and before[name].rows else None
        again = read_batches(spark, layout.waiting(name), [held]) if held else None
        rows = feeds.get(name)
        if rows is None:
            rows, again = again, None
        if rows is not None:
            known = snapshots[name], rules[name]
            fresh[name] = fresh_rows(rows, *known, now, work.settle, again)
    counts = {}
    for name, tagged in gate_feeds(fresh, snapshots, rules, work.settle).items():
        if SINCE not in tagged.columns:
            tagged = tagged.withColumn(SINCE, F.lit(None).cast("timestamp"))
        tagged = tagged.withColumn(SINCE, F.coalesce(SINCE, F.lit(now).cast("timestamp")))
        unlinked = F.col(fv.ERROR_REASON) == rules[name].link_reason
        in_time = F.col(SINCE) > F.lit(now - wait).cast("timestamp")
        waits = F.coalesce(unlinked & in_time, F.lit(False))
        tagged = work.settle(tagged.withColumn("waits", waits))
        index, table = indexed(name, rules), layout.landing(specs[name].table)
        kept, rejected = land(
            tagged.where("NOT waits").drop("waits", SINCE),
            table,
            layout.errors(name),
            batch,
            now,
            rules[name].types,
            index,
        )
        own = ("waits", fv.ERROR_REASON, fv.DUPLICATE_FLAG)
        left = _keep_waiting(tagged.where("waits").drop(*own), layout.waiting(name), batch, before[name])
        counts |= {f"landing {name}": kept, f"rejected {name}": rejected, f"waiting {name}": left}
    for name in fresh:
        tidy(spark, layout.landing(specs[name].table), indexed(name, rules))
    return counts


def end_waits(
    spark: SparkSession, specs: Specs, layout: Layout, now: dt.datetime, wait: dt.timedelta
) -> Counts:
    """Set aside what has waited for ``wait``, while no stream of the family runs.

    A stream does so itself whenever files arrive; this is for when none do.
    """
    with Workspace(spark) as work:
        batch = f"waits_{run_name(now)}"
        return land_family(spark, specs, layout, {}, batch, now, wait, work)


def _packed(lines: DataFrame, spec: FeedSpec) -> DataFrame:
    """Lines of one feed with their values as a list, so that feeds of a family fit together."""
    values = F.array(*[F.col(c) for c in spec.columns]).alias(VALUES)
    return lines.select(F.lit(spec.feed_type).alias(FEED), values, CORRUPT, FILE_PATH, PLACE)


def _stage(rows: DataFrame, folder: str, now: dt.datetime) -> DataFrame:
    """Write the lines of a micro-batch once, those of each feed and kind on their own."""
    kind = F.when(F.col(CORRUPT).isNull(), "rows").otherwise("malformed")
    rows = rows.withColumns({KIND: kind, fv.INTAKE_TIME: F.lit(now)})
    rows = rows.withColumnRenamed(CORRUPT, LINE)
    write_table(rows, folder, [FEED, KIND], whole=True)
    order = [f for f in rows.schema if f.name not in (FEED, KIND)]
    last = [rows.schema[FEED], rows.schema[KIND]]
    return read_table(rows.sparkSession, folder, T.StructType([*order, *last]))


def _lines_of(staged: DataFrame, spec: FeedSpec, specs: Specs) -> DataFrame:
    """Lines of one feed, without those of files that another feed claims."""
    values = [F.col(VALUES)[i].alias(c) for i, c in enumerate(spec.columns)]
    lines = staged.where(F.col(FEED) == spec.feed_type)
    lines = lines.select(*values, LINE, FILE_PATH, PLACE, FILE_NAME, fv.INTAKE_TIME, KIND)
    foreign = foreign_name(FILE_NAME, spec, specs.values())
    return lines.where(own_name(FILE_NAME, spec) | ~foreign)


def stream_family(
    spark: SparkSession,
    specs: Specs,
    layout: Layout,
    checkpoint: str,
    wait: dt.timedelta,
    max_files: int | None = None,
    clock: Callable[[], dt.datetime] = _now,
    every: str | None = None,
) -> StreamingQuery:
    """Take in all waiting files of feeds that are linked to each other, then stop.

    With ``every``, such as "1 minute", keep looking for new files instead. A row that lacks a
    link waits for it, as long as ``wait``. ``max_files`` bounds a micro-batch per feed.
    """
    for spec in specs.values():
        lost = [link.feed_type for link in spec.rules.links if link.feed_type not in specs]
        if lost:
            raise ValueError(f"Feed {spec.feed_type} is linked to feeds that are left out: {lost}")
        if not spec.rules.file_pattern:
            raise ValueError(f"Unknown file type: {spec.feed_type} has no file pattern")
    streams = [
        _packed(
            stream_lines(spark, s.inbound, s.columns, s.sep, s.file_prefix, max_files), s
        )
        for s in specs.values()
    ]

    def handle(rows: DataFrame, number: int) -> None:
        session, now = rows.sparkSession, clock()
        batch = f"stream_{query_id(session, checkpoint)}_{number:09d}"
        with Workspace(session) as work:
            folder = f"{work.folder}/staged"
            staged, feeds = _stage(placed(rows), folder, now), {}
            with fitted_shuffles(session, stored_bytes(session, folder)):
                for name, spec in specs.items():
                    lines = _lines_of(staged, spec, specs)
                    if lines.isEmpty():
                        continue
                    good, rejects = checked_lines(lines, spec, work.settle)
                    quarantine(rejects, layout.errors(name), batch, now, LINES)
                    feeds[name] = good
                land_family(session, specs, layout, feeds, batch, now, wait, work)

    return _started(reduce(DataFrame.unionAll, streams), handle, checkpoint, every)
