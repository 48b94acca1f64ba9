"""Marts as sums that a batch changes, instead of counts over all rows.

A state is a table of lines, each a kind, the values of a group, and measures; lines of one
group add up. ``EVENT`` lines hold, per event, how many rows have which dimensions, how often
it was deleted, and the counts of its participants, whatever comes first. The other kinds hold
the marts. A batch needs the lines of its own events only: what they gave to each mart before
and what they give with the batch differ by a few lines per group, which are added to the mart.

Distinct events are counted from the state, as those that have rows in the group. That is exact,
and unlike a bitmap or a sketch, whose union cannot be undone, it can be taken back: rows with a
``sign`` of -1 undo the same rows with 1. Event ids are compared as text. NULL ids match nothing.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions import day, require_columns
from eventmart.operators import marts
from eventmart.operators.quality import Settle

EVENT, ENGAGEMENT = "event", "engagement"
# The dimensions of each kind of mart that counts events.
GROUPS = {
    "day": ("event_date",),
    "type": ("event_type",),
    "brand": ("brand_id", "brand_name"),
}
DIMENSIONS = {
    "event_date": "date",
    "event_type": "string",
    "brand_id": "string",
    "brand_name": "string",
    "participant_type": "string",
}
MEASURES = (
    "copies", "deletes", "events", "registrations", "attendees", "participant_rows",
    "joined_rows", "registered", "no_shows",
)
# A line is found by its spot: the id of an event, or the values of a group.
KEYS = ("kind", "spot", *DIMENSIONS)
_COUNTS = ("deletes", "registrations", "attendees", "participant_rows")


def lines(df: DataFrame, kind: str, sign: int = 1, **given: Column) -> DataFrame:
    """``df`` as lines: ``given`` are the values of their columns, others are NULL or zero."""
    group = [given[d].cast("string") for d in DIMENSIONS if d in given]
    spot = given.get("spot", F.to_json(F.array(*group), {"ignoreNullFields": "false"}))
    return df.select(
        F.lit(kind).alias("kind"),
        spot.cast("string").alias("spot"),
        *[given.get(d, F.lit(None)).cast(t).alias(d) for d, t in DIMENSIONS.items()],
        *[(given.get(m, F.lit(0)) * sign).cast("long").alias(m) for m in MEASURES],
    )


def fold(state: DataFrame) -> DataFrame:
    """Lines of one group added up; those that add up to nothing go."""
    sums = state.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
    return sums.where(reduce(or_, [F.col(m) != 0 for m in MEASURES]))


def event_lines(events: DataFrame, sign: int = 1) -> DataFrame:
    """Rows of events, with the dimensions of all marts."""
    held = [d for d in DIMENSIONS if d != "participant_type"]
    require_columns(events, ["event_id", *held], "events")
    values = {d: day(events, d) if d == "event_date" else F.col(d) for d in held}
    return lines(events, EVENT, sign, spot=F.col("event_id"), copies=F.lit(1), **values)


def delete_lines(deletes: DataFrame, sign: int = 1) -> DataFrame:
    """Deleted events, known by then or not."""
    gone = deletes.where("event_id IS NOT NULL")
    return lines(gone, EVENT, sign, spot=F.col("event_id"), deletes=F.lit(1))


def participant_lines(participants: DataFrame, sign: int = 1) -> DataFrame:
    """Participants counted per event and per participant type."""
    counts = marts.attendance_by_event(participants.where("event_id IS NOT NULL"))
    columns = {m: F.col(m) for m in ("registrations", "attendees", "participant_rows")}
    of_events = lines(counts, EVENT, sign, spot=F.col("event_id"), **columns)
    types = marts.engagement_counts(participants)
    columns |= {m: F.col(m) for m in ("participant_type", "registered", "no_shows")}
    return of_events.unionByName(lines(types, ENGAGEMENT, sign, **columns))


def touched(old: DataFrame, new: DataFrame) -> DataFrame:
    """The ``EVENT`` lines of ``old`` whose event has such a line in ``new``."""
    ids = new.where(F.col("kind") == EVENT).select(F.col("spot").alias("_id")).distinct()
    held = old.where(F.col("kind") == EVENT)
    return held.join(ids, F.col("spot").eqNullSafe(F.col("_id")), "left_semi")


def _gives(when: str) -> dict[str, Column]:
    """What an event gives to a group, as of the columns that end in ``when``."""
    def at(name: str) -> Column:
        return F.coalesce(F.col(f"{name}_{when}"), F.lit(0))

    copies = F.when(at("deletes") > 0, 0).otherwise(F.greatest(at("copies"), F.lit(0)))
    return {
        "events": F.when((copies > 0) & F.col("spot").isNotNull(), 1).otherwise(0),
        "registrations": copies * at("registrations"),
        "attendees": copies * at("attendees"),
        "joined_rows": copies * F.greatest(at("participant_rows"), F.lit(1)),
    }


def _changes(base: DataFrame, group: list[str]) -> DataFrame:
    """What events change in their groups, added up; several lines of an event and group are one."""
    known = [F.first(f"{m}_{w}").alias(f"{m}_{w}") for m in _COUNTS for w in ("before", "after")]
    copies = [F.sum(f"copies_{w}").alias(f"copies_{w}") for w in ("before", "after")]
    per_event = base.groupBy("spot", *group).agg(*copies, *known)
    before, after = _gives("before"), _gives("after")
    return per_event.groupBy(*group).agg(
        *[F.sum(after[m] - before[m]).alias(m) for m in before]
    )


def mart_lines(old: DataFrame, new: DataFrame, settle: Settle | None = None) -> DataFrame:
    """What ``new`` event lines change in the marts; ``old`` are all earlier lines of the events.

    One shuffle by event puts an event's counts beside its dimensions. Nearly all events have one
    line of dimensions, which is regrouped for all marts at once, without another look at the
    event; only events with more are first added up per event and group. ``settle`` keeps what
    both read, so that it is made once.
    """
    both = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    event = Window.partitionBy("spot")

    def before(name: str) -> Column:
        return F.when(F.col("_new"), 0).otherwise(F.col(name))

    def count(value: Column) -> Column:  # NULL ids match nothing
        return F.when(F.col("spot").isNotNull(), F.sum(value).over(event))

    dimensions = [d for group in GROUPS.values() for d in group]
    base = both.select(
        "spot",
        *dimensions,
        before("copies").alias("copies_before"),
        F.col("copies").alias("copies_after"),
        *[count(before(m)).alias(f"{m}_before") for m in _COUNTS],
        *[count(F.col(m)).alias(f"{m}_after") for m in _COUNTS],
        F.sum((F.col("copies") != 0).cast("int")).over(event).alias("_held"),
    ).where("copies_after <> 0")
    if settle is not None:
        base = settle(base)
    gives, gave = _gives("after"), _gives("before")
    single = base.where("_held = 1").select(
        *dimensions, *[(gives[m] - gave[m]).alias(m) for m in gives]
    )
    several = base.where("_held > 1")
    sums = single.groupingSets([list(group) for group in GROUPS.values()], *dimensions).agg(
        F.grouping_id().alias("_set"), *[F.sum(m).alias(m) for m in gives]
    )
    out = None
    for kind, group in GROUPS.items():
        # a set's number has a bit for each dimension that it leaves out, the first one highest
        number = sum(
            1 << at for at, d in enumerate(reversed(dimensions)) if d not in group
        )
        own = sums.where(F.col("_set") == number).select(*group, *gives)
        own = own.unionByName(_changes(several, list(group)))
        own = own.groupBy(*group).agg(*[F.sum(m).alias(m) for m in gives])
        part = lines(own, kind, **{c: F.col(c) for c in (*group, *gives)})
        out = part if out is None else out.unionByName(part)
    return out.where(reduce(or_, [F.col(m) != 0 for m in MEASURES]))


def marts_of(state: DataFrame, run_date: str | None = None) -> dict[str, DataFrame]:
    """Mart name to mart, from all lines of a state."""

    def base(kind: str) -> DataFrame:
        group = GROUPS.get(kind, ("participant_type",))
        rows = "joined_rows" if kind in GROUPS else "participant_rows"
        sums = state.where(F.col("kind") == kind).groupBy(*group).agg(
            *[F.sum(m).alias(m) for m in MEASURES]
        )
        return sums.where(F.col(rows) > 0)

    brands = marts.brand_performance(base("brand"), run_date, counted="events")
    return {
        "event_performance_kpi": marts.event_performance(base("day"), run_date, counted="events"),
        "product_performance_kpi": brands.drop("attendance_rate"),
        "participant_engagement_kpi": marts.engagement_of(base(ENGAGEMENT), run_date),
        "event_type_participants_kpi": marts.event_type_participants(
            base("type"), run_date, counted="events"
        ),
        "brand_performance_kpi": brands,
    }
