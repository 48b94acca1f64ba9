"""Attendance and engagement marts.

Four marts share one base: participants are counted per event before any join, so the join
has one row per event on the participant side whatever the size of an event, and each mart
is then a small regrouping of that base.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart import fixed_values as fv
from eventmart.functions import day, day_text, flag_count, ratio, require_columns


def _processed(mart: DataFrame, run_date: str | None) -> DataFrame:
    if run_date is None:
        return mart
    return mart.withColumn(fv.PROCESSING_DATE, F.lit(run_date))


def attendance_by_event(participants: DataFrame) -> DataFrame:
    """Per event: participants with an id, attendees, and rows."""
    require_columns(participants, ["event_id", "participant_id", "attended"], "participants")
    return participants.groupBy("event_id").agg(
        F.count("participant_id").alias("registrations"),
        flag_count(F.col("attended") == "Y").alias("attendees"),
        F.count("*").alias("participant_rows"),
    )


def event_attendance(
    events: DataFrame, participants: DataFrame, dimensions: Sequence[str]
) -> DataFrame:
    """Each event with its dimensions and counts; the base of the four event marts.

    ``joined_rows`` is how many rows the event would have in a plain left join with its
    participants: an event without any still has one.
    """
    require_columns(events, ["event_id", *dimensions], "events")
    counts = attendance_by_event(participants)
    return (
        events.select("event_id", *dimensions)
        .join(counts, "event_id", "left")
        .select(
            "event_id",
            *dimensions,
            F.coalesce("registrations", F.lit(0)).alias("registrations"),
            F.coalesce("attendees", F.lit(0)).alias("attendees"),
            F.coalesce("participant_rows", F.lit(1)).alias("joined_rows"),
        )
    )


def _events(unique: bool, counted: str | None = None) -> Column:
    """Events of a group; a base of ``unique`` events has a row for each, so rows are counted
    where they are, and no event is shuffled to be told from its repeats. A base of groups has
    its events already counted, in the column ``counted``."""
    if counted is not None:
        return F.sum(counted)
    return F.count("event_id") if unique else F.count_distinct("event_id")


def _registrations() -> Column:
    return F.sum("registrations")


def _attendees() -> Column:
    return F.sum("attendees")


def event_performance(
    base: DataFrame, run_date: str | None = None, unique: bool = False, counted: str | None = None
) -> DataFrame:
    """Per day. ``avg_attendance_per_event`` is the share of attended rows, where an event
    without participants counts as one row; ``attendance_rate`` divides by participants."""
    require_columns(base, ["event_date"], "event attendance")
    # Grouped as a date, which is narrower than its text, and written as text at the end.
    mart = base.groupBy(day(base, "event_date").alias("event_date")).agg(
        _events(unique, counted).alias("total_events"),
        _registrations().alias("total_registrations"),
        _attendees().alias("total_attendees"),
        ratio(_attendees(), F.sum("joined_rows")).alias("avg_attendance_per_event"),
        ratio(_attendees(), _registrations()).alias("attendance_rate"),
    )
    return _processed(mart.withColumn("event_date", day_text(F.col("event_date"))), run_date)


def brand_performance(
    base: DataFrame, run_date: str | None = None, unique: bool = False, counted: str | None = None
) -> DataFrame:
    """Per brand combination, with the attendance rate."""
    mart = base.groupBy("brand_id", "brand_name").agg(
        _events(unique, counted).alias("event_count"),
        _registrations().alias("total_registrations"),
        _attendees().alias("total_attendees"),
        ratio(_attendees(), _registrations()).alias("attendance_rate"),
        ratio(_attendees(), _events(unique, counted)).alias("avg_attendance_per_event"),
    )
    return _processed(mart, run_date)


def product_performance(
    base: DataFrame, run_date: str | None = None, unique: bool = False, counted: str | None = None
) -> DataFrame:
    """Per brand combination: the brand mart without the attendance rate."""
    return brand_performance(base, run_date, unique, counted).drop("attendance_rate")


def event_type_participants(
    base: DataFrame, run_date: str | None = None, unique: bool = False, counted: str | None = None
) -> DataFrame:
    """Per event type."""
    require_columns(base, ["event_type"], "event attendance")
    mart = base.groupBy("event_type").agg(
        _events(unique, counted).alias("event_count"),
        _registrations().alias("total_registrations"),
        _attendees().alias("total_attendees"),
        ratio(_attendees(), _registrations()).alias("attendance_rate"),
        ratio(_registrations(), _events(unique, counted)).alias("avg_registrations_per_event"),
    )
    return _processed(mart, run_date)


def engagement_counts(participants: DataFrame) -> DataFrame:
    """Per participant type: what the engagement mart divides, as counts that can be added up."""
    require_columns(
        participants,
        ["participant_type", "participant_id", "attended", "registered"],
        "participants",
    )
    registered = F.col("registered") == "Y"
    return participants.groupBy("participant_type").agg(
        F.count("participant_id").alias("registrations"),
        flag_count(F.col("attended") == "Y").alias("attendees"),
        flag_count(registered).alias("registered"),
        flag_count(registered & (F.col("attended") == "N")).alias("no_shows"),
        F.count("*").alias("participant_rows"),
    )


def engagement_of(counts: DataFrame, run_date: str | None = None) -> DataFrame:
    """The engagement mart from its counts, one row per participant type."""
    mart = counts.select(
        "participant_type",
        F.col("registrations").alias("total_participants"),
        F.col("attendees").alias("attended_count"),
        ratio(F.col("attendees"), F.col("registrations")).alias("attendance_rate"),
        ratio(F.col("no_shows"), F.col("registered")).alias("no_show_rate"),
    )
    return _processed(mart, run_date)


def participant_engagement(
    participants: DataFrame, run_date: str | None = None
) -> DataFrame:
    """Per participant type; needs no join."""
    return engagement_of(engagement_counts(participants), run_date)
