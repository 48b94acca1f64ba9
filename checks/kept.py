"""Marts kept up by batches equal marts made of all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import SQL_PARTICIPANTS, line_participants, query, table
from eventmart.operators import delete_lines, event_lines, marts_of, participant_lines
from eventmart.plans import kept
from eventmart.session import settle, work_dir

_BASE = f"""
SELECT o_orderkey AS event_id, strftime(o_orderdate, '%Y-%m-%d') AS event_date,
       o_orderpriority AS event_type, o_orderstatus AS brand_id, CAST(o_custkey % 100 AS VARCHAR) AS brand_name,
       participant_id, attended
FROM orders LEFT JOIN ({SQL_PARTICIPANTS}) p ON o_orderkey = order_id
WHERE o_orderkey % 11 <> 0
"""
_ATTENDEES = "sum(CASE WHEN attended = 'Y' THEN 1 ELSE 0 END)"


def _measures(mart: str, group: str) -> str:
    return f"""
SELECT '{mart}' AS mart, {group} AS grouped, count(DISTINCT event_id) AS events,
       count(participant_id) AS registrations, {_ATTENDEES}::BIGINT AS attendees,
       {_ATTENDEES}::DOUBLE / NULLIF(count(participant_id), 0) AS attendance_rate
FROM ({_BASE}) GROUP BY mart, grouped
"""


def _kept(spark, d):
    """Three batches: participants before and after their event, the second run twice, and
    deletes of events that are stored, that come with them, and that never come."""
    folder = work_dir(spark)
    key, line = F.col("event_id"), F.col("participant_id")
    events = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_orderdate").alias("event_date"),
        F.col("o_orderpriority").alias("event_type"),
        F.col("o_orderstatus").alias("brand_id"),
        (F.col("o_custkey") % 100).cast("string").alias("brand_name"),
    )
    people = line_participants(spark, d)
    deletes = table(spark, d, "lineitem").where("l_orderkey % 11 = 0")
    first = F.when((line == 1) & (key % 2 == 0), 0)
    when = first.when((line <= 3) | line.isNull(), 1).otherwise(2)
    lines = None
    for run in (0, 1, 1, 2):
        new = event_lines(events.where(key % 3 == run))
        new = new.unionByName(participant_lines(people.where(when == run)))
        if run == 2:
            gone = deletes.select(F.col("l_orderkey").alias("event_id"))
            extra = events.where(key % 11 == 0).select("event_id")
            new = new.unionByName(delete_lines(gone.unionAll(extra)))
        lines = kept.update(spark, f"{folder}/states", f"run_{run}", new, {}, settle)
    return marts_of(lines, "2025-07-06")


@query(
    "kept_event_marts",
    " UNION ALL ".join(
        _measures(mart, group)
        for mart, group in (
            ("day", "event_date"),
            ("type", "event_type"),
            ("brand", "concat_ws('|', brand_id, brand_name)"),
        )
    ),
)
def kept_event_marts(spark, d):
    marts = _kept(spark, d)
    day = marts["event_performance_kpi"].withColumnRenamed("total_events", "event_count")
    found = (
        ("day", day, F.col("event_date")),
        ("type", marts["event_type_participants_kpi"], F.col("event_type")),
        ("brand", marts["brand_performance_kpi"], F.concat_ws("|", "brand_id", "brand_name")),
    )
    out = None
    for name, mart, group in found:
        part = mart.select(
            F.lit(name).alias("mart"),
            group.alias("grouped"),
            F.col("event_count").alias("events"),
            F.col("total_registrations").alias("registrations"),
            F.col("total_attendees").alias("attendees"),
            "attendance_rate",
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "kept_engagement",
    f"""SELECT participant_type, count(participant_id) AS total_participants,
               {_ATTENDEES}::BIGINT AS attended_count,
               {_ATTENDEES}::DOUBLE / NULLIF(count(participant_id), 0) AS attendance_rate,
               sum(CASE WHEN registered = 'Y' AND attended = 'N' THEN 1 ELSE 0 END)::DOUBLE
                 / NULLIF(sum(CASE WHEN registered = 'Y' THEN 1 ELSE 0 END), 0) AS no_show_rate,
               '2025-07-06' AS processing_date
        FROM ({SQL_PARTICIPANTS}) GROUP BY participant_type""",
)
def kept_engagement(spark, d):
    return _kept(spark, d)["participant_engagement_kpi"]
