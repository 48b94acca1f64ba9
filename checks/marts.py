"""The five marts. The SQL joins participants row by row; the jobs count them per event first."""

from pyspark.sql import functions as F

from checks.registry import (
    SQL_PARTICIPANTS,
    line_participants,
    order_events,
    part_events,
    query,
)
from eventmart.operators import (
    attendance_by_event,
    brand_performance,
    event_attendance,
    event_performance,
    event_type_participants,
    participant_engagement,
    product_performance,
)

_ORDERS = f"""
SELECT o_orderkey AS event_id, strftime(o_orderdate, '%Y-%m-%d') AS event_date,
       o_orderpriority AS event_type, participant_id, attended
FROM orders LEFT JOIN ({SQL_PARTICIPANTS}) p ON o_orderkey = order_id
"""
_PARTS = f"""
SELECT p_partkey AS event_id, p_brand AS brand_id, p_type AS brand_name, participant_id, attended
FROM part LEFT JOIN ({SQL_PARTICIPANTS}) p ON p_partkey = part_id
"""
_ATTENDEES = "sum(CASE WHEN attended = 'Y' THEN 1 ELSE 0 END)"
_RATE = f"{_ATTENDEES}::DOUBLE / NULLIF(count(participant_id), 0)"


@query(
    "attendance_by_event",
    f"""SELECT order_id AS event_id, count(participant_id) AS registrations,
               {_ATTENDEES}::BIGINT AS attendees, count(*) AS participant_rows
        FROM ({SQL_PARTICIPANTS}) GROUP BY order_id""",
)
def by_event(spark, d):
    return attendance_by_event(line_participants(spark, d))


@query(
    "kpi_event_performance",
    f"""SELECT event_date, count(DISTINCT event_id) AS total_events,
               count(participant_id) AS total_registrations,
               {_ATTENDEES}::BIGINT AS total_attendees,
               avg(CASE WHEN attended = 'Y' THEN 1 ELSE 0 END) AS avg_attendance_per_event,
               {_RATE} AS attendance_rate
        FROM ({_ORDERS}) GROUP BY event_date""",
)
def kpi_event_performance(spark, d):
    base = event_attendance(order_events(spark, d), line_participants(spark, d), ["event_date"])
    return event_performance(base, unique=True)


_TYPE_MEASURES = f"""
count(DISTINCT event_id) AS event_count, count(participant_id) AS total_registrations,
{_ATTENDEES}::BIGINT AS total_attendees, {_RATE} AS attendance_rate,
count(participant_id)::DOUBLE / NULLIF(count(DISTINCT event_id), 0) AS avg_registrations_per_event
"""


@query(
    "kpi_event_type",
    f"SELECT event_type, {_TYPE_MEASURES} FROM ({_ORDERS}) GROUP BY event_type",
)
def kpi_event_type(spark, d):
    base = event_attendance(order_events(spark, d), line_participants(spark, d), ["event_type"])
    return event_type_participants(base, unique=True)


@query(
    "kpi_event_type_fine",
    f"""SELECT event_type, {_TYPE_MEASURES}
        FROM (SELECT * REPLACE (CAST(event_id AS VARCHAR) AS event_type) FROM ({_ORDERS}))
        GROUP BY event_type""",
)
def kpi_event_type_fine(spark, d):
    """One group per event: events without participants divide by zero."""
    events = order_events(spark, d).withColumn("event_type", F.col("event_id").cast("string"))
    base = event_attendance(events, line_participants(spark, d), ["event_type"])
    return event_type_participants(base, unique=True)


@query(
    "kpi_product_performance",
    f"""SELECT brand_id, brand_name, count(DISTINCT event_id) AS event_count,
               count(participant_id) AS total_registrations,
               {_ATTENDEES}::BIGINT AS total_attendees,
               {_ATTENDEES}::DOUBLE / NULLIF(count(DISTINCT event_id), 0)
                 AS avg_attendance_per_event
        FROM ({_PARTS}) GROUP BY brand_id, brand_name""",
)
def kpi_product_performance(spark, d):
    return product_performance(_parts(spark, d), unique=True)


@query(
    "kpi_brand_performance",
    f"""SELECT brand_id, brand_name, count(DISTINCT event_id) AS event_count,
               count(participant_id) AS total_registrations,
               {_ATTENDEES}::BIGINT AS total_attendees, {_RATE} AS attendance_rate,
               {_ATTENDEES}::DOUBLE / NULLIF(count(DISTINCT event_id), 0)
                 AS avg_attendance_per_event
        FROM ({_PARTS}) GROUP BY brand_id, brand_name""",
)
def kpi_brand_performance(spark, d):
    return brand_performance(_parts(spark, d), unique=True)


def _parts(spark, d):
    return event_attendance(
        part_events(spark, d),
        line_participants(spark, d, "l_partkey"),
        ["brand_id", "brand_name"],
    )


@query(
    "kpi_participant_engagement",
    f"""SELECT participant_type, count(participant_id) AS total_participants,
               {_ATTENDEES}::BIGINT AS attended_count, {_RATE} AS attendance_rate,
               sum(CASE WHEN registered = 'Y' AND attended = 'N' THEN 1 ELSE 0 END)::DOUBLE
                 / NULLIF(sum(CASE WHEN registered = 'Y' THEN 1 ELSE 0 END), 0) AS no_show_rate,
               '2025-07-06' AS processing_date
        FROM ({SQL_PARTICIPANTS}) GROUP BY participant_type""",
)
def kpi_participant_engagement(spark, d):
    return participant_engagement(line_participants(spark, d), "2025-07-06")
