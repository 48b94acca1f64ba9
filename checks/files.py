"""Files and stored tables: the given tables are written as feeds, taken in and landed."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from checks.registry import SQL_PARTICIPANTS, line_participants, order_events, query, table
from eventmart.plans import build_marts, export_latest, flow, gate_feeds, land, landed, take_in
from eventmart.plans.landing import fresh_rows
from eventmart.session import settle, work_dir
from eventmart.sources import (
    read_delimited,
    read_master,
    read_optional,
    read_table,
    write_delimited,
)
from eventmart.specs import DEFAULT_RULES, FeedRules, FeedSpec

RUN = dt.datetime(2025, 7, 6, 16, 0, 0)
NEXT = dt.datetime(2025, 7, 7, 16, 0, 0)
ORDER_COLUMNS = ("event_id", "event_date", "event_type", "status")
ORDER_RULES = FeedRules(
    keys=("event_id",), required=("event_id", "event_type"), file_pattern=r"part-.*\.csv$"
)

ORDERS = """
SELECT CAST(o_orderkey AS VARCHAR) AS event_id, strftime(o_orderdate, '%Y-%m-%d') AS event_date,
       NULLIF(o_orderpriority, '5-LOW') AS event_type, o_orderstatus AS status
FROM orders
"""


def orders_feed(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("event_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("event_date"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("event_type"),
        F.col("o_orderstatus").alias("status"),
    )


def spec_of(folder: str, columns=ORDER_COLUMNS, rules=ORDER_RULES, sep="|") -> FeedSpec:
    staged = f"{folder}_staged"
    return FeedSpec("event", "lm_events", folder, staged, "part-", sep, columns, rules)


@query("delimited_roundtrip", ORDERS)
def delimited_roundtrip(spark, d):
    folder = f"{work_dir(spark)}/orders"
    write_delimited(orders_feed(spark, d), folder)
    return read_delimited(spark, folder, ORDER_COLUMNS, "|").select(*ORDER_COLUMNS)


@query(
    "master_scan",
    "SELECT CAST(s_suppkey AS VARCHAR) AS source_id, s_name AS mdm_id FROM supplier",
)
def master_scan(spark, d):
    folder = f"{work_dir(spark)}/master"
    suppliers = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("source_id"), F.col("s_name").alias("mdm_id")
    )
    write_delimited(suppliers, folder, ",")
    return read_master(spark, folder)


@query("intake_rows", ORDERS)
def intake_rows(spark, d):
    folder = f"{work_dir(spark)}/orders"
    write_delimited(orders_feed(spark, d), folder)
    return take_in(spark, spec_of(folder), RUN, settle).rows.select(*ORDER_COLUMNS)


_LANDED = f"SELECT * FROM ({ORDERS}) WHERE event_type IS NOT NULL"


def _land(spark, feed, folder, run, batch):
    path = f"{folder}/landing"
    snapshot = landed(spark, path, but=batch)
    fresh = fresh_rows(feed, snapshot, ORDER_RULES, run)
    tagged = gate_feeds({"event": fresh}, {}, {"event": ORDER_RULES}, settle)["event"]
    land(tagged, path, f"{folder}/error", batch, run)


def _two_runs(spark, d):
    """First the closed orders, then all of them, the second run repeated."""
    folder = f"{work_dir(spark)}/layers"
    orders = orders_feed(spark, d)
    _land(spark, orders.where("status = 'F'").drop("event_date"), folder, RUN, "run_1")
    _land(spark, orders, folder, NEXT, "run_2")
    _land(spark, orders, folder, NEXT, "run_2")
    return folder


@query(
    "landing_two_runs",
    f"""SELECT event_id, event_type, status,
               CASE WHEN status <> 'F' THEN event_date END AS event_date,
               CASE WHEN status = 'F' THEN '2025-07-06' ELSE '2025-07-07' END
                 AS oasis_load_time
        FROM ({_LANDED})""",
)
def landing_two_runs(spark, d):
    stored = landed(spark, f"{_two_runs(spark, d)}/landing")
    loaded = F.col("oasis_load_time").cast("string").alias("oasis_load_time")
    return stored.select("event_id", "event_type", "status", "event_date", loaded)


@query(
    "quarantine_two_runs",
    f"""SELECT 'Null value in key column' AS error_reason, status, count(*) AS n,
               '2025-07-07' AS last_day
        FROM ({ORDERS}) WHERE event_type IS NULL GROUP BY status
        UNION ALL SELECT 'Null value in key column', 'F first run', count(*), '2025-07-06'
        FROM ({ORDERS}) WHERE event_type IS NULL AND status = 'F'""",
)
def quarantine_two_runs(spark, d):
    errors = read_optional(spark, f"{_two_runs(spark, d)}/error", merge=True)
    first = F.col("load_batch") == "run_1"
    return errors.groupBy(
        "error_reason",
        F.when(first, F.concat("status", F.lit(" first run")))
        .otherwise(F.col("status"))
        .alias("status"),
    ).agg(
        F.count("*").alias("n"),
        F.max("error_timestamp").cast("date").cast("string").alias("last_day"),
    )


@query(
    "export_latest",
    """SELECT CAST(l_orderkey AS VARCHAR) AS event_id, CAST(l_linenumber AS VARCHAR) AS line,
              strftime(l_shipdate, '%Y-%m-%d') AS oasis_modified_date
       FROM lineitem WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)""",
)
def exported(spark, d):
    lines = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("event_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_shipdate").cast("date").alias("oasis_modified_date"),
    )
    path, _ = export_latest(lines, "lm_events", work_dir(spark), RUN.date())
    columns = ("event_id", "line", "oasis_modified_date")
    return read_delimited(spark, path, columns, "|").select(*columns)


def _feeds(spark, d) -> tuple[dict[str, FeedSpec], flow.Masters, flow.Layout]:
    """Orders as events and order lines as participants, written as feeds below a new base."""
    base = work_dir(spark)
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    flag = F.col("l_returnflag")
    feeds = {
        "event": orders.select(
            F.col("o_orderkey").alias("event_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("event_date"),
            priority.alias("event_type"),
            F.concat(status, F.lit(" | "), priority).alias("event_brand"),
            status.alias("indication_name"),
        ),
        "participant": lines.select(
            F.col("l_linenumber").alias("participant_id"),
            F.col("l_orderkey").alias("event_id"),
            F.nullif(flag, F.lit("R")).alias("hcp_id"),
            F.col("l_linestatus").alias("participant_type"),
            F.when(F.col("l_quantity") >= 25, "Y").otherwise("N").alias("registered"),
            F.when(flag == "A", "Y").otherwise("N").alias("attended"),
        ),
    }
    specs = {}
    for name, feed in feeds.items():
        folder = f"{base}/inbound/{name}"
        write_delimited(feed, folder)
        rules = replace(DEFAULT_RULES[name], file_pattern=ORDER_RULES.file_pattern)
        specs[name] = FeedSpec(
            name, f"lm_{name}s", folder, f"{base}/preprocess", "part-", "|",
            tuple(feed.columns), rules,
        )
    customers = table(spark, d, "customer")
    master_id = F.concat(F.lit("M"), "c_custkey")
    masters = flow.Masters(
        orders.select(
            priority.alias("source_product_name"),
            F.left(priority, F.lit(1)).alias("brand_id"),
            priority.alias("brand_name"),
        ).distinct(),
        orders.select(
            status.alias("source_indication_name"), F.lower(status).alias("indication_id")
        ).distinct(),
        customers.select(
            F.col("c_custkey").cast("string").alias("source_id"), master_id.alias("mdm_id")
        ),
        customers.where("c_acctbal < 0").select(
            master_id.alias("loser_mdm_id"), F.lit("M0").alias("winner_mdm_id")
        ),
    )
    return specs, masters, flow.Layout(f"{base}/lake")


@query(
    "flow_brand_mart",
    """WITH participants AS (
         SELECT * FROM lineitem
         QUALIFY count(*) OVER (PARTITION BY l_linenumber, l_orderkey) = 1
             AND l_returnflag <> 'R')
       SELECT '412|' || left(o_orderpriority, 1) AS brand_id,
              'UNKNOWN|' || o_orderpriority AS brand_name,
              count(DISTINCT o_orderkey) AS event_count,
              count(l_linenumber) AS total_registrations,
              sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END)::BIGINT AS total_attendees,
              sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END)::DOUBLE
                / NULLIF(count(l_linenumber), 0) AS attendance_rate,
              sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END)::DOUBLE
                / count(DISTINCT o_orderkey) AS avg_attendance_per_event,
              '2025-07-06' AS processing_date
       FROM orders LEFT JOIN participants ON o_orderkey = l_orderkey
       GROUP BY o_orderpriority""",
)
def flow_brand_mart(spark, d):
    """From feed files through all layers to a stored mart."""
    specs, masters, layout = _feeds(spark, d)
    flow.run(spark, specs, masters, layout, RUN)
    return read_table(spark, layout.summarized("brand_performance_kpi"))


_MART_ROWS = f"""
SELECT o_orderkey AS event_id, strftime(o_orderdate, '%Y-%m-%d') AS event_date,
       o_orderpriority AS event_type, o_orderstatus AS brand_id,
       lower(o_orderstatus) AS brand_name, participant_id, attended
FROM orders LEFT JOIN ({SQL_PARTICIPANTS}) p ON o_orderkey = order_id
"""
_CAME = "sum(CASE WHEN attended = 'Y' THEN 1 ELSE 0 END)"
_SAME = f"""count(DISTINCT event_id)::DOUBLE AS events,
            count(participant_id)::DOUBLE AS registrations, {_CAME}::DOUBLE AS attendees"""
_SHARE = f"{_CAME}::DOUBLE / NULLIF(count(participant_id), 0)"
_EACH = f"{_CAME}::DOUBLE / count(DISTINCT event_id)"


@query(
    "marts_shared_base",
    f"""WITH r AS ({_MART_ROWS})
        SELECT 'event_performance_kpi' AS mart, event_date AS label, {_SAME},
               avg(CASE WHEN attended = 'Y' THEN 1 ELSE 0 END) AS one, {_SHARE} AS other
        FROM r GROUP BY event_date
        UNION ALL SELECT 'product_performance_kpi', brand_id || brand_name, {_SAME}, {_EACH}, NULL
        FROM r GROUP BY brand_id, brand_name
        UNION ALL SELECT 'brand_performance_kpi', brand_id || brand_name, {_SAME}, {_SHARE}, {_EACH}
        FROM r GROUP BY brand_id, brand_name
        UNION ALL SELECT 'event_type_participants_kpi', event_type, {_SAME}, {_SHARE},
               count(participant_id)::DOUBLE / count(DISTINCT event_id) FROM r GROUP BY event_type
        UNION ALL SELECT 'participant_engagement_kpi', participant_type, NULL,
               count(participant_id)::DOUBLE, {_CAME}::DOUBLE, {_SHARE},
               sum(CASE WHEN registered = 'Y' AND attended = 'N' THEN 1 ELSE 0 END)::DOUBLE
                 / NULLIF(sum(CASE WHEN registered = 'Y' THEN 1 ELSE 0 END), 0)
        FROM ({SQL_PARTICIPANTS}) GROUP BY participant_type""",
)
def marts_shared_base(spark, d):
    """All measures of all five marts built in one go from one stored base."""
    status = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_orderstatus").alias("brand_id"),
        F.lower("o_orderstatus").alias("brand_name"),
    )
    events = order_events(spark, d).join(status, "event_id")
    marts = build_marts(events, line_participants(spark, d), settle=settle, unique=True)
    brand = F.concat("brand_id", "brand_name")
    totals = ("event_count", "total_registrations", "total_attendees")
    measures = {
        "event_performance_kpi": (
            F.col("event_date"), "total_events", *totals[1:],
            "avg_attendance_per_event", "attendance_rate",
        ),
        "product_performance_kpi": (brand, *totals, "avg_attendance_per_event", None),
        "brand_performance_kpi": (
            brand, *totals, "attendance_rate", "avg_attendance_per_event",
        ),
        "event_type_participants_kpi": (
            F.col("event_type"), *totals, "attendance_rate", "avg_registrations_per_event",
        ),
        "participant_engagement_kpi": (
            F.col("participant_type"), None, "total_participants", "attended_count",
            "attendance_rate", "no_show_rate",
        ),
    }
    names, out = ("events", "registrations", "attendees", "one", "other"), None
    for mart, (label, *columns) in measures.items():
        values = [F.lit(None) if c is None else F.col(c) for c in columns]
        rows = marts[mart].select(
            F.lit(mart).alias("mart"),
            label.alias("label"),
            *[v.cast("double").alias(n) for v, n in zip(values, names)],
        )
        out = rows if out is None else out.unionByName(rows)
    return out
