"""Landing rules: feeds that need each other, typed keys, rules of groups."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from checks.files import NEXT, RUN
from checks.registry import query, table
from eventmart import fixed_values as fv
from eventmart.operators import clean_rows, rejected_rows
from eventmart.plans import Layout, fresh_rows, gate_feeds, land, landed
from eventmart.plans.landing import Place, indexed, rebuild_tables, set_aside
from eventmart.session import settle, work_dir
from eventmart.sources import read_optional, stored
from eventmart.specs import FeedRules, FeedSpec, Link
from eventmart.streaming import end_waits, stream_family

_RULES = {
    "customer": FeedRules(
        ("id",), ("name",),
        (Link("orders", ("id",), ("id",)), Link("marked", ("id",), ("id",))),
        fv.REASON_MISSING_CHILD, parent=True,
    ),
    "orders": FeedRules(("line", "id"), ("id",), (Link("customer", ("id",), ("id",)),)),
    "marked": FeedRules(("line", "id"), ("id",), (Link("customer", ("id",), ("id",)),)),
}
# Parents with both kinds of children survive; the children of the others are orphans.
_LINKED = f"""
WITH parents AS (
       SELECT c_custkey AS id, CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS name FROM customer),
     orders_of AS (SELECT o_custkey AS id, o_orderkey AS line FROM orders),
     marked_of AS (SELECT * FROM orders_of WHERE line % 3 = 0),
     tagged AS (
       SELECT 'customer' AS feed, id, NULL::BIGINT AS line,
              CASE WHEN name IS NULL THEN '{fv.REASON_NULL}'
                   WHEN id NOT IN (SELECT id FROM orders_of) OR id NOT IN (SELECT id FROM marked_of)
                   THEN '{fv.REASON_MISSING_CHILD}' END AS error_reason
       FROM parents),
     survivors AS (SELECT id FROM tagged WHERE error_reason IS NULL),
     whole AS (
       SELECT * FROM tagged
       UNION ALL
       SELECT feed, id, line, CASE WHEN id NOT IN (SELECT id FROM survivors)
                                   THEN '{fv.REASON_MISSING_PARENT}' END
       FROM (SELECT 'orders' AS feed, id, line FROM orders_of
             UNION ALL SELECT 'marked', id, line FROM marked_of))
"""


def _linked(spark, d):
    """Customers, their orders, and every third order, gated as feeds that need each other."""
    key = F.col("c_custkey")
    orders = table(spark, d, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("line")
    )
    feeds = {
        "customer": table(spark, d, "customer").select(
            key.alias("id"), F.when(key % 7 != 0, F.col("c_name")).alias("name")
        ),
        "orders": orders,
        "marked": orders.where("line % 3 = 0"),
    }
    fresh = {n: fresh_rows(f, None, _RULES[n], RUN) for n, f in feeds.items()}
    return gate_feeds(fresh, {}, _RULES, settle)


def _as_one(parts):
    out = None
    for name, part in parts.items():
        line = F.col("line") if "line" in part.columns else F.lit(None)
        more = [c for c in ("error_reason",) if c in part.columns]
        rows = part.select(
            F.lit(name).alias("feed"),
            F.col("id").cast("long").alias("id"),
            line.cast("long").alias("line"),
            *more,
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query("linked_clean", f"{_LINKED} SELECT feed, id, line FROM whole WHERE error_reason IS NULL")
def linked_clean(spark, d):
    return _as_one({n: clean_rows(t) for n, t in _linked(spark, d).items()})


@query("linked_reject", f"{_LINKED} SELECT * FROM whole WHERE error_reason IS NOT NULL")
def linked_reject(spark, d):
    return _as_one({n: rejected_rows(t) for n, t in _linked(spark, d).items()})


TYPED_RULES = FeedRules(("event_id",), ("event_id",), types={"event_id": "int"})
_TYPED = """
WITH feed AS (
       SELECT o_orderkey AS k, o_orderstatus AS status, 1 AS part FROM orders
       UNION ALL SELECT o_orderkey, o_orderstatus, 2 FROM orders WHERE o_orderkey % 22 = 2),
     first AS (SELECT * FROM feed WHERE status = 'F'),
     stored AS (SELECT k FROM first WHERE k % 11 <> 0 GROUP BY k HAVING count(*) = 1),
     second AS (SELECT * FROM feed WHERE k NOT IN (SELECT k FROM stored)),
     added AS (SELECT k FROM second WHERE k % 11 <> 0 GROUP BY k HAVING count(*) = 1)
"""


@query(
    "landing_typed_two_runs",
    f"""{_TYPED}
        SELECT 'landed ' || k AS what, 1::BIGINT AS n FROM stored
        UNION ALL SELECT 'landed ' || k, 1 FROM added
        UNION ALL SELECT 'Value is not of its type', (SELECT count(*) FROM first WHERE k % 11 = 0)
          + (SELECT count(*) FROM second WHERE k % 11 = 0)
        UNION ALL SELECT '{fv.REASON_DUPLICATE}',
          (SELECT count(*) FROM first WHERE k % 11 <> 0 AND k NOT IN (SELECT k FROM stored))
          + (SELECT count(*) FROM second WHERE k % 11 <> 0 AND k NOT IN (SELECT k FROM added))""",
)
def landing_typed_two_runs(spark, d):
    """Keys with zeros in front are their numbers, keys that are no numbers are rejects."""
    folder, key = f"{work_dir(spark)}/typed", F.col("o_orderkey")
    text, orders = key.cast("string"), table(spark, d, "orders")
    written = (
        F.when(key % 11 == 0, F.concat(F.lit("x"), text))
        .when(key % 2 == 0, F.concat(F.lit("000"), text))
        .otherwise(text)
    )
    again = orders.where(key % 22 == 2).select(text.alias("event_id"), "o_orderstatus")
    feed = orders.select(written.alias("event_id"), "o_orderstatus").unionAll(again)
    runs = ((RUN, "run_1", feed.where("o_orderstatus = 'F'")), (NEXT, "run_2", feed))
    for run, batch, rows in runs:
        snapshot = landed(spark, f"{folder}/landing", but=batch)
        fresh = fresh_rows(rows, snapshot, TYPED_RULES, run, settle)
        tagged = gate_feeds({"event": fresh}, {}, {"event": TYPED_RULES}, settle)["event"]
        land(tagged, f"{folder}/landing", f"{folder}/error", batch, run, TYPED_RULES.types)
    stored = landed(spark, f"{folder}/landing").select(
        F.concat(F.lit("landed "), F.col("event_id").cast("string")).alias("what")
    )
    errors = read_optional(spark, f"{folder}/error", merge=True)
    errors = errors.select(F.col("error_reason").alias("what"))
    return stored.unionAll(errors).groupBy("what").agg(F.count("*").alias("n"))


_GROUP_RULES = FeedRules(("line", "id"), ("id",), group=(("id",), "status", ("P", "F")))


@query(
    "landing_group_rule",
    """WITH passing AS (SELECT o_custkey FROM orders WHERE o_orderstatus IN ('P', 'F'))
       SELECT o_custkey AS id, o_orderkey AS line,
              CASE WHEN o_custkey NOT IN (SELECT o_custkey FROM passing)
                   THEN 'Group lacks a required value' END AS error_reason
       FROM orders""",
)
def landing_group_rule(spark, d):
    """Customers without an order of a wanted status, as a rule of a feed."""
    feed = table(spark, d, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderkey").alias("line"),
        F.col("o_orderstatus").alias("status"),
    )
    fresh = fresh_rows(feed, None, _GROUP_RULES, RUN)
    tagged = gate_feeds({"f": fresh}, {}, {"f": _GROUP_RULES}, settle)["f"]
    return tagged.select("id", "line", "error_reason")


_WAITING = f"""
WITH stored AS (SELECT c_custkey AS id, c_nationkey AS nation FROM customer
                WHERE c_custkey IN (SELECT o_custkey FROM orders) AND c_custkey % 5 <> 0),
     children AS (SELECT o_orderkey AS line, o_custkey AS id, o_orderstatus AS status FROM orders),
     kept AS (SELECT id FROM stored WHERE nation % 4 <> 0),
     waiting AS (SELECT line, id FROM children WHERE id NOT IN (SELECT id FROM kept))
"""
_CHILD_RULES = FeedRules(("line",), ("line",), (Link("parent", ("id",), ("id",)),))
_PARENT_RULES = FeedRules(
    ("id",), ("id",), (Link("child", ("id",), ("id",)),), fv.REASON_MISSING_CHILD, parent=True
)


def _rebuilt(spark, d, runs: int) -> dict[str, Place]:
    """Four in five customers and all orders land; then customers of every fourth nation are no
    longer allowed, and all tables are gated anew, ``runs`` times over."""
    folder = work_dir(spark)
    nations = [str(n) for n in range(25) if n % 4]
    strict = replace(_PARENT_RULES, domains={"nation": tuple(nations)})
    rules = {"parent": _PARENT_RULES, "child": _CHILD_RULES}
    places = {
        n: Place(f"{folder}/{n}", f"{folder}/{n}_error", strict if n == "parent" else r)
        for n, r in rules.items()
    }
    key = F.col("c_custkey")
    feeds = {
        "parent": table(spark, d, "customer")
        .where(key % 5 != 0)
        .select(key.cast("string").alias("id"), F.col("c_nationkey").cast("string").alias("nation")),
        "child": table(spark, d, "orders").select(
            F.col("o_orderkey").cast("string").alias("line"),
            F.col("o_custkey").cast("string").alias("id"),
        ),
    }
    fresh = {n: fresh_rows(f, None, rules[n], RUN, settle) for n, f in feeds.items()}
    for n, tagged in gate_feeds(fresh, {}, rules, settle).items():
        land(tagged, places[n].table, places[n].errors, "run_1", RUN, index=indexed(n, rules))
    for _ in range(runs):
        rebuild_tables(spark, places, "run_2", NEXT, settle)
    return places


@query(
    "rebuild_twice",
    f"""{_WAITING}
        SELECT 'parent' AS feed, id::VARCHAR AS key FROM kept
        UNION ALL SELECT 'child', line::VARCHAR FROM children WHERE id IN (SELECT id FROM kept)""",
)
def rebuild_twice(spark, d):
    """What two rebuilds by one run, such as a scheduler's retry, leave of linked tables."""
    places = _rebuilt(spark, d, 2)
    parents = landed(spark, places["parent"].table).select(F.lit("parent").alias("feed"), F.col("id").alias("key"))
    children = landed(spark, places["child"].table).select(F.lit("child").alias("feed"), F.col("line").alias("key"))
    return parents.unionAll(children)


@query("rebuild_pending", f"{_WAITING} SELECT line::VARCHAR AS line, id::VARCHAR AS id FROM waiting")
def rebuild_pending(spark, d):
    """Orders that wait for their customer after a rebuild: since before it, or because of it."""
    places = _rebuilt(spark, d, 2)
    return set_aside(spark, places["child"].errors, _CHILD_RULES, "run_3").select("line", "id")


@query(
    "landing_known_keys",
    """SELECT o_orderkey AS event_id, o_orderstatus AS status,
              CASE WHEN o_orderkey % 3 = 0 THEN 'run_1' WHEN o_orderkey % 3 = 1 THEN 'run_2'
                   ELSE 'run_3' END AS run
       FROM orders""",
)
def landing_known_keys(spark, d):
    """Three runs, each with all orders of the runs before: stored keys are found in buckets."""
    folder, rules = f"{work_dir(spark)}/known", FeedRules(("event_id",), ("event_id",))
    key = F.col("o_orderkey")
    orders = table(spark, d, "orders").select(
        key.cast("string").alias("event_id"), F.col("o_orderstatus").alias("status"), (key % 3).alias("turn")
    )
    for turn, batch in enumerate(("run_1", "run_2", "run_3")):
        snapshot = stored(spark, f"{folder}/landing", but=batch)
        feed = orders.where(F.col("turn") <= turn).drop("turn").withColumn("run", F.lit(batch))
        fresh = fresh_rows(feed, snapshot, rules, RUN, settle)
        tagged = gate_feeds({"event": fresh}, {"event": snapshot}, {"event": rules}, settle)["event"]
        index = indexed("event", {"event": rules})
        land(tagged, f"{folder}/landing", f"{folder}/error", batch, RUN, index=index)
    return landed(spark, f"{folder}/landing").select(F.col("event_id").cast("long").alias("event_id"), "status", "run")


def _streamed_family(spark, d):
    """The linked feeds as files: children before their parents, over three rounds; then all
    waits end."""
    base = work_dir(spark)
    customers = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_name")).alias("name"),
    )
    orders = table(spark, d, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("line")
    )
    feeds = {"customer": customers, "orders": orders, "marked": orders.where("line % 3 = 0")}
    specs = {
        n: FeedSpec(
            n, f"lm_{n}", f"{base}/in/{n}", f"{base}/staged/{n}", "part-", "|", tuple(f.columns),
            replace(_RULES[n], file_pattern=r"part-.*\.csv$"),
        )
        for n, f in feeds.items()
    }
    layout, wait = Layout(base), NEXT - RUN
    rounds = (
        {"orders": orders.where("line % 2 = 0"), "customer": customers.where("id % 3 = 0")},
        {"customer": customers.where("id % 3 > 0"), "marked": feeds["marked"]},
        {"orders": orders.where("line % 2 = 1")},
    )
    for spec in specs.values():  # a stream needs its folders
        spark.createDataFrame([], ",".join(f"{c} string" for c in spec.columns)).write.csv(spec.inbound)
    for files in rounds:
        for name, rows in files.items():
            rows.write.mode("append").options(header=True, sep="|").csv(specs[name].inbound)
        query = stream_family(spark, specs, layout, f"{base}/checkpoint", wait, clock=lambda: RUN)
        query.awaitTermination()
    end_waits(spark, specs, layout, NEXT, wait)
    return specs, layout


@query("stream_linked_clean", f"{_LINKED} SELECT feed, id, line FROM whole WHERE error_reason IS NULL")
def stream_linked_clean(spark, d):
    """What the stream of a family lands, whatever comes first."""
    specs, layout = _streamed_family(spark, d)
    return _as_one({n: landed(spark, layout.landing(s.table)) for n, s in specs.items()})


@query("stream_linked_reject", f"{_LINKED} SELECT * FROM whole WHERE error_reason IS NOT NULL")
def stream_linked_reject(spark, d):
    """What it sets aside when the time of the waiting rows is up."""
    specs, layout = _streamed_family(spark, d)
    errors = {n: read_optional(spark, layout.errors(n), merge=True) for n in specs}
    return _as_one({n: e.where("reject_kind = 'rows'") for n, e in errors.items()})
