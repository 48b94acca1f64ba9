"""Lookups and normalized tables.

Product names are the words of a part's name and its type, master data its distinct types.
"""

from pyspark.sql import functions as F

from checks.registry import query, table
from eventmart.operators import (
    explode_tokens,
    keep_known,
    list_by_key,
    lookup,
    map_multivalue,
    merge_ends,
    resolve_survivor,
    survivor_xref,
)
from eventmart.plans import normalize_events, normalize_expenses, normalize_participants
from eventmart.session import settle

_SQL_PRODUCTS = """
SELECT DISTINCT lower(p_type) AS source_product_name, 'BRD-' || p_type AS brand_id,
       p_type AS brand_name FROM part
"""
_SQL_EVENTS = """
SELECT p_partkey AS event_id, p_name AS event_name,
       replace(p_name, ' ', ' | ') || '| ' || lower(p_type) AS event_brand,
       p_type AS indication_name, p_brand AS event_type
FROM part
"""
_SQL_TOKENS = f"""
SELECT * EXCLUDE (pos), CAST(pos - 1 AS INTEGER) AS pos, trim(parts[pos]) AS token FROM (
  SELECT *, unnest(generate_series(1, len(parts))) AS pos FROM (
    SELECT event_id, event_brand, string_split(event_brand, '|') AS parts FROM ({_SQL_EVENTS})))
"""


def _products(spark, d):
    kind = F.col("p_type")
    return (
        table(spark, d, "part")
        .select(
            F.lower(kind).alias("source_product_name"),
            F.concat(F.lit("BRD-"), kind).alias("brand_id"),
            kind.alias("brand_name"),
        )
        .distinct()
    )


def _events(spark, d):
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("event_id"),
        F.col("p_name").alias("event_name"),
        F.concat(
            F.replace("p_name", F.lit(" "), F.lit(" | ")), F.lit("| "), F.lower("p_type")
        ).alias("event_brand"),
        F.col("p_type").alias("indication_name"),
        F.col("p_brand").alias("event_type"),
    )


def _indications(spark, d):
    kind = F.col("p_type")
    return (
        table(spark, d, "part")
        .where(kind != "PROMO")
        .select(kind.alias("source_indication_name"), F.lower(kind).alias("indication_id"))
        .distinct()
    )


_BRANDS = {"brand_id": "brand_id", "brand_name": "brand_name"}
_DEFAULTS = {"brand_id": "412", "brand_name": "UNKNOWN"}


@query(
    "brand_tokens",
    f"SELECT event_id, event_brand, pos, token FROM ({_SQL_TOKENS})",
)
def brand_tokens(spark, d):
    events = _events(spark, d).select("event_id", "event_brand")
    return explode_tokens(events, "event_brand")


@query(
    "list_agg",
    f"""SELECT event_id, string_agg(token, '/' ORDER BY pos) AS token
        FROM ({_SQL_TOKENS}) GROUP BY event_id""",
)
def list_agg(spark, d):
    exploded = explode_tokens(_events(spark, d).select("event_id", "event_brand"), "event_brand")
    return list_by_key(exploded, ["event_id"], "pos", ["token"], "/")


@query(
    "brand_lookup",
    f"""SELECT e.event_id, e.pos, e.token, p.brand_id, p.brand_name
        FROM ({_SQL_TOKENS}) e LEFT JOIN ({_SQL_PRODUCTS}) p ON e.token = p.source_product_name""",
)
def brand_lookup(spark, d):
    exploded = explode_tokens(_events(spark, d).select("event_id", "event_brand"), "event_brand")
    return lookup(
        exploded, _products(spark, d), "token", "source_product_name", _BRANDS
    ).drop("event_brand")


@query(
    "indication_lookup",
    """SELECT e.event_id, e.event_type AS indication_name, m.indication_id
       FROM events e LEFT JOIN (
         SELECT event_type, 'IND_' || upper(event_type) AS indication_id FROM events
         WHERE event_type <> 'error' GROUP BY event_type) m ON e.event_type = m.event_type""",
)
def indication_lookup(spark, d):
    events = table(spark, d, "events").select(
        "event_id", F.col("event_type").alias("indication_name")
    )
    master = (
        events.where(F.col("indication_name") != "error")
        .select(
            F.col("indication_name").alias("source_indication_name"),
            F.concat(F.lit("IND_"), F.upper("indication_name")).alias("indication_id"),
        )
        .distinct()
    )
    return lookup(
        events, master, "indication_name", "source_indication_name",
        {"indication_id": "indication_id"},
    )


_SQL_BRANDED = f"""
SELECT event_id, string_agg(COALESCE(brand_id, '412'), '|' ORDER BY pos) AS brand_id,
       string_agg(COALESCE(brand_name, 'UNKNOWN'), '|' ORDER BY pos) AS brand_name,
       string_agg(token, '|' ORDER BY pos) AS event_brand
FROM ({_SQL_TOKENS}) t LEFT JOIN ({_SQL_PRODUCTS}) p ON t.token = p.source_product_name
GROUP BY event_id
"""


@query("brand_multi_map", _SQL_BRANDED)
def brand_multi_map(spark, d):
    events = _events(spark, d).select("event_id", "event_brand")
    return map_multivalue(
        events, "event_brand", _products(spark, d), "source_product_name", _BRANDS, _DEFAULTS
    )


@query(
    "brand_multi_map_nulls",
    f"""SELECT e.event_id, COALESCE(b.brand_id, '412') AS brand_id,
               COALESCE(b.brand_name, 'UNKNOWN') AS brand_name, b.event_brand
        FROM ({_SQL_EVENTS}) e
        LEFT JOIN ({_SQL_BRANDED}) b
          ON e.event_id = b.event_id AND e.indication_name <> 'PROMO'""",
)
def brand_multi_map_nulls(spark, d):
    """Events without a brand, kept."""
    events = _events(spark, d).select(
        "event_id",
        F.when(F.col("indication_name") != "PROMO", F.col("event_brand")).alias("event_brand"),
    )
    return map_multivalue(
        events, "event_brand", _products(spark, d), "source_product_name", _BRANDS, _DEFAULTS,
        keep_null=True,
    )


@query(
    "event_normalize",
    f"""SELECT DISTINCT e.event_id, e.event_name, e.event_type, b.event_brand, b.brand_id,
               b.brand_name, e.indication_name, i.indication_id
        FROM ({_SQL_EVENTS}) e JOIN ({_SQL_BRANDED}) b ON e.event_id = b.event_id
        LEFT JOIN (SELECT DISTINCT p_type, lower(p_type) AS indication_id FROM part
                   WHERE p_type <> 'PROMO') i ON e.indication_name = i.p_type""",
)
def event_normalize(spark, d):
    return normalize_events(_events(spark, d), _products(spark, d), _indications(spark, d))


_SQL_XREF = """
SELECT c_custkey AS source_id, 'M' || c_custkey AS mdm_id FROM customer WHERE c_acctbal >= 0
"""
_SQL_MERGES = """
SELECT 'M' || c.c_custkey AS loser_mdm_id, 'M' || w.winner AS winner_mdm_id
FROM customer c JOIN (
  SELECT c_nationkey, min(c_custkey) AS winner FROM customer GROUP BY c_nationkey) w
  ON c.c_nationkey = w.c_nationkey
WHERE c.c_mktsegment = 'BUILDING' AND c.c_custkey <> w.winner
"""


def _xref(spark, d):
    return (
        table(spark, d, "customer")
        .where(F.col("c_acctbal") >= 0)
        .select(
            F.col("c_custkey").alias("source_id"),
            F.concat(F.lit("M"), "c_custkey").alias("mdm_id"),
        )
    )


def _merges(spark, d):
    customers = table(spark, d, "customer")
    winners = customers.groupBy("c_nationkey").agg(F.min("c_custkey").alias("winner"))
    return (
        customers.where(F.col("c_mktsegment") == "BUILDING")
        .join(winners, "c_nationkey")
        .where(F.col("c_custkey") != F.col("winner"))
        .select(
            F.concat(F.lit("M"), "c_custkey").alias("loser_mdm_id"),
            F.concat(F.lit("M"), "winner").alias("winner_mdm_id"),
        )
    )


def _order_participants(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("participant_id"),
        F.col("o_orderkey").alias("event_id"),
        F.col("o_orderstatus").alias("participant_type"),
    )


@query(
    "xref_resolve",
    f"""SELECT o.o_custkey AS participant_id, o.o_orderkey AS event_id,
               o.o_orderstatus AS participant_type, x.mdm_id
        FROM orders o LEFT JOIN ({_SQL_XREF}) x ON o.o_custkey = x.source_id""",
)
def xref_resolve(spark, d):
    return lookup(
        _order_participants(spark, d), _xref(spark, d), "participant_id", "source_id",
        {"mdm_id": "mdm_id"},
    )


@query(
    "survivor_xref",
    f"""SELECT x.source_id, x.mdm_id, COALESCE(m.winner_mdm_id, x.mdm_id) AS final_mdm_id
        FROM ({_SQL_XREF}) x LEFT JOIN ({_SQL_MERGES}) m ON x.mdm_id = m.loser_mdm_id""",
)
def final_xref(spark, d):
    return survivor_xref(_xref(spark, d), _merges(spark, d))


_CHAINS = """
SELECT c_custkey AS loser,
       CASE WHEN c_custkey % 50 <> 0 THEN c_custkey - 1
            WHEN c_custkey % 1000 = 950 THEN c_custkey + 49 END AS winner
FROM customer
"""


@query(
    "mdm_chains",
    f"""WITH RECURSIVE merged AS (SELECT * FROM ({_CHAINS}) WHERE winner IS NOT NULL),
             walk AS (SELECT loser, winner AS top, 1::BIGINT AS hops FROM merged
                      UNION ALL
                      SELECT walk.loser, merged.winner, hops + 1
                      FROM walk JOIN merged ON merged.loser = walk.top WHERE hops < 60),
             ends AS (SELECT * FROM walk WHERE top NOT IN (SELECT loser FROM merged))
        SELECT merged.loser AS loser_mdm_id, top AS winner_mdm_id, hops,
               top IS NULL AS in_cycle
        FROM merged LEFT JOIN ends ON merged.loser = ends.loser""",
)
def mdm_chains(spark, d):
    """Customers that lose to their neighbour, over and over, some of them in a circle."""
    key = F.col("c_custkey")
    winner = F.when(key % 50 != 0, key - 1).when(key % 1000 == 950, key + 49)
    merges = table(spark, d, "customer").select(
        key.alias("loser_mdm_id"), winner.alias("winner_mdm_id")
    )
    return merge_ends(merges, settle)


_SQL_RESOLVED = f"""
SELECT o.o_custkey AS participant_id, o.o_orderkey AS event_id,
       o.o_orderstatus AS participant_type, x.mdm_id,
       CASE WHEN m.winner_mdm_id IS NOT NULL THEN m.winner_mdm_id ELSE x.mdm_id END AS final_mdm_id
FROM orders o LEFT JOIN ({_SQL_XREF}) x ON o.o_custkey = x.source_id
LEFT JOIN ({_SQL_MERGES}) m ON x.mdm_id = m.loser_mdm_id
"""


@query("mdm_resolve", _SQL_RESOLVED)
def mdm_resolve(spark, d):
    return resolve_survivor(_order_participants(spark, d), _xref(spark, d), _merges(spark, d))


@query(
    "participant_normalize",
    f"""SELECT participant_id, event_id, participant_type, mdm_id, final_mdm_id
        FROM ({_SQL_RESOLVED})""",
)
def participant_normalize(spark, d):
    rows = _order_participants(spark, d).withColumn("not_wanted", F.lit(1))
    return normalize_participants(rows, _xref(spark, d), _merges(spark, d))


@query(
    "expense_inner",
    """SELECT l_orderkey AS event_vendor_id, l_linenumber, l_extendedprice, o_custkey AS event_id
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'""",
)
def expense_inner(spark, d):
    expenses = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("event_vendor_id"), "l_linenumber", "l_extendedprice"
    )
    known = (
        table(spark, d, "orders")
        .where(F.col("o_orderstatus") == "F")
        .select(F.col("o_orderkey").alias("event_vendor_id"), F.col("o_custkey").alias("event_id"))
    )
    return keep_known(expenses, known, "event_vendor_id", ["event_id"])


@query(
    "expense_normalize",
    """SELECT o_custkey AS event_id, l_orderkey AS event_vendor_id,
              l_extendedprice AS event_expense, l_quantity AS event_expense_estimate,
              l_tax AS event_expense_actual
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'""",
)
def expense_normalize(spark, d):
    expenses = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("event_vendor_id"),
        F.col("l_extendedprice").alias("event_expense"),
        F.col("l_quantity").alias("event_expense_estimate"),
        F.col("l_tax").alias("event_expense_actual"),
    )
    known = (
        table(spark, d, "orders")
        .where(F.col("o_orderstatus") == "F")
        .select(F.col("o_orderkey").alias("event_vendor_id"), F.col("o_custkey").alias("event_id"))
    )
    return normalize_expenses(expenses, known)
