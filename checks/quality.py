"""Row checks: each half of each split, and the chain of checks."""

from pyspark.sql import functions as F

from checks.registry import query, table
from eventmart.operators import (
    clean_rows,
    gate,
    quarantined,
    rejected_rows,
    split_duplicates,
    split_incomplete_parents,
    split_nulls,
    split_orphans,
)

LINE_KEY = ["l_orderkey", "l_linenumber"]

_DUPLICATES = """
SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC
                         RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) > 1 AS is_duplicate
FROM lineitem
"""


def _split_lines(spark, d):
    return split_duplicates(table(spark, d, "lineitem"), LINE_KEY, "l_shipdate")


@query(
    "dup_clean",
    f"SELECT * EXCLUDE (is_duplicate) FROM ({_DUPLICATES}) WHERE NOT is_duplicate",
)
def dup_clean(spark, d):
    return _split_lines(spark, d)[0]


@query("dup_reject", f"SELECT * FROM ({_DUPLICATES}) WHERE is_duplicate")
def dup_reject(spark, d):
    return _split_lines(spark, d)[1]


@query(
    "dup_hot_key",
    """SELECT event_type, ts, value,
              count(*) OVER (PARTITION BY event_type ORDER BY ts DESC
                             RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) > 1
                AS is_duplicate
       FROM events
       QUALIFY is_duplicate""",
)
def dup_hot_key(spark, d):
    """Few keys with very many rows each."""
    events = table(spark, d, "events").select("event_type", "ts", "value")
    return split_duplicates(events, ["event_type"], "ts")[1]


_REQUIRED = "SELECT *, NULLIF(l_returnflag, 'R') AS flag FROM lineitem"


def _with_flag(spark, d):
    return table(spark, d, "lineitem").withColumn(
        "flag", F.nullif("l_returnflag", F.lit("R"))
    )


@query("null_clean", f"SELECT * FROM ({_REQUIRED}) WHERE flag IS NOT NULL")
def null_clean(spark, d):
    return split_nulls(_with_flag(spark, d), ["l_orderkey", "flag"])[0]


@query("null_reject", f"SELECT * FROM ({_REQUIRED}) WHERE flag IS NULL")
def null_reject(spark, d):
    return split_nulls(_with_flag(spark, d), ["l_orderkey", "flag"])[1]


@query(
    "quarantine_enrich",
    f"""SELECT *, 'Null value in key column' AS error_reason,
               TIMESTAMP '2025-07-06 16:00:00' AS error_timestamp
        FROM ({_REQUIRED}) WHERE flag IS NULL""",
)
def quarantine_enrich(spark, d):
    rejected = split_nulls(_with_flag(spark, d), ["flag"])[1]
    at = F.lit("2025-07-06 16:00:00").cast("timestamp_ntz")
    return quarantined(rejected, "Null value in key column", at)


_COMPLETE = """
o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')
AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')
"""


def _parents(spark, d):
    lines = table(spark, d, "lineitem")
    return split_incomplete_parents(
        table(spark, d, "orders"),
        ["o_orderkey"],
        [
            (lines.where(F.col("l_returnflag") == "A"), ["l_orderkey"]),
            (lines.where(F.col("l_linestatus") == "F"), ["l_orderkey"]),
        ],
    )


@query("ri_parent_clean", f"SELECT * FROM orders WHERE {_COMPLETE}")
def ri_parent_clean(spark, d):
    return _parents(spark, d)[0]


@query("ri_parent_reject", f"SELECT * FROM orders WHERE NOT ({_COMPLETE})")
def ri_parent_reject(spark, d):
    return _parents(spark, d)[1]


_LINKED = "l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')"


def _open_orders(spark, d):
    return table(spark, d, "orders").where(F.col("o_orderstatus") != "P")


def _children(spark, d):
    return split_orphans(
        table(spark, d, "lineitem"), ["l_orderkey"], _open_orders(spark, d), ["o_orderkey"]
    )


@query("ri_child_clean", f"SELECT * FROM lineitem WHERE {_LINKED}")
def ri_child_clean(spark, d):
    return _children(spark, d)[0]


@query("ri_child_reject", f"SELECT * FROM lineitem WHERE NOT ({_LINKED})")
def ri_child_reject(spark, d):
    return _children(spark, d)[1]


@query(
    "ri_documents_unlabeled",
    """SELECT doc_id, lang, source, n_chars FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def ri_documents(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return split_orphans(documents, ["doc_id"], table(spark, d, "labels"), ["doc_id"])[1]


_GATED = f"""
SELECT *, CASE WHEN is_duplicate THEN 'Duplicate key violation'
               WHEN flag IS NULL THEN 'Null value in key column'
               WHEN NOT ({_LINKED})
                 THEN 'Referential integrity issue - HCP not found in master' END AS error_reason
FROM (SELECT *, NULLIF(l_returnflag, 'R') AS flag FROM ({_DUPLICATES}))
"""


def _gated(spark, d):
    return gate(
        _with_flag(spark, d),
        LINE_KEY,
        ["flag"],
        [(["l_orderkey"], _open_orders(spark, d), ["o_orderkey"])],
        modified="l_shipdate",
    )


@query(
    "gate_clean",
    f"SELECT * EXCLUDE (is_duplicate, error_reason) FROM ({_GATED}) WHERE error_reason IS NULL",
)
def gate_clean(spark, d):
    return clean_rows(_gated(spark, d))


@query(
    "gate_reject",
    f"""SELECT * EXCLUDE (is_duplicate), CASE WHEN is_duplicate THEN 'true' END AS is_duplicate
        FROM ({_GATED}) WHERE error_reason IS NOT NULL""",
)
def gate_reject(spark, d):
    rejected = rejected_rows(_gated(spark, d))
    return rejected.withColumn("is_duplicate", F.col("is_duplicate").cast("string"))


@query(
    "gate_reject_counts",
    f"""SELECT error_reason, count(*) AS n FROM ({_GATED})
        WHERE error_reason IS NOT NULL GROUP BY error_reason""",
)
def gate_reject_counts(spark, d):
    return rejected_rows(_gated(spark, d)).groupBy("error_reason").agg(F.count("*").alias("n"))
