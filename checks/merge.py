"""Incremental merge."""

from pyspark.sql import functions as F

from checks.registry import query, table
from eventmart.operators import merge_snapshot, new_only, stamp


@query(
    "merge_new_only",
    """SELECT * FROM lineitem l WHERE NOT EXISTS (
         SELECT 1 FROM lineitem s WHERE s.l_linestatus = 'F'
         AND s.l_orderkey = l.l_orderkey AND s.l_linenumber = l.l_linenumber)""",
)
def merge_new_only(spark, d):
    lines = table(spark, d, "lineitem")
    stored = lines.where(F.col("l_linestatus") == "F")
    return new_only(lines, stored, ["l_orderkey", "l_linenumber"])


@query(
    "merge_null_keys",
    """SELECT l_orderkey, l_partkey, NULLIF(l_returnflag, 'R') AS flag FROM lineitem
       WHERE l_returnflag = 'R' OR l_orderkey NOT IN
         (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
       OR NULLIF(l_returnflag, 'R') <> 'A'""",
)
def merge_null_keys(spark, d):
    """Rows with a NULL in the key are always new."""
    feed = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", F.nullif("l_returnflag", F.lit("R")).alias("flag")
    )
    stored = (
        table(spark, d, "orders")
        .where(F.col("o_orderstatus") == "F")
        .select(F.col("o_orderkey").alias("l_orderkey"), F.lit("A").alias("flag"))
    )
    return new_only(feed, stored, ["l_orderkey", "flag"])


@query(
    "merge_snapshot",
    """SELECT doc_id, lang, source, n_chars::DOUBLE AS n_chars,
              TIMESTAMP '2025-07-06 16:00:00' AS oasis_create_date,
              TIMESTAMP '2025-07-06 16:00:00' AS oasis_modified_date,
              CAST(NULL AS DOUBLE) AS quality, CAST(NULL AS DOUBLE) AS toxic
       FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
       UNION ALL
       SELECT doc_id, NULL, NULL, NULL, NULL, NULL, quality::DOUBLE, toxic::DOUBLE FROM labels""",
)
def merge_documents(spark, d):
    feed = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    at = F.lit("2025-07-06 16:00:00").cast("timestamp_ntz")
    merged = merge_snapshot(stamp(feed, at), table(spark, d, "labels"), ["doc_id"])
    # Numbers with gaps are compared as doubles.
    return merged.withColumns(
        {c: F.col(c).cast("double") for c in ("n_chars", "quality", "toxic")}
    )


@query("merge_first_load", "SELECT * FROM customer")
def merge_first_load(spark, d):
    return merge_snapshot(table(spark, d, "customer"), None, ["c_custkey"])
