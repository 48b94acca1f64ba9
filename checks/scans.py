"""Scans, projections, filters, scalar functions, latest batch."""

from pyspark.sql import functions as F

from checks.registry import query, table
from eventmart.functions import filled, project_existing
from eventmart.operators import latest_batch, stamp, stamp_load
from eventmart.plans.intake import name_matches
from eventmart.sources import read_table
from eventmart.specs import named, named_like


@query(
    "scan_parquet",
    "SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderstatus = 'F'",
)
def scan_parquet(spark, d):
    orders = read_table(spark, f"{d}/orders.parquet")
    return orders.where(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_orderstatus", "o_orderdate"
    )


@query(
    "project_rename",
    """SELECT p_partkey AS event_id, p_name AS event_name, p_brand AS brand_id,
              p_type AS brand_name FROM part""",
)
def project_rename(spark, d):
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("event_id"),
        F.col("p_name").alias("event_name"),
        F.col("p_brand").alias("brand_id"),
        F.col("p_type").alias("brand_name"),
    )


@query("project_existing", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def existing_columns(spark, d):
    return project_existing(
        table(spark, d, "customer"),
        ["c_custkey", "c_title", "c_name", "c_phone", "c_mktsegment"],
    )


@query(
    "rlike_name",
    r"""SELECT page_id, url,
               regexp_matches(url, '(?i)^(?:HTTPS?://[a-z]+\.example\.(com|org)/en/\d+$)')
                 AS name_ok
        FROM pages""",
)
def rlike_name(spark, d):
    pattern = r"HTTPS?://[a-z]+\.example\.(com|org)/en/\d+$"
    return table(spark, d, "pages").select(
        "page_id", "url", name_matches("url", pattern).alias("name_ok")
    )


@query("control_lookup", "SELECT * FROM customer WHERE lower(c_name) = 'customer#000000042'")
def control_lookup(spark, d):
    return named(table(spark, d, "customer"), "c_name", "CUSTOMER#000000042")


@query("ilike_lookup", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%D Ring%'")
def ilike_lookup(spark, d):
    return named_like(table(spark, d, "part"), "p_name", "D Ring").select("p_partkey", "p_name")


@query(
    "default_fill",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice,
              COALESCE(NULLIF(l_returnflag, 'R'), 'UNKNOWN') AS returnflag,
              COALESCE(NULLIF(l_linenumber, 1), 412) AS line
       FROM lineitem""",
)
def default_fill(spark, d):
    lines = table(spark, d, "lineitem")
    types = {f.name: f.dataType for f in lines.schema}
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_shipdate",
        "l_extendedprice",
        filled(
            F.nullif("l_returnflag", F.lit("R")), "UNKNOWN", types["l_returnflag"]
        ).alias("returnflag"),
        filled(F.nullif("l_linenumber", F.lit(1)), "412", types["l_linenumber"]).alias("line"),
    )


@query(
    "row_distinct",
    """SELECT DISTINCT l_partkey, l_returnflag, l_linestatus, date_trunc('month', l_shipdate) AS m
       FROM lineitem""",
)
def row_distinct(spark, d):
    month = F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("m")
    return (
        table(spark, d, "lineitem")
        .select("l_partkey", "l_returnflag", "l_linestatus", month)
        .distinct()
    )


@query(
    "audit_stamp",
    """SELECT *, TIMESTAMP '2025-07-06 16:00:00' AS oasis_create_date,
              TIMESTAMP '2025-07-06 16:00:00' AS oasis_modified_date,
              '2025-07-06' AS oasis_load_time
       FROM supplier""",
)
def audit_stamp(spark, d):
    at = F.lit("2025-07-06 16:00:00").cast("timestamp_ntz")
    stamped = stamp_load(stamp(table(spark, d, "supplier"), at), at.cast("date"))
    return stamped.withColumn("oasis_load_time", F.col("oasis_load_time").cast("string"))


@query(
    "latest_batch",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate AS modified_date
       FROM lineitem WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)""",
)
def latest_lines(spark, d):
    lines = table(spark, d, "lineitem").withColumnRenamed("l_shipdate", "modified_date")
    return latest_batch(
        lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "modified_date")
    )


@query(
    "latest_batch_text_time",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS oasis_modified_date FROM orders
       WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
)
def latest_text(spark, d):
    orders = table(spark, d, "orders")
    return latest_batch(
        orders.select(
            "o_orderkey",
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("oasis_modified_date"),
        )
    )


@query("latest_batch_fallback", "SELECT * FROM supplier")
def latest_without_time(spark, d):
    return latest_batch(table(spark, d, "supplier"))
