from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables; its schema is read from the files the first time only."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


# Tables in their role as events and participants.

def order_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_orderdate").alias("event_date"),
        F.col("o_orderpriority").alias("event_type"),
    )


def part_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("event_id"),
        F.col("p_brand").alias("brand_id"),
        F.col("p_type").alias("brand_name"),
    )


def line_participants(spark: SparkSession, folder: str, event: str = "l_orderkey") -> DataFrame:
    lines = table(spark, folder, "lineitem")
    flag = F.col("l_returnflag")
    return lines.select(
        F.col(event).alias("event_id"),
        F.col("l_linenumber").alias("participant_id"),
        F.col("l_linestatus").alias("participant_type"),
        F.when(flag == "A", "Y").when(flag == "N", "N").alias("attended"),
        F.when(F.col("l_quantity") >= 25, "Y").otherwise("N").alias("registered"),
    )


# The same roles in SQL.
SQL_PARTICIPANTS = """
SELECT l_orderkey AS order_id, l_partkey AS part_id, l_linenumber AS participant_id,
       l_linestatus AS participant_type,
       CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'N' THEN 'N' END AS attended,
       CASE WHEN l_quantity >= 25 THEN 'Y' ELSE 'N' END AS registered
FROM lineitem
"""
