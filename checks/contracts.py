"""Rules of the feed contract, on columns written as text."""

from pyspark.sql import functions as F

from checks.registry import query, table
from eventmart.operators.contracts import (
    apply_deletes,
    split_conditional,
    split_dates,
    split_domains,
    split_group_rule,
    split_untyped,
)

_TYPES = {"quantity": "int", "shipped": "date"}
_RAW = """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
         || CASE l_returnflag WHEN 'R' THEN ' pieces' ELSE '' END AS quantity,
       CASE l_linestatus WHEN 'F' THEN strftime(l_shipdate, '%Y-%m-%d') END AS shipped
FROM lineitem
"""


def _raw(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.concat(
            F.col("l_quantity").cast("int").cast("string"),
            F.when(F.col("l_returnflag") == "R", " pieces").otherwise(""),
        ).alias("quantity"),
        F.when(F.col("l_linestatus") == "F", F.date_format("l_shipdate", "yyyy-MM-dd")).alias(
            "shipped"
        ),
    )


@query(
    "contract_typed",
    f"""SELECT * REPLACE (TRY_CAST(quantity AS INTEGER) AS quantity,
                          CAST(TRY_CAST(shipped AS DATE) AS TIMESTAMP) AS shipped)
        FROM ({_RAW}) WHERE TRY_CAST(quantity AS INTEGER) IS NOT NULL""",
)
def contract_typed(spark, d):
    typed = split_untyped(_raw(spark, d), _TYPES)[0]
    return typed.withColumn("shipped", F.col("shipped").cast("timestamp_ntz"))


@query(
    "contract_untyped",
    f"SELECT * FROM ({_RAW}) WHERE TRY_CAST(quantity AS INTEGER) IS NULL",
)
def contract_untyped(spark, d):
    return split_untyped(_raw(spark, d), _TYPES)[1]


@query("contract_domain_reject", "SELECT * FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def contract_domain_reject(spark, d):
    return split_domains(table(spark, d, "orders"), {"o_orderstatus": ("F", "O")})[1]


@query(
    "contract_conditional_reject",
    """SELECT *, NULLIF(l_returnflag, 'R') AS parent_id FROM lineitem
       WHERE l_linestatus = 'F' AND l_returnflag = 'R'""",
)
def contract_conditional_reject(spark, d):
    rows = table(spark, d, "lineitem").withColumn(
        "parent_id", F.nullif("l_returnflag", F.lit("R"))
    )
    return split_conditional(rows, "l_linestatus", "F", "parent_id")[1]


_DATES = """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%d/%m/%Y')
  WHEN 'P' THEN strftime(o_orderdate, '%Y-%m-4%d') ELSE strftime(o_orderdate, '%Y-%m-%d') END
  AS dob FROM orders
"""


@query(
    "contract_date_clean",
    f"""SELECT * FROM ({_DATES}) WHERE regexp_matches(dob, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$')
        AND TRY_CAST(dob AS DATE) IS NOT NULL""",
)
def contract_date_clean(spark, d):
    status, date = F.col("o_orderstatus"), F.col("o_orderdate")
    rows = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(status == "F", F.date_format(date, "dd/MM/yyyy"))
        .when(status == "P", F.date_format(date, "yyyy-MM-'4'dd"))
        .otherwise(F.date_format(date, "yyyy-MM-dd"))
        .alias("dob"),
    )
    return split_dates(rows, ["dob"])[0]


@query(
    "contract_group_reject",
    """SELECT * FROM lineitem WHERE l_orderkey NOT IN
         (SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('A', 'N'))""",
)
def contract_group_reject(spark, d):
    return split_group_rule(
        table(spark, d, "lineitem"), ["l_orderkey"], "l_returnflag", ("A", "N")
    )[1]


@query(
    "contract_deletes",
    """SELECT * FROM orders WHERE o_orderkey NOT IN
         (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def contract_deletes(spark, d):
    deleted = (
        table(spark, d, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .select(F.col("l_orderkey").alias("o_orderkey"))
    )
    return apply_deletes(table(spark, d, "orders"), deleted, ["o_orderkey"])
