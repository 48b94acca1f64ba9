import datetime as dt

from pyspark.sql import functions as F

from eventmart import fixed_values as fv
from eventmart.functions import try_typed
from eventmart.operators.contracts import (
    apply_deletes,
    split_conditional,
    split_dates,
    split_domains,
    split_group_rule,
    split_untyped,
)


def test_types(spark, rows):
    df = spark.createDataFrame(
        [(1, "2025-08-15", "15", "1.5"), (2, "15.08.2025", "15", None), (3, None, "many", "x"),
         (4, None, None, None)],
        "id int, event_start_date string, planned_customers string, actual string",
    )
    typed, rejected = split_untyped(df)
    assert rows(typed) == [(1, dt.date(2025, 8, 15), 15, 1.5), (4, None, None, None)]
    assert rows(rejected, "id", "planned_customers") == [(2, "15"), (3, "many")]
    assert dict(typed.dtypes)["event_start_date"] == "date"
    untouched, none = split_untyped(df.select("id"))
    assert (untouched.count(), none.count()) == (4, 0)


def test_whole_numbers_equal_the_cast(spark):
    texts = ["1", " 1", "1 ", "\t+7\n", "-0", "--1", "1-", "+", "", " ", "1.0", "1e3", "x", "1 2",
             "99999999999", "9999999999999999999999", "\u0663", "1_0", "\x7f5", "\u00a05", "0x1", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for dtype in ("int", "bigint", "double", "date"):
        cast = df.select(F.col("t").try_cast(dtype)).collect()
        assert df.select(try_typed(F.col("t"), dtype)).collect() == cast


def test_domains(spark, rows):
    df = spark.createDataFrame(
        [(1, "Confirmed", "Dinner"), (2, "confirmed", "Dinner"), (3, None, "No Meal"), (4, None, None)],
        "id int, event_status string, meal_type string",
    )
    clean, rejected = split_domains(df)
    assert rows(clean, "id") == [(1,), (4,)]
    assert rows(rejected, "id") == [(2,), (3,)]


def test_child_needs_parent(spark, rows):
    df = spark.createDataFrame(
        [(1, "Yes", "E1"), (2, "Yes", None), (3, "No", None), (4, None, None)],
        "id int, is_child_event string, parent_event_vendor_id string",
    )
    clean, rejected = split_conditional(df, *fv.CHILD_EVENT_RULE)
    assert rows(clean, "id") == [(1,), (3,), (4,)]
    assert rows(rejected, "id") == [(2,)]


def test_dates(spark, rows):
    df = spark.createDataFrame(
        [(1, "2025-02-28"), (2, "2025-02-30"), (3, "28/02/2025"), (4, "2025-2-8"), (5, None)],
        "id int, dob string",
    )
    clean, rejected = split_dates(df, ["dob"])
    assert rows(clean, "id") == [(1,), (5,)]
    assert rows(rejected, "id") == [(2,), (3,), (4,)]


def test_group_rule(spark, rows):
    df = spark.createDataFrame(
        [(1, "Degree"), (1, "License"), (2, "License"), (3, "Identifier"), (None, "Degree")],
        "customer_id int, category string",
    )
    clean, rejected = split_group_rule(df, ["customer_id"], "category")
    assert rows(clean) == [(1, "Degree"), (1, "License"), (3, "Identifier")]
    assert rows(rejected) == [(None, "Degree"), (2, "License")]


def test_deletes(spark, rows):
    events = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "event_id int, v string")
    deletes = spark.createDataFrame([(2, "x"), (2, "y"), (None, "z")], "event_id int, why string")
    assert rows(apply_deletes(events, deletes, ["event_id"])) == [(None, "c"), (1, "a")]
