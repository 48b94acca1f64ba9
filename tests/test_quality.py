import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventmart import fixed_values as fv
from eventmart.operators import (
    clean_rows,
    gate,
    quarantined,
    rejected_rows,
    split_duplicates,
    split_incomplete_parents,
    split_nulls,
    split_orphans,
    tag_duplicates,
)
from eventmart.session import settle


@pytest.fixture
def versions(spark):
    return spark.createDataFrame(
        [("a", 1), ("a", 1), ("b", 1), ("b", 2), ("b", 3), ("c", 5), (None, 1), (None, 1)],
        "k string, m int",
    )


@pytest.mark.parametrize("through", [None, settle])
def test_duplicates_keep_a_unique_newest_row(versions, rows, through):
    clean, rejected = split_duplicates(versions, ["k"], "m", through)
    assert rows(clean) == [("b", 3), ("c", 5)]
    assert rows(rejected, "k", "m") == [
        (None, 1), (None, 1), ("a", 1), ("a", 1), ("b", 1), ("b", 2),
    ]
    assert {r.is_duplicate for r in rejected.collect()} == {True}
    assert clean.columns == ["k", "m"]


def test_duplicates_order_null_times_last(spark, rows):
    df = spark.createDataFrame(
        [("a", None), ("a", 1), ("b", None), ("b", None), ("c", None)], "k string, m int"
    )
    clean, rejected = split_duplicates(df, ["k"], "m")
    assert rows(clean) == [("a", 1), ("c", None)]
    assert rows(rejected, "k", "m") == [("a", None), ("b", None), ("b", None)]


def test_duplicates_without_keys_change_nothing(versions):
    assert split_duplicates(versions, [], "m") == (versions, None)


def test_duplicates_equal_the_cumulative_count(spark, rows):
    """The window form, on composite keys with many ties and one key with a third of all rows."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 401).alias("k"),
        F.nullif(F.col("id") % 7, F.lit(3)).alias("j"),
        F.nullif((F.col("id") * 37) % 11, F.lit(5)).alias("m"),
        F.col("id").alias("row"),
    )
    df.createOrReplaceTempView("versions")
    expected = spark.sql(
        """SELECT *, count(*) OVER (PARTITION BY k, j ORDER BY m DESC NULLS LAST
             RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) > 1 AS is_duplicate FROM versions"""
    )
    assert rows(tag_duplicates(df, ["k", "j"], "m")) == rows(expected)


def test_nulls(spark, rows):
    df = spark.createDataFrame(
        [(1, "x"), (None, "x"), (2, None), (None, None), (3, "")], "k int, v string"
    )
    clean, rejected = split_nulls(df, ["k", "v"])
    assert rows(clean) == [(1, "x"), (3, "")]
    assert rows(rejected) == [(None, None), (None, "x"), (2, None)]
    assert split_nulls(df, []) == (df, None)


def test_parents_need_every_child(spark, rows):
    parents = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "id int")
    first = spark.createDataFrame([(1,), (2,), (2,), (None,)], "owner int")
    second = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    clean, rejected = split_incomplete_parents(
        parents, ["id"], [(first, ["owner"]), (second, ["id"])]
    )
    assert rows(clean) == [(1,)]
    assert rows(rejected) == [(None,), (2,), (3,), (4,)]


def test_orphans(spark, rows):
    children = spark.createDataFrame([("c1", 1), ("c2", 9), ("c3", None)], "c string, p int")
    parent = spark.createDataFrame([(1, "x"), (1, "y")], "p int, other string")
    clean, rejected = split_orphans(children, ["p"], parent, ["p"])
    assert rows(clean) == [("c1", 1)]
    assert rows(rejected) == [("c2", 9), ("c3", None)]


def test_links_on_several_columns(spark, rows):
    children = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "x int, y string")
    parent = spark.createDataFrame([(1, "a"), (2, "b")], "u int, v string")
    clean, rejected = split_orphans(children, ["x", "y"], parent, ["u", "v"])
    assert rows(clean) == [(1, "a")]
    assert rows(rejected) == [(1, "b"), (2, "a")]


def test_gate_gives_the_first_reason_and_loses_nothing(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, None, 1), ("a", 2, None, 1), ("b", 1, "v", 1), ("c", 1, "v", 9),
         ("d", 1, "v", 9), ("d", 1, "v", 9)],
        "k string, m int, v string, p int",
    )
    parent = spark.createDataFrame([(1,)], "p int")
    tagged = gate(df, ["k"], ["k", "v"], [(["p"], parent, ["p"])], "no parent", "m")
    assert rows(clean_rows(tagged)) == [("b", 1, "v", 1)]
    rejected = rejected_rows(tagged)
    assert rows(rejected, "k", "m", "error_reason", "is_duplicate") == [
        ("a", 1, fv.REASON_DUPLICATE, True),
        ("a", 2, fv.REASON_NULL, None),
        ("c", 1, "no parent", None),
        ("d", 1, fv.REASON_DUPLICATE, True),
        ("d", 1, fv.REASON_DUPLICATE, True),
    ]
    assert tagged.count() == df.count()


def test_gate_without_keys_checks_nulls_only(spark, rows):
    df = spark.createDataFrame([(1, None), (1, 2)], "k int, v int")
    assert rows(clean_rows(gate(df, [], ["v"]))) == [(1, 2)]
    assert rows(clean_rows(gate(df, [], []))) == [(1, None), (1, 2)]


def test_quarantined(spark):
    at = dt.datetime(2025, 7, 6, 16)
    out = quarantined(spark.range(1), "why", F.lit(at)).first()
    assert (out.error_reason, out.error_timestamp) == ("why", at)


def test_splits_lose_and_repeat_nothing(spark, rows):
    """Each input row is in exactly one half, whatever its NULLs, repeats and ties."""
    df = spark.range(2000).select(
        F.nullif(F.col("id") % 83, F.lit(5)).alias("k"),
        F.nullif(F.floor(F.col("id") / 166), F.lit(2)).alias("m"),
        F.nullif(F.col("id") % 29, F.lit(3)).alias("p"),
        F.nullif(F.col("id") % 2, F.lit(1)).alias("h"),
        F.col("id").alias("row"),
    )
    parent = spark.range(40).select(F.nullif("id", F.lit(7)).alias("p")).union(
        spark.range(10).select(F.lit(1).alias("p"))
    )
    other = spark.range(0, 40, 2).withColumnRenamed("id", "q")
    everything = rows(df)
    for clean, rejected in [
        split_duplicates(df, ["k"], "m"),
        split_duplicates(df, ["k", "h"], "m"),
        split_duplicates(df, ["p"], "row"),
        split_nulls(df, ["k", "p"]),
        split_orphans(df, ["p"], parent, ["p"]),
        split_incomplete_parents(df, ["p"], [(parent, ["p"]), (other, ["q"])]),
    ]:
        both = clean.unionByName(rejected.select(df.columns))
        assert rows(both) == everything
        assert clean.count() > 0 and rejected.count() > 0
