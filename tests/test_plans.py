"""The shape of physical plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from checks import QUERIES
from eventmart.operators import (
    latest_batch,
    lookup,
    resolve_survivor,
    split_duplicates,
    split_orphans,
)
from eventmart.session import settle

FOLDER = "/root/testdata/sf0.001"
LAZY = sorted(
    name
    for name in QUERIES
    if not name.startswith(("delimited", "master_scan", "intake", "landing", "quarantine_two",
                            "export", "stream", "flow", "marts_shared", "handled", "control_table",
                            "row_counts", "linked"))
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_joins(spark, name):
    text = plan(entry_points.queries()[name](spark, FOLDER))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


@pytest.mark.parametrize("name", LAZY)
def test_no_window_over_rows(spark, name):
    assert "Window" not in plan(entry_points.queries()[name](spark, FOLDER))


def test_marts_read_only_their_columns(spark):
    text = plan(entry_points.queries()["kpi_event_performance"](spark, FOLDER))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_returnflag:string>" in text


def test_participants_are_counted_before_the_join(spark):
    text = plan(entry_points.queries()["kpi_event_type"](spark, FOLDER))
    join = text.index("Join [")
    assert "partial_count(participant_id" in text[join:]


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def test_master_tables_beyond_the_broadcast_limit_merge_join(spark, no_broadcast):
    text = plan(entry_points.queries()["mdm_resolve"](spark, FOLDER))
    assert "SortMergeJoin" in text and "Broadcast" not in text
    text = plan(entry_points.queries()["brand_multi_map"](spark, FOLDER))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_survivor_shuffles_the_large_side_once(spark, no_broadcast):
    people = spark.read.parquet(f"{FOLDER}/orders.parquet").select(
        F.col("o_custkey").alias("participant_id"), "o_orderkey"
    )
    customers = spark.read.parquet(f"{FOLDER}/customer.parquet")
    xref = customers.select(F.col("c_custkey").alias("source_id"), F.col("c_name").alias("mdm_id"))
    merges = customers.select(F.col("c_name").alias("loser_mdm_id"), F.col("c_name").alias("winner_mdm_id"))
    text = plan(resolve_survivor(people, xref, merges))
    assert text.count("SortMergeJoin") == 2
    assert sum("o_orderkey" in line and "Exchange" in line for line in text.splitlines()) == 0
    assert text.count("Exchange hashpartitioning(participant_id") == 1


def test_duplicates_shuffle_keys_and_times_only(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    clean, _ = split_duplicates(lines, ["l_orderkey", "l_linenumber"], "l_shipdate", settle)
    text = plan(clean)
    # The repeated keys are settled, so their size is known and the rows stay where they are.
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text


def test_rows_of_single_keys_are_not_shuffled_by_time(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    keys = ["l_orderkey", "l_linenumber"]
    for through in (None, settle):
        text = plan(split_duplicates(lines, keys, "l_shipdate", through)[0])
        assert "l_shipdate" not in "".join(
            line for line in text.splitlines() if "Exchange hashpartitioning" in line
        )
        assert "Window" not in text


def test_unique_events_are_counted_without_telling_them_apart(spark):
    for name in ("kpi_event_performance", "kpi_event_type", "kpi_brand_performance"):
        text = plan(entry_points.queries()[name](spark, FOLDER))
        assert "distinct" not in text


def test_the_newest_time_reaches_the_scan(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").withColumnRenamed("l_shipdate", "modified_date")
    text = plan(latest_batch(lines))
    assert "EqualTo(l_shipdate,ScalarSubquery" in text


@pytest.fixture
def small_skew_limits(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def hot_rows(spark, key):
    """300,000 rows, a third of them under one key."""
    return spark.range(0, 300000, 1, 8).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias(key),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )


def test_a_hot_key_is_split(spark, small_skew_limits):
    parents = spark.range(0, 4000).withColumnRenamed("id", "key")
    clean, orphans = split_orphans(hot_rows(spark, "parent"), ["parent"], parents, ["key"])
    rows = clean.collect()
    assert "skew=true" in plan(clean)
    assert len(rows) == 100000 + sum(1 for i in range(300000) if i % 3 and i % 5000 < 4000)
    assert len(rows) + orphans.count() == 300000


def test_a_hot_key_is_split_before_a_distinct(spark, small_skew_limits):
    """The distinct could reuse the join's partitioning; the split must win over that."""
    master = spark.range(0, 4000).select(
        F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("code")
    )
    found = lookup(hot_rows(spark, "name"), master, "name", "key", {"code": "code"}).distinct()
    rows = found.collect()
    assert "skew=true" in plan(found)
    assert len(rows) == 300000


def test_rows_without_a_known_id_do_not_meet_in_one_task(spark, small_skew_limits):
    """A third of all rows have no master id: NULL is no join key of the large side."""
    people = hot_rows(spark, "k").select(
        F.when(F.col("id") % 3 == 0, -F.col("id")).otherwise(F.col("id") % 5000).alias("participant_id"),
        "text",
    )
    xref = spark.range(0, 5000).select(
        F.col("id").alias("source_id"), F.concat(F.lit("M"), "id").alias("mdm_id")
    )
    merges = xref.select(
        F.col("mdm_id").alias("loser_mdm_id"), F.lit("M0").alias("winner_mdm_id")
    ).where("loser_mdm_id > 'M4'")
    out = resolve_survivor(people, xref, merges)
    assert out.where("mdm_id IS NULL").count() == 100000 - 1
    assert out.count() == 300000
