import pytest

from eventmart.operators import (
    assert_unique,
    explode_tokens,
    keep_known,
    lookup,
    map_multivalue,
    merge_ends,
    resolve_survivor,
)
from eventmart.plans import normalize_events, normalize_expenses, normalize_participants
from eventmart.session import settle

OUTPUTS = {"brand_id": "id", "brand_name": "name"}
DEFAULTS = {"brand_id": "412", "brand_name": "UNKNOWN"}


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [("A", "1", "Alpha"), ("B", "2", "Beta")], "src string, id string, name string"
    )


@pytest.fixture
def events(spark):
    return spark.createDataFrame(
        [(1, "A | B"), (2, "B|X|A"), (3, None), (4, "A|A"), (5, "")], "id int, brand string"
    )


@pytest.mark.parametrize("through", [None, settle])
def test_lists_stay_aligned_and_ordered(events, dim, rows, through):
    out = map_multivalue(events, "brand", dim, "src", OUTPUTS, DEFAULTS, settle=through)
    assert out.columns == ["id", "brand", "brand_id", "brand_name"]
    assert rows(out) == [
        (1, "A|B", "1|2", "Alpha|Beta"),
        (2, "B|X|A", "2|412|1", "Beta|UNKNOWN|Alpha"),
        (4, "A|A", "1|1", "Alpha|Alpha"),
        (5, "", "412", "UNKNOWN"),
    ]


def test_rows_without_a_brand_can_be_kept(events, dim, rows):
    out = map_multivalue(events, "brand", dim, "src", OUTPUTS, DEFAULTS, keep_null=True)
    assert (3, None, "412", "UNKNOWN") in rows(out)
    assert out.count() == 5


def test_numeric_ids_keep_the_default(spark, rows):
    events = spark.createDataFrame([(1, "A|Z")], "id int, brand string")
    dim = spark.createDataFrame([("A", 7, "Alpha")], "src string, id int, name string")
    out = map_multivalue(events, "brand", dim, "src", OUTPUTS, DEFAULTS)
    assert rows(out) == [(1, "A|Z", "7|412", "Alpha|UNKNOWN")]


def test_repeated_master_rows_multiply(events, spark, rows):
    dim = spark.createDataFrame([("A", "1", "a"), ("A", "2", "b")], "src string, id string, name string")
    out = map_multivalue(events.where("id = 1"), "brand", dim, "src", OUTPUTS, DEFAULTS)
    assert rows(out) == [(1, "A|A|B", "1|2|412", "a|b|UNKNOWN")]
    with pytest.raises(ValueError, match="repeated keys"):
        assert_unique(dim, ["src"])


def test_explode_tokens(events, rows):
    out = explode_tokens(events, "brand")
    assert rows(out.where("id = 2"), "pos", "token") == [(0, "B"), (1, "X"), (2, "A")]
    assert out.where("id = 3").count() == 0
    assert explode_tokens(events, "brand", keep_null=True).where("id = 3").count() == 1


def test_lookup_replaces_a_column_of_the_same_name(spark, rows):
    df = spark.createDataFrame([(1, "A"), (2, "Z"), (3, None)], "id int, k string")
    dim = spark.createDataFrame([("A", "found", 5)], "key string, k string, n int")
    out = lookup(df, dim, "k", "key", {"k": "k", "n": "n"}, {"n": 0})
    assert rows(out) == [(1, "found", 5), (2, None, 0), (3, None, 0)]


def test_survivor_takes_one_hop(spark, rows):
    xref = spark.createDataFrame(
        [("p1", "m1"), ("p2", "m2"), ("p4", None)], "source_id string, mdm_id string"
    )
    merges = spark.createDataFrame(
        [("m2", "m9"), ("m9", "m10")], "loser_mdm_id string, winner_mdm_id string"
    )
    df = spark.createDataFrame(
        [("p1",), ("p2",), ("p3",), ("p4",), (None,)], "participant_id string"
    )
    assert rows(resolve_survivor(df, xref, merges)) == [
        (None, None, None), ("p1", "m1", "m1"), ("p2", "m2", "m9"), ("p3", None, None),
        ("p4", None, None),
    ]


def test_keep_known(spark, rows):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("a", "x"), (None, "y")], "k string, e string")
    assert rows(keep_known(left, right, "k", ["e"])) == [("a", 1, "x")]


def test_normalized_tables(spark, rows):
    events = spark.createDataFrame(
        [("e1", "v1", "Alpha | Other", "Flu", "x"), ("e1", "v1", "Alpha | Other", "Flu", "y"),
         ("e2", "v2", "Beta", "None", "x")],
        "event_id string, event_vendor_id string, event_brand string, indication_name string, "
        "not_listed string",
    )
    products = spark.createDataFrame(
        [("Alpha", "Alpha", "B1"), ("Beta", "Beta", "B2")],
        "source_product_name string, Brand_name string, Brand_id string",
    )
    indications = spark.createDataFrame(
        [("Flu", "Influenza", "I1")],
        "source_indication_name string, indication_name string, indication_id string",
    )
    out = normalize_events(events, products, indications)
    assert out.columns == [
        "event_id", "event_vendor_id", "event_brand", "brand_id", "brand_name",
        "indication_name", "indication_id",
    ]
    assert rows(out) == [
        ("e1", "v1", "Alpha|Other", "B1|412", "Alpha|UNKNOWN", "Flu", "I1"),
        ("e2", "v2", "Beta", "B2", "Beta", "None", None),
    ]
    expenses = spark.createDataFrame(
        [("v1", "Venue", 1.0, 2.0), ("v9", "Venue", 1.0, 2.0)],
        "event_vendor_id string, event_expense string, event_expense_estimate double, "
        "event_expense_actual double",
    )
    assert rows(normalize_expenses(expenses, out)) == [("e1", "v1", "Venue", 1.0, 2.0)]
    people = spark.createDataFrame([("p1", "e1", "Y")], "participant_id string, event_id string, attended string")
    xref = spark.createDataFrame([("p1", "m1")], "source_id string, mdm_id string")
    merges = spark.createDataFrame([("m1", "m2")], "loser_mdm_id string, winner_mdm_id string")
    out = normalize_participants(people, xref, merges)
    assert out.columns == ["participant_id", "event_id", "attended", "mdm_id", "final_mdm_id"]
    assert rows(out) == [("p1", "e1", "Y", "m1", "m2")]


def test_unique_events_need_no_comparison_of_rows(spark, rows):
    events = spark.createDataFrame(
        [("e1", "Alpha", "Flu"), ("e2", "Beta|Alpha", "Cold")],
        "event_id string, event_brand string, indication_name string",
    )
    products = spark.createDataFrame(
        [("Alpha", "B1", "Alpha")], "source_product_name string, brand_id string, brand_name string"
    )
    indications = spark.createDataFrame(
        [("Flu", "a", "I1"), ("Flu", "b", "I1"), ("Flu", "c", "I2")],
        "source_indication_name string, indication_name string, indication_id string",
    )
    compared = normalize_events(events, products, indications)
    assert compared.count() == 3
    assert rows(normalize_events(events, products, indications, unique=True)) == rows(compared)


@pytest.mark.parametrize("length", [1, 2, 3, 7, 8, 9, 50])
def test_chains_of_merges_are_followed_to_their_end(spark, rows, length):
    chain = [(f"a{i}", f"a{i + 1}") for i in range(length)]
    merges = spark.createDataFrame(chain, "loser_mdm_id string, winner_mdm_id string")
    wanted = [(f"a{i}", f"a{length}", length - i, False) for i in range(length)]
    assert rows(merge_ends(merges, settle)) == sorted(wanted)


def test_cycles_and_odd_merges_are_told(spark, rows):
    merges = spark.createDataFrame(
        [("a", "b"), ("b", "c"), ("c", "a"), ("into", "a"), ("self", "self"), ("x", "y"),
         ("x", "w"), ("w", None), (None, "x"), ("before", "x")],
        "loser_mdm_id string, winner_mdm_id string",
    )
    ends = merge_ends(merges, settle)
    assert rows(ends.where("in_cycle"), "loser_mdm_id", "winner_mdm_id", "hops") == [
        (i, None, None) for i in ("a", "b", "c", "into", "self")
    ]
    assert rows(ends.where("not in_cycle")) == [("before", "w", 2, False), ("x", "w", 1, False)]
    xref = spark.createDataFrame(
        [("P1", "before"), ("P2", "into"), ("P3", "w")], "source_id string, mdm_id string"
    )
    people = spark.createDataFrame([("P1",), ("P2",), ("P3",)], "participant_id string")
    found = normalize_participants(people, xref, merges, settle)
    assert rows(found, "participant_id", "final_mdm_id") == [("P1", "w"), ("P2", "into"), ("P3", "w")]
    assert merge_ends(merges.limit(0), settle).isEmpty()


def test_rounds_end_with_the_chains_and_send_no_table_to_the_driver(spark, rows):
    """Two in a circle among many losers: as many rounds as the chains need, all joined by sorting."""
    pairs = [("a", "b"), ("b", "a"), *[(f"s{i}", "end") for i in range(200)], ("t", "s0")]
    merges = spark.createDataFrame(pairs, "loser_mdm_id string, winner_mdm_id string")
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return settle(df)

    ends = merge_ends(merges, noted)
    assert rows(ends.where("in_cycle"), "loser_mdm_id") == [("a",), ("b",)]
    assert rows(ends.where("hops > 1"), "loser_mdm_id", "winner_mdm_id") == [("t", "end")]
    assert len(plans) <= 4
    assert not any("Broadcast" in plan for plan in plans)
