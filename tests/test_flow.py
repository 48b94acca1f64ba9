"""All layers on feeds written by hand, over two days."""

import datetime as dt
import logging
from dataclasses import replace

import pytest

from eventmart import fixed_values as fv
from eventmart.plans import Layout, Masters, build_marts, flow, rebuild, run
from eventmart.plans.flow import normalize, run_name
from eventmart.plans.landing import fresh_rows, gate_feeds, land, landed, rebuild_table
from eventmart.operators import clean_rows, rejected_rows
from eventmart.session import settle
from eventmart.sources import state
from eventmart.specs import DEFAULT_RULES, FeedRules, Link, load_specs

DAY1 = dt.datetime(2025, 7, 6, 1)
DAY2 = dt.datetime(2025, 7, 7, 1)

COLUMNS = {
    "event": "event_vendor_id,event_name,event_start_date,event_type,event_brand,indication_name",
    "event_del": "event_vendor_id,deletion_reason,deletion_date_time",
    "participant": "event_vendor_id,participant_vendor_id,participant_type,hcp_id,registered,attended",
    "hcp_master": "hcp_id,hcp_last_name,hcp_primary_address_id",
    "address": "address_id,city",
    "child_attributes": "hcp_id,attribute_type,attribute_value",
    "expenses": "event_vendor_id,event_expense,event_expense_estimate,event_expense_actual",
}
RULES = {
    "event": FeedRules(
        ("event_id",), ("event_id", "event_date"),
        aliases={"event_id": "event_vendor_id", "event_date": "event_start_date"},
        file_pattern=fv.FILE_PATTERNS["event"],
    ),
    "event_del": FeedRules(
        ("event_id",), ("event_id", "deletion_date"),
        aliases={"event_id": "event_vendor_id", "deletion_date": "deletion_date_time"},
        file_pattern=fv.FILE_PATTERNS["event_del"],
    ),
    "participant": FeedRules(
        ("participant_id", "event_id"), ("participant_id", "event_id", "hcp_id"),
        aliases={"event_id": "event_vendor_id", "participant_id": "participant_vendor_id"},
        file_pattern=fv.FILE_PATTERNS["participant"],
    ),
    "hcp_master": FeedRules(
        ("hcp_id",), ("hcp_id",),
        (Link("address", ("hcp_primary_address_id",), ("address_id",)),
         Link("child_attributes", ("hcp_id",), ("hcp_id",))),
        fv.REASON_MISSING_CHILD, file_pattern=fv.FILE_PATTERNS["hcp_master"], parent=True,
    ),
    "address": FeedRules(
        ("address_id",), ("address_id", "city"),
        (Link("hcp_master", ("address_id",), ("hcp_primary_address_id",)),),
        file_pattern=fv.FILE_PATTERNS["address"],
    ),
    "child_attributes": FeedRules(
        ("hcp_id", "attribute_type"), ("hcp_id",),
        (Link("hcp_master", ("hcp_id",), ("hcp_id",)),),
        file_pattern=fv.FILE_PATTERNS["child_attributes"],
    ),
    "expenses": replace(DEFAULT_RULES["expenses"], file_pattern=r"LMHC_EXPENSES_\d{14}\.csv$"),
}
PREFIX = {
    "event": "LMHC_EVENT", "event_del": "LMHC_EVENT_DEL", "participant": "LMHC_PARTICIPANT",
    "hcp_master": "LMHC_hcp", "address": "LMHC_address", "child_attributes": "LMHC_child",
    "expenses": "LMHC_EXPENSES",
}
TABLE = {
    "event": "lm_events", "event_del": "lm_event_del", "participant": "lm_participants",
    "hcp_master": "lm_hcp_master", "address": "lm_address",
    "child_attributes": "lm_child_attributes", "expenses": "lnd_events_expenses_daily",
}


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    return tmp_path_factory.mktemp("flow")


@pytest.fixture(scope="module")
def world(spark, base):
    control = spark.createDataFrame(
        [
            (f"{base}/inbound", f"{base}/preprocess", PREFIX[f], ",", COLUMNS[f], TABLE[f], f)
            for f in COLUMNS
        ],
        [*fv.CONTROL_COLUMNS, "feed_type"],
    )
    masters = Masters(
        spark.createDataFrame(
            [("Alpha", "Alpha", "B1"), ("Beta", "Beta", "B2")],
            "source_product_name string, Brand_name string, Brand_id string",
        ),
        spark.createDataFrame(
            [("Flu", "Flu", "I1")],
            "source_indication_name string, indication_name string, indication_id string",
        ),
        spark.createDataFrame([("P1", "M1"), ("P2", "M2")], "source_id string, mdm_id string"),
        spark.createDataFrame([("M2", "M1")], "loser_mdm_id string, winner_mdm_id string"),
    )
    return load_specs(control, RULES), masters, Layout(str(base))


def put(base, feed, name, *lines, header=None):
    (base / "inbound").mkdir(exist_ok=True)
    (base / "inbound" / name).write_text("\n".join([header or COLUMNS[feed], *lines]) + "\n")


@pytest.fixture(scope="module")
def day_one(spark, base, world):
    put(base, "event", "LMHC_EVENT_20250706010000.csv",
        "E1,Kick-off,2025-08-15,Program,Alpha | Beta,Flu",
        "E2,Talk,2025-08-15,Training,Gamma,Cold",
        "E3,Twice,2025-08-16,Program,Alpha,Flu", "E3,Twice,2025-08-16,Program,Alpha,Flu",
        "E4,No date,,Program,Alpha,Flu", "E5,Short")
    put(base, "event", "LMHC_EVENT_20250706020000.csv", "E6,No brand,2025-08-17,Program,,Flu")
    put(base, "event", "LMHC_EVENT_20250706030000.csv", "E7,Bad", header="event_vendor_id,event_name")
    put(base, "event_del", "LMHC_EVENT_DEL_20250706010000.csv", "E2,Low RSVP,2025-07-03")
    put(base, "participant", "LMHC_PARTICIPANT_20250706010000.csv",
        "E1,P1,Speaker,1001,Y,Y", "E1,P2,Attendee,1002,Y,N", "E1,P3,Attendee,,Y,Y",
        "E2,P2,Attendee,1002,N,")
    put(base, "hcp_master", "LMHC_hcp_master_file_20250706.csv",
        "1001,Smith,A1", "1002,Jones,A9", "1003,Brown,A3")
    put(base, "address", "LMHC_address_file_20250706.csv", "A1,Boston", "A3,Chicago", "A4,Miami")
    put(base, "child_attributes", "LMHC_child_attributes_20250706.csv",
        "1001,Degree,MD", "1001,Tier,1", "1002,Degree,DO", "1009,Degree,MD")
    put(base, "expenses", "LMHC_EXPENSES_20250706010000.csv", "E1,Venue,10.5,9.5", "E9,Venue,1,1")
    specs, masters, layout = world
    return run(spark, specs, masters, layout, DAY1)


def read(spark, path):
    return spark.read.option("mergeSchema", True).parquet(path)


def test_counts(day_one):
    assert day_one == {
        "malformed event": 1, "malformed event_del": 0, "malformed participant": 0,
        "malformed hcp_master": 0, "malformed address": 0, "malformed child_attributes": 0,
        "malformed expenses": 0, "files": 9,
        "landing lm_events": 3, "rejected event": 3,
        "landing lm_event_del": 1, "rejected event_del": 0,
        "landing lm_participants": 3, "rejected participant": 1,
        "landing lm_hcp_master": 1, "rejected hcp_master": 2,
        "landing lm_address": 1, "rejected address": 2,
        "landing lm_child_attributes": 2, "rejected child_attributes": 2,
        "landing lnd_events_expenses_daily": 2, "rejected expenses": 0,
        "normalized lm_events": 2, "normalized lm_participants": 3,
        "normalized lm_events_expenses": 1,
        "summarized event_performance_kpi": 1, "summarized product_performance_kpi": 2,
        "summarized participant_engagement_kpi": 2, "summarized event_type_participants_kpi": 2,
        "summarized brand_performance_kpi": 2,
        "outbound lm_events": 2, "outbound lm_participants": 3,
    }


def test_tables_of_day_one(spark, day_one, world, rows, base):
    layout = world[2]
    assert rows(read(spark, layout.errors("event")), "event_id", "error_reason", "malformed_line") == [
        (None, "Malformed record", "E5,Short"),
        ("E3", fv.REASON_DUPLICATE, None), ("E3", fv.REASON_DUPLICATE, None),
        ("E4", fv.REASON_NULL, None),
    ]
    assert rows(read(spark, layout.errors("hcp_master")), "hcp_id", "error_reason") == [
        ("1002", fv.REASON_MISSING_CHILD), ("1003", fv.REASON_MISSING_CHILD),
    ]
    assert rows(read(spark, layout.errors("address")), "address_id", "error_reason") == [
        ("A3", fv.REASON_MISSING_PARENT), ("A4", fv.REASON_MISSING_PARENT),
    ]
    assert rows(read(spark, layout.normalized("lm_events")), "event_id", "event_brand", "brand_id", "indication_id") == [
        ("E1", "Alpha|Beta", "B1|B2", "I1"), ("E2", "Gamma", "412", None),
    ]
    assert rows(read(spark, layout.normalized("lm_participants")), "participant_id", "event_id", "final_mdm_id") == [
        ("P1", "E1", "M1"), ("P2", "E1", "M1"), ("P2", "E2", "M1"),
    ]
    assert rows(read(spark, layout.normalized("lm_events_expenses"))) == [
        ("E1", "E1", "Venue", "10.5", "9.5"),
    ]
    assert rows(read(spark, layout.summarized("event_performance_kpi"))) == [
        ("2025-08-15", 2, 3, 1, 1 / 3, 1 / 3, "2025-07-06"),
    ]
    assert rows(read(spark, layout.summarized("participant_engagement_kpi"))) == [
        ("Attendee", 2, 0, 0.0, 1.0, "2025-07-06"), ("Speaker", 1, 1, 1.0, 0.0, "2025-07-06"),
    ]
    out = spark.read.options(header=True, sep="|").csv(f"{base}/outbound/OUT_LM_PARTICIPANTS_20250706.csv")
    assert out.count() == 3
    ledger = read(spark, layout.ledger)
    assert rows(ledger.where("reason IS NOT NULL"), "file_name", "feed_type") == [
        ("LMHC_EVENT_20250706030000.csv", "event"),
    ]
    assert ledger.count() == 9


def test_day_two_adds_new_rows_only(spark, day_one, world, base, rows):
    specs, masters, layout = world
    put(base, "event", "LMHC_EVENT_20250707010000.csv",
        "E1,Changed,2025-09-01,Program,Beta,Flu", "E3,Once,2025-08-16,Program,Alpha,Flu")
    put(base, "address", "LMHC_address_file_20250707.csv", "A9,Dallas")
    put(base, "hcp_master", "LMHC_hcp_master_file_20250707.csv", "1002,Jones,A9")
    counts = run(spark, specs, masters, layout, DAY2, without_deleted=True, keep_unbranded=True)
    assert counts["landing lm_events"] == 1
    # 1002 lacked its address; now it lands, and so do its attributes of day one.
    assert counts["landing lm_hcp_master"] == counts["landing lm_address"] == 1
    assert counts["landing lm_child_attributes"] == 1
    children(spark, layout)
    assert "landing lm_participants" not in counts
    expected = [("E1", "Kick-off", DAY1.date()), ("E2", "Talk", DAY1.date()),
                ("E3", "Once", DAY2.date()), ("E6", "No brand", DAY1.date())]
    stored = read(spark, layout.landing("lm_events"))
    assert rows(stored, "event_id", "event_name", "oasis_load_time") == expected
    # E2 was deleted, E6 has no brand and is kept.
    assert rows(read(spark, layout.normalized("lm_events")), "event_id", "brand_id") == [
        ("E1", "B1|B2"), ("E3", "B1"), ("E6", "412"),
    ]
    assert counts["outbound lm_events"] == 1
    # The same run once more changes nothing.
    assert run(spark, specs, masters, layout, DAY2, True, True) == counts
    assert rows(read(spark, layout.landing("lm_events")), "event_id", "event_name", "oasis_load_time") == expected
    # A run without new files takes nothing in.
    later = run(spark, specs, masters, layout, DAY2 + dt.timedelta(days=1), True, True)
    assert later["files"] == 0
    assert not [name for name in later if name.startswith("malformed")]
    # What still lacks its link was offered again, in vain.
    assert {n: c for n, c in later.items() if n.startswith(("landing", "rejected"))} == {
        "landing lm_hcp_master": 0, "rejected hcp_master": 1,
        "landing lm_address": 0, "rejected address": 2,
        "landing lm_child_attributes": 0, "rejected child_attributes": 1,
    }
    children(spark, layout)


def children(spark, layout):
    """No landed child lacks a landed parent, no landed parent its children."""
    parents = read(spark, layout.landing("lm_hcp_master"))
    addresses = read(spark, layout.landing("lm_address"))
    attributes = read(spark, layout.landing("lm_child_attributes"))
    ids = {r.hcp_id for r in parents.collect()}
    homes = {r.hcp_primary_address_id for r in parents.collect()}
    assert {r.address_id for r in addresses.collect()} == homes
    assert {r.hcp_id for r in attributes.collect()} == ids


def test_typed_keys_over_runs(spark, tmp_path, rows):
    """Zeros in front do not make another key; what is no number is a reject and ends no run."""
    rules = FeedRules(("k",), ("k",), types={"k": "int", "n": "int"})
    table, errors = str(tmp_path / "t"), str(tmp_path / "e")

    def go(batch, lines):
        feed = spark.createDataFrame(lines, "k string, n string")
        stored = landed(spark, table, but=batch)
        fresh = fresh_rows(feed, stored, rules, DAY1)
        tagged = gate_feeds({"f": fresh}, {"f": stored}, {"f": rules}, settle)["f"]
        return land(tagged, table, errors, batch, DAY1, rules.types)

    assert go("a", [("7", "1"), ("1", "1"), ("x", "1"), ("y", "1"), (None, "1")]) == (2, 3)
    assert go("b", [("007", "2"), ("8", "2"), ("08", "3"), ("9", "four"), ("x", "2")]) == (0, 4)
    assert rows(read(spark, table), "k", "n") == [(1, 1), (7, 1)]
    assert rows(read(spark, errors).groupBy("error_reason").count()) == [
        (fv.REASON_DUPLICATE, 2), (fv.REASON_NULL, 1), ("Value is not of its type", 4),
    ]
    # Stored rows are typed, the rules change, and the table is gated anew.
    stricter = replace(rules, domains={"k": ("1", "2")})
    assert rebuild_table(spark, table, errors, stricter, "c", DAY2, settle) == (1, 1)
    assert rows(read(spark, table), "k", "load_batch") == [(1, "c")]


def test_group_rule_of_a_feed(spark, rows):
    rules = FeedRules(("k", "v"), ("k",), group=(("k",), "v", ("Degree",)))
    stored = spark.createDataFrame([("3", "Degree")], "k string, v string")
    feed = spark.createDataFrame(
        [("1", "Degree"), ("1", "Tier"), ("2", "Tier"), ("3", "Tier")], "k string, v string"
    )
    fresh = fresh_rows(feed, stored, rules, DAY1)
    tagged = gate_feeds({"f": fresh}, {"f": stored}, {"f": rules}, settle)["f"]
    assert rows(clean_rows(tagged), "k", "v") == [("1", "Degree"), ("1", "Tier"), ("3", "Tier")]
    assert rows(rejected_rows(tagged), "k", "error_reason") == [("2", "Group lacks a required value")]


def test_repeated_master_keys_end_a_strict_run(spark, world, day_one):
    specs, masters, layout = world
    twice = replace(masters, xref=masters.xref.unionAll(masters.xref))
    with pytest.raises(ValueError, match="repeated keys"):
        normalize(spark, specs, twice, layout, settle, strict_masters=True)


def test_run_names_tell_fractions_of_a_second_apart():
    later = DAY1.replace(microsecond=5)
    assert run_name(DAY1) < run_name(later) < run_name(DAY2)


def test_missing_tables_are_named(spark, world, tmp_path, caplog):
    specs, masters, _ = world
    with caplog.at_level(logging.WARNING):
        normalize(spark, specs, masters, Layout(str(tmp_path)), settle)
    assert "no landed events" in caplog.text and "no landed expenses" in caplog.text


def test_adding_a_batch_equals_rebuilding_the_table(spark, rows):
    rules = FeedRules(("k",), ("k", "v"))
    first = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, None)], "k int, v string")
    second = spark.createDataFrame(
        [(1, "new"), (2, "d"), (4, "e"), (None, "f")], "k int, v string"
    )
    def gated(feed, snapshot, run_ts):
        fresh = fresh_rows(feed, snapshot, rules, run_ts)
        return gate_feeds({"f": fresh}, {}, {"f": rules}, settle)["f"]

    stored = clean_rows(gated(first, None, DAY1))
    added = gated(second, stored, DAY2)
    whole = rebuild(second, stored, rules, DAY2)
    both = stored.unionByName(clean_rows(added))
    assert rows(both, "k", "v") == [(1, "a"), (2, "d"), (4, "e")]
    assert rows(clean_rows(whole), "k", "v") == rows(both, "k", "v")
    assert rows(rejected_rows(whole), "k", "error_reason") == rows(rejected_rows(added), "k", "error_reason")


def test_a_row_without_its_whole_key_does_not_land(spark, rows):
    rules = FeedRules(("k", "j"), ())
    df = spark.createDataFrame([(1, None), (1, 2), (None, None)], "k int, j int")
    tagged = gate_feeds({"f": fresh_rows(df, None, rules, DAY1)}, {}, {"f": rules}, settle)["f"]
    assert rows(clean_rows(tagged), "k", "j") == [(1, 2)]


def test_contract_rules_of_a_feed(spark, tmp_path, rows):
    rules = FeedRules(
        ("k",), ("k",), types={"n": "int"}, domains={"s": ("Closed", "Pending")}, dates=("d",),
        conditional=(("s", "Closed", "p"),),
    )
    df = spark.createDataFrame(
        [("1", "4", "Closed", "2025-01-01", "x"), ("2", "four", "Pending", None, None),
         ("3", "4", "closed", None, None), ("4", "4", "Closed", None, None),
         ("5", None, None, "01/01/2025", None), ("6", None, None, None, None),
         (None, "four", "closed", None, None)],
        "k string, n string, s string, d string, p string",
    )
    fresh = fresh_rows(df, None, rules, DAY1)
    tagged = gate_feeds({"f": fresh}, {}, {"f": rules}, settle)["f"]
    table, errors = str(tmp_path / "t"), str(tmp_path / "e")
    assert land(tagged, table, errors, "b", DAY1, rules.types) == (2, 5)
    assert rows(spark.read.parquet(table), "k", "n") == [("1", 4), ("6", None)]
    assert rows(spark.read.parquet(errors), "k", "n", "error_reason") == [
        (None, "four", fv.REASON_NULL), ("2", "four", "Value is not of its type"),
        ("3", "4", "Value is not listed"), ("4", "4", "Missing p where s is Closed"),
        ("5", None, "Date is not valid"),
    ]


def test_a_failure_ends_the_run(spark, base, world, tmp_path):
    specs, masters, _ = world
    specs = {**specs, "event": replace(specs["event"], rules=replace(RULES["event"], keys=("no_such_key",)))}
    logging.getLogger("py4j").setLevel(logging.CRITICAL)
    with pytest.raises(Exception, match="no_such_key"):
        run(spark, specs, masters, Layout(str(tmp_path)), DAY1)
    # The files of the failed run are not marked as handled.
    assert not (tmp_path / "intake" / "handled").exists()


def test_kept_marts_follow_the_runs(spark, day_one, world, base, rows):
    """Marts kept up by runs equal those of all rows; the state is made anew only when it must be."""
    specs, masters, layout = world
    day = dt.datetime(2025, 7, 10, 1)

    def check(at):
        flow.normalize(spark, specs, masters, layout, settle, True)
        tables = [read(spark, layout.normalized(n)) for n in ("lm_events", "lm_participants")]
        wanted = build_marts(*tables, at.date().isoformat())
        for name, mart in wanted.items():
            assert rows(read(spark, layout.summarized(name)), *mart.columns) == rows(mart), name
        return [b.name for b in state(spark, layout.mart_states).batches]

    flow.keep_marts(spark, specs, masters, layout, day, settle, True)
    assert check(day) == [run_name(day)]
    # A new event, late and early participants, and deletes of a stored and of an unknown event.
    put(base, "event", "LMHC_EVENT_20250711010000.csv", "E8,New,2025-08-20,Program,Beta,Flu")
    put(base, "participant", "LMHC_PARTICIPANT_20250711010000.csv",
        "E1,P7,Attendee,1007,Y,Y", "E9,P7,Attendee,1007,Y,Y", "E8,P1,Speaker,1001,N,Y")
    put(base, "event_del", "LMHC_EVENT_DEL_20250711010000.csv", "E3,Gone,2025-07-10", "E10,Gone,2025-07-10")
    later = day + dt.timedelta(days=1)
    for _ in range(2):  # the second time is a scheduler's retry
        run(spark, specs, masters, layout, later, without_deleted=True, kept_marts=True)
        assert check(later) == [run_name(day), run_name(later)]
    # Another brand for a stored event's text: the state is made anew.
    products = spark.createDataFrame(
        [("Alpha", "Alpha", "B9"), ("Beta", "Beta", "B2")],
        "source_product_name string, Brand_name string, Brand_id string",
    )
    masters = replace(masters, products=products)
    last = later + dt.timedelta(days=1)
    flow.keep_marts(spark, specs, masters, layout, last, settle, True)
    assert check(last) == [run_name(last)]
