"""Tables of batches: manifests, keys in buckets, compaction, and rebuilds that may end anywhere."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from eventmart import fixed_values as fv
from eventmart.operators import clean_rows
from eventmart.plans import landing as plan
from eventmart.plans.landing import (
    Place,
    fresh_rows,
    gate_feeds,
    indexed,
    land,
    landed,
    rebuild_table,
    rebuild_tables,
    set_aside,
)
from eventmart.session import settle
from eventmart.sources import batches as bt
from eventmart.sources import compact, publish, state, stored, sweep, write_batch
from eventmart.specs import FeedRules, Link

DAY = [dt.datetime(2025, 7, d, 1) for d in range(1, 9)]
RULES = FeedRules(("k",), ("k",))
FAMILY = {
    "parent": FeedRules(("id",), ("id",), (Link("child", ("id",), ("of",)),), fv.REASON_MISSING_CHILD, parent=True),
    "child": FeedRules(("line",), ("line", "of"), (Link("parent", ("of",), ("id",)),)),
}


def put(spark, path, name, lines, schema="k string, v string", index=(("k",),)):
    batch = write_batch(spark, path, name, spark.createDataFrame(lines, schema), index)
    return publish(spark, path, batch)


def lines(spark, path):
    table = landed(spark, path)
    return [] if table is None else sorted(tuple(r) for r in table.collect())


def test_only_published_batches_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    assert landed(spark, path) is None and stored(spark, path) is None
    write_batch(spark, path, "a", spark.createDataFrame([("1", "x")], "k string, v string"))
    assert lines(spark, path) == [] and stored(spark, path) is None
    put(spark, path, "b", [("2", "y")])
    assert lines(spark, path) == [("2", "y")]
    assert stored(spark, path, but="b") is None and landed(spark, path, but="b").count() == 0
    sweep(spark, path)
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["_keys", "_manifests", "load_batch=b"]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, "a", [("1", "x")])
    open_before = landed(spark, path)
    put(spark, path, "a", [("2", "y")])
    assert lines(spark, path) == [("2", "y")]
    assert [tuple(r) for r in open_before.collect()] == [("1", "x")]  # nobody's files were replaced
    sweep(spark, path)
    assert lines(spark, path) == [("2", "y")] and len(state(spark, path).batches) == 1


def test_a_folder_without_manifest_is_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    for name in "ab":
        spark.createDataFrame([(name, "x")], "k string, v string").write.parquet(f"{path}/load_batch={name}")
    assert lines(spark, path) == [("a", "x"), ("b", "x")]
    put(spark, path, "c", [("c", "x")])
    assert lines(spark, path) == [("a", "x"), ("b", "x"), ("c", "x")]
    feed = spark.createDataFrame([("a",), ("c",), ("d",)], "k string")
    known = stored(spark, path).keys(["k"], feed, ["k"])
    assert {"a", "c"} <= {r[0] for r in known.collect()}


def test_a_second_writer_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    before = put(spark, path, "a", [("1", "x")])
    put(spark, path, "b", [("2", "x")])
    with pytest.raises(RuntimeError, match="another writer"):
        bt.commit(spark, path, before)


def test_a_small_feed_opens_few_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bt, "KEYS", 64)
    path = str(tmp_path / "t")
    for name, n in (("a", 3000), ("b", 3000), ("c", 60)):
        put(spark, path, name, [(f"{name}{i}", "x") for i in range(n)])
    table = stored(spark, path)
    assert [b.buckets for b in table.batches] == [64, 64, 1]
    assert len(spark.read.parquet(f"{path}/_keys/k").inputFiles()) > 100
    feed = spark.createDataFrame([("a7",), ("b7",), ("new",), (None,)], "key string")
    read = table.keys(["k"], feed, ["key"])
    assert read.columns == ["k"]
    files = {r[0] for r in read.select(F.input_file_name()).distinct().collect()}
    assert 3 <= len(files) <= 4 * 2 + 1  # a bucket per key and large batch, and the small one
    assert {"a7", "b7"} <= {r["k"] for r in read.collect()}
    # the others are not listed among the partitions that the scan selects
    scan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "bucket" in scan.split("PartitionFilters: [")[1][:300]


def test_keys_of_several_columns_and_types(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, f"s{i}", None if i == 3 else i % 2) for i in range(6)]
    put(spark, path, "a", rows, "n int, s string, flag int", [("n", "s"), ("flag",)])
    feed = spark.createDataFrame([("4", "s4"), ("5", "s4"), ("3", "s3")], "a string, b string")
    known = stored(spark, path).keys(["n", "s"], feed, ["a", "b"]).join(feed.toDF("n", "s"), ["n", "s"], "left_semi")
    assert sorted(map(tuple, known.collect())) == [("3", "s3"), ("4", "s4")]
    flags = stored(spark, path).keys(["flag"], spark.createDataFrame([(0,), (1,)], "f int"), ["f"])
    assert sorted(r[0] for r in flags.collect()) == ["0", "1"]


def test_compaction_keeps_every_row_and_few_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bt, "FAN_IN", 3)
    path, most = str(tmp_path / "t"), 0
    for i in range(13):
        put(spark, path, f"b{i:02d}", [(f"{i}-{n}", "x") for n in range(4)])
        compact(spark, path, [("k",)])
        sweep(spark, path)
        most = max(most, len(state(spark, path).batches))
    assert len(lines(spark, path)) == 52 and most <= 7
    folders = {p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("load_batch=")}
    assert folders == {b.folder for b in state(spark, path).batches}
    assert "b12" in {b.name for b in state(spark, path).batches}  # the newest can still be repeated
    feed = spark.createDataFrame([("0-0",), ("12-3",), ("none",)], "k string")
    known = {r[0] for r in stored(spark, path).keys(["k"], feed, ["k"]).collect()}
    assert {"0-0", "12-3"} <= known and all(b.index == ("k",) for b in state(spark, path).batches)


def go(spark, base, day, batch, **feeds):
    """One landing run of the family; returns what each feed keeps and rejects."""
    schemas = {"parent": "id string, name string", "child": "line string, of string"}
    snapshots = {n: stored(spark, f"{base}/{n}", but=batch) for n in FAMILY}
    fresh = {}
    for name, rules in FAMILY.items():
        waiting = set_aside(spark, f"{base}/{name}_error", rules, batch)
        rows = feeds.get(name, [])
        if rows or waiting is not None:
            feed = spark.createDataFrame(rows, schemas[name])
            fresh[name] = fresh_rows(feed, snapshots[name], rules, day, settle, waiting)
    tagged = gate_feeds(fresh, snapshots, FAMILY, settle)
    return {
        n: land(t, f"{base}/{n}", f"{base}/{n}_error", batch, day, index=indexed(n, FAMILY))
        for n, t in tagged.items()
    }


def places(base, rules=FAMILY):
    return {n: Place(f"{base}/{n}", f"{base}/{n}_error", r) for n, r in rules.items()}


def content(spark, base):
    return {n: sorted(tuple(r)[:2] for r in landed(spark, f"{base}/{n}").collect()) for n in FAMILY}


def start(spark, base):
    """Two whole families, and a child that waits for its parent."""
    return go(
        spark, base, DAY[0], "r1", parent=[("p1", "a"), ("p2", None)],
        child=[("c1", "p1"), ("c2", "p2"), ("c3", "p3")],
    )


STRICT = FAMILY | {"parent": replace(FAMILY["parent"], required=("id", "name"))}


def test_a_rebuild_run_twice_changes_nothing(spark, tmp_path):
    base = str(tmp_path)
    assert start(spark, base) == {"parent": (2, 0), "child": (2, 1)}
    before = content(spark, base)
    once = rebuild_tables(spark, places(base), "r1x1", DAY[1], settle)
    assert once == {"parent": (2, 0), "child": (2, 0)} and content(spark, base) == before
    assert rebuild_tables(spark, places(base), "r1x1", DAY[1], settle) == once
    assert rebuild_tables(spark, places(base), "r1x2", DAY[2], settle) == once
    assert content(spark, base) == before
    assert [b.name for b in state(spark, f"{base}/child").batches] == ["r1x2"]


def test_children_go_with_their_parent_and_come_back(spark, tmp_path):
    base = str(tmp_path)
    start(spark, base)
    out = rebuild_tables(spark, places(base, STRICT), "r1x1", DAY[1], settle)
    assert out == {"parent": (1, 1), "child": (1, 1)}
    assert rebuild_tables(spark, places(base, STRICT), "r1x1", DAY[1], settle) == out
    assert content(spark, base) == {"parent": [("p1", "a")], "child": [("c1", "p1")]}
    # both the child that waited before and the one that lost its parent are offered again
    assert set_aside(spark, f"{base}/child_error", FAMILY["child"], "r2").count() == 2
    go(spark, base, DAY[2], "r2", parent=[("p2", "b"), ("p3", "c")])
    assert content(spark, base)["child"] == [("c1", "p1"), ("c2", "p2"), ("c3", "p3")]
    assert set_aside(spark, f"{base}/child_error", FAMILY["child"], "r3").count() == 0


@pytest.mark.parametrize(
    ("stop_at", "after"), [("write_batch", 1), ("quarantine", 0), ("commit", 0), ("commit", 1), ("sweep", 1)]
)
def test_a_rebuild_that_stops_half_way_is_repeated(spark, tmp_path, monkeypatch, stop_at, after):
    base, calls = str(tmp_path), []
    start(spark, base)
    before = content(spark, base)
    real = getattr(plan, stop_at)

    def stop(*args, **more):
        calls.append(1)
        if len(calls) > after:
            raise KeyboardInterrupt
        return real(*args, **more)

    monkeypatch.setattr(plan, stop_at, stop)
    with pytest.raises(KeyboardInterrupt):
        rebuild_tables(spark, places(base, STRICT), "r1x1", DAY[1], settle)
    if (stop_at, after) not in (("commit", 1), ("sweep", 1)):  # until a table is switched
        assert content(spark, base) == before
    monkeypatch.undo()
    assert rebuild_tables(spark, places(base, STRICT), "r1x1", DAY[1], settle) == {"parent": (1, 1), "child": (1, 1)}
    assert content(spark, base) == {"parent": [("p1", "a")], "child": [("c1", "p1")]}
    for name in FAMILY:
        found = sorted(p.name for p in (tmp_path / name).iterdir() if p.name.startswith("load_batch"))
        assert found == [b.folder for b in state(spark, f"{base}/{name}").batches]


def test_waiting_rows_outlive_rejects_of_a_rebuild(spark, tmp_path):
    """A rebuild that rejects a row for another reason does not hide those that wait."""
    base = str(tmp_path)
    start(spark, base)
    strict = replace(FAMILY["child"], required=("line", "of", "line"), domains={"line": ("c1",)})
    assert rebuild_table(spark, f"{base}/child", f"{base}/child_error", strict, "r1x1", DAY[1], settle) == (1, 1)
    assert [tuple(r)[:2] for r in set_aside(spark, f"{base}/child_error", FAMILY["child"], "r2").collect()] == [("c3", "p3")]


def test_a_rebuild_of_nothing(spark, tmp_path):
    assert rebuild_tables(spark, places(str(tmp_path)), "x", DAY[0], settle) == {"parent": (0, 0), "child": (0, 0)}


def test_a_run_that_stops_before_its_manifest_adds_nothing(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    start(spark, base)
    before = content(spark, base)
    monkeypatch.setattr(plan, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        go(spark, base, DAY[1], "r2", parent=[("p4", "d")], child=[("c4", "p4")])
    assert content(spark, base) == before
    monkeypatch.undo()
    go(spark, base, DAY[2], "r3", parent=[("p4", "d")], child=[("c4", "p4")])
    assert content(spark, base)["child"] == [("c1", "p1"), ("c2", "p2"), ("c4", "p4")]


def test_typed_keys_are_found_by_their_text(spark, tmp_path):
    rules = FeedRules(("k",), ("k",), types={"k": "int"})
    table, errors = str(tmp_path / "t"), str(tmp_path / "e")
    for batch, keys in (("a", ["7", "01"]), ("b", ["007", "1", "8"])):
        feed = spark.createDataFrame([(k,) for k in keys], "k string")
        known = stored(spark, table, but=batch)
        fresh = fresh_rows(feed, known, rules, DAY[0], settle)
        tagged = gate_feeds({"f": fresh}, {"f": known}, {"f": rules}, settle)["f"]
        land(tagged, table, errors, batch, DAY[0], rules.types, indexed("f", {"f": rules}))
    assert sorted(r["k"] for r in landed(spark, table).collect()) == [1, 7, 8]
    assert clean_rows(tagged).count() == 1
