"""Linked feeds as a stream: rows wait for their counterparts, whatever order files come in."""

import datetime as dt
import itertools

import pytest

from eventmart import fixed_values as fv
from eventmart.plans import Layout, landed
from eventmart.plans.landing import LINES
from eventmart.session import Workspace
from eventmart.specs import FeedRules, FeedSpec, Link
from eventmart.streaming import end_waits, family, stream_family

START = dt.datetime(2025, 7, 6, 1)
HOUR = dt.timedelta(hours=1)
RULES = {
    "parent": FeedRules(
        ("id",), ("id",), (Link("child", ("id",), ("of",)), Link("mark", ("id",), ("of",))),
        fv.REASON_MISSING_CHILD, file_pattern=r"parent_\d+\.csv$", parent=True,
    ),
    "child": FeedRules(("line",), ("line", "of"), (Link("parent", ("of",), ("id",)),), file_pattern=r"child_\d+\.csv$"),
    "mark": FeedRules(("of",), ("of",), (Link("parent", ("of",), ("id",)),), file_pattern=r"mark_\d+\.csv$"),
}
COLUMNS = {"parent": ("id", "name"), "child": ("line", "of", "n"), "mark": ("of",)}
FILES = {
    "parent_1": ["p1,a", "p2,b", "p3,c"],
    "child_1": ["c1,p1,1", "c2,p2,1", "c4,p4,1", "short"],
    "mark_1": ["p1", "p4"],
    "child_2": ["c5,p1,2", ",p1,2"],
}


@pytest.fixture
def world(tmp_path):
    (tmp_path / "in").mkdir()
    specs = {
        n: FeedSpec(n, f"lm_{n}", str(tmp_path / "in"), str(tmp_path / "pre"), f"{n}_", ",", COLUMNS[n], r)
        for n, r in RULES.items()
    }
    return specs, Layout(str(tmp_path)), tmp_path


def put(world, name):
    feed = name.split("_")[0]
    (world[2] / "in" / f"{name}.csv").write_text("\n".join([",".join(COLUMNS[feed]), *FILES[name]]) + "\n")


def go(spark, world, now, wait=10 * HOUR):
    specs, layout, base = world
    query = stream_family(spark, specs, layout, str(base / "checkpoint"), wait, clock=lambda: now)
    query.awaitTermination()


def keys(spark, world):
    out = {}
    for name, spec in world[0].items():
        table = landed(spark, world[1].landing(spec.table))
        out[name] = sorted(r[0] for r in table.collect()) if table is not None else []
    return out


def waiting(spark, world):
    found = {n: family._waiting(spark, world[1].waiting(n), "none") for n in world[0]}
    return {n: b.rows if b else 0 for n, b in found.items()}


def rejects(spark, world):
    out = []
    for name in world[0]:
        table = spark.read.option("mergeSchema", True).parquet(world[1].errors(name))
        out += [(name, r[0]) for r in table.where(f"reject_kind <> '{LINES}'").select(fv.ERROR_REASON).collect()]
    return sorted(out)


@pytest.mark.parametrize("order", [("child_1", "parent_1", "mark_1", "child_2"), ("mark_1", "child_2", "parent_1", "child_1")])
def test_any_order_of_files(spark, world, order):
    for i, name in enumerate(order):
        put(world, name)
        go(spark, world, START + i * HOUR)
    # p1 has all it needs; p2 lacks its mark, p3 lacks both, c4 and p4's mark lack their parent
    assert keys(spark, world) == {"parent": ["p1"], "child": ["c1", "c5"], "mark": ["p1"]}
    assert waiting(spark, world) == {"parent": 2, "child": 2, "mark": 1}
    assert rejects(spark, world) == [("child", fv.REASON_NULL)]
    specs, layout, _ = world
    soon = end_waits(spark, specs, layout, START + 4 * HOUR, 10 * HOUR)
    assert soon["rejected parent"] == 0 and soon["waiting parent"] == 2
    end_waits(spark, specs, layout, START + 20 * HOUR, 10 * HOUR)
    assert waiting(spark, world) == {"parent": 0, "child": 0, "mark": 0}
    assert rejects(spark, world) == sorted(
        [("child", fv.REASON_NULL)] + 2 * [("parent", fv.REASON_MISSING_CHILD)]
        + 2 * [("child", fv.REASON_MISSING_PARENT)] + [("mark", fv.REASON_MISSING_PARENT)]
    )
    assert keys(spark, world)["parent"] == ["p1"]


def test_a_late_counterpart_is_late(spark, world):
    """Time is counted per row; after it is up, the row does not come back."""
    put(world, "parent_1")
    go(spark, world, START, 2 * HOUR)
    put(world, "child_1")
    go(spark, world, START + 2 * HOUR, 2 * HOUR)  # the parents' time is up as this batch ends
    assert keys(spark, world)["parent"] == [] and waiting(spark, world)["child"] == 3
    put(world, "mark_1")
    go(spark, world, START + 3 * HOUR, 2 * HOUR)
    assert keys(spark, world) == {"parent": [], "child": [], "mark": []}


def test_a_repeated_batch_gives_the_same(spark, world, monkeypatch):
    """A batch that fails after some feeds have landed starts from the same waiting rows."""
    put(world, "parent_1")
    go(spark, world, START)
    put(world, "child_1")
    put(world, "mark_1")
    real, calls = family._keep_waiting, itertools.count()

    def fail(*args):
        if next(calls) == 2:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(family, "_keep_waiting", fail)
    with pytest.raises(Exception, match="lost"):
        go(spark, world, START + HOUR)
    monkeypatch.undo()
    go(spark, world, START + HOUR)
    assert keys(spark, world) == {"parent": ["p1"], "child": ["c1"], "mark": ["p1"]}
    assert waiting(spark, world) == {"parent": 2, "child": 2, "mark": 1}


def test_feeds_of_a_family_belong_together(spark, world):
    specs, layout, base = world
    with pytest.raises(ValueError, match="left out"):
        stream_family(spark, {"child": specs["child"]}, layout, str(base / "c"), HOUR)


def test_nothing_waits(spark, world):
    with Workspace(spark) as work:
        assert family.land_family(spark, world[0], world[1], {}, "b", START, HOUR, work) == {}
