"""The layers in dependency order, each a step of its own; any failure ends the run.

All steps of a run share ``run_ts``, which names what they write: a step repeated for the same
run replaces its own output. The files of a run count as handled once they have landed, so
files of a failed run are taken in again.
"""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import fixed_values as fv
from eventmart.operators import mart_states as ms
from eventmart.operators.contracts import apply_deletes
from eventmart.operators.enrich import assert_unique
from eventmart.operators.quality import Settle
from eventmart.plans import kept
from eventmart.plans.intake import staged_rows, take_in
from eventmart.plans.landing import (
    LINES,
    Place,
    fresh_rows,
    gate_feeds,
    indexed,
    land,
    landed,
    quarantine,
    rebuild_tables,
    set_aside,
    tidy,
)
from eventmart.plans.normalize import (
    normalize_events,
    normalize_expenses,
    normalize_participants,
)
from eventmart.plans.outbound import export_latest
from eventmart.plans.summarize import build_marts
from eventmart.session import Workspace, fitted_shuffles, stored_bytes
from eventmart.sources import (
    read_master,
    read_optional,
    read_table,
    stored,
    write_table,
)
from eventmart.specs import FeedSpec

log = logging.getLogger(__name__)

Counts = dict[str, int]
Specs = dict[str, FeedSpec]


@dataclass(frozen=True)
class Layout:
    """Folders of the layers below one base folder (local, HDFS or an object store)."""

    base: str

    def _in(self, layer: str, name: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{name}"

    def layer(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def landing(self, table: str) -> str:
        return self._in("landing", table)

    def errors(self, feed_type: str) -> str:
        return self._in("error", f"{feed_type}_error")

    def waiting(self, feed_type: str) -> str:
        return self._in("waiting", feed_type)

    def normalized(self, table: str) -> str:
        return self._in("normalized", table)

    def summarized(self, mart: str) -> str:
        return self._in("summarized", mart)

    def checked(self, batch: str) -> str:
        return self._in("intake/checked", batch)

    @property
    def mart_states(self) -> str:
        return self._in("summarized", "states")

    @property
    def ledger(self) -> str:
        return self._in("intake", "handled")

    @property
    def outbound(self) -> str:
        return f"{self.base.rstrip('/')}/outbound"


@dataclass(frozen=True)
class Masters:
    products: DataFrame
    indications: DataFrame
    xref: DataFrame
    merges: DataFrame


def read_masters(spark: SparkSession, folder: str) -> Masters:
    names = (fv.PRODUCT_MASTER, fv.INDICATION_MASTER, fv.XREF_MASTER, fv.MERGE_MASTER)
    return Masters(*[read_master(spark, f"{folder.rstrip('/')}/{name}") for name in names])


def run_name(run_ts: dt.datetime) -> str:
    """The batch of a run; later runs have later names."""
    fraction = f"_{run_ts:%f}" if run_ts.microsecond else ""
    return f"run_{run_ts:%Y%m%dT%H%M%S}{fraction}"


def input_bytes(spark: SparkSession, specs: Specs, layout: Layout) -> int:
    """Bytes of waiting files and stored layers, which a run's shuffles are sized for."""
    folders = {spec.inbound for spec in specs.values()}
    return stored_bytes(spark, *folders, layout.layer("landing"), layout.layer("normalized"))


def intake(
    spark: SparkSession, specs: Specs, layout: Layout, run_ts: dt.datetime, settle: Settle
) -> Counts:
    """Check and stage the waiting files of every feed."""
    batch, counts = run_name(run_ts), {}
    ledger = read_optional(spark, layout.ledger)
    if ledger is not None:
        ledger = ledger.where(F.col("run") != batch)
    checked = []
    for name, spec in specs.items():
        taken = take_in(spark, spec, run_ts, settle, specs.values(), ledger)
        checked.append(taken.files)
        if taken.rows is None:
            log.warning("no accepted file for feed %s", name)
            continue
        counts[f"malformed {name}"] = quarantine(
            taken.malformed, layout.errors(name), batch, run_ts, LINES
        )
    files = checked[0]
    for more in checked[1:]:
        files = files.unionByName(more)
    counts["files"] = write_table(files, layout.checked(batch))
    return counts


def landing(
    spark: SparkSession, specs: Specs, layout: Layout, run_ts: dt.datetime, settle: Settle
) -> Counts:
    """Land the feeds that got files in this run, then note the files as handled.

    Rows that lacked a link in an earlier run are offered again with them.
    """
    batch, counts = run_name(run_ts), {}
    files = read_table(spark, layout.checked(batch))
    accepted = files.where("reason IS NULL").select("feed_type").distinct()
    names = {r.feed_type for r in accepted.collect()}
    rules = {name: spec.rules for name, spec in specs.items()}
    snapshots = {
        name: stored(spark, layout.landing(spec.table), but=batch)
        for name, spec in specs.items()
    }
    fresh = {}
    for name, spec in specs.items():
        pending = set_aside(spark, layout.errors(name), rules[name], batch)
        if pending is not None:
            pending = settle(pending)
            pending = None if pending.isEmpty() else pending
        if name in names:
            rows = staged_rows(spark, spec, files)
        elif pending is not None:
            rows, pending = pending, None
        else:
            continue
        fresh[name] = fresh_rows(rows, snapshots[name], rules[name], run_ts, settle, pending)
    for name, tagged in gate_feeds(fresh, snapshots, rules, settle).items():
        table = specs[name].table
        kept, rejected = land(
            tagged,
            layout.landing(table),
            layout.errors(name),
            batch,
            run_ts,
            rules[name].types,
            indexed(name, rules),
        )
        counts[f"landing {table}"], counts[f"rejected {name}"] = kept, rejected
    for name in fresh:
        tidy(spark, layout.landing(specs[name].table), indexed(name, rules))
    write_table(files.withColumn("run", F.lit(batch)), layout.ledger, ["run"])
    return counts


def rebuild(
    spark: SparkSession, specs: Specs, layout: Layout, run_ts: dt.datetime, settle: Settle
) -> Counts:
    """Gate all landed rows of all feeds anew, for rules that changed since they came in."""
    places = {
        name: Place(layout.landing(spec.table), layout.errors(name), spec.rules)
        for name, spec in specs.items()
    }
    counts = {}
    rebuilt = rebuild_tables(spark, places, run_name(run_ts), run_ts, settle)
    for name, (kept, rejected) in rebuilt.items():
        counts[f"landing {specs[name].table}"], counts[f"rejected {name}"] = kept, rejected
    return counts


def normalize(
    spark: SparkSession,
    specs: Specs,
    masters: Masters,
    layout: Layout,
    settle: Settle,
    without_deleted: bool = False,
    keep_unbranded: bool = False,
    strict_masters: bool = False,
    follow_merges: bool = False,
) -> Counts:
    """Normalized tables of all landed feeds.

    ``strict_masters`` ends the run if a master key repeats, which would repeat joined rows.
    ``follow_merges`` takes the survivor at the end of a chain of merges, not the first.
    """
    counts = {}
    if strict_masters:
        assert_unique(masters.products, ["source_product_name"])
        assert_unique(masters.indications, ["source_indication_name"])
        assert_unique(masters.xref, ["source_id"])
        assert_unique(masters.merges, ["loser_mdm_id"])

    def table(name: str) -> DataFrame | None:
        return landed(spark, layout.landing(specs[name].table)) if name in specs else None

    def write(df: DataFrame, name: str) -> None:
        counts[f"normalized {name}"] = write_table(df, layout.normalized(name))

    events, participants, expenses = table("event"), table("participant"), table("expenses")
    if events is not None:
        deletes = table("event_del") if without_deleted else None
        if deletes is not None:
            events = apply_deletes(events, deletes, specs["event"].rules.keys, settle)
        write(
            normalize_events(
                events,
                masters.products,
                masters.indications,
                keep_unbranded,
                settle,
                unique=specs["event"].rules.keys == ("event_id",),
            ),
            "lm_events",
        )
    if participants is not None:
        write(
            normalize_participants(
                participants, masters.xref, masters.merges, settle if follow_merges else None
            ),
            "lm_participants",
        )
    if expenses is not None and events is not None:
        known = read_table(spark, layout.normalized("lm_events"))
        write(normalize_expenses(expenses, known), "lm_events_expenses")
    for name, stored in (("events", events), ("participants", participants), ("expenses", expenses)):
        if stored is None:
            log.warning("no landed %s: left out of the normalized tables", name)
    if expenses is not None and events is None:
        log.warning("expenses are left out: they need landed events")
    return counts


def summarize(
    spark: SparkSession,
    layout: Layout,
    run_ts: dt.datetime,
    settle: Settle,
    unique: bool = False,
) -> Counts:
    """The five marts; ``unique`` says that no event id repeats in the normalized events."""
    marts = build_marts(
        read_table(spark, layout.normalized("lm_events")),
        read_table(spark, layout.normalized("lm_participants")),
        run_ts.date().isoformat(),
        settle,
        unique,
    )
    return {
        f"summarized {name}": write_table(mart, layout.summarized(name))
        for name, mart in marts.items()
    }


def _made_of(products: DataFrame, *options: object) -> str:
    """Options and a sum over all product rows, on which the brands of stored events depend."""
    row = F.xxhash64(*[F.col(c).cast("string") for c in products.columns]).cast("decimal(38,0)")
    total = products.agg(F.sum(row).alias("total"), F.count("*").alias("n")).collect()[0]
    return "|".join(str(part) for part in (total["n"], total["total"], *options))


def keep_marts(
    spark: SparkSession,
    specs: Specs,
    masters: Masters,
    layout: Layout,
    run_ts: dt.datetime,
    settle: Settle,
    without_deleted: bool = False,
    keep_unbranded: bool = False,
    strict_masters: bool = False,
) -> Counts:
    """The five marts, from their state and what landed in this run.

    The same marts as ``normalize`` and ``summarize`` make of all rows, as long as no master key
    repeats, which would repeat normalized rows. Earlier rows are read
    only if the state does not have them all: at first, after a run without this step, after a
    rebuild, when the product master or an option changed, or if events do not have unique ids.
    """
    batch, names = run_name(run_ts), ["event", "participant"]
    if without_deleted and "event_del" in specs:
        names.append("event_del")
    if strict_masters:
        assert_unique(masters.products, ["source_product_name"])
    own = _made_of(masters.products, without_deleted, keep_unbranded)
    paths = {name: layout.landing(specs[name].table) for name in names}
    expected = {}
    for name, path in paths.items():
        rows, rebuilt = kept.rows_but(spark, path, batch)
        expected[name] = (rows, f"{own}|{rebuilt}")
    unique = specs["event"].rules.keys == ("event_id",)
    before = stored(spark, layout.mart_states, but=batch)
    anew = not unique or kept.taken(before) != expected
    parts, rows = {}, {}
    for name, path in paths.items():
        parts[name], count = kept.rows_of(spark, path, batch)
        rows[name] = (count, expected[name][1])
        if anew:
            parts[name] = landed(spark, path)
            rows[name] = (count + expected[name][0], expected[name][1])
    found = []
    if parts["event"] is not None:
        events = normalize_events(
            parts["event"], masters.products, masters.indications, keep_unbranded, settle, unique
        )
        found.append(ms.event_lines(events))
    if parts["participant"] is not None:
        found.append(ms.participant_lines(parts["participant"]))
    if parts.get("event_del") is not None:
        found.append(ms.delete_lines(parts["event_del"]))
    new = None
    for part in found:
        new = part if new is None else new.unionByName(part)
    lines = kept.update(spark, layout.mart_states, batch, new, rows, settle, anew)
    return {
        f"summarized {name}": write_table(mart, layout.summarized(name))
        for name, mart in ms.marts_of(lines, run_ts.date().isoformat()).items()
    }


def export(spark: SparkSession, layout: Layout, run_ts: dt.datetime) -> Counts:
    """The latest batch of events and participants as delimited files."""
    counts = {}
    for name in ("lm_events", "lm_participants"):
        table = read_table(spark, layout.normalized(name))
        _, rows = export_latest(table, name, layout.outbound, run_ts.date())
        counts[f"outbound {name}"] = rows
    return counts


def run(
    spark: SparkSession,
    specs: Specs,
    masters: Masters,
    layout: Layout,
    run_ts: dt.datetime,
    without_deleted: bool = False,
    keep_unbranded: bool = False,
    strict_masters: bool = False,
    kept_marts: bool = False,
    follow_merges: bool = False,
) -> Counts:
    """All steps; returns the rows each wrote. ``kept_marts`` makes the marts from their state
    and the run's own rows instead of from all normalized rows."""
    with fitted_shuffles(spark, input_bytes(spark, specs, layout)), Workspace(spark) as work:
        counts = intake(spark, specs, layout, run_ts, work.settle)
        counts |= landing(spark, specs, layout, run_ts, work.settle)
        options = (without_deleted, keep_unbranded, strict_masters)
        counts |= normalize(
            spark, specs, masters, layout, work.settle, *options, follow_merges
        )
        if {"normalized lm_events", "normalized lm_participants"} <= counts.keys():
            # landed events have unique ids if that is their key, and a lookup adds no rows
            # unless a master key repeats
            unique = strict_masters and specs["event"].rules.keys == ("event_id",)
            if kept_marts:
                counts |= keep_marts(spark, specs, masters, layout, run_ts, work.settle, *options)
            else:
                counts |= summarize(spark, layout, run_ts, work.settle, unique)
            counts |= export(spark, layout, run_ts)
        else:
            log.warning("marts and export are left out: they need events and participants")
    return counts
