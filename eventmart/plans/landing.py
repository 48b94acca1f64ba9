"""Landing: merge a feed into its table behind the row checks.

A landing table is a list of batches, one per run (``eventmart.sources.batches``). A run adds its
own batch, so it never overwrites what it reads, a repeated run replaces its own batch, and stored
rows are not rewritten to add new ones: they passed the same checks when they came in, and new rows
cannot repeat their keys. What is stored is found by its keys, which lie in buckets of their own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import fixed_values as fv
from eventmart.functions import try_typed, with_aliases
from eventmart.operators.contracts import lacks_required, misdated, outside_domain, typed, untyped
from eventmart.operators.merge import (
    keys_in,
    new_only,
    stamp,
    stamp_load,
)
from eventmart.operators.quality import (
    Settle,
    clean_rows,
    gate,
    rejected_rows,
    tag_links,
)
from eventmart.sources import (
    BATCH,
    Stored,
    compact,
    publish,
    state,
    stored,
    sweep,
    write_batch,
    write_table,
)
from eventmart.sources.batches import commit, names_in
from eventmart.specs import FeedRules, Link

# What is known of a feed's stored rows: the rows, or the table whose keys are in buckets.
Snapshot = DataFrame | Stored | None


def landed(
    spark: SparkSession, path: str, but: str | None = None, merge: bool = True
) -> DataFrame | None:
    """All stored rows, or those of the other batches than ``but``; ``None`` on first load.

    Without ``merge``, columns that only some batches have may be missing; keys never are.
    """
    if state(spark, path) is None:
        return None
    table = stored(spark, path, but)
    if table is not None:
        return table.rows(merge)
    whole = stored(spark, path)
    return whole.rows(merge).where(F.lit(False)) if whole is not None else None


def indexed(name: str, rules: Mapping[str, FeedRules]) -> list[tuple[str, ...]]:
    """The sets of columns by which rows of a feed are looked up: its keys, and what the links
    of other feeds name."""
    sets = [tuple(rules[name].keys)] if rules[name].keys else []
    sets += [
        tuple(link.other_columns)
        for other in rules.values()
        for link in other.links
        if link.feed_type == name
    ]
    return list(dict.fromkeys(sets))


def compared(rules: FeedRules, column: str) -> str:
    """The column that comparisons use in the place of ``column``."""
    return f"_typed_{column}" if column in rules.types else column


def _comparable(rows: DataFrame, rules: FeedRules) -> DataFrame:
    """Add what a feed's typed key and link columns are compared by: the value as its type
    writes it, so that ``7`` and ``007`` are one; NULL if it is not of its type."""
    used = dict.fromkeys([*rules.keys, *(c for link in rules.links for c in link.columns)])
    return rows.withColumns(
        {
            compared(rules, c): try_typed(F.col(c), rules.types[c]).cast("string")
            for c in used
            if c in rules.types
        }
    )


def _plain(rows: DataFrame, rules: FeedRules) -> DataFrame:
    return rows.drop(*[compared(rules, c) for c in rules.types])


def _stored(snapshot: DataFrame, rules: FeedRules) -> DataFrame:
    """Stored rows with their typed columns as text, the way ``_comparable`` writes them."""
    return snapshot.withColumns(
        {c: F.col(c).cast("string") for c in rules.types if c in snapshot.columns}
    )


def _rows_of(snapshot: Snapshot) -> DataFrame | None:
    return snapshot.rows() if isinstance(snapshot, Stored) else snapshot


def _keys_of(
    snapshot: DataFrame | Stored,
    rules: FeedRules,
    columns: Sequence[str],
    df: DataFrame,
    own: Sequence[str],
) -> DataFrame:
    """``columns`` of the stored rows that may occur as ``own`` in ``df``; typed ones as text."""
    if isinstance(snapshot, Stored):
        return snapshot.keys(columns, df, own)
    return _stored(snapshot, rules).select(*columns)


def fresh_rows(
    feed: DataFrame,
    snapshot: Snapshot,
    rules: FeedRules,
    run_ts: dt.datetime,
    settle: Settle | None = None,
    pending: DataFrame | None = None,
) -> DataFrame:
    """Feed rows under their table names, stamped, without those whose key is stored.

    ``pending`` are rows that earlier runs set aside for a missing link; they are offered again
    unless the feed brings their key.
    """
    rows = _comparable(with_aliases(feed, rules.aliases), rules)
    keys = [compared(rules, k) for k in rules.keys]
    if pending is not None:
        again = _comparable(pending, rules)
        if rules.keys:
            again = again.join(rows.select(*keys).distinct(), keys, "left_anti")
        rows = rows.unionByName(again, allowMissingColumns=True)
    rows = stamp(rows, F.lit(run_ts))
    if snapshot is not None and rules.keys:
        known = _keys_of(snapshot, rules, rules.keys, rows, keys)
        rows = new_only(rows, known, rules.keys, settle, keys)
    return _plain(rows, rules)


# Parts of the quarantine: what a run rejected, what a rebuild rejected, and malformed lines.
ROWS, REBUILT, LINES = "rows", "rebuilt", "lines"
_KIND = "reject_kind="


def set_aside(
    spark: SparkSession, error_path: str, rules: FeedRules, batch: str
) -> DataFrame | None:
    """Rows that wait for a missing link when the run ``batch`` begins.

    Each run offers all of them again, so the last run before has all that still waited then;
    rebuilds since may have added rows whose link they rejected. Only these parts are read.
    """
    if not rules.links:
        return None
    runs = [n for n in names_in(spark, error_path) if n.startswith(f"{BATCH}=")]
    runs = [n for n in runs if n.removeprefix(f"{BATCH}=") < batch]
    parts = []
    for name in reversed(runs):
        found = names_in(spark, f"{error_path}/{name}")
        parts += [f"{error_path}/{name}/{k}" for k in (_KIND + ROWS, _KIND + REBUILT) if k in found]
        if _KIND + ROWS in found:
            break
    if not parts:
        return None
    rows = spark.read.option("mergeSchema", True).option("basePath", error_path).parquet(*parts)
    rows = rows.where(F.col(fv.ERROR_REASON) == rules.link_reason)
    own = (BATCH, "reject_kind", fv.ERROR_REASON, fv.ERROR_TIME, fv.DUPLICATE_FLAG)
    return rows.drop(*own, "malformed_line")


def tidy(spark: SparkSession, table_path: str, index: Sequence[Sequence[str]] = ()) -> None:
    """Merge small batches and delete what the table no longer names, when nothing reads it."""
    compact(spark, table_path, index)
    sweep(spark, table_path)


REASON_TYPE = "Value is not of its type"
REASON_DOMAIN = "Value is not listed"
REASON_DATE = "Date is not valid"
REASON_GROUP = "Group lacks a required value"


def contract_checks(df: DataFrame, rules: FeedRules) -> list[tuple[str, Column]]:
    """Reasons and conditions of the contract rules that ``rules`` name."""
    checks = [
        (f"Missing {needs} where {when} is {equals}", lacks_required(when, equals, needs))
        for when, equals, needs in rules.conditional
    ]
    if rules.domains:
        checks.append((REASON_DOMAIN, outside_domain(df, rules.domains)))
    if rules.dates:
        checks.append((REASON_DATE, misdated(rules.dates)))
    if rules.types:
        checks.append((REASON_TYPE, untyped(df, rules.types)))
    return checks


def needed(rules: FeedRules) -> list[str]:
    """Columns a landed row must have: a row without its whole key could never be matched."""
    return list(dict.fromkeys([*rules.keys, *rules.required]))


def _checked(rows: DataFrame, rules: FeedRules, settle: Settle) -> DataFrame:
    """Rows with the checks that need no other feed; typed keys are compared as their type.

    A key that is not of its type equals no other: such rows are rejected for that, and do not
    count as duplicates of each other.
    """
    rows = _comparable(rows, rules)
    bad_key = F.lit(False)
    for key in rules.keys:
        if key in rules.types:
            bad_key = bad_key | (F.col(key).isNotNull() & F.col(compared(rules, key)).isNull())
    tagged = gate(
        rows.where(~bad_key),
        [compared(rules, k) for k in rules.keys],
        needed(rules),
        modified=rules.modified,
        settle=settle,
        more=contract_checks(rows, rules),
    )
    if set(rules.keys) & set(rules.types):
        reason = {fv.DUPLICATE_FLAG: F.lit(False), fv.ERROR_REASON: F.lit(REASON_TYPE)}
        tagged = tagged.unionByName(rows.where(bad_key).withColumns(reason))
    return settle(tagged)


def _group_checked(
    tagged: DataFrame, snapshot: Snapshot, rules: FeedRules, settle: Settle
) -> DataFrame:
    """Reject clean rows of groups in which no clean or stored row has a wanted value."""
    if rules.group is None:
        return tagged
    group, column, any_of = rules.group
    parts = [clean_rows(tagged).select(*group, column)]
    if snapshot is not None:
        parts.append(_stored(_rows_of(snapshot), rules).select(*group, column))
    passing = reduce(DataFrame.unionByName, parts).where(F.col(column).isin(*any_of))
    found = tag_links(tagged, [(group, passing.select(*group), group)], "_lacking")
    reason = F.coalesce(fv.ERROR_REASON, F.when(F.col("_lacking"), REASON_GROUP))
    return settle(found.withColumn(fv.ERROR_REASON, reason).drop("_lacking"))


def gate_feeds(
    fresh: Mapping[str, DataFrame],
    snapshots: Mapping[str, Snapshot],
    rules: Mapping[str, FeedRules],
    settle: Settle,
) -> dict[str, DataFrame]:
    """Tag the new rows of several feeds that refer to each other.

    Feeds may need each other both ways. Parents go first: they are checked against each other
    feed's stored rows and those new rows that passed the checks of their own. Then the others
    are checked against stored and *surviving* new parents, so no child lands without its
    parent; and since a child of a survivor has its parent, no survivor loses its children.
    """
    checked = {
        name: _group_checked(
            _checked(rows, rules[name], settle), snapshots.get(name), rules[name], settle
        )
        for name, rows in fresh.items()
    }

    def present(link: Link, rows: DataFrame, own: list[str]) -> DataFrame:
        """The keys of the linked feed, of its stored rows only those that ``rows`` need."""
        name, columns = link.feed_type, link.other_columns
        parts = []
        if name in checked:
            known = _comparable(clean_rows(checked[name]), _linked(rules[name], columns))
            parts.append(
                known.select(*[F.col(compared(rules[name], c)).alias(c) for c in columns])
            )
        if snapshots.get(name) is not None:
            known = _keys_of(snapshots[name], rules.get(name, FeedRules()), columns, rows, own)
            parts.append(keys_in(known, columns, rows, own))
        if not parts:
            # Nothing of that feed was ever stored: no row can be linked to it.
            nothing = rows.where(F.lit(False))
            parts = [nothing.select(*[F.col(a).alias(b) for a, b in zip(own, columns)])]
        return reduce(DataFrame.unionByName, parts)

    for name in sorted(checked, key=lambda n: not rules[n].parent):
        tagged, links = checked[name], []
        for link in rules[name].links:
            own = [compared(rules[name], c) for c in link.columns]
            links.append((own, present(link, tagged, own), link.other_columns))
        if links:
            linked = tag_links(tagged, links, "_unlinked")
            reason = F.coalesce(
                fv.ERROR_REASON, F.when(F.col("_unlinked"), rules[name].link_reason)
            )
            checked[name] = settle(
                linked.withColumn(fv.ERROR_REASON, reason).drop("_unlinked")
            )
    return {name: _plain(tagged, rules[name]) for name, tagged in checked.items()}


def _linked(rules: FeedRules, columns: Sequence[str]) -> FeedRules:
    """The rules with ``columns`` among those that are compared by type."""
    return replace(rules, keys=tuple(dict.fromkeys([*rules.keys, *columns])))


def land(
    tagged: DataFrame,
    table_path: str,
    error_path: str,
    batch: str,
    run_ts: dt.datetime,
    types: Mapping[str, str] | None = None,
    index: Sequence[Sequence[str]] = (),
) -> tuple[int, int]:
    """Write clean rows as a batch of the table and rejects as a batch of the quarantine.

    Clean rows get their ``types``; rejects stay as they came. The batch becomes part of the
    table, with the keys of the columns that ``index`` names, when all else is written.
    """
    spark = tagged.sparkSession
    clean = stamp_load(typed(clean_rows(tagged), types or {}), F.lit(run_ts.date()))
    written = write_batch(spark, table_path, batch, clean, index)
    rejected = quarantine(rejected_rows(tagged), error_path, batch, run_ts)
    publish(spark, table_path, written)
    return written.rows, rejected


def quarantine(
    rejects: DataFrame, path: str, batch: str, run_ts: dt.datetime, part: str = ROWS
) -> int:
    """Write rejects, which carry their reason, as one part of the quarantine."""
    rows = rejects.withColumn(fv.ERROR_TIME, F.lit(run_ts))
    return write_table(rows, f"{path}/{BATCH}={batch}/reject_kind={part}")


def rebuild(
    feed: DataFrame,
    snapshot: DataFrame | None,
    rules: FeedRules,
    run_ts: dt.datetime,
    links=(),
    settle: Settle | None = None,
) -> DataFrame:
    """Tag the whole table, stored and new rows together, for a rewrite as one table.

    Needed when the rules changed since the rows were stored. All rows are text, as a feed's
    are; ``typed`` gives the clean ones their types again.
    """
    rows = fresh_rows(feed, snapshot, rules, run_ts, settle)
    if snapshot is not None:
        rows = rows.unionByName(_stored(snapshot, rules), allowMissingColumns=True)
    rows = _comparable(rows, rules)
    tagged = gate(
        rows,
        [compared(rules, k) for k in rules.keys],
        needed(rules),
        links,
        rules.link_reason,
        rules.modified,
        settle,
        contract_checks(rows, rules),
    )
    return _plain(tagged, rules)


@dataclass(frozen=True)
class Place:
    """Where a feed lies, and the rules it has to meet."""

    table: str
    errors: str
    rules: FeedRules


def rebuild_tables(
    spark: SparkSession,
    places: Mapping[str, Place],
    batch: str,
    run_ts: dt.datetime,
    settle: Settle,
) -> dict[str, tuple[int, int]]:
    """Gate all stored rows of several feeds anew, links included, and write each table as one
    batch; returns the rows that each keeps and rejects.

    New tables and rejects are written beside the old ones. Then each table is switched by one
    manifest, which also notes the run, and old folders go last. So a run that ends anywhere can
    be repeated: tables that it has switched already are left alone, and give the same links.
    """
    rules = {name: place.rules for name, place in places.items()}
    now = {name: state(spark, place.table) for name, place in places.items()}
    done = {
        name: (found.rebuilt["rows"], found.rebuilt["rejected"])
        for name, found in now.items()
        if found is not None and found.rebuilt.get("batch") == batch
    }
    rows = {
        name: stored(spark, place.table).rows(merge=True)
        for name, place in places.items()
        if now[name] is not None and now[name].batches
    }
    fresh = {name: _stored(df, rules[name]) for name, df in rows.items()}
    if set(fresh) - set(done):
        tagged = gate_feeds(fresh, {}, rules, settle)
    counts = {name: (0, 0) for name in places} | done
    written = {}
    for name in fresh:
        if name in done:
            continue
        place, result = places[name], settle(tagged[name])
        clean = typed(clean_rows(result), rules[name].types)
        written[name] = write_batch(spark, place.table, batch, clean, indexed(name, rules))
        rejected = quarantine(rejected_rows(result), place.errors, batch, run_ts, REBUILT)
        counts[name] = (written[name].rows, rejected)
    for name, new in written.items():
        kept, rejected = counts[name]
        noted = {"batch": batch, "rows": kept, "rejected": rejected}
        before = state(spark, places[name].table)
        after = replace(before, batches=(new,), rebuilt=noted)
        commit(spark, places[name].table, after)
    for name in fresh:
        sweep(spark, places[name].table)
    return counts


def rebuild_table(
    spark: SparkSession,
    table_path: str,
    error_path: str,
    rules: FeedRules,
    batch: str,
    run_ts: dt.datetime,
    settle: Settle,
) -> tuple[int, int]:
    """``rebuild_tables`` for one feed, without the links that need others."""
    place = Place(table_path, error_path, replace(rules, links=()))
    return rebuild_tables(spark, {"feed": place}, batch, run_ts, settle)["feed"]
