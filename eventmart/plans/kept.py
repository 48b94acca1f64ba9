"""Marts kept up by each batch: the state of ``operators.mart_states`` as a stored table.

A run adds one batch of lines to the table: the state of its events, and what it changes in the
marts. It opens those buckets of earlier event lines that its own ids fall into, and the lines of
the marts, which are as many as groups; no stored event or participant row is read again.
The lines also say how many rows of each feed are in them, so a run that was left out, a rebuild
or changed master data is seen, and the state is then made anew from all rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators import mart_states as ms
from eventmart.operators.quality import Settle
from eventmart.sources import (
    Spread,
    State,
    Stored,
    commit,
    compact,
    publish,
    read_batches,
    state,
    stored,
    sweep,
    write_batch,
)

TAKEN = "taken"
SPREAD = Spread(("spot",), ("kind",), ms.fold)

# Per feed: how many rows of it are in the marts, and what else they depend on, as text.
Taken = Mapping[str, tuple[int, str]]


def taken(before: Stored | None) -> dict[str, tuple[int, str]]:
    """What the lines of a stored state were made from."""
    if before is None:
        return {}
    found = before.rows().where(F.col("kind") == TAKEN).groupBy("spot", "event_type")
    sums = found.agg(F.sum("copies").alias("rows"))
    return {r["spot"]: (r["rows"], r["event_type"]) for r in sums.collect()}  # a row per feed


def _taken_lines(spark: SparkSession, rows: Taken) -> DataFrame:
    noted = [(feed, count, on) for feed, (count, on) in rows.items()]
    df = spark.createDataFrame(noted, "feed string, rows long, made_of string")
    return ms.lines(
        df, TAKEN, spot=F.col("feed"), copies=F.col("rows"), event_type=F.col("made_of")
    )


def update(
    spark: SparkSession,
    path: str,
    batch: str,
    new: DataFrame | None,
    rows: Taken,
    settle: Settle,
    anew: bool = False,
) -> DataFrame:
    """Add the lines ``new`` of a batch, and what they change in the marts; returns all lines.

    A repeated batch replaces itself. With ``anew`` the table is this batch alone. The table
    changes by one rename, after which it has both the events and the marts, or neither.
    """
    before = None if anew else stored(spark, path, but=batch)
    out = _taken_lines(spark, rows)
    if new is not None:
        new = settle(ms.fold(new))
        events = new.where(F.col("kind") == ms.EVENT)
        old = events.limit(0)
        if before is not None:
            old = ms.touched(before.near(SPREAD.columns, events, SPREAD.columns), events)
        changes = settle(ms.mart_lines(old, events, settle))
        out = out.unionByName(new).unionByName(changes)
    written = write_batch(spark, path, batch, out, spread=SPREAD)
    if anew:
        commit(spark, path, replace(state(spark, path) or State(), batches=(written,)))
    else:
        publish(spark, path, written)
    compact(spark, path, spread=SPREAD)
    sweep(spark, path)
    return stored(spark, path).rows()


def rows_of(spark: SparkSession, path: str, batch: str) -> tuple[DataFrame | None, int]:
    """The rows that one batch added to a landing table, and how many they are."""
    now = state(spark, path)
    own = [b for b in now.batches if b.name == batch] if now is not None else []
    return read_batches(spark, path, own, merge=True), sum(b.rows or 0 for b in own)


def rows_but(spark: SparkSession, path: str, batch: str) -> tuple[int, str]:
    """How many rows the other batches have, by the manifest, and the last rebuild; -1 when a
    batch has no count there."""
    now = state(spark, path)
    if now is None:
        return 0, ""
    counts = [b.rows for b in now.but(batch).batches]
    return -1 if None in counts else sum(counts), str(now.rebuilt.get("batch", ""))
