"""Incremental merge of a feed into what is already stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart import fixed_values as fv
from eventmart.operators.quality import Settle


def stamp(df: DataFrame, at: Column) -> DataFrame:
    """Creation and modification time of every feed row: the time of the batch."""
    return df.withColumns({fv.CREATED: at, fv.MODIFIED: at})


def stamp_load(df: DataFrame, on: Column) -> DataFrame:
    return df.withColumn(fv.LOADED, on)


def keys_in(
    stored: DataFrame, columns: Sequence[str], df: DataFrame, df_columns: Sequence[str]
) -> DataFrame:
    """The ``columns`` of ``stored`` that occur as ``df_columns`` in ``df``.

    Stored keys, which may be all days before, are first filtered to those of ``df``, such as
    one day's feed; so no later step handles all stored keys. They may repeat: what they are
    used for, semi- and anti-joins, does not count them.
    """
    keys = stored.select(*columns)
    wanted = df.select(*[F.col(d).alias(c) for d, c in zip(df_columns, columns)]).distinct()
    return keys.join(wanted, list(columns), "left_semi")


def new_only(
    feed: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    settle: Settle | None = None,
    feed_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Feed rows whose key is not in the snapshot: the snapshot wins over an update.

    A NULL in the key matches nothing, so such rows always count as new. ``settle``
    materializes the known keys, so that several uses of the result scan the snapshot once.
    ``feed_keys`` names the feed's columns to compare, if they have other names.
    """
    own = list(feed_keys or keys)
    known = keys_in(snapshot, keys, feed, own)
    known = known.select(*[F.col(k).alias(c) for k, c in zip(keys, own)])
    if settle is not None:
        known = settle(known)
    return feed.join(known, own, "left_anti").select(*feed.columns)


def merge_snapshot(
    feed: DataFrame, snapshot: DataFrame | None, keys: Sequence[str]
) -> DataFrame:
    """New feed rows and all snapshot rows; a column one side lacks is NULL there."""
    if snapshot is None:
        return feed
    return new_only(feed, snapshot, keys).unionByName(snapshot, allowMissingColumns=True)
