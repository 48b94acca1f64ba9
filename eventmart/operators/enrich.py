"""Lookups against master data.

No join here is forced to broadcast: the planner compares each side's size, from file
sizes when planning and from shuffle sizes while running, with the broadcast limit, and
falls back to a sort-merge join whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart import fixed_values as fv
from eventmart.functions import filled, joined, tokens
from eventmart.operators.quality import Settle


def assert_unique(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``dim``, or raise when a key repeats (a repeat would multiply joined rows)."""
    repeated = dim.groupBy(*keys).count().where("count > 1")
    sample = repeated.limit(5).collect()
    if sample:
        shown = ", ".join(str(tuple(r)[:-1]) for r in sample)
        raise ValueError(f"Master data has repeated keys on {list(keys)}: {shown}")
    return dim


def lookup(
    df: DataFrame,
    dim: DataFrame,
    column: str,
    dim_key: str,
    outputs: Mapping[str, str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Left join on one column, adding ``outputs`` (new name -> column of ``dim``).

    ``defaults`` fills new columns that found no value.
    """
    defaults = defaults or {}
    side = dim.select(
        F.col(dim_key).alias("_lookup_key"),
        *[F.col(source).alias(f"_out_{name}") for name, source in outputs.items()],
    )
    new = {
        name: (
            filled(F.col(f"_out_{name}"), defaults[name], side.schema[f"_out_{name}"].dataType)
            if name in defaults
            else F.col(f"_out_{name}")
        )
        for name in outputs
    }
    kept = [F.col(c) for c in df.columns if c not in outputs]
    return df.join(side, F.col(column) == F.col("_lookup_key"), "left").select(
        *kept, *[c.alias(name) for name, c in new.items()]
    )


def explode_tokens(
    df: DataFrame,
    column: str,
    sep: str = fv.BRAND_SEPARATOR,
    token: str = "token",
    pos: str = "pos",
    keep_null: bool = False,
) -> DataFrame:
    """One row per trimmed token with its position; rows with NULL go, unless kept."""
    explode = F.posexplode_outer if keep_null else F.posexplode
    return df.select("*", explode(tokens(F.col(column), sep)).alias(pos, token))


def list_by_key(
    df: DataFrame, keys: Sequence[str], pos: str, columns: Sequence[str], sep: str
) -> DataFrame:
    """Fold exploded rows back: per key one delimited list per column, ordered by ``pos``."""
    parts = F.array_sort(F.collect_list(F.struct(pos, *columns)))
    folded = df.groupBy(*keys).agg(parts.alias("_parts"))
    return folded.select(
        *keys, *[joined(F.col(f"_parts.{c}"), sep).alias(c) for c in columns]
    )


def map_multivalue(
    df: DataFrame,
    column: str,
    dim: DataFrame,
    dim_key: str,
    outputs: Mapping[str, str],
    defaults: Mapping[str, object],
    sep: str = fv.BRAND_SEPARATOR,
    keep_null: bool = False,
    settle: Settle | None = None,
) -> DataFrame:
    """Map each token of a delimited column through ``dim`` into aligned delimited lists.

    ``column`` becomes its trimmed tokens; ``outputs`` hold the mapped values in token order,
    with ``defaults`` for unknown tokens. Repeated tokens stay. Rows whose ``column`` is NULL
    are dropped, or kept with the defaults when ``keep_null``.

    The result depends on the text alone, so the explode, lookup and fold run on distinct
    texts (deduplicated before their shuffle) and no row of ``df`` is exploded; a group in
    the fold is the tokens of one text.
    """
    texts = df.select(F.col(column).alias("_text")).dropna().distinct()
    exploded = explode_tokens(texts, "_text", sep, "_token", "_pos")
    mapped = lookup(exploded, dim, "_token", dim_key, outputs, defaults)
    lists = list_by_key(mapped, ["_text"], "_pos", ["_token", *outputs], sep)
    lists = lists.select(
        F.col("_text"),
        F.col("_token").alias("_tokens"),
        *[F.col(name).alias(f"_list_{name}") for name in outputs],
    )
    if settle is not None:
        lists = settle(lists)
    how = "left" if keep_null else "inner"
    new = {
        name: (
            F.coalesce(F.col(f"_list_{name}"), F.lit(str(defaults[name])))
            if keep_null
            else F.col(f"_list_{name}")
        ).alias(name)
        for name in outputs
    }
    kept = [
        F.col("_tokens").alias(c) if c == column else F.col(c)
        for c in df.columns
        if c not in outputs
    ]
    return df.join(lists, F.col(column) == F.col("_text"), how).select(*kept, *new.values())


def merge_ends(merges: DataFrame, settle: Settle) -> DataFrame:
    """Each loser once, with the winner at the end of its chain of merges.

    ``loser_mdm_id, winner_mdm_id, hops, in_cycle``. Every round joins a loser's winner with that
    one's own winner, so chains are followed twice as far each time, and the rounds are the
    logarithm of the longest. A chain holds the shorter ones that begin further on, so once a
    round ends none, those still at a loser are in a cycle or lead into one: they have no winner,
    and are ``in_cycle``. Of several winners of one loser the least counts; NULL ids are no
    merges. ``settle`` ends the lineage of a round.

    Both sides of a round's join are as long as ``merges``, and their files, being ids in order,
    are much smaller than their rows; so the join is by sorting, and no round sends them all to
    the driver.
    """
    first = merges.select("loser_mdm_id", "winner_mdm_id").dropna()
    first = first.groupBy("loser_mdm_id").agg(F.min("winner_mdm_id").alias("at"))
    steps = settle(first.select("loser_mdm_id", "at", F.lit(1).cast("long").alias("hops")))
    before = steps.count()
    while True:
        onward = steps.select(
            F.col("loser_mdm_id").alias("_id"), F.col("at").alias("_at"), F.col("hops").alias("_hops")
        )
        steps = settle(
            steps.join(onward.hint("merge"), F.col("at") == F.col("_id"), "left").select(
                "loser_mdm_id",
                F.coalesce("_at", "at").alias("at"),
                (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"),
                F.col("_id").isNotNull().alias("moving"),
            )
        )
        moving = steps.where("moving").count()
        if moving in (0, before):
            break
        before = moving
    ended = ~F.col("moving")
    return steps.select(
        "loser_mdm_id",
        F.when(ended, F.col("at")).alias("winner_mdm_id"),
        F.when(ended, F.col("hops")).alias("hops"),
        F.col("moving").alias("in_cycle"),
    )


def survivor_xref(xref: DataFrame, merges: DataFrame) -> DataFrame:
    """``source_id, mdm_id, final_mdm_id``: own master id, and the one that survived a merge.

    One hop only: a winner that later lost again is followed if ``merges`` are ``merge_ends``.
    """
    merged = lookup(
        xref.select("source_id", "mdm_id"),
        merges,
        "mdm_id",
        "loser_mdm_id",
        {"_winner": "winner_mdm_id"},
    )
    return merged.select(
        "source_id", "mdm_id", F.coalesce("_winner", "mdm_id").alias("final_mdm_id")
    )


def resolve_survivor(
    df: DataFrame, xref: DataFrame, merges: DataFrame, source: str = "participant_id"
) -> DataFrame:
    """Add ``mdm_id`` and ``final_mdm_id`` to each row, NULL when its id is unknown.

    The two master tables are joined first, so the large side is joined once, on its own
    well-spread id, and rows without a master id never meet on one NULL key.
    """
    return lookup(
        df,
        survivor_xref(xref, merges),
        source,
        "source_id",
        {"mdm_id": "mdm_id", "final_mdm_id": "final_mdm_id"},
    )


def keep_known(
    df: DataFrame, known: DataFrame, on: str, add: Sequence[str] = ()
) -> DataFrame:
    """Rows whose ``on`` value occurs in ``known``, with ``add`` columns taken from there."""
    return df.join(known.select(on, *add), on, "inner")
