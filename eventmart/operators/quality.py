"""Row checks that split a table into clean and rejected rows.

Each check is a *tag*: it adds one column that says what is wrong with a row, so both halves
come from one pass and no row can be in both or in neither.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart import fixed_values as fv

Settle = Callable[[DataFrame], DataFrame]
Split = tuple[DataFrame, DataFrame | None]

# One check against another table: columns here, that table, columns there.
LinkTo = tuple[Sequence[str], DataFrame, Sequence[str]]


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Join condition that treats NULL as equal to NULL."""
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def _repeated_keys(df: DataFrame, keys: Sequence[str], modified: str) -> DataFrame:
    """Keys with more than one row: their newest ``modified``, and whether one row alone has it.

    One aggregation by key, which starts in the map tasks, so a key with a third of all rows
    costs one line per task. Rows are numbered for it: if the newest row of highest number is
    also the one of lowest number, it is alone.
    """
    numbered = df.select(*keys, modified, F.monotonically_increasing_id().alias("_up"))
    numbered = numbered.withColumn("_down", -F.col("_up"))
    per_key = numbered.groupBy(*keys).agg(
        F.count("*").alias("_rows"),
        F.max(F.struct(F.col(modified).alias("at"), F.col("_up").alias("row"))).alias("_last"),
        F.max(F.struct(F.col(modified).alias("at"), F.col("_down").alias("row"))).alias("_first"),
    )
    return per_key.where("_rows > 1").select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.col("_last.at").alias("_newest"),
        (F.col("_last.row") == -F.col("_first.row")).alias("_alone"),
    )


def tag_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    modified: str = fv.MODIFIED,
    settle: Settle | None = None,
) -> DataFrame:
    """Add ``is_duplicate``: false only for the single newest row of each key.

    Per key (NULL keys form one group) a unique newest row is clean and all older rows are
    duplicates; when several rows tie for newest, all rows of the key are duplicates. NULL
    times are the oldest. This equals counting rows, peers included, from the newest down.

    ``settle`` materializes the repeated keys. They are few in a healthy feed; once their
    size is known, the planner can send them to the rows instead of shuffling the rows.
    """
    repeated = _repeated_keys(df, keys, modified)
    if settle is not None:
        repeated = settle(repeated)
    marks = [f"_key{i}" for i in range(len(keys))]
    newest = F.col("_alone") & F.col("_newest").eqNullSafe(F.col(modified))
    repeats = F.col("_alone").isNotNull()  # the key has a line among the repeated
    return df.join(repeated, _same(keys, marks), "left").select(
        *[F.col(c) for c in df.columns],
        (repeats & ~newest).alias(fv.DUPLICATE_FLAG),
    )


def split_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    modified: str = fv.MODIFIED,
    settle: Settle | None = None,
) -> Split:
    """Clean rows, and duplicates (which keep the ``is_duplicate`` column)."""
    if not keys:
        return df, None
    tagged = tag_duplicates(df, keys, modified, settle)
    flag = F.col(fv.DUPLICATE_FLAG)
    return tagged.where(~flag).drop(fv.DUPLICATE_FLAG), tagged.where(flag)


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def split_nulls(df: DataFrame, columns: Sequence[str]) -> Split:
    """Clean rows, and rows with NULL in any of ``columns``."""
    if not columns:
        return df, None
    return df.where(~any_null(columns)), df.where(any_null(columns))


def tag_links(
    df: DataFrame, links: Sequence[LinkTo], flag: str = "is_unlinked"
) -> DataFrame:
    """Add ``flag``: true when a row lacks its counterpart in any of the linked tables.

    The other side is cut to its distinct keys before the join, so neither its width nor a
    repeated key reaches the join, and no row of ``df`` is multiplied. NULL never matches.
    """
    out = df
    found = []
    for i, (columns, other, other_columns) in enumerate(links):
        marks = [f"_link{i}_{j}" for j in range(len(columns))]
        keys = (
            other.select(*[F.col(c).alias(m) for c, m in zip(other_columns, marks)])
            .dropna()
            .distinct()
            .withColumn(f"_found{i}", F.lit(True))
        )
        on = reduce(and_, [F.col(c) == F.col(m) for c, m in zip(columns, marks)])
        out = out.join(keys, on, "left")
        found.append(F.col(f"_found{i}").isNotNull())
    return out.select(*[F.col(c) for c in df.columns], (~reduce(and_, found)).alias(flag))


def _split_links(df: DataFrame, links: Sequence[LinkTo]) -> tuple[DataFrame, DataFrame]:
    tagged = tag_links(df, links)
    return (
        tagged.where(~F.col("is_unlinked")).drop("is_unlinked"),
        tagged.where("is_unlinked").drop("is_unlinked"),
    )


def split_incomplete_parents(
    df: DataFrame,
    key: Sequence[str],
    children: Sequence[tuple[DataFrame, Sequence[str]]],
    unique: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Rows found in every child table, and (each once) rows missing from at least one.

    With ``unique`` keys no row can repeat, and the wide rows need not be compared.
    """
    clean, rejected = _split_links(df, [(key, child, cols) for child, cols in children])
    return clean, rejected if unique else rejected.distinct()


def split_orphans(
    df: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows whose parent exists, and rows whose parent does not."""
    return _split_links(df, [(columns, parent, parent_columns)])


def gate(
    df: DataFrame,
    keys: Sequence[str],
    required: Sequence[str],
    links: Sequence[LinkTo] = (),
    link_reason: str = fv.REASON_MISSING_PARENT,
    modified: str = fv.MODIFIED,
    settle: Settle | None = None,
    more: Sequence[tuple[str, Column]] = (),
) -> DataFrame:
    """Run the checks in their fixed order (duplicates, NULLs, links) as one tag.

    ``more`` are further reasons with the condition of a bad row, checked before the links.
    ``error_reason`` names the first check a row fails and is NULL for clean rows.
    """
    if keys:
        out = tag_duplicates(df, keys, modified, settle)
    else:
        out = df.withColumn(fv.DUPLICATE_FLAG, F.lit(False))
    unlinked = F.lit(False)
    if links:
        out, unlinked = tag_links(out, links, "_unlinked"), F.col("_unlinked")
    null = any_null(required) if required else F.lit(False)
    reason = F.when(F.col(fv.DUPLICATE_FLAG), fv.REASON_DUPLICATE).when(null, fv.REASON_NULL)
    for text, bad in more:
        reason = reason.when(bad, text)
    reason = reason.when(unlinked, link_reason)
    return out.withColumn(fv.ERROR_REASON, reason).drop("_unlinked")


def clean_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(fv.ERROR_REASON).isNull()).drop(
        fv.DUPLICATE_FLAG, fv.ERROR_REASON
    )


def rejected_rows(tagged: DataFrame) -> DataFrame:
    """Rejects with their reason; ``is_duplicate`` is set for duplicates only."""
    flag = F.col(fv.DUPLICATE_FLAG)
    return tagged.where(F.col(fv.ERROR_REASON).isNotNull()).withColumn(
        fv.DUPLICATE_FLAG, F.when(flag, flag)
    )


def quarantined(df: DataFrame, reason: str | Column, at: Column) -> DataFrame:
    """Add why and when rows were set aside."""
    text = F.lit(reason) if isinstance(reason, str) else reason
    return df.withColumns({fv.ERROR_REASON: text, fv.ERROR_TIME: at})
