"""Column expressions and column-list helpers shared by all operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE_NUMBERS = ("tinyint", "smallint", "int", "integer", "bigint", "long")


def _names(df: DataFrame) -> dict[str, str]:
    return {c.lower(): c for c in df.columns}


def existing(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """The wanted columns that ``df`` has, in wanted order (names compare without case)."""
    have = _names(df)
    return [c for c in wanted if c.lower() in have]


def first_existing(df: DataFrame, candidates: Iterable[str]) -> str | None:
    return next(iter(existing(df, candidates)), None)


def project_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    return df.select(*existing(df, wanted))


def require_columns(df: DataFrame, wanted: Iterable[str], what: str = "input") -> DataFrame:
    """Return ``df``, or raise naming every wanted column it lacks."""
    have = _names(df)
    missing = [c for c in wanted if c.lower() not in have]
    if missing:
        raise ValueError(f"Missing required columns in {what}: {', '.join(missing)}")
    return df


def with_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Add ``target`` as a copy of ``source`` for each pair whose target is not there yet."""
    have = _names(df)
    return df.withColumns(
        {
            target: F.col(source)
            for target, source in aliases.items()
            if target.lower() not in have and source.lower() in have
        }
    )


def tokens(column: Column, sep: str) -> Column:
    """Split a delimited text into trimmed tokens; NULL stays NULL."""
    return F.transform(F.split(column, re.escape(sep)), lambda token: F.trim(token))


def joined(items: Column, sep: str) -> Column:
    """Join an array into a delimited text, skipping NULL items."""
    return F.array_join(items.cast("array<string>"), sep)


def filled(column: Column, default: object, dtype: T.DataType) -> Column:
    return F.coalesce(column, F.lit(default).cast(dtype))


def try_typed(column: Column, dtype: str) -> Column:
    """Text as ``dtype``, NULL if it is not one.

    A failing cast to a whole number is slow, so text with a character that no whole number
    has is not cast at all.
    """
    if dtype not in WHOLE_NUMBERS:
        return column.try_cast(dtype)
    return F.when(~column.rlike(r"[^0-9+\-\x00-\x20\x7f]"), column.try_cast(dtype))


def as_timestamp(df: DataFrame, name: str) -> Column:
    """``name`` as a point in time: text is parsed (bad text is NULL), other types stay stored."""
    if isinstance(df.schema[existing(df, [name])[0]].dataType, T.StringType):
        return F.col(name).try_cast("timestamp")
    return F.col(name)


def day(df: DataFrame, name: str) -> Column:
    return as_timestamp(df, name).cast("date")


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def flag_count(condition: Column) -> Column:
    """Rows for which ``condition`` is true; NULL counts as false."""
    return F.sum(F.when(condition, 1).otherwise(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is NULL, not an error, when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
