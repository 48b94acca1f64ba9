"""Rules of the feed contract: types, value domains, conditional and group rules, deletes.

These are documented with the feeds but optional: a job runs those its feed's rules name.
Each row rule is a condition that is true for a row that breaks it, never NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart import fixed_values as fv
from eventmart.functions import existing, try_typed
from eventmart.operators.quality import Settle, split_orphans

Split = tuple[DataFrame, DataFrame]


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def _split(df: DataFrame, broken: Column) -> Split:
    return df.where(~broken), df.where(broken)


def untyped(df: DataFrame, types: Mapping[str, str] = fv.CONTRACT_TYPES) -> Column:
    """A value is set but is not of its type."""
    return _any(
        [
            F.col(c).isNotNull() & try_typed(F.col(c), types[c]).isNull()
            for c in existing(df, types)
        ]
    )


def typed(df: DataFrame, types: Mapping[str, str] = fv.CONTRACT_TYPES) -> DataFrame:
    return df.withColumns({c: try_typed(F.col(c), types[c]) for c in existing(df, types)})


def outside_domain(
    df: DataFrame, domains: Mapping[str, Sequence[str]] = fv.CONTRACT_DOMAINS
) -> Column:
    """A value is set but not listed."""
    return _any(
        [F.col(c).isNotNull() & ~F.col(c).isin(*domains[c]) for c in existing(df, domains)]
    )


def lacks_required(when: str, equals: str, needs: str) -> Column:
    """``needs`` is not set although ``when`` equals ``equals``."""
    return F.coalesce(F.col(when) == equals, F.lit(False)) & F.col(needs).isNull()


def misdated(columns: Sequence[str]) -> Column:
    """A text date is set but is no real date written year-month-day."""
    return _any(
        [
            F.col(c).isNotNull()
            & ~(F.col(c).rlike(fv.DATE_PATTERN) & F.col(c).try_cast("date").isNotNull())
            for c in columns
        ]
    )


def split_untyped(df: DataFrame, types: Mapping[str, str] = fv.CONTRACT_TYPES) -> Split:
    """Typed rows, and rows (still text) with a value that is not of its type."""
    clean, rejected = _split(df, untyped(df, types))
    return typed(clean, types), rejected


def split_domains(
    df: DataFrame, domains: Mapping[str, Sequence[str]] = fv.CONTRACT_DOMAINS
) -> Split:
    """Rows whose values are all listed or NULL, and the others."""
    return _split(df, outside_domain(df, domains))


def split_conditional(df: DataFrame, when: str, equals: str, needs: str) -> Split:
    """Rows where ``needs`` is set whenever ``when`` equals ``equals``, and the others."""
    return _split(df, lacks_required(when, equals, needs))


def split_dates(df: DataFrame, columns: Sequence[str]) -> Split:
    """Rows whose text dates are real dates written year-month-day, and the others."""
    return _split(df, misdated(columns))


def split_group_rule(
    df: DataFrame,
    group: Sequence[str],
    column: str,
    any_of: Sequence[str] = fv.REQUIRED_CATEGORIES,
) -> Split:
    """Rows of groups that have at least one row with a listed value, and the others.

    Only the keys of groups that pass are joined back, one line each.
    """
    passing = df.where(F.col(column).isin(*any_of)).select(*group)
    return split_orphans(df, group, passing, group)


def apply_deletes(
    df: DataFrame, deletes: DataFrame, keys: Sequence[str], settle: Settle | None = None
) -> DataFrame:
    """Rows whose key was not deleted."""
    gone = deletes.select(*keys).distinct()
    if settle is not None:
        gone = settle(gone)
    return df.join(gone, list(keys), "left_anti").select(*df.columns)
