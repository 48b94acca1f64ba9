"""Rows of the latest batch of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart import fixed_values as fv
from eventmart.functions import as_timestamp, first_existing


def latest_batch(
    df: DataFrame, candidates: Sequence[str] = fv.EXPORT_MODIFIED_COLUMNS
) -> DataFrame:
    """Rows whose modification time is the greatest of the table; all rows if it has none.

    The first candidate column that exists is used. The greatest time is a scalar subquery:
    one job, and the value reaches the scan as a pushed filter. NULL times are left out.
    """
    column = first_existing(df, candidates)
    if column is None:
        return df
    at = as_timestamp(df, column)
    newest = df.agg(F.max(at).alias("newest"))
    return df.where(at == newest.scalar())
