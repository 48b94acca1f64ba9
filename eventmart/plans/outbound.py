"""Delimited export of the latest batch of a table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from eventmart.operators.latest import latest_batch
from eventmart.sources import export_name, write_delimited


def export_latest(df: DataFrame, table: str, folder: str, on: dt.date) -> tuple[str, int]:
    """Write the latest batch; returns the folder written and its row count."""
    path = f"{folder.rstrip('/')}/{export_name(table, on)}"
    return path, write_delimited(latest_batch(df), path)
