"""Every operator on the shared test tables, each next to the SQL that must give the same."""

from checks import (  # noqa: F401
    contracts,
    enrich,
    files,
    intake,
    kept,
    landing,
    marts,
    merge,
    quality,
    scans,
)
from checks.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
