from eventmart.functions.columns import (
    as_timestamp,
    day,
    day_text,
    existing,
    filled,
    first_existing,
    flag_count,
    joined,
    project_existing,
    ratio,
    require_columns,
    tokens,
    try_typed,
    with_aliases,
)

__all__ = [
    "as_timestamp",
    "day",
    "day_text",
    "existing",
    "filled",
    "first_existing",
    "flag_count",
    "joined",
    "project_existing",
    "ratio",
    "require_columns",
    "tokens",
    "try_typed",
    "with_aliases",
]
