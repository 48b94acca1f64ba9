"""All five marts from one shared base."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.operators import marts
from eventmart.operators.quality import Settle

MART_DIMENSIONS = ("event_date", "event_type", "brand_id", "brand_name")


def _unique(base: DataFrame) -> bool:
    """No event id repeats; marts do not count events without one."""
    events = base.where(F.col("event_id").isNotNull()).groupBy("event_id")
    return events.count().where("count > 1").isEmpty()


def build_marts(
    events: DataFrame,
    participants: DataFrame,
    run_date: str | None = None,
    settle: Settle | None = None,
    unique: bool = False,
) -> dict[str, DataFrame]:
    """Mart name to mart. ``settle`` materializes the base once for its readers, and the brand
    mart for the product mart; ``unique`` says that no event id repeats. If that is not said, the
    settled base is asked once, instead of each mart telling events from their repeats."""
    base = marts.event_attendance(events, participants, MART_DIMENSIONS)
    if settle is not None:
        base = settle(base)
        unique = unique or _unique(base)
    brands = marts.brand_performance(base, run_date, unique)
    if settle is not None:
        brands = settle(brands)
    return {
        "event_performance_kpi": marts.event_performance(base, run_date, unique),
        "product_performance_kpi": brands.drop("attendance_rate"),
        "participant_engagement_kpi": marts.participant_engagement(participants, run_date),
        "event_type_participants_kpi": marts.event_type_participants(base, run_date, unique),
        "brand_performance_kpi": brands,
    }
