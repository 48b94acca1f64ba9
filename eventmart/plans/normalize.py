"""Normalized tables: landed rows enriched with master data."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventmart import fixed_values as fv
from eventmart.functions import project_existing
from eventmart.operators.enrich import (
    keep_known,
    lookup,
    map_multivalue,
    merge_ends,
    resolve_survivor,
)
from eventmart.operators.quality import Settle


def normalize_events(
    events: DataFrame,
    products: DataFrame,
    indications: DataFrame,
    keep_unbranded: bool = False,
    settle: Settle | None = None,
    unique: bool = False,
) -> DataFrame:
    """Brand lists and indication id per event; events without a brand go, unless kept.

    The result holds no row twice. With ``unique`` events, which landed ones are, that follows
    from distinct master rows, and the wide rows need not be compared.
    """
    branded = map_multivalue(
        events,
        "event_brand",
        products,
        "source_product_name",
        {"brand_id": "brand_id", "brand_name": "brand_name"},
        {"brand_id": fv.DEFAULT_BRAND_ID, "brand_name": fv.DEFAULT_BRAND_NAME},
        fv.BRAND_SEPARATOR,
        keep_unbranded,
        settle,
    )
    indicated = lookup(
        branded,
        indications.select("source_indication_name", "indication_id").distinct(),
        "indication_name",
        "source_indication_name",
        {"indication_id": "indication_id"},
    )
    normalized = project_existing(indicated, fv.EVENT_COLUMNS)
    return normalized if unique else normalized.distinct()


def normalize_participants(
    participants: DataFrame,
    xref: DataFrame,
    merges: DataFrame,
    follow: Settle | None = None,
) -> DataFrame:
    """Own and surviving master id per participant row.

    With ``follow``, which settles the rounds, chains of merges are followed to their end; an id
    that leads into a cycle keeps itself.
    """
    if follow is not None:
        merges = merge_ends(merges, follow)
    return project_existing(
        resolve_survivor(participants, xref, merges), fv.PARTICIPANT_COLUMNS
    )


def normalize_expenses(expenses: DataFrame, events: DataFrame) -> DataFrame:
    """Expenses of known events, with the event id."""
    return keep_known(expenses, events, "event_vendor_id", ["event_id"]).select(
        *fv.EXPENSE_COLUMNS
    )
