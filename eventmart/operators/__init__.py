from eventmart.operators.enrich import (
    assert_unique,
    explode_tokens,
    keep_known,
    list_by_key,
    lookup,
    map_multivalue,
    merge_ends,
    resolve_survivor,
    survivor_xref,
)
from eventmart.operators.latest import latest_batch
from eventmart.operators.mart_states import (
    delete_lines,
    event_lines,
    fold,
    mart_lines,
    marts_of,
    participant_lines,
    touched,
)
from eventmart.operators.marts import (
    attendance_by_event,
    brand_performance,
    engagement_counts,
    engagement_of,
    event_attendance,
    event_performance,
    event_type_participants,
    participant_engagement,
    product_performance,
)
from eventmart.operators.merge import keys_in, merge_snapshot, new_only, stamp, stamp_load
from eventmart.operators.quality import (
    clean_rows,
    gate,
    quarantined,
    rejected_rows,
    split_duplicates,
    split_incomplete_parents,
    split_nulls,
    split_orphans,
    tag_duplicates,
    tag_links,
)

__all__ = [
    "assert_unique",
    "attendance_by_event",
    "brand_performance",
    "clean_rows",
    "delete_lines",
    "engagement_counts",
    "engagement_of",
    "event_attendance",
    "event_lines",
    "event_performance",
    "event_type_participants",
    "explode_tokens",
    "fold",
    "gate",
    "keep_known",
    "keys_in",
    "latest_batch",
    "list_by_key",
    "lookup",
    "map_multivalue",
    "mart_lines",
    "marts_of",
    "merge_ends",
    "merge_snapshot",
    "new_only",
    "participant_engagement",
    "participant_lines",
    "product_performance",
    "quarantined",
    "rejected_rows",
    "resolve_survivor",
    "split_duplicates",
    "split_incomplete_parents",
    "split_nulls",
    "split_orphans",
    "stamp",
    "stamp_load",
    "survivor_xref",
    "tag_duplicates",
    "tag_links",
    "touched",
]
