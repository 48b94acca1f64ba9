"""The registered queries, one per operator, and the SQL that gives the same where SQL can."""

from eventmart.llm import (
    block_search,
    filter_audit,
    language,
    mixing,
    near_duplicates,
    neighbours,
    packing,
    pii,
    quality_rules,
    secrets,
    site_quality,
    target_resampling,
    warc,
)

QUERIES = {
    "op1_classify_quality": site_quality.op1_classify_quality,
    "op2_rule_documents": quality_rules.op2_rule_documents,
    "op3_mix_sources": mixing.op3_mix_sources,
    "op4_near_duplicates": near_duplicates.op4_near_duplicates,
    "op5_identify_language": language.op5_identify_language,
    "op6_find_personal_data": pii.op6_find_personal_data,
    "op7_round_trip_archives": warc.op7_round_trip_archives,
    "op8_nearest_vectors": neighbours.op8_nearest_vectors,
    "op9_scan_secrets": secrets.op9_scan_secrets,
    "op10_pack_sequences": packing.op10_pack_sequences,
    "op11_search_top_products": block_search.op11_search_top_products,
    "op12_audit_filters": filter_audit.op12_audit_filters,
    "op13_resample_to_target": target_resampling.op13_resample_to_target,
}
ORACLE = {
    "op3_mix_sources": mixing.SQL,
    "op7_round_trip_archives": warc.SQL,
    "op11_search_top_products": block_search.SQL,
    "op12_audit_filters": filter_audit.SQL,
    "op13_resample_to_target": target_resampling.SQL,
}
