
from __future__ import annotations

from carelake.plans import analogs as A
from carelake.plans import domain_oracles, domain_queries
from carelake.plans.oracles import SQL

QUERIES = {
    "flag_awv": A.flag_awv,
    "flag_recent_30_90": A.flag_recent_30_90,
    "flag_open_encounter": A.flag_open_encounter,
    "flag_alert_counts": A.flag_alert_counts,
    "flag_latest_year_answer": A.flag_latest_year_answer,
    "flag_overdue_interval": A.flag_overdue_interval,
    "flag_distinct_threshold": A.flag_distinct_threshold,
    "flag_latest_score": A.flag_latest_score,
    "roster_latest": A.roster_latest,
    "role_lookup": A.role_lookup,
    "visits_by_setting": A.visits_by_setting,
    "visits_domain": A.visits_domain,
    "spine_union": A.spine_union,
    "child_arrays": A.child_arrays,
    "chronic": A.chronic,
    "raf_pivot": A.raf_pivot,
    "hcc_capture": A.hcc_capture,
    "hcc_gaps": A.hcc_gaps,
    "uamcc_summary": A.uamcc_summary,
    "adherence": A.adherence,
    "hedis_status": A.hedis_status,
    "labs_chain": A.labs_chain,
    "alerts_map": A.alerts_map,
    "food_by_year": A.food_by_year,
    "appointments": A.appointments,
    "demographics": A.demographics,
    "measure_range": A.measure_range,
    "measure_any_of": A.measure_any_of,
    "measure_none_of": A.measure_none_of,
    "measure_nested2": A.measure_nested2,
    "measure_should": A.measure_should,
    "measure_latest_mode": A.measure_latest_mode,
    "measure_latest_two": A.measure_latest_two,
    "measure_full": A.measure_full,
    "measure_full_parts": A.measure_full_parts,
    "measure_exclusion_any": A.measure_exclusion_any,
    "measure_population": A.measure_population,
    "measure_report": A.measure_report,
    "measure_rate": A.measure_rate,
    "measure_worklist": A.measure_worklist,
    "measure_gap_check": A.measure_gap_check,
    "cdc_direct": A.cdc_direct,
    "cdc_hop1": A.cdc_hop1,
    "cdc_hop2": A.cdc_hop2,
    "cdc_fanout": A.cdc_fanout,
    "cdc_mass": A.cdc_mass,
    "cdc_xref": A.cdc_xref,
    "cdc_dedup_latest": A.cdc_dedup_latest,
    "cdc_last_writer": A.cdc_last_writer,
    "cdc_time_refresh": A.cdc_time_refresh,
    "doc_json": A.doc_json,
    "doc_profile": A.doc_profile,
    "doc_missing_keys": A.doc_missing_keys,
    "doc_cardinality": A.doc_cardinality,
    "doc_missing": A.doc_missing,
    "stream_replace": A.stream_replace,
    "stream_compact": A.stream_compact,
    "stream_trigger": A.stream_trigger,
    "doc_files": A.doc_files,
    "ext_flags": A.ext_flags,
    "ext_threshold": A.ext_threshold,
    "doc_parts": A.doc_parts,
    "doc_domain": A.doc_domain,
    **domain_queries.QUERIES,
}

ORACLES = {**SQL, **domain_oracles.SQL}
