from tidelog.quality.checks import (
    accepted_range,
    accepted_values,
    expression_is_true,
    not_null,
    relationships,
    unique,
    unique_combination,
)
from tidelog.quality.gate import GateFailure, Suite, run_gate
from tidelog.quality.history import (
    as_of_no_fan_out,
    history_checks,
    no_gaps_or_overlaps,
    one_current,
    opening_events,
    versions_match_log,
)
from tidelog.quality.logs import (
    deleted_do_not_reappear,
    log_gaps,
    log_matches_source,
    no_duplicate_generations,
    offset_gaps,
    op_reconcile,
    order_key_sound,
    streamed_without_position,
)
from tidelog.quality.totals import (
    assert_counts,
    assert_invariants,
    cdc_latency,
    distribution_drift,
    fact_reconciles_to_log,
    facts_reconcile,
    latency_quantiles,
    latency_summary,
    merge_latency,
    profile,
)

__all__ = [
    "GateFailure",
    "Suite",
    "accepted_range",
    "accepted_values",
    "as_of_no_fan_out",
    "assert_counts",
    "assert_invariants",
    "cdc_latency",
    "deleted_do_not_reappear",
    "distribution_drift",
    "expression_is_true",
    "fact_reconciles_to_log",
    "facts_reconcile",
    "history_checks",
    "latency_quantiles",
    "latency_summary",
    "log_gaps",
    "log_matches_source",
    "merge_latency",
    "no_duplicate_generations",
    "no_gaps_or_overlaps",
    "not_null",
    "offset_gaps",
    "one_current",
    "op_reconcile",
    "opening_events",
    "order_key_sound",
    "profile",
    "relationships",
    "run_gate",
    "streamed_without_position",
    "unique",
    "unique_combination",
    "versions_match_log",
]
