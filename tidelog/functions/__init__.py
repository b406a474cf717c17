from tidelog.functions.columns import (
    compute_once,
    event_time,
    has_image,
    is_snapshot,
    late_flag,
    no_op_update,
    op_name,
    payload,
    primary_key,
    seconds_between,
    surrogate_key,
    timestamp_defects,
)

__all__ = [
    "compute_once",
    "event_time",
    "has_image",
    "is_snapshot",
    "late_flag",
    "no_op_update",
    "op_name",
    "payload",
    "primary_key",
    "seconds_between",
    "surrogate_key",
    "timestamp_defects",
]
