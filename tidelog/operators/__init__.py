from tidelog.operators.asof import as_of_join, find_hot_facts
from tidelog.operators.changelog import (
    message_value,
    number_messages,
    synthesize_history,
    synthesize_log,
    topic_name,
    unfold_states,
)
from tidelog.operators.drift import changed_rows, detect_changes
from tidelog.operators.events import (
    ORDER,
    event_order,
    number_events,
    ordered_events,
    stage_events,
    typed_images,
    unreadable_images,
)
from tidelog.operators.history import open_end, scd2, with_duration
from tidelog.operators.latest import first_state, latest_state, newest_event
from tidelog.operators.lifecycle import (
    lifecycle_events,
    lifecycle_steps,
    out_of_order_count,
    rewind,
    terminal_time,
    transitions_by_status,
)
from tidelog.operators.lookup import first_activity, parent_join, translate
from tidelog.operators.ordered import (
    HotKeys,
    by_heat,
    cut_keys,
    find_hot_keys,
    join_small,
    large_keys,
    over_history,
)
from tidelog.operators.sampling import hash_sample, sample_rule

__all__ = [
    "ORDER",
    "HotKeys",
    "as_of_join",
    "by_heat",
    "changed_rows",
    "cut_keys",
    "detect_changes",
    "event_order",
    "find_hot_facts",
    "find_hot_keys",
    "first_activity",
    "first_state",
    "hash_sample",
    "join_small",
    "large_keys",
    "latest_state",
    "lifecycle_events",
    "lifecycle_steps",
    "message_value",
    "newest_event",
    "number_events",
    "number_messages",
    "open_end",
    "ordered_events",
    "out_of_order_count",
    "over_history",
    "parent_join",
    "rewind",
    "sample_rule",
    "scd2",
    "stage_events",
    "synthesize_history",
    "synthesize_log",
    "terminal_time",
    "topic_name",
    "transitions_by_status",
    "translate",
    "typed_images",
    "unfold_states",
    "unreadable_images",
    "with_duration",
]
