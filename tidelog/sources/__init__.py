from tidelog.sources.csv import read_csv
from tidelog.sources.decode import decode_envelope, load_summary, quarantined, valid_events
from tidelog.sources.heavy import Heavy, heavy_keys
from tidelog.sources.log import append_log, compact_log, log_changes, log_ranges, overwrite_log, read_log
from tidelog.sources.messages import read_changes, write_messages

__all__ = [
    "Heavy",
    "append_log",
    "compact_log",
    "decode_envelope",
    "heavy_keys",
    "load_summary",
    "log_changes",
    "log_ranges",
    "overwrite_log",
    "quarantined",
    "read_changes",
    "read_csv",
    "read_log",
    "valid_events",
    "write_messages",
]
