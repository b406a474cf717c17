from tidelog.streaming.tail import read_quarantine, rebuild_log, tail
from tidelog.streaming.upkeep import (
    Kept,
    follow_log,
    keep_history,
    keep_latest,
    keep_summary,
    read_history,
    read_latest,
    read_summary,
)

__all__ = [
    "Kept",
    "follow_log",
    "keep_history",
    "keep_latest",
    "keep_summary",
    "read_history",
    "read_latest",
    "read_quarantine",
    "read_summary",
    "rebuild_log",
    "tail",
]
