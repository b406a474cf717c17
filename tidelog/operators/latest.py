"""Newest state per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest_event(
    events: DataFrame, keys: Sequence[str], order: Sequence[str], form: str = "window"
) -> DataFrame:
    """The last event of every key, deletes included.

    Both forms keep one row per key and input partition before the shuffle, so a hot
    key costs no more than a cold one: `window` through Spark's window group limit,
    `aggregate` through a partial `max_by`. The aggregate form suits narrow events.
    """
    if form == "window":
        latest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
        ranked = events.withColumn("_rn", F.row_number().over(latest_first))
        return ranked.filter("_rn = 1").drop("_rn")
    if form == "aggregate":
        rest = [c for c in events.columns if c not in keys]
        newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
        return events.groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(events.columns)
    raise ValueError(f"unknown form {form!r}")


def latest_state(
    events: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    op_col: str = "op",
    form: str = "window",
) -> DataFrame:
    """Live rows: the newest event per key unless it is a delete.

    Deletes leave after ranking. Were they dropped before, the key would fall back to
    an older event and reappear; and a key inserted again after a delete is live.
    """
    return newest_event(events, keys, order, form).filter(F.col(op_col) != "delete")


def first_state(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The earliest row of every key, e.g. a person's first known address."""
    earliest = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(earliest)).filter("_rn = 1").drop("_rn")
