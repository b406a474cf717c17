"""Type 2 history: one row per version of a key with a half-open validity window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import seconds_between
from tidelog.operators.ordered import HotKeys, by_heat, over_history
from tidelog.schemas import OPEN_END_SECONDS


def open_end() -> Column:
    """End of a window that is still open; the same instant in every session zone."""
    return F.timestamp_seconds(F.lit(OPEN_END_SECONDS))


def scd2(
    events: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    valid_from: str = "changed_at",
    *,
    clamp: bool = False,
    on_delete: str = "close",
    delete_at: str = "event_at",
    end: Column | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Versions of every key from its change events.

    Versions follow `order`, never the clock; `valid_from` names the business time
    that bounds the windows. Events flagged `is_no_op_update` open no version. With
    `clamp` a version that claims to precede its predecessor starts with it instead,
    so no window runs backwards.

    `on_delete="close"`: a delete opens no version but ends the open one at the
    delete's observed time, not before the version's own start nor after the next
    version's. `on_delete="keep"`: a delete is a version like any other.

    All columns share one key and order, so the whole build is one shuffle and one sort.
    """
    if on_delete not in ("close", "keep"):
        raise ValueError(f"unknown on_delete {on_delete!r}")
    versions = events
    if "is_no_op_update" in events.columns:
        versions = versions.filter(~F.col("is_no_op_update"))

    def build(part: DataFrame, heat: HotKeys | None) -> DataFrame:
        if on_delete == "close":
            part = _close_deleted(part, keys, order, delete_at, heat)
        else:
            unclosed = F.lit(None).cast("timestamp")
            part = part.withColumns({"is_deleted": F.lit(False), "_closed_at": unclosed})
        return _windows(part, keys, order, valid_from, clamp, end, heat)

    return by_heat(versions, hot, build)


def _close_deleted(events, keys, order, delete_at, hot) -> DataFrame:
    """Drop deletes, leaving the time of each on the version it ends."""
    marked = events.withColumn("_deleted_at", F.when(F.col("op") == "delete", F.col(delete_at)))
    following = {"_next_op": "op", "_closed_at": "_deleted_at"}
    return (
        over_history(marked, keys, order, lead=following, hot=hot)
        .filter("op <> 'delete'")
        .withColumn("is_deleted", F.coalesce(F.col("_next_op") == "delete", F.lit(False)))
        .drop("_deleted_at", "_next_op")
    )


def _windows(versions, keys, order, valid_from, clamp, end, hot) -> DataFrame:
    numbered = over_history(
        versions,
        keys,
        order,
        number="version",
        total="total_versions",
        running_max={"_start": valid_from} if clamp else {},
        lead={"_next": valid_from},
        hot=hot,
    )
    if clamp:
        # the next clamped start, without another pass: it is the later of the next
        # version's own time and the maximum so far (greatest skips NULLs)
        has_next = F.col("version") < F.col("total_versions")
        next_start = F.when(has_next, F.greatest("_start", "_next"))
    else:
        numbered = numbered.withColumn("_start", F.col(valid_from))
        next_start = F.col("_next")
    chained = numbered.withColumn("_next", next_start)

    # least and greatest skip NULLs: no next version leaves the delete's own time
    closed = F.least("_next", F.greatest("_closed_at", "_start"))
    still_open = open_end() if end is None else end
    out = chained.withColumns(
        {
            "valid_to": F.when(F.col("is_deleted"), closed).otherwise(
                F.coalesce("_next", still_open)
            ),
            "is_current": F.col("_next").isNull() & ~F.col("is_deleted"),
            "has_history": F.col("total_versions") > 1,
        }
    )
    if clamp:
        moved = F.col(valid_from).isNotNull() & (F.col(valid_from) < F.col("_start"))
        out = out.withColumn("is_timestamp_clamped", moved)
    return out.withColumn("valid_from", F.col("_start")).drop("_start", "_next", "_closed_at")


def with_duration(versions: DataFrame) -> DataFrame:
    """Time spent in a closed version, and whether it began and ended at one instant."""
    is_closed = ~F.col("is_current")
    return versions.withColumns(
        {
            "seconds_in_status": F.when(is_closed, seconds_between("valid_from", "valid_to")),
            "is_instantaneous": is_closed & (F.col("valid_to") == F.col("valid_from")),
        }
    )
