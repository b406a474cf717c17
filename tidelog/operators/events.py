"""Typed, ordered change events of one source table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import compute_once, event_time, no_op_update
from tidelog.operators.ordered import HotKeys, by_heat, over_history
from tidelog.schemas import IMAGES

ORDER = ["lsn", "kafka_offset"]


def event_order(lsn: str = "lsn", offset: str = "kafka_offset"):
    """Sort columns of one key's events. Events without a log position come first."""
    return [F.coalesce(F.col(lsn), F.lit(0)), F.col(offset)]


def ordered_events(log: DataFrame, table: str) -> DataFrame:
    """Events of one table with a log position that is never NULL."""
    lsn, offset = event_order()
    return log.filter(F.col("source_table") == table).withColumns(
        {"lsn": lsn, "kafka_offset": offset}
    )


def typed_images(
    events: DataFrame,
    image: str,
    previous: Sequence[str] = (),
    prefix: str = "prev_",
    mode: str = "FAILFAST",
) -> DataFrame:
    """Decode `after` in one parse to typed columns, and `before` to the columns in `previous`.

    A value that does not fit its type stops the job; with mode `PERMISSIVE` it becomes
    NULL, and `unreadable_images` lists the events it came from.
    """
    kept = [c for c in events.columns if c not in ("before", "after")]
    parsed = {"_after": F.from_json("after", image, {"mode": mode})}
    if previous:
        wanted = T.StructType([f for f in T.StructType.fromDDL(image) if f.name in previous])
        parsed["_before"] = F.from_json("before", wanted, {"mode": mode})
    return compute_once(events, **parsed).select(
        *kept,
        "_after.*",
        *[F.col(f"_before.{c}").alias(prefix + c) for c in previous],
    )


def unreadable_images(log: DataFrame, table: str, image: str | None = None) -> DataFrame:
    """Events of a table whose images do not fit its columns."""
    schema = f"{image or IMAGES[table]}, _corrupt string"
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    events = compute_once(
        log.filter(F.col("source_table") == table),
        _after=F.from_json("after", schema, options),
        _before=F.from_json("before", schema, options),
    )
    corrupt = F.col("_after._corrupt").isNotNull() | F.col("_before._corrupt").isNotNull()
    return events.filter(corrupt).drop("_after", "_before")


def stage_events(
    log: DataFrame,
    table: str,
    key: str,
    tracked: Sequence[str],
    image: str | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """One typed row per change event of a table, its key under the name `key`.

    `is_no_op_update` marks updates that left every tracked attribute unchanged. Each
    row is made from one event alone, without a shuffle.
    """
    events = ordered_events(log, table)
    typed = typed_images(events, image or IMAGES[table], tracked, mode=mode)
    # the key comes from the event, not from the image, which is absent on deletes
    return typed.drop(key).withColumnRenamed("pk", key).withColumns(
        {
            "event_at": event_time("event_ts_ms"),
            "changed_at": event_time("updated_at"),
            "is_no_op_update": no_op_update("op", tracked),
        }
    )


def number_events(events: DataFrame, key: str, hot: HotKeys | None = None) -> DataFrame:
    """Add `event_seq`, which counts all events of a key, no-op updates included."""

    def build(part: DataFrame, heat: HotKeys | None) -> DataFrame:
        return over_history(part, [key], ORDER, number="event_seq", hot=heat)

    return by_heat(events, hot, build)
