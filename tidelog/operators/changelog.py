"""Change messages made from successive row images."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import compute_once
from tidelog.operators.ordered import HotKeys, by_heat, number_rows, over_history
from tidelog.schemas import TOPIC_PREFIX

# JSON of an image names every column, unknown ones as null
_ALL_FIELDS = {"ignoreNullFields": "false"}


def message_value(
    table: str,
    op: Column,
    ts_ms: Column,
    lsn: Column,
    tx_id: Column,
    snapshot: Column,
    before: Column,
    after: Column,
) -> Column:
    """One change message as JSON text."""
    source = F.struct(
        F.lit(table).alias("table"),
        lsn.alias("lsn"),
        tx_id.alias("txId"),
        F.when(snapshot, "true").otherwise("false").alias("snapshot"),
    )
    envelope = F.struct(
        op.alias("op"),
        ts_ms.alias("ts_ms"),
        source.alias("source"),
        before.alias("before"),
        after.alias("after"),
    )
    return F.to_json(envelope, _ALL_FIELDS)


def topic_name(table: str, prefix: str = TOPIC_PREFIX, schema: str = TOPIC_PREFIX) -> str:
    return f"{prefix}.{schema}.{table}"


POSITION = ["op", "lsn", "partition", "kafka_offset", "ts_ms", "tx_id"]


def synthesize_log(events: DataFrame, table: str, image: Sequence[str]) -> DataFrame:
    """Messages of one table from one row per event.

    `op` is the operation code, `lsn`, `partition`, `kafka_offset`, `ts_ms` and `tx_id`
    say where and when it was committed, `now` and `was` are structs that hold at least
    the image columns after and before the event. Reads and inserts have no image before,
    deletes none after.
    """
    op, now, was = F.col("op"), F.col("now"), F.col("was")

    def row_image(state: Column) -> Column:
        return F.struct(*[state[c].alias(c) for c in image])

    value = message_value(
        table,
        op,
        F.col("ts_ms"),
        F.col("lsn"),
        F.col("tx_id"),
        op == "r",
        F.when(~op.isin("r", "c"), row_image(was)),
        F.when(op != "d", row_image(now)),
    )
    return compute_once(events, value=value).select(
        F.lit(topic_name(table)).alias("topic"), "partition", "kafka_offset", "value"
    )


def unfold_states(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of the array column `states`: `now`, `was` and its `pos`.

    For rows that each hold their own whole history, so that the state before an event is
    known without gathering a key by a shuffle.
    """
    paired = F.transform(
        "states",
        lambda s, i: F.struct(
            s.alias("now"), F.get(F.col("states"), i - 1).alias("was"), i.alias("pos")
        ),
    )
    return df.select(*keep, F.inline(paired))


def synthesize_history(
    events: DataFrame,
    table: str,
    image: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    hot: HotKeys | None = None,
) -> DataFrame:
    """Messages of one table from one row per event, its image as plain columns.

    The image before an event is the row before it in the key's order.
    """
    kept = list(dict.fromkeys([*keys, *order, *POSITION]))
    rows = events.select(*kept, F.struct(*image).alias("now"))
    paired = by_heat(
        rows, hot, lambda part, heat: over_history(part, keys, order, lag={"was": "now"}, hot=heat)
    )
    return synthesize_log(paired, table, image)


def number_messages(
    events: DataFrame, key: str, order: Sequence[str], partitions: int, observed_from_ms: int
) -> DataFrame:
    """Give events the positions a broker and a log would have given them.

    All events of a key go to one topic partition; offsets are dense per partition, along
    `order`, which must be total. Reads have no log position, other events one that grows
    with the offset. See `number_rows`: no topic partition is gathered in one task.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")
    numbered = number_rows(events.withColumn("partition", slot), ["partition"], order, "_n")
    offset = F.col("_n") - 1
    return numbered.withColumns(
        {
            "kafka_offset": offset,
            "lsn": F.when(F.col("op") != "r", offset + 1),
            "ts_ms": offset + observed_from_ms,
            "tx_id": offset,
        }
    ).drop("_n")
