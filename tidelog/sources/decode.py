"""Change messages to typed log rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import compute_once, has_image, is_snapshot, op_name, payload, primary_key
from tidelog.schemas import ENVELOPE, EVENT_LOG, PRIMARY_KEYS

DECODED = EVENT_LOG + ", value string, problem string"
LOG_COLUMNS = [field.split()[0] for field in EVENT_LOG.split(", ")]


def decode_envelope(
    messages: DataFrame,
    value_col: str = "value",
    keys: Mapping[str, Sequence[str]] = PRIMARY_KEYS,
) -> DataFrame:
    """Log columns plus `value` and `problem`, one row per message.

    Tombstones (no value) and events of other tables that are named are skipped. A message
    that cannot become a log row keeps its text and says why in `problem`; so does one that
    names no source table. See `quarantined`.
    One parse of the envelope and one look into the identifying image, no shuffle.
    """
    parsed = compute_once(
        messages.filter(F.col(value_col).isNotNull()).select(
            "topic", "partition", "kafka_offset", F.col(value_col).alias("value")
        ),
        e=F.from_json("value", ENVELOPE, {"columnNameOfCorruptRecord": "_corrupt"}),
    )
    malformed = F.col("e").isNull() | F.col("e._corrupt").isNotNull()
    unnamed = F.col("e.source.table").isNull()
    known = unnamed | F.col("e.source.table").isin(list(keys))
    image = payload("e.after", "e.before")
    rows = compute_once(
        parsed.filter(malformed | known), pk=primary_key("e.source.table", image, keys)
    ).select(
        F.col("e.source.table").alias("source_table"),
        op_name("e.op").alias("op"),
        F.col("e.source.lsn").alias("lsn"),
        F.col("e.source.txId").alias("tx_id"),
        F.col("e.ts_ms").alias("event_ts_ms"),
        is_snapshot("e.source.snapshot").alias("is_snapshot"),
        "topic",
        "partition",
        "kafka_offset",
        "pk",
        has_image("e.before").alias("before"),
        has_image("e.after").alias("after"),
        "value",
        malformed.alias("_malformed"),
    )
    problem = (
        F.when(F.col("_malformed"), "malformed message")
        .when(F.col("source_table").isNull(), "no source table")
        .when(F.col("op").isNull(), "no operation")
        .when(F.col("event_ts_ms").isNull(), "no observation time")
        .when(F.col("after").isNull() & F.col("before").isNull(), "no row image")
        .when(F.col("pk").isNull(), "no business key")
    )
    return rows.select(*LOG_COLUMNS, "value", problem.alias("problem"))


def valid_events(decoded: DataFrame) -> DataFrame:
    """Rows for the event log."""
    return decoded.filter("problem IS NULL").select(*LOG_COLUMNS)


def quarantined(decoded: DataFrame) -> DataFrame:
    """Messages that did not become log rows, with the reason."""
    return decoded.filter("problem IS NOT NULL").select(
        "topic", "partition", "kafka_offset", "problem", "value"
    )


def load_summary(log: DataFrame) -> DataFrame:
    """Events per table and operation, per table, per operation and in total.

    The totals are taken from the small table of counts, not from the log again.
    """
    fine = log.groupBy("source_table", "op").agg(F.count(F.lit(1)).alias("events"))
    return fine.cube("source_table", "op").agg(F.sum("events").alias("events"))
