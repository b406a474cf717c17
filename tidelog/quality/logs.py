"""Invariants of the event log and its agreement with the source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import (
    ORDER,
    HotKeys,
    by_heat,
    event_order,
    find_hot_keys,
    newest_event,
    over_history,
)
from tidelog.operators.ordered import ROWS_PER_CHUNK
from tidelog.quality.checks import expression_is_true
from tidelog.sources.commits import Committed, complete
from tidelog.sources.log import committed_rows

PARTITION = ["topic", "partition"]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def streamed_without_position(log: DataFrame) -> DataFrame:
    """Streamed events without a log position: they cannot be ordered."""
    return expression_is_true(log, "lsn IS NOT NULL OR is_snapshot")


def no_duplicate_generations(log: DataFrame) -> DataFrame:
    """Keys read by more than one snapshot: the log holds more than one generation."""
    reads = log.filter("op = 'read'").groupBy("source_table", "pk")
    return reads.agg(F.count(F.lit(1)).alias("snapshot_reads")).filter("snapshot_reads > 1")


def newest_ops(log: DataFrame) -> DataFrame:
    """Source table, key and operation of every key's newest event."""
    lsn, offset = event_order()
    narrow = log.select("source_table", "pk", "op", lsn.alias("lsn"), offset.alias("kafka_offset"))
    return newest_event(narrow, ["source_table", "pk"], ORDER).select("source_table", "pk", "op")


def deleted_do_not_reappear(
    log: DataFrame, models: Mapping[str, tuple[str, DataFrame, Sequence[str]]]
) -> DataFrame:
    """Keys whose newest event is a delete but which a current-state model still holds.

    `models` maps source table to model name, frame and key columns.
    """
    gone = newest_ops(log).filter("op = 'delete'")
    leaks = []
    for table, (name, frame, keys) in models.items():
        held = frame.select(F.concat_ws(":", *[F.col(k).cast("string") for k in keys]).alias("pk"))
        leaks.append(
            gone.filter(F.col("source_table") == table)
            .join(held, "pk", "left_semi")
            .select(F.lit(name).alias("model"), "pk")
        )
    return union_all(leaks)


def log_matches_source(log: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Tables whose number of events is not rows + updates + 2 * deletes.

    Every live row came by one read or insert; a deleted row by one that is no longer
    live, and the delete is an event too.
    """
    counted = log.groupBy("source_table").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("op") == "update").alias("updates"),
        F.count_if(F.col("op") == "delete").alias("deletes"),
    )
    rows = union_all(
        [
            frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("source_table"), "rows")
            for t, frame in sources.items()
        ]
    )
    joined = counted.join(rows, "source_table", "full").na.fill(0)
    expected = F.col("rows") + F.col("updates") + 2 * F.col("deletes")
    return joined.withColumn("expected", expected).filter("events <> expected")


def op_reconcile(log: DataFrame, end_offsets: DataFrame) -> DataFrame:
    """Events per table and operation next to the messages the source holds.

    `end_offsets` has `source_table` and `messages`; `is_reconciled` says whether the
    operations of the table add up to it.
    """
    mix = log.groupBy("source_table", "op").agg(F.count(F.lit(1)).alias("events"))
    totals = mix.groupBy("source_table").agg(F.sum("events").alias("total"))
    compared = totals.join(end_offsets, "source_table", "full").select(
        "source_table",
        F.col("total").eqNullSafe(F.col("messages")).alias("is_reconciled"),
    )
    return mix.join(compared, "source_table", "full")


def _following(messages: DataFrame, hot: HotKeys | None, lag: Mapping[str, str]) -> DataFrame:
    def build(part: DataFrame, heat: HotKeys | None) -> DataFrame:
        return over_history(part, PARTITION, ["kafka_offset"], lag=lag, hot=heat)

    return by_heat(messages, hot, build)


def offset_gaps(log: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Places where offsets of a topic partition are missing.

    A topic partition is a hot key by nature, so its offsets are cut into chunks.
    """
    offsets = log.select(*PARTITION, "kafka_offset")
    hot = find_hot_keys(offsets, PARTITION, ["kafka_offset"], rows_per_chunk)
    chained = _following(offsets, hot, {"previous": "kafka_offset"})
    missing = F.col("kafka_offset") - F.col("previous") - 1
    return chained.withColumn("missing", missing).filter("missing > 0")


def log_gaps(spark: SparkSession, path: str) -> DataFrame:
    """`offset_gaps` of the log at `path`: topic, partition, previous, kafka_offset, missing.

    Topic partitions whose ranges of offsets are complete are answered from the log's version
    alone; for the others the folders that hold them are read.
    """
    table = Committed(spark, path)
    folders = table.newest().folders
    ranges: dict[tuple[str, int], list[tuple[int, ...]]] = {}
    for folder in folders:
        for topic, partition, *own in folder.ranges:
            ranges.setdefault((topic, partition), []).append(tuple(own))
    unsure = [k for k, own in sorted(ranges.items()) if not all(complete(*r) for r in own)]
    found = []
    for key, own in sorted(ranges.items()):
        if key not in unsure:
            own.sort()
            found += [(*key, a[1], b[0], b[0] - a[1] - 1) for a, b in zip(own, own[1:]) if b[0] > a[1] + 1]
    columns = "topic string, partition int, previous bigint, kafka_offset bigint, missing bigint"
    parts = [spark.createDataFrame(found, columns)]
    if unsure:
        rows = committed_rows(table, [f for f in folders if any(r[:2] in unsure for r in f.ranges)])
        here = reduce(or_, [(F.col("topic") == t) & (F.col("partition") == p) for t, p in unsure])
        parts.append(offset_gaps(rows.where(here)).select("topic", "partition", "previous", "kafka_offset", "missing"))
    return union_all(parts)


def order_key_sound(log: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Streamed events whose log position runs backwards or repeats along the offsets.

    `backwards` compares with the message before, `collision` with every message of the
    topic partition.
    """
    streamed = log.filter("lsn IS NOT NULL").select(*PARTITION, "kafka_offset", "lsn")
    hot = find_hot_keys(streamed, PARTITION, ["kafka_offset"], rows_per_chunk)
    chained = _following(streamed, hot, {"previous_lsn": "lsn"})
    backwards = chained.filter("lsn < previous_lsn").select(
        F.lit("backwards").alias("problem"), *PARTITION, "lsn", F.lit(1).cast("bigint").alias("events")
    )
    repeated = streamed.groupBy(*PARTITION, "lsn").agg(F.count(F.lit(1)).alias("events"))
    collisions = repeated.filter("events > 1").select(
        F.lit("collision").alias("problem"), *PARTITION, "lsn", "events"
    )
    return backwards.unionByName(collisions)
