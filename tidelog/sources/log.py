"""The append-only event log, safe for several writers at once.

The log is a table of committed folders (`commits`). Every writer leaves out messages that
the log holds already: a version's ranges of offsets say which folders can hold any, ranges
without gaps answer by themselves, and only the positions of the others are read. Should
another writer commit first, the check is repeated against what it brought in. So each
message is there once, whoever writes, and a batch that is repeated adds nothing.

A rebuild is written beside the log and switched to in one commit. What others commit while
it is written is carried over; if anything is committed between that and the switch, the
switch fails and is tried again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.schemas import EVENT_LOG
from tidelog.sources.commits import Committed, Folder, Version, complete, merge_candidates, merged_ranges
from tidelog.sources.heavy import merge_summaries, summarise

POSITION = ["topic", "partition", "kafka_offset"]
KIND = "kind"
ROWS = f"/{KIND}=event"
STORED = f"{EVENT_LOG}, {KIND} string"
COLUMNS = [f.split()[0] for f in EVENT_LOG.split(", ")]


def committed_rows(table: Committed, folders: Iterable[Folder]) -> DataFrame | None:
    """Events of these folders, or None where they have none."""
    found = table.read(folders, STORED, ROWS)
    return None if found is None else found.drop(KIND)


def _written(table: Committed, name: str) -> DataFrame:
    return table.read_names([name], STORED, ROWS).drop(KIND)


def _blocks(rows: DataFrame) -> DataFrame:
    """Positions by blocks of 64 offsets, each offset a bit: those that lie near each other travel as one row."""
    offset = F.col("kafka_offset")
    return rows.groupBy("topic", "partition", F.shiftright(offset, 6).alias("block")).agg(
        F.min(offset).alias("low"),
        F.max(offset).alias("high"),
        F.bit_or(F.expr("shiftleft(1L, cast(kafka_offset & 63 AS int))")).alias("seen"),
        F.count(F.lit(1)).alias("n"),
    )


def _positions(table: Committed, name: str) -> tuple[tuple[tuple, ...], int, int]:
    """(ranges, distinct positions, rows) of a folder; only blocks of positions are shuffled."""
    # rows without an offset are one position
    offsets = F.when(F.col("block").isNull(), 1).otherwise(F.bit_count("seen"))
    found = _blocks(_written(table, name)).groupBy("topic", "partition").agg(
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum(offsets).alias("offsets"),
        F.sum("n").alias("n"),
    )
    # one row for each topic partition
    rows = found.collect()
    ranges = tuple(sorted((r.topic, r.partition, r.low, r.high, r.offsets) for r in rows))
    return ranges, sum(r.offsets for r in rows), sum(r.n for r in rows)


def _meeting(ranges: Iterable[tuple], folders: Iterable[Folder]) -> list[Folder]:
    """Folders whose ranges meet any of these."""
    own = list(ranges)

    def meets(r: tuple) -> bool:
        return any(r[:2] == o[:2] and r[2] <= o[3] and r[3] >= o[2] for o in own)

    return [f for f in folders if any(meets(r) for r in f.ranges)]


def _without(table: Committed, rows: DataFrame, folders: list[Folder]) -> DataFrame:
    """Rows whose positions these folders do not hold."""
    whole = [r for f in folders for r in f.ranges if complete(*r[2:])]
    for topic, partition, low, high, _ in whole:
        held = (F.col("topic") == topic) & (F.col("partition") == partition) & F.col("kafka_offset").between(low, high)
        rows = rows.where(~held)
    gappy = [f for f in folders if not all(complete(*r[2:]) for r in f.ranges)]
    known = committed_rows(table, gappy)
    return rows if known is None else rows.join(known.select(*POSITION), POSITION, "left_anti")


def _new_rows(table: Committed, name: str | None, seen: Iterable[Folder]) -> tuple[str | None, int, tuple]:
    """(folder, rows, ranges) of what is new in a written folder; written anew only if not all of it is."""
    if name is None:
        return None, 0, ()
    ranges, offsets, n = _positions(table, name)
    meeting = _meeting(ranges, seen)
    rows = _written(table, name)
    if n > offsets:
        rows = rows.dropDuplicates(POSITION)
    if meeting:
        rows = _without(table, rows, meeting)
        if n == offsets and rows.select(*POSITION).count() == n:
            meeting = []
    if n == offsets and not meeting:
        return name, n, ranges
    name = table.write(rows.withColumn(KIND, F.lit("event")), [KIND, "source_table"])
    if not _has_rows(table, name):
        return None, 0, ()
    ranges, _, n = _positions(table, name)
    return name, n, ranges


def _has_rows(table: Committed, name: str) -> bool:
    return table.exists(table.place(name) + ROWS)


def write_events(events: DataFrame, path: str) -> str | None:
    """Events as a folder of the log that no version names yet; None where there are none."""
    table = Committed(events.sparkSession, path)
    name = table.write(events.withColumn(KIND, F.lit("event")), [KIND, "source_table"])
    return name if _has_rows(table, name) else None


def commit_events(
    spark: SparkSession, path: str, name: str | None, load: str, batch_id: int, side: tuple[str, ...] = ()
) -> Version | None:
    """Commit a written folder without what the log holds; None where that leaves nothing to say.

    `side` names folders beside the log that belong to the batch (its quarantine).
    """
    table = Committed(spark, path)
    seen, given = table.newest(), name
    generation, checked = seen.generation, set()
    while True:
        if seen.generation != generation:
            # what the old generation held the new one may lack
            name, generation, checked = given, seen.generation, set()
        fresh = [f for f in seen.folders if f.name not in checked]
        name, rows, ranges = _new_rows(table, name, fresh)
        checked |= {f.name for f in fresh}
        if not rows and not side:
            return None
        folder = Folder(name, load, batch_id, rows, ranges=ranges, side=side)
        summarise(table, name, name and _written(table, name))
        after = table.publish(seen, added=[folder])
        if after:
            return after
        seen = table.newest()


def append_log(events: DataFrame, path: str, batch_id: int | None = None, load: str | None = None) -> None:
    """Append events, each message once whoever appends it.

    `load` and `batch_id` say in the log's versions who wrote a batch; a batch that is
    repeated adds what the log lacks of it. Copies of a message within the events count
    once. Rows are not gathered by table: each task writes the tables it has.
    """
    load = load or ("append" if batch_id is not None else f"append-{uuid.uuid4().hex}")
    commit_events(events.sparkSession, path, write_events(events, path), load, batch_id or 0)


def rebuild(
    spark: SparkSession, path: str, write: Callable[[], tuple[str | None, tuple[str, ...]]]
) -> Version:
    """Replace the log by what `write` writes: (folder, folders beside the log).

    Folders that others commit meanwhile stay, but for the messages that the new ones hold.
    """
    table = Committed(spark, path)
    began = _fence(table)
    name, side = write()
    # repeated messages within the new rows are left out
    name, rows, ranges = _new_rows(table, name, [])
    new = Folder(name, "rebuild", 0, rows, ranges=ranges, side=side)
    summarise(table, name, name and _written(table, name))
    carried: dict[str | None, list[Folder]] = {}
    while True:
        seen = table.newest()
        if seen.generation != began.generation:
            raise RuntimeError(f"{path} was rebuilt by another writer meanwhile")
        late = [f for f in seen.folders if f.since > began.number]
        for folder in late:
            if folder.name not in carried or folder.name is None:
                kept, n, left = _new_rows(table, folder.name, [new])
                own = Folder(kept, folder.writer, folder.batch, n, ranges=left, side=folder.side)
                summarise(table, kept, kept and _written(table, kept))
                carried[folder.name] = [own] if n or folder.side else []
        added = [new, *(f for folder in late for f in carried[folder.name])]
        after = table.publish(
            seen, kind="rebuild", generation=seen.generation + 1, folders=(), added=added, fences=()
        )
        if after:
            return after


def _fence(table: Committed) -> Version:
    """A version that folders are not merged across, so that what comes later can be told."""
    while True:
        seen = table.newest()
        after = table.publish(seen, kind="fence", fences=(*seen.fences, seen.number + 1))
        if after:
            return after


def overwrite_log(events: DataFrame, path: str) -> None:
    """Rebuild the log from nothing; `events` may be read from the old one."""
    rebuild(events.sparkSession, path, lambda: (write_events(events, path), ()))


def compact_log(spark: SparkSession, path: str) -> int:
    """Merge small folders until no size class is full; returns how many folders were merged.

    Readers of older versions keep what they read: folders are deleted by `remove_unnamed`.
    """
    table, merged = Committed(spark, path), 0
    while True:
        seen = table.newest()
        few = merge_candidates(seen)
        if not few:
            return merged
        rows = committed_rows(table, few)
        name = None
        if rows is not None:
            name = table.write(rows.withColumn(KIND, F.lit("event")), [KIND, "source_table"])
            merge_summaries(table, few, name)
        one = Folder(
            name,
            "merge",
            0,
            sum(f.rows for f in few),
            since=max(f.since for f in few),
            ranges=merged_ranges(few),
            side=tuple(dict.fromkeys(s for f in few for s in f.side)),
        )
        while seen and set(few) <= set(seen.folders):
            kept = tuple(f for f in seen.folders if f not in set(few))
            if seen.fences and any(min(f.since for f in few) < x <= max(f.since for f in few) for x in seen.fences):
                break  # a rebuild has begun in between
            if table.publish(seen, kind="merge", folders=(*kept, one)):
                merged += len(few)
                break
            seen = table.newest()


def read_log(spark: SparkSession, path: str) -> DataFrame | None:
    """The log, or None where nothing was committed yet. A filter on `source_table` prunes files."""
    table = Committed(spark, path)
    version = table.newest()
    if not version.number:
        return None
    rows = committed_rows(table, version.folders)
    return spark.createDataFrame([], EVENT_LOG) if rows is None else rows.select(*COLUMNS)


def log_changes(spark: SparkSession, path: str, after: int) -> tuple[int, DataFrame | None, bool]:
    """(newest version, rows that came in after version `after`, whether they are all rows instead).

    Merges bring in nothing. After a rebuild, or where the versions in between are gone, a
    follower has to begin anew and gets the whole log.
    """
    table = Committed(spark, path)
    now, added = table.since(after)
    if added is None:
        return now.number, committed_rows(table, now.folders), True
    return now.number, committed_rows(table, added), False


def log_ranges(spark: SparkSession, path: str) -> list[tuple[str, int, int, int, int]]:
    """(topic, partition, lowest offset, highest, offsets) of the log, from its version alone."""
    return list(merged_ranges(Committed(spark, path).newest().folders))


def read_if_present(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
