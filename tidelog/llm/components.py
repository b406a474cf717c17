"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidelog.session import drop_scratch, scratch_dir

MAX_ROUNDS = 100
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BITMAP_BITS = 23

# tables written within the open scopes, innermost last
_scopes: list[list[str]] = []


def written(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """`df` as a table in the shared folder: cuts lineage and survives lost executors.

    Once it is written nothing needs its shuffles; Spark is told to delete them right away,
    not when the driver happens to collect its garbage.
    """
    path = scratch_dir(spark, purpose)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    if _scopes:
        _scopes[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for table in tables:
        drop_scratch(table.sparkSession, table._written_at)
        for scope in _scopes:
            if table._written_at in scope:
                scope.remove(table._written_at)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables written within when it ends; `kept` saves one."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            drop_scratch(spark, path)


def kept(table: DataFrame) -> DataFrame:
    """A written table that outlives the innermost scope."""
    if _scopes and table._written_at in _scopes[-1]:
        _scopes[-1].remove(table._written_at)
        if len(_scopes) > 1:
            _scopes[-2].append(table._written_at)
    return table


def _places(ids: np.ndarray) -> np.ndarray:
    """Bits of ids in a bitmap of 2^BITMAP_BITS."""
    return ((ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


class Wanted:
    """A bitmap of hashed ids (1 MB, however many there are) that thins out tables before a join.

    It lets through every id that it was made from and some others, so it steers cost only.
    """

    def __init__(self, ids: DataFrame):
        """`ids` has one long column."""

        def mark(batches):
            seen = np.zeros(1 << BITMAP_BITS, bool)
            for batch in batches:
                seen[_places(batch.column(0).drop_null().to_numpy())] = True
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(seen).tobytes()])], ["seen"])

        bits = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
        # a fixed number of tasks, so a fixed number of bitmaps
        for row in ids.coalesce(8).mapInArrow(mark, "seen binary").toLocalIterator():
            bits |= np.frombuffer(row.seen, np.uint8)
        self._shared = ids.sparkSession.sparkContext.broadcast(bits)

    def mask(self, column: pa.Array) -> pa.Array:
        """Which of the ids may be wanted."""
        at = _places(column.fill_null(0).to_numpy(zero_copy_only=False))
        return pa.array((self._shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool))

    def among(self, df: DataFrame, column: str) -> DataFrame:
        """The rows of `df` whose id may be wanted."""
        place = df.columns.index(column)
        types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

        def thin(batches):
            for batch in batches:
                yield batch.filter(self.mask(batch.column(place)))

        return df.mapInArrow(thin, types)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))
    return (
        both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = down.groupBy("src").agg(F.min("dst").alias("low"))
    moved = down.join(least, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.union(least.select("src", F.col("low").alias("dst"))).distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge.

    `edges` has columns src and dst of one orderable type; direction, repeated edges and
    loops do not matter, edges with a null end are left out. The number of rounds grows
    with the logarithm of the longest path.
    """
    edges, before = _marked(spark, edges.where("src <> dst").select("src", "dst").distinct())
    for _ in range(MAX_ROUNDS):
        after = before
        if before["n"]:
            old = edges
            edges, after = _marked(spark, _small_star(_large_star(old)))
            dropped(old)
        if after == before:
            named = edges.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(
                edges.select("dst", "dst").distinct()
            )
            named._written_at = edges._written_at
            return named
        before = after
    raise RuntimeError(f"no fixpoint after {MAX_ROUNDS} rounds")


def _marked(spark: SparkSession, edges: DataFrame) -> tuple[DataFrame, dict]:
    """Written edges and, observed in writing them, their number and a sum of their hashes."""
    seen = Observation()
    total = F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))
    out = written(spark, edges.observe(seen, F.count("*").alias("n"), total.alias("total")), "edges")
    return out, seen.get
