"""Ordered columns per key (row number, running maximum, next and previous value).

A window partitioned by key puts all rows of a key into one task. That is right
for ordinary keys and wrong for one that holds a third of the log. `find_hot_keys`
measures which keys are too large; `over_history` range-partitions only those along
their whole order, computes each range on its own, and carries counts, maxima and
edge values from range to range through a table with one row per range.
Results are the same as those of the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.session import scratch_dir

# A window partition of this many narrow rows sorts within one task's memory.
ROWS_PER_CHUNK = 4_000_000
# cuts are looked up level by level, this many at a time
CUTS_PER_LEVEL = 64

_CHUNK, _HOT, _CUTS, _EDGE = "_chunk", "_hot", "_cuts", "_edge"


@dataclass(frozen=True)
class HotKeys:
    """Oversized keys and into how many ranges all of them together are cut.

    `frame` holds the key columns and, from `cut_keys`, `_cuts`: every key's cuts in
    ascending order, then every 64th of them, and so on until one level has at most 64.
    Every key in it has more than `rows_per_chunk` rows and about rows / rows_per_chunk
    cuts, so keys and cuts together stay below 3 * total rows / rows_per_chunk: small enough
    to broadcast.
    """

    keys: tuple[str, ...]
    position: tuple[str, ...]
    frame: DataFrame
    chunks: int

    def named(self, *keys: str) -> HotKeys:
        """The same keys under the column names used downstream."""
        frame = self.frame.withColumnsRenamed(dict(zip(self.keys, keys, strict=True)))
        return HotKeys(keys, self.position, frame, self.chunks)

    def along(self, *position: str) -> HotKeys:
        """The same keys for rows in another order; not for keys that were cut."""
        return HotKeys(self.keys, position, self.frame, self.chunks)


def position_value(columns: Sequence[str]) -> Column:
    """One or two non-negative integer columns as a double that never decreases along them."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("double")
    major, minor = columns
    # exact before the one rounding step, so rounding may tie but never reorder
    shifted = F.col(major).cast("decimal(19,0)") * F.lit(str(2**63)).cast("decimal(19,0)")
    return (shifted + F.col(minor).cast("decimal(19,0)")).cast("double")


def _counted(df: DataFrame, keys: Sequence[str], limit: int) -> list:
    """Keys with more than `limit` rows and their number of rows; at most rows / limit of them."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > limit).collect()


def large_keys(
    df: DataFrame, keys: Sequence[str], limit: int = ROWS_PER_CHUNK
) -> DataFrame | None:
    """The keys with more than `limit` rows, or None where there are none."""
    found = _counted(df, keys, limit)
    if not found:
        return None
    schema = T.StructType([df.schema[k] for k in keys])
    return df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in found], schema)


def find_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    position: Sequence[str],
    rows_per_chunk: int = ROWS_PER_CHUNK,
    among: DataFrame | None = None,
) -> HotKeys | None:
    """Keys with more than `rows_per_chunk` rows, or None where there are none.

    One count per key, combined before the shuffle. Where it is known which keys can be hot
    (`among`, see `heavy_keys`), only their rows are counted.
    """
    if among is not None:
        df = join_small(df.select(*keys), among, keys, "left_semi")
    return hot_keys_of(df, keys, position, _counted(df, keys, rows_per_chunk), rows_per_chunk)


def hot_keys_of(
    df: DataFrame, keys: Sequence[str], position: Sequence[str], counted: Sequence, rows_per_chunk: int
) -> HotKeys | None:
    """Hot keys from rows of the keys' values and their number of rows, `_n`."""
    if not counted:
        return None
    schema = T.StructType([df.schema[k] for k in keys])
    named = df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in counted], schema)
    chunks = sum(-(-r["_n"] // rows_per_chunk) for r in counted)
    return HotKeys(tuple(keys), tuple(position), named, chunks)


def cut_keys(df: DataFrame, hot: HotKeys) -> HotKeys:
    """The same keys with the positions at which each is cut into ranges of about equal size.

    One pass over the hot keys' rows; equal positions stay together.
    """
    keys = hot.keys
    located = join_small(
        df.select(*keys, position_value(hot.position).alias("_pos")), hot.frame, keys, "left_semi"
    )
    ranged = located.repartitionByRange(hot.chunks, *keys, "_pos").select(
        *keys, "_pos", F.spark_partition_id().alias("_range")
    )
    measured = (
        ranged.groupBy(*keys, "_range")
        .agg(F.min("_pos").alias("_low"))
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_set("_low")).alias("_lows"))
        .select(*keys, F.slice("_lows", 2, 2**31 - 1).alias("_fine"))
        .collect()
    )
    levels = T.StructField(_CUTS, T.ArrayType(T.ArrayType(T.DoubleType())))
    frame = df.sparkSession.createDataFrame(
        [(*r[:-1], _levels(r["_fine"])) for r in measured],
        T.StructType([df.schema[k] for k in keys] + [levels]),
    )
    return HotKeys(keys, hot.position, frame, hot.chunks)


def _levels(cuts: list[float]) -> list[list[float]]:
    """All cuts, every 64th of them, every 64th of those, until one level is short."""
    levels = [cuts]
    while len(levels[-1]) > CUTS_PER_LEVEL:
        levels.append(levels[-1][CUTS_PER_LEVEL - 1 :: CUTS_PER_LEVEL])
    return levels


def cuts_before(cuts: Column | str, position: Column) -> Column:
    """How many cuts are at or below `position`, from the shortest level to the longest.

    Each level looks at no more than 64 cuts: those after the ones the level above counted.
    """

    def count(found, level):
        near = F.slice(level, found * CUTS_PER_LEVEL + 1, CUTS_PER_LEVEL)
        return found * CUTS_PER_LEVEL + F.size(F.filter(near, lambda cut: cut <= position))

    return F.aggregate(F.reverse(cuts), F.lit(0), count)


def join_small(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Null-safe equi join with a side whose size is bounded (see HotKeys)."""
    renamed = small.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[c for c in small.columns if c not in keys],
    )
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = df.join(F.broadcast(renamed), on, how)
    return joined.drop(*[f"_k{i}" for i in range(len(keys))])


def assign_chunk(df: DataFrame, hot: HotKeys, position: Column | None = None) -> DataFrame:
    """Add `_chunk` (0 for ordinary keys) and `_hot`."""
    pos = position_value(hot.position) if position is None else position
    joined = join_small(df, hot.frame, hot.keys, "left")
    is_hot = F.col(_CUTS).isNotNull()
    # the position is worked out once per hot row, then held against the cuts
    cut_at = cuts_before(_CUTS, F.col("_pos"))
    return (
        joined.withColumn("_pos", F.when(is_hot, pos))
        .withColumn(_CHUNK, F.when(is_hot, cut_at).otherwise(F.lit(0)))
        .withColumn(_HOT, is_hot)
        .drop(_CUTS, "_pos")
    )


def by_heat(
    df: DataFrame, hot: HotKeys | None, build: Callable[[DataFrame, HotKeys | None], DataFrame]
) -> DataFrame:
    """Build ordinary and hot keys apart and put the results together.

    `build` works key by key. Hot rows are written to the shared scratch folder first:
    the chunked form reads its input twice per pass, and that must not run everything
    upstream again.
    """
    if hot is None:
        return build(df, None)
    named = hot.frame.select(*hot.keys)
    ordinary = join_small(df, named, hot.keys, "left_anti")
    busy = _kept(join_small(df, named, hot.keys, "left_semi"), "hot-keys")
    return build(ordinary, None).unionByName(build(busy, hot))


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def over_history(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    number: str | None = None,
    total: str | None = None,
    running_max: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
    lag: Mapping[str, str] | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add columns computed over each key's rows in order.

    `number` is the 1-based row number, `total` the rows of the key. `running_max`,
    `lead` and `lag` map new column to source column. `order` must be total per key.
    With `hot`, its position columns must be the leading columns of `order`, and `df` should
    hold the rows of hot keys only (see `by_heat`): they are cut along the whole order, so
    that rows which tie in its leading columns come apart as well.
    """
    running_max, lead, lag = running_max or {}, lead or {}, lag or {}
    if hot is None:
        return df.withColumns(_plain(keys, order, number, total, running_max, lead, lag))
    if list(hot.keys) != list(keys) or list(order[: len(hot.position)]) != list(hot.position):
        raise ValueError("hot keys were measured for another key or order")

    # the numbers of ranges are kept with the rows: they must not be drawn anew by a later pass
    ranged = df.repartitionByRange(max(1, hot.chunks), *keys, *order)
    rows = _kept(ranged.withColumn(_CHUNK, F.spark_partition_id()), "hot-ranges")
    chunk_keys = [*keys, _CHUNK]
    local = rows.withColumns(
        _plain(
            chunk_keys,
            order,
            "_n",
            total and "_t",
            {f"_max_{out}": c for out, c in running_max.items()},
            {f"_lead_{out}": c for out, c in lead.items()} | ({_EDGE: F.lit(True)} if lead else {}),
            {f"_lag_{out}": c for out, c in lag.items()},
        )
    )
    joined = join_small(
        local, _carry(rows, keys, order, running_max, lead, lag), chunk_keys, "left"
    )

    added: dict[str, Column] = {}
    if number:
        added[number] = F.col("_n") + F.coalesce("_n_before", F.lit(0))
    if total:
        added[total] = F.coalesce("_n_all", F.col("_t"))
    for out in running_max:
        added[out] = F.greatest(f"_max_{out}", f"_before_{out}")
    for out in lead:
        # the last row of a chunk continues with the first row of the next one
        added[out] = F.when(F.col(_EDGE).isNull(), F.col(f"_next_{out}")["v"]).otherwise(
            F.col(f"_lead_{out}")
        )
    for out in lag:
        added[out] = F.when(F.col("_n") == 1, F.col(f"_prev_{out}")["v"]).otherwise(
            F.col(f"_lag_{out}")
        )
    return joined.withColumns(added).select(*df.columns, *added)


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], number: str) -> DataFrame:
    """Add the 1-based row number of each key, for few keys of any size.

    Rows are cut into ranges along the keys and the order, sorted there and kept in the
    shared folder; a table with one row per key and range says how many rows come before.
    What leads to `df` runs for one shuffle only, and no key is counted first.
    """
    sorted_ = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    # an id holds the range above the row's place in it
    rows = _kept(sorted_.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn(_CHUNK, F.shiftright("_id", 33))
    ranges = rows.groupBy(*keys, _CHUNK).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(*keys, _CHUNK, "_first", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"))
    placed = join_small(rows, starts, [*keys, _CHUNK], "left")
    at = F.col("_id") - F.col("_first") + F.col("_before") + 1
    return placed.select(*df.columns, at.alias(number))


def _plain(keys, order, number, total, running_max, lead, lag) -> dict[str, Column]:
    window = Window.partitionBy(*keys).orderBy(*order)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added: dict[str, Column] = {}
    if number:
        added[number] = F.row_number().over(window).cast("bigint")
    if total:
        added[total] = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    added |= {out: F.max(c).over(so_far) for out, c in running_max.items()}
    added |= {out: F.lead(c).over(window) for out, c in lead.items()}
    added |= {out: F.lag(c).over(window) for out, c in lag.items()}
    return added


def _carry(rows: DataFrame, keys, order, running_max, lead, lag) -> DataFrame:
    """One row per chunk of a hot key: what its rows need to know of the other chunks."""
    at = F.struct(*order)
    # a struct keeps a NULL edge value apart from "no edge"
    first = [F.min_by(F.struct(F.col(c).alias("v")), at).alias(f"_f_{o}") for o, c in lead.items()]
    last = [F.max_by(F.struct(F.col(c).alias("v")), at).alias(f"_l_{o}") for o, c in lag.items()]
    chunks = (
        rows.groupBy(*keys, _CHUNK)
        .agg(
            F.count(F.lit(1)).alias("_c"),
            *[F.max(c).alias(f"_m_{out}") for out, c in running_max.items()],
            *first,
            *last,
        )
    )
    along = Window.partitionBy(*keys).orderBy(_CHUNK)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    return chunks.select(
        *keys,
        _CHUNK,
        F.sum("_c").over(before).alias("_n_before"),
        F.sum("_c").over(Window.partitionBy(*keys)).alias("_n_all"),
        *[F.max(f"_m_{o}").over(before).alias(f"_before_{o}") for o in running_max],
        *[F.lead(f"_f_{o}").over(along).alias(f"_next_{o}") for o in lead],
        *[F.lag(f"_l_{o}").over(along).alias(f"_prev_{o}") for o in lag],
    )
