"""As-of join: the version of a key that was valid at a fact's time."""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.ordered import (
    HotKeys,
    assign_chunk,
    cut_keys,
    cuts_before,
    hot_keys_of,
    join_small,
)


def fact_position(at: str):
    """Position of a fact in time, for cutting a hot key's facts and versions alike."""
    return F.unix_micros(F.col(at)).cast("double")


# Rows of a chunk, and pairs: within a chunk every fact is held against every version.
FACTS_PER_CHUNK = 1_000_000
PAIRS_PER_CHUNK = 1_000_000_000


def find_hot_facts(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    at: str,
    rows_per_chunk: int = FACTS_PER_CHUNK,
    pairs_per_chunk: int = PAIRS_PER_CHUNK,
) -> HotKeys | None:
    """Keys that are too much work for one task, cut along time.

    The work of a key is its facts times its versions. Ranges of equal depth hold so many
    facts and versions together that their product stays within `pairs_per_chunk`,
    however they are mixed. A key's cuts number about (facts + versions) / range, and a key
    needs more than a range to have any, so all of them together stay small.
    """
    is_fact = F.lit(1).cast("bigint").alias("_fact")
    starts = dim.select(key, F.unix_micros("valid_from").alias("_at_us"), F.lit(0).cast("bigint").alias("_fact"))
    timed = facts.select(key, F.unix_micros(at).alias("_at_us"), is_fact).unionByName(starts)
    counted = timed.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.sum("_fact").alias("_facts"))
    pairs = F.col("_facts").cast("double") * (F.col("_n") - F.col("_facts"))
    heavy = counted.filter((F.col("_n") > rows_per_chunk) | (pairs > pairs_per_chunk)).collect()
    # a and b with a + b = r have a product of at most (r / 2) squared
    depth = max(1, min(rows_per_chunk, 2 * isqrt(pairs_per_chunk)))
    hot = hot_keys_of(timed, [key], ["_at_us"], heavy, depth)
    return hot and cut_keys(timed, hot)


def as_of_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    at: str,
    columns: Sequence[str],
    *,
    how: str = "left",
    strategy: str = "range",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Facts with `columns` of the version where valid_from <= at < valid_to.

    `range` joins on the key with the window as residual condition; overlapping
    windows match more than once. A hot key's facts are cut along time and its
    versions copied to the cuts they overlap, so no task holds the whole key.

    `window` merges facts and versions of a key in time order and takes the last
    version seen: one shuffle, linear in long histories, right for windows that do
    not overlap.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unknown join type {how!r}")
    if strategy == "range":
        return _range(facts, dim, key, at, columns, how, hot)
    if strategy == "window":
        return _merge(facts, dim, key, at, columns, how, hot)
    raise ValueError(f"unknown strategy {strategy!r}")


def _versions(dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return dim.select(
        F.col(key).alias("_dim_key"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        *[F.col(c).alias(f"_dim_{c}") for c in columns],
    )


def _range(facts, dim, key, at, columns, how, hot):
    versions = _versions(dim, key, columns)
    on = [F.col(key) == F.col("_dim_key"), F.col(at) >= F.col("_from"), F.col(at) < F.col("_to")]
    if hot is not None:
        lookup = join_small(versions, hot.named("_dim_key").frame, ["_dim_key"], "left")
        first, last = (cuts_before("_cuts", fact_position(edge)) for edge in ("_from", "_to"))
        # windows of zero or negative width match nothing and need no copy
        spans = F.when(F.col("_cuts").isNull(), F.array(F.lit(0))).when(
            F.col("_from") < F.col("_to"), F.sequence(first, last)
        )
        versions = lookup.withColumn("_dim_chunk", F.explode(spans)).drop("_cuts")
        facts = assign_chunk(facts, hot, fact_position(at)).drop("_hot")
        on.append(F.col("_chunk") == F.col("_dim_chunk"))
    joined = facts.join(versions, on, how)
    kept = [c for c in facts.columns if c != "_chunk"]
    return joined.select(*kept, *[F.col(f"_dim_{c}").alias(c) for c in columns])


def _merge(facts, dim, key, at, columns, how, hot):
    version = F.struct(
        F.col("valid_to").alias("to"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]
    )
    fact = F.struct(*[F.col(c) for c in facts.columns])
    # an empty window is passed over; at one instant the version comes before the fact
    marks = dim.filter("valid_from < valid_to").select(
        F.col(key).alias("_key"),
        F.col("valid_from").alias("_t"),
        F.lit(0).alias("_side"),
        version.alias("_version"),
    )
    points = facts.select(
        F.col(key).alias("_key"),
        F.col(at).alias("_t"),
        F.lit(1).alias("_side"),
        fact.alias("_fact"),
    )
    merged = points.unionByName(marks, allowMissingColumns=True)
    group = ["_key"]
    if hot is not None:
        merged = assign_chunk(merged, hot.named("_key"), fact_position("_t"))
        group = ["_key", "_chunk"]
    so_far = (
        Window.partitionBy(*group)
        .orderBy("_t", "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = merged.withColumn("_seen", F.last("_version", ignorenulls=True).over(so_far))
    if hot is not None:
        # the version still open at the start of a chunk began in an earlier one
        last_version = F.max_by("_version", F.when(F.col("_side") == 0, F.col("_t")))
        chunks = merged.filter("_hot").groupBy("_key", "_chunk").agg(last_version.alias("_last"))
        earlier = (
            Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        )
        opening = chunks.select(
            "_key", "_chunk", F.last("_last", ignorenulls=True).over(earlier).alias("_opening")
        )
        found = join_small(found, opening, ["_key", "_chunk"], "left")
        found = found.withColumn("_seen", F.coalesce("_seen", "_opening"))
    valid = F.col("_t") < F.col("_seen.to")
    out = found.filter("_side = 1").select(
        "_fact.*",
        valid.alias("_valid"),
        *[F.when(valid, F.col(f"_seen.c{i}")).alias(c) for i, c in enumerate(columns)],
    )
    if how == "inner":
        out = out.filter("_valid")
    return out.drop("_valid")
