"""Joins to a side with one row per key: parents, translations, anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.ordered import join_small


def parent_join(
    children: DataFrame,
    parents: DataFrame,
    key: str,
    how: str = "inner",
    busy: DataFrame | None = None,
) -> DataFrame:
    """Children with their parent's columns; `parents` has one row per key.

    `busy` lists the keys with too many children for one task (see `large_keys`). Their
    parents, one row per listed key, are few enough to broadcast, so their children are
    joined where they are; all others meet by key.
    """
    if busy is None:
        return children.join(parents, key, how)
    few = join_small(parents, busy, [key], "left_semi")
    spread = join_small(children, busy, [key], "left_semi").join(F.broadcast(few), key, how)
    others = join_small(children, busy, [key], "left_anti").join(parents, key, how)
    return others.unionByName(spread)


def translate(
    df: DataFrame, lookup: DataFrame, code: str, lookup_code: str, text: str, out: str
) -> DataFrame:
    """Add the translation of `code`; rows without one keep NULL.

    The lookup side is broadcast by Spark only if its size is below the session's limit.
    """
    table = lookup.select(F.col(lookup_code).alias("_code"), F.col(text).alias(out))
    return df.join(table, F.col(code) == F.col("_code"), "left").drop("_code")


def first_activity(
    entities: DataFrame,
    lines: DataFrame,
    parents: DataFrame,
    key: str,
    parent_key: str,
    at: str,
    out: str,
    fallback_ms: int,
) -> DataFrame:
    """Add each entity's earliest parent time, or the fallback where it has none.

    Minima are taken per entity before the entity table is joined, so a busy entity
    shrinks to one row per task before anything is shuffled by it.
    """
    earliest = (
        lines.select(key, parent_key)
        .join(parents.select(parent_key, at), parent_key)
        .groupBy(key)
        .agg(F.min(at).alias("_first"))
    )
    known = F.coalesce("_first", F.timestamp_millis(F.lit(fallback_ms)))
    return entities.join(earliest, key, "left").withColumn(out, known).drop("_first")
