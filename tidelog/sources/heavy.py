"""Which keys of the log may be hot, from summaries written with each batch.

Each committed folder has a frequent-items sketch of its keys by source table, of bounded
size and mergeable. A build merges the sketches of the live folders and counts only the keys
they name, instead of all keys of the log.

A sketch that tracks n keys misses none that has more than a share of 2 * ERROR / n of all
rows. Where that share of the table's rows is more than the limit asked about, the sketches
are too coarse to tell, and the build counts all keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.sources.commits import Committed, Folder

TRACKED = 20_000
# the published error of a frequent-items sketch, in keys of its table
ERROR = 3.5
SUMMARY = (
    "source_table string, rows bigint, "
    "keys struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>"
)


@dataclass(frozen=True)
class Heavy:
    """Keys of a source table that may have more than `limit` rows; `sure` if no other has."""

    limit: int
    sure: bool
    keys: tuple[str, ...] = ()

    def among(self, spark: SparkSession, column: str) -> DataFrame:
        return spark.createDataFrame([(k,) for k in self.keys], f"{column} string")


def missed_share(tracked: int) -> float:
    """The largest share of the rows that a key can have without being named."""
    slots = 1
    while slots * 0.75 < tracked:
        slots *= 2
    return 2 * ERROR / slots


def _place(table: Committed, name: str) -> str:
    return f"{table.path}/summaries/commit={name}"


def summarise(table: Committed, name: str | None, rows: DataFrame | None, tracked: int = TRACKED) -> None:
    """Write the summary of a folder's rows (source_table, pk) beside the data."""
    if name is None or rows is None or table.exists(_place(table, name)):
        return
    counted = rows.groupBy("source_table").agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k_accumulate(pk, {tracked})").alias("keys")
    )
    counted.coalesce(1).write.mode("overwrite").parquet(_place(table, name))


def merge_summaries(table: Committed, few: list[Folder], name: str | None, tracked: int = TRACKED) -> None:
    """Write the summary of a folder that others were merged into."""
    old = _summaries(table, few)
    if name is not None and old is not None:
        _combined(old, tracked).coalesce(1).write.mode("overwrite").parquet(_place(table, name))


def _summaries(table: Committed, folders: list[Folder]) -> DataFrame | None:
    """Summaries of these folders; None if one has none."""
    names = [f.name for f in folders if f.name]
    if not names or not all(table.exists(_place(table, n)) for n in names):
        return None
    return table.spark.read.schema(SUMMARY).parquet(*[_place(table, n) for n in names])


def _combined(summaries: DataFrame, tracked: int) -> DataFrame:
    return summaries.groupBy("source_table").agg(
        F.sum("rows").alias("rows"), F.expr(f"approx_top_k_combine(keys, {tracked})").alias("keys")
    )


def heavy_keys(spark: SparkSession, path: str, limit: int, tracked: int = TRACKED) -> dict[str, Heavy]:
    """By source table, the keys that may have more than `limit` events in the log at `path`.

    At most rows / limit of them and a few more, so they can be collected. Empty where a
    folder has no summary.
    """
    table = Committed(spark, path)
    summaries = _summaries(table, list(table.newest().folders))
    if summaries is None:
        return {}
    named = _combined(summaries, tracked).select(
        "source_table",
        "rows",
        F.transform(
            F.filter(F.expr(f"approx_top_k_estimate(keys, {tracked})"), lambda k: k["count"] > limit),
            lambda k: k["item"],
        ).alias("keys"),
    )
    return {
        r.source_table: Heavy(limit, missed_share(tracked) * r.rows <= limit, tuple(r["keys"])) for r in named.collect()
    }
