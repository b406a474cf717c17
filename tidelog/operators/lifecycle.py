"""Change events derived from wide rows that hold one time column per lifecycle step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _struct(position: Column, status: Column, at: Column) -> Column:
    return F.struct(position.alias("position"), status.alias("status"), at.alias("at"))


def lifecycle_steps(
    steps: Sequence[tuple[str, str]], final_status: str | None = None, initial: str = "created"
) -> Column:
    """The steps a row went through, as an array in lifecycle order.

    A step whose time is missing did not happen. Where the recorded status is not the
    one the times imply, a last step without a time leads to it.
    """
    listed = F.array(
        *[_struct(F.lit(i), F.lit(s), F.col(c)) for i, (c, s) in enumerate(steps)]
    )
    reached = F.filter(listed, lambda step: step["at"].isNotNull())
    if final_status is None:
        return reached
    no_time = F.when(F.lit(False), F.col(steps[0][0]))  # a NULL of the times' type
    last = _struct(F.lit(len(steps)), F.col(final_status), no_time)
    derived = F.coalesce(F.try_element_at(reached, F.lit(-1))["status"], F.lit(initial))
    agrees = F.col(final_status).eqNullSafe(derived)
    return F.when(agrees, reached).otherwise(F.concat(reached, F.array(last)))


def lifecycle_events(
    df: DataFrame,
    key: Sequence[str],
    steps: Sequence[tuple[str, str]],
    final_status: str | None = None,
    initial: str = "created",
) -> DataFrame:
    """One row per step: key, seq (1-based), status, at, is_terminal_hop, is_out_of_order.

    `is_out_of_order` marks a step timed before the previous one. Everything is decided
    inside the row, so the job has no shuffle.
    """
    listed = df.select(*key, lifecycle_steps(steps, final_status, initial).alias("_steps"))
    walked = F.transform(
        "_steps",
        lambda step, i: F.struct(
            (i + 1).cast("int").alias("seq"),
            step["status"].alias("status"),
            step["at"].alias("at"),
            (step["position"] == len(steps)).alias("is_terminal_hop"),
            F.coalesce(
                step["at"] < F.get(F.col("_steps"), i - 1)["at"], F.lit(False)
            ).alias("is_out_of_order"),
        ),
    )
    return listed.select(*key, F.inline(walked))


def terminal_time(updated_at: str, *times_latest_first: str) -> Column:
    """Business time of a step without its own: no earlier than the last known time."""
    return F.greatest(F.col(updated_at), F.coalesce(*[F.col(t) for t in times_latest_first]))


def out_of_order_count(events: DataFrame) -> DataFrame:
    """How many steps are timed before the step they follow."""
    return events.agg(F.count_if("is_out_of_order").alias("out_of_order"))


def transitions_by_status(events: DataFrame) -> DataFrame:
    """Number of steps into each status."""
    return events.groupBy("status").agg(F.count(F.lit(1)).alias("transitions"))


def rewind(
    df: DataFrame,
    status: str,
    later_times: Sequence[str],
    at: str,
    updated_at: str = "updated_at",
    initial: str = "created",
) -> DataFrame:
    """Rows as they were first written: initial status, later times unknown."""
    undone = {c: F.lit(None).cast(df.schema[c].dataType) for c in later_times}
    return df.withColumns({status: F.lit(initial), **undone, updated_at: F.col(at)})
