"""Attribute changes between successive rows of a key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.ordered import HotKeys, by_heat, over_history


def _any(tests):
    return reduce(lambda a, b: a | b, tests)


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tracked: Sequence[str],
    hot: HotKeys | None = None,
) -> DataFrame:
    """Rows with their place in the key and the previous row's attributes (`prev_*`)."""
    lag = {f"prev_{c}": c for c in tracked}

    def build(part: DataFrame, heat: HotKeys | None) -> DataFrame:
        return over_history(part, keys, order, number="_row", lag=lag, hot=heat)

    return by_heat(df, hot, build)


def detect_changes(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tracked: Sequence[str],
    hot: HotKeys | None = None,
) -> DataFrame:
    """Rows whose known attributes differ from the key's previous row.

    The first tracked attribute must be known on the previous row, and an unknown value
    differs from nothing. A value that changes and changes back gives two rows.
    """
    rows = with_previous(df, keys, order, tracked, hot)
    differs = _any(F.col(c) != F.col(f"prev_{c}") for c in tracked)
    return rows.filter(F.col(f"prev_{tracked[0]}").isNotNull() & differs).drop("_row")


def changed_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tracked: Sequence[str],
    hot: HotKeys | None = None,
) -> DataFrame:
    """A key's first row and every row that differs from the one before (NULL equals NULL)."""
    rows = with_previous(df, keys, order, tracked, hot)
    differs = _any(~F.col(c).eqNullSafe(F.col(f"prev_{c}")) for c in tracked)
    return rows.filter((F.col("_row") == 1) | differs).drop("_row")
