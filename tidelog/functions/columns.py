"""Column expressions of the change stream. All are built-in, code-generated SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.schemas import OP_NAMES, PRIMARY_KEYS

# --- fixed values: format of a surrogate key; the words for NULL must stay as they are ---
KEY_SEPARATOR = "-"
KEY_NULL = "_dbt_utils_surrogate_key_null_"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add expensive columns so that each is evaluated once per row.

    Spark moves a filter below the projection it reads from and repeats the projected
    expression in it; for parsed JSON that means parsing again for every reference. A
    filter on generated columns stays above the generator.
    """
    packed = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    names = [f"`{c}`" for c in df.columns]
    out = df.select(*names, F.explode(F.array(packed)).alias("_once"))
    return out.select(*names, *[F.col("_once")[name].alias(name) for name in columns])


def op_name(code: str | Column) -> Column:
    """Operation code to name; a code without a name passes unchanged."""
    code = _col(code)
    named = F.lit(None).cast("string")
    for short, name in OP_NAMES.items():
        named = F.when(code == short, name).otherwise(named)
    return F.coalesce(named, code)


def is_snapshot(flag: str | Column) -> Column:
    """True unless the flag is missing or false (JSON boolean or text)."""
    flag = _col(flag)
    return flag.isNotNull() & (flag != "false")


def has_image(image: str | Column) -> Column:
    """The image text, or NULL where it is absent or an empty object."""
    return F.nullif(_col(image), F.lit("{}"))


def payload(after: str | Column, before: str | Column) -> Column:
    """The image that identifies the row: `after`, on deletes `before`."""
    return F.coalesce(has_image(after), has_image(before))


def primary_key(
    table: str | Column,
    image: str | Column,
    keys: Mapping[str, Sequence[str]] = PRIMARY_KEYS,
) -> Column:
    """Business key as text, parts joined by `:`; NULL if a part or the table is unknown."""
    key = F.lit(None).cast("string")
    for name, cols in keys.items():
        # concat is NULL if any part is; concat_ws would skip the part
        pieces = [F.get_json_object(_col(image), f"$.{cols[0]}")]
        for part in cols[1:]:
            pieces += [F.lit(":"), F.get_json_object(_col(image), f"$.{part}")]
        key = F.when(_col(table) == name, F.concat(*pieces)).otherwise(key)
    return key


def event_time(millis: str | Column) -> Column:
    """Epoch milliseconds to an instant."""
    return F.timestamp_millis(_col(millis))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Second boundaries crossed between two instants (not elapsed whole seconds)."""
    return F.unix_seconds(_col(end)) - F.unix_seconds(_col(start))


def no_op_update(op: str | Column, tracked: Sequence[str], previous: str = "prev_") -> Column:
    """True for an update that left every tracked attribute as it was (NULL equals NULL)."""
    same = (F.col(c).eqNullSafe(F.col(previous + c)) for c in tracked)
    return reduce(lambda a, b: a & b, same, _col(op) == "update")


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the key parts as text."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def late_flag(delivered_at: str | Column, estimated_date: str | Column) -> Column:
    """Delivered after the estimated day; NULL, not false, while undelivered."""
    delivered = _col(delivered_at)
    return F.when(delivered.isNotNull(), delivered.cast("date") > _col(estimated_date))


def _both(a: Column, b: Column, test: Column) -> Column:
    return a.isNotNull() & b.isNotNull() & test


def timestamp_defects(purchased: str, approved: str, shipped: str, delivered: str) -> dict[str, Column]:
    """Flags for lifecycle times that contradict their order; false where a time is missing."""
    p, a, s, d = (F.col(c) for c in (purchased, approved, shipped, delivered))
    return {
        "is_approved_before_purchase": _both(a, p, a < p),
        "is_shipped_before_approved": _both(s, a, s < a),
        "is_delivered_before_shipped": _both(d, s, d < s),
        "is_approved_at_purchase_instant": _both(a, p, a == p),
    }
