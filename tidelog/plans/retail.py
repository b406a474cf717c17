"""A retail source derived from the given order, item, part, supplier and event tables.

Integer arithmetic only, so that any engine derives the same rows. The wide tables hold
the end state; `messages` turns them into the change stream that leads there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import (
    changed_rows,
    by_heat,
    find_hot_keys,
    first_activity,
    lifecycle_steps,
    over_history,
    synthesize_history,
    synthesize_log,
    translate,
    unfold_states,
)
from tidelog.operators.changelog import POSITION
from tidelog.operators.ordered import ROWS_PER_CHUNK
from tidelog.schemas import FALLBACK_ANCHOR_MS, IMAGES, MONEY, TABLES
from tidelog.session import configure, scratch_dir
from tidelog.sources import append_log, decode_envelope, read_log, valid_events
from tidelog.sources.heavy import Heavy, heavy_keys

OBSERVED_FROM_MS = 1_100_000_000_000
LSN_FROM = 1_000_000

STEPS_MS = [
    ("approved_ms", "approved"),
    ("shipped_ms", "shipped"),
    ("delivered_ms", "delivered"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def image_fields(name: str) -> list[str]:
    return [f.split()[0] for f in IMAGES[name].split(", ")]


# --- wide source tables -------------------------------------------------------


# making the messages of so many orders, some 150,000, is work for one task
ORDERS_PER_TASK = 50_000


def spread(rows: DataFrame, per_task: int) -> DataFrame:
    """The same rows over as many tasks as their number asks for.

    A scan has no more tasks than its files have row groups. Counting reads footers only. Rows are
    cut along all their columns: near keys stay together, and equal ones, or none, come apart.
    """
    tasks = -(-rows.count() // per_task)
    return rows.repartitionByRange(tasks, *rows.columns) if tasks > 1 else rows


def orders_wide(spark: SparkSession, sf_dir: str, per_task: int | None = None) -> DataFrame:
    """One row per order with its lifecycle times (epoch millis) and final status.

    With `per_task` no task gets many more orders than that.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    if per_task:
        orders = spread(orders, per_task)
    return (
        orders.selectExpr(
            "o_orderkey AS k",
            "o_custkey AS c",
            "o_orderstatus AS s",
            "unix_millis(cast(o_orderdate AS timestamp)) + o_orderkey % 86400 * 1000 AS purchased_ms",
        )
        .selectExpr(
            "*",
            "CASE WHEN k % 50 <> 7 THEN purchased_ms + k % 4 * 3600000L END AS approved_ms",
            "CASE WHEN s IN ('F', 'P') AND k % 50 <> 7 "
            "THEN purchased_ms + (k % 7 - 1) * 86400000L + 7200000L END AS shipped_ms",
        )
        .selectExpr("*", "CASE WHEN s = 'F' THEN shipped_ms + k % 11 * 86400000L END AS delivered_ms")
        .selectExpr(
            "cast(k AS string) AS order_id",
            "concat('c', k) AS customer_id",
            "cast(c AS string) AS customer_unique_id",
            "k",
            "c",
            "purchased_ms",
            "approved_ms",
            "shipped_ms",
            "delivered_ms",
            "purchased_ms + 8 * 86400000L AS estimated_ms",
            "coalesce(delivered_ms, shipped_ms, approved_ms, purchased_ms) AS last_ms",
            """CASE WHEN k % 97 = 5 THEN 'canceled'
                    WHEN s = 'O' AND k % 89 = 3 THEN 'invoiced'
                    WHEN s = 'O' AND k % 83 = 2 THEN 'processing'
                    WHEN k % 100 = 57 THEN 'unavailable'
                    WHEN k % 50 = 7 THEN 'created'
                    WHEN s = 'F' THEN 'delivered'
                    WHEN s = 'P' THEN 'shipped'
                    ELSE 'approved' END AS final_status""",
        )
    )


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address on each order, by person and time of purchase."""
    moved = (F.col("c") % 10 == 0) & (F.col("k") % 4 == 0)
    zip_code = F.col("c") * 7 + F.when(moved, 1).otherwise(0)
    return (
        orders_wide(spark, sf_dir)
        .withColumn("z", zip_code)
        .select(
            "customer_unique_id",
            "order_id",
            "k",
            "purchased_ms",
            F.lpad(F.col("z").cast("string"), 8, "0").alias("zip_code_prefix"),
            F.concat(F.lit("city "), (F.col("z") % 50).cast("string")).alias("city"),
            F.lpad((F.col("z") % 27).cast("string"), 2, "0").alias("state"),
        )
    )


# all that an item says of a line: lines that tie in these make the same items, whichever is numbered first
ITEM_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


def raw_items(spark: SparkSession, sf_dir: str, key: str = "l_orderkey") -> DataFrame:
    """Order items, numbered within their order; money as text, like the CSV export.

    They lie by `key`, the order's number or its text `order_id`, for a join on the same.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *ITEM_ORDER)
    order_id = F.col("l_orderkey").cast("string").alias("order_id")
    if key == "order_id":
        lines, order_id = lines.withColumn("order_id", order_id), F.col("order_id")
    hot = find_hot_keys(lines, [key], ITEM_ORDER[:2])
    numbered = by_heat(
        lines,
        hot,
        lambda part, heat: over_history(part, [key], ITEM_ORDER, number="order_item_id", hot=heat),
    )
    cents = (F.col("l_partkey") * 37) % 5000
    return numbered.select(
        order_id,
        "order_item_id",
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("shipping_limit_ms"),
        F.col("l_extendedprice").cast(MONEY).cast("string").alias("price"),
        (cents.cast(MONEY) / 100).cast(MONEY).cast("string").alias("freight_value"),
        F.col("l_orderkey").alias("k"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed items with the purchase time of their order."""
    parents = orders_wide(spark, sf_dir).select("k", F.col("purchased_ms").alias("updated_ms"))
    return (
        raw_items(spark, sf_dir)
        .join(parents, "k")
        .select(
            "order_id",
            F.col("order_item_id").cast("smallint").alias("order_item_id"),
            "product_id",
            "seller_id",
            F.timestamp_millis("shipping_limit_ms").alias("shipping_limit_at"),
            F.col("price").cast(MONEY).alias("price"),
            F.col("freight_value").cast(MONEY).alias("freight_value"),
            F.timestamp_millis("updated_ms").alias("updated_at"),
            "k",
        )
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every category but one with its translation."""
    kinds = table(spark, sf_dir, "part").select("p_type").distinct().filter("p_type <> 'PROMO'")
    return kinds.select("p_type", F.lower("p_type").alias("english"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with the translation of their category."""
    key, size = F.col("p_partkey"), F.col("p_size")
    parts = table(spark, sf_dir, "part")
    translations = category_translation(spark, sf_dir)
    listed = parts.select(
        key.cast("string").alias("product_id"),
        F.when(key % 54 != 0, F.col("p_type")).alias("category_name"),
        F.when(key % 211 != 0, size * 100).alias("weight_g"),
        (size + 10).alias("length_cm"),
        (size + 5).alias("height_cm"),
        (size + 7).alias("width_cm"),
        F.timestamp_millis(F.lit(FALLBACK_ANCHOR_MS)).alias("updated_at"),
        key.alias("k"),
    )
    return translate(listed, translations, "category_name", "p_type", "english", "category_name_en")


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sellers, dated by the first order they served."""
    key = F.col("s_suppkey")
    listed = table(spark, sf_dir, "supplier").select(
        key.cast("string").alias("seller_id"),
        F.lpad((key * 13).cast("string"), 8, "0").alias("zip_code_prefix"),
        F.col("s_name").alias("city"),
        F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("state"),
        key.alias("k"),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
    )
    orders = orders_wide(spark, sf_dir).select(
        "order_id", F.timestamp_millis("purchased_ms").alias("purchased_at")
    )
    return first_activity(
        listed, lines, orders, "seller_id", "order_id", "purchased_at", "updated_at",
        FALLBACK_ANCHOR_MS,
    )


def export(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The wide tables in the shape of the CSV export."""

    def at(column: str, name: str) -> Column:
        return F.timestamp_millis(column).alias(name)

    visits = addresses(spark, sf_dir)
    measured = ["category_name", "weight_g", "length_cm", "height_cm", "width_cm"]
    return {
        "orders": orders_wide(spark, sf_dir).select(
            "order_id",
            "customer_id",
            F.col("final_status").alias("order_status"),
            at("purchased_ms", "order_purchase_timestamp"),
            at("approved_ms", "order_approved_at"),
            at("shipped_ms", "order_delivered_carrier_date"),
            at("delivered_ms", "order_delivered_customer_date"),
            at("estimated_ms", "order_estimated_delivery_date"),
        ),
        "customers": visits.select(
            F.concat(F.lit("c"), "order_id").alias("customer_id"),
            "customer_unique_id",
            *[F.col(c).alias(f"customer_{c}") for c in ("zip_code_prefix", "city", "state")],
        ),
        "order_items": raw_items(spark, sf_dir, "order_id")
        .withColumn("shipping_limit_date", F.timestamp_millis("shipping_limit_ms"))
        .drop("shipping_limit_ms", "k"),
        "products": products(spark, sf_dir).select(
            "product_id", *[F.col(c).alias(f"product_{c}") for c in measured]
        ),
        "sellers": sellers(spark, sf_dir).select(
            "seller_id",
            *[F.col(c).alias(f"seller_{c}") for c in ("zip_code_prefix", "city", "state")],
        ),
        "category_translation": category_translation(spark, sf_dir).select(
            F.col("p_type").alias("product_category_name"),
            F.col("english").alias("product_category_name_english"),
        ),
    }


# --- change messages ----------------------------------------------------------


def _order_state(seq: str, op: str, status: str, changed: str, reached: str) -> str:
    """SQL of one event; `reached` is the last lifecycle position the order has reached."""
    return f"""named_struct(
        'op', '{op}',
        'partition', 0,
        'lsn', CASE WHEN {seq} > 0 THEN {LSN_FROM} + k * 8 + {seq} END,
        'kafka_offset', k * 8 + {seq},
        'ts_ms', {OBSERVED_FROM_MS} + k * 8 + {seq},
        'tx_id', k,
        'order_id', order_id,
        'customer_id', customer_id,
        'customer_unique_id', customer_unique_id,
        'order_status', {status},
        'purchased_at', purchased_ms,
        'approved_at', CASE WHEN {reached} >= 0 THEN approved_ms END,
        'delivered_carrier_at', CASE WHEN {reached} >= 1 THEN shipped_ms END,
        'delivered_customer_at', CASE WHEN {reached} >= 2 THEN delivered_ms END,
        'estimated_delivery_at', estimated_ms,
        'updated_at', {changed})"""


def order_states(spark: SparkSession, sf_dir: str, deletes: bool = False) -> DataFrame:
    """Orders with the array of states they pass through, in commit order.

    The number of an event within its order is fixed by its kind, so the log positions
    of an order are known without looking at other rows.
    """
    step = _order_state(
        "(x.position + 1)", "u", "x.status", "coalesce(x.at, last_ms)", "x.position"
    )
    optional = [("k % 13 = 4", _order_state("5", "u", "final_status", "last_ms + 1000", "3"))]
    if deletes:
        optional += [
            ("k % 101 = 9", _order_state("6", "d", "final_status", "last_ms", "3")),
            ("k % 202 = 9", _order_state("7", "c", "'created'", "last_ms + 2000", "-1")),
        ]
    parts = [
        f"array({_order_state('0', 'r', "'created'", 'purchased_ms', '-1')})",
        f"transform(steps, x -> {step})",
        *[f"filter(array({state}), x -> {condition})" for condition, state in optional],
    ]
    walked = orders_wide(spark, sf_dir, ORDERS_PER_TASK).withColumn(
        "steps", lifecycle_steps(STEPS_MS, "final_status")
    )
    return walked.selectExpr(f"concat({', '.join(parts)}) AS states")


def _reads(rows: DataFrame, name: str, offset: Column) -> DataFrame:
    """Snapshot messages of a table whose rows never change."""
    image = [
        (F.unix_millis(c) if c.endswith("_at") else F.col(c)).alias(c) for c in image_fields(name)
    ]
    events = rows.select(
        F.lit("r").alias("op"),
        F.lit(None).cast("bigint").alias("lsn"),
        F.lit(0).alias("partition"),
        offset.alias("kafka_offset"),
        (offset + OBSERVED_FROM_MS).alias("ts_ms"),
        offset.alias("tx_id"),
        F.struct(*image).alias("now"),
    )
    return synthesize_log(events.withColumn("was", F.col("now")), name, image_fields(name))


def customer_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First known address as the snapshot, every later change of address as an update."""
    person, order = ["customer_unique_id"], ["purchased_ms", "k"]
    tracked = ["zip_code_prefix", "city", "state"]
    visits = addresses(spark, sf_dir)
    hot = find_hot_keys(visits, person, order)
    changes = changed_rows(visits, person, order, tracked, hot)
    first = F.col("prev_zip_code_prefix").isNull()
    events = changes.select(
        *person, "purchased_ms", "k", *tracked,
        F.when(first, "r").otherwise("u").alias("op"),
        F.lit(0).alias("partition"),
        F.when(~first, F.col("purchased_ms")).alias("lsn"),
        F.col("k").alias("kafka_offset"),
        (F.col("k") + OBSERVED_FROM_MS).alias("ts_ms"),
        F.col("k").alias("tx_id"),
        F.col("purchased_ms").alias("updated_at"),
    )
    return synthesize_history(events, "customer", image_fields("customer"), person, order, hot)


def table_messages(spark: SparkSession, sf_dir: str, name: str, deletes: bool = False) -> DataFrame:
    if name == "order":
        events = unfold_states(order_states(spark, sf_dir, deletes)).select(
            *[F.col("now")[c].alias(c) for c in POSITION], "now", "was"
        )
        return synthesize_log(events, "order", image_fields("order"))
    if name == "customer":
        return customer_messages(spark, sf_dir)
    if name == "order_item":
        items = order_items(spark, sf_dir).withColumn("price", F.col("price").cast("string"))
        items = items.withColumn("freight_value", F.col("freight_value").cast("string"))
        return _reads(items, name, F.col("k") * 2**24 + F.col("order_item_id"))
    if name == "product":
        return _reads(products(spark, sf_dir), name, F.col("k"))
    if name == "seller":
        return _reads(sellers(spark, sf_dir), name, F.col("k"))
    raise ValueError(f"unknown table {name}")


def messages(
    spark: SparkSession, sf_dir: str, names: Sequence[str] = TABLES, deletes: bool = False
) -> DataFrame:
    """The change stream of the given tables."""
    parts = [table_messages(spark, sf_dir, n, deletes) for n in names]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def event_log(
    spark: SparkSession, sf_dir: str, names: Sequence[str] = TABLES, deletes: bool = False
) -> dict[str, DataFrame]:
    """The decoded log by table, composed lazily."""
    return {
        n: valid_events(decode_envelope(table_messages(spark, sf_dir, n, deletes))) for n in names
    }


_landed: dict[tuple, str] = {}


def _landed_path(spark: SparkSession, sf_dir: str, name: str, deletes: bool) -> str:
    """The folder of a table's log, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name, deletes and name == "order")
    if key not in _landed:
        path = scratch_dir(spark, f"log-{name}")
        append_log(event_log(spark, sf_dir, [name], deletes)[name], path, batch_id=0)
        _landed[key] = path
    return _landed[key]


def landed_log(
    spark: SparkSession, sf_dir: str, names: Sequence[str] = TABLES, deletes: bool = False
) -> dict[str, DataFrame]:
    """The decoded log by table, written once per session below the shared scratch folder."""
    return {n: read_log(configure(spark), _landed_path(spark, sf_dir, n, deletes)) for n in names}


def landed_heavy(
    spark: SparkSession, sf_dir: str, names: Sequence[str] = TABLES, deletes: bool = False
) -> dict[str, Heavy]:
    """What the summaries of `landed_log` say of the keys whose history is ordered."""
    out: dict[str, Heavy] = {}
    for name in names:
        if name in ("customer", "order"):
            out |= heavy_keys(spark, _landed_path(spark, sf_dir, name, deletes), ROWS_PER_CHUNK)
    return out
