"""The retail star schema, built from the event log.

Every model is a function of DataFrames. `MODELS` names its inputs and says whether it
is a view (composed lazily) or a table (written once).
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import event_time, late_flag, surrogate_key, timestamp_defects
from tidelog.operators import (
    ORDER,
    HotKeys,
    as_of_join,
    find_hot_facts,
    find_hot_keys,
    join_small,
    large_keys,
    latest_state,
    number_events,
    ordered_events,
    parent_join,
    scd2,
    stage_events,
    typed_images,
    with_duration,
)
from tidelog.operators.ordered import ROWS_PER_CHUNK
from tidelog.schemas import IMAGES, MONEY, UNKNOWN, UNMATCHED
from tidelog.sources.heavy import Heavy

ADDRESS = ["zip_code_prefix", "city", "state"]

# --- staging ----------------------------------------------------------------


def customer_events(log: DataFrame) -> DataFrame:
    """One typed row per customer change event."""
    staged = stage_events(log, "customer", "customer_unique_id", ADDRESS)
    return staged.select(
        "customer_unique_id", "op", "is_snapshot", "event_at", "changed_at",
        *ADDRESS, *[f"prev_{c}" for c in ADDRESS],
        "lsn", "kafka_offset", "tx_id", "is_no_op_update",
    )


def _order_times() -> list[Column]:
    return [
        event_time("purchased_at").alias("purchased_at"),
        event_time("approved_at").alias("approved_at"),
        event_time("delivered_carrier_at").alias("shipped_at"),
        event_time("delivered_customer_at").alias("delivered_at"),
        event_time("estimated_delivery_at").cast("date").alias("estimated_delivery_date"),
    ]


def order_events(log: DataFrame) -> DataFrame:
    """One typed row per order change event."""
    staged = stage_events(log, "order", "order_id", ["order_status"])
    return staged.select(
        "order_id", "customer_id", "customer_unique_id", "order_status", "prev_order_status",
        "op", "is_snapshot", "event_at", "changed_at", *_order_times(),
        "lsn", "kafka_offset", "tx_id", "is_no_op_update",
    )


def stg_customer_events(customer_events: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Customer change events, numbered per person."""
    return number_events(customer_events, "customer_unique_id", hot)


def stg_order_events(order_events: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Order change events, numbered per order."""
    return number_events(order_events, "order_id", hot)


def _live_images(log: DataFrame, table: str) -> DataFrame:
    """Newest images of live rows.

    Where the key of a model is one column it is taken from `pk`: rows lie by it already, and
    a later join on it needs no further shuffle. Pre-images are not read, and what is
    shuffled is the few typed columns a model needs, not the text of the image.
    """
    return latest_state(typed_images(ordered_events(log, table), IMAGES[table]), ["pk"], ORDER)


def stg_order_items(log: DataFrame) -> DataFrame:
    """Live order items."""
    return _live_images(log, "order_item").select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        F.col("price").cast(MONEY).alias("price"),
        F.col("freight_value").cast(MONEY).alias("freight_value"),
        event_time("shipping_limit_at").alias("shipping_limit_at"),
    )


def stg_products(log: DataFrame) -> DataFrame:
    """Live products."""
    return _live_images(log, "product").select(
        F.col("pk").alias("product_id"), "category_name", "category_name_en",
        "weight_g", "length_cm", "height_cm", "width_cm",
    )


def stg_sellers(log: DataFrame) -> DataFrame:
    """Live sellers."""
    return _live_images(log, "seller").select(F.col("pk").alias("seller_id"), *ADDRESS)


def int_orders_current(log: DataFrame) -> DataFrame:
    """Live orders in their newest state."""
    return _live_images(log, "order").select(
        F.col("pk").alias("order_id"), "customer_id", "customer_unique_id", "order_status", *_order_times(),
        event_time("event_ts_ms").alias("last_changed_at"),
    )


# --- dimensions --------------------------------------------------------------


def dim_customer(
    customer_events: DataFrame, hot: HotKeys | None = None, on_delete: str = "close"
) -> DataFrame:
    """Address history per person, not per order alias."""
    key = "customer_unique_id"
    versions = scd2(customer_events, [key], ORDER, on_delete=on_delete, hot=hot)
    return versions.select(
        surrogate_key(key, "version").alias("customer_key"),
        key, "version", *ADDRESS, "valid_from", "valid_to", "is_current", "is_deleted",
        "has_history", F.col("event_at").alias("cdc_observed_at"),
    )


def dim_order_status_history(
    order_events: DataFrame, hot: HotKeys | None = None, on_delete: str = "close"
) -> DataFrame:
    """Status history per order, its windows clamped so that none runs backwards."""
    key = "order_id"
    versions = scd2(order_events, [key], ORDER, clamp=True, on_delete=on_delete, hot=hot)
    defects = timestamp_defects("purchased_at", "approved_at", "shipped_at", "delivered_at")
    return with_duration(versions).select(
        surrogate_key(key, "version").alias("order_status_key"),
        key, "customer_unique_id", "version", "order_status", "prev_order_status",
        "valid_from", "valid_to", "is_current", "is_deleted", "seconds_in_status",
        "is_instantaneous", "is_timestamp_clamped",
        F.col("changed_at").alias("raw_changed_at"), F.col("event_at").alias("cdc_observed_at"),
        "purchased_at", "approved_at", "shipped_at", "delivered_at",
        *[flag.alias(name) for name, flag in defects.items()],
        F.col("total_versions").alias("total_status_versions"),
    )


def dim_product(stg_products: DataFrame) -> DataFrame:
    """Products; those without a category are kept as unknown."""
    return stg_products.select(
        surrogate_key("product_id").alias("product_key"),
        "product_id",
        F.coalesce("category_name", F.lit(UNKNOWN)).alias("category_name"),
        F.coalesce("category_name_en", F.lit(UNKNOWN)).alias("category_name_en"),
        F.col("category_name").isNull().alias("is_category_missing"),
        "weight_g", "length_cm", "height_cm", "width_cm",
    )


def dim_seller(stg_sellers: DataFrame) -> DataFrame:
    """Sellers; their attributes never change, so there is no history."""
    return stg_sellers.select(
        surrogate_key("seller_id").alias("seller_key"), "seller_id", *ADDRESS
    )


# --- facts -------------------------------------------------------------------


def _item_totals(items: DataFrame, busy: DataFrame | None) -> DataFrame:
    """Counts and money of each order's items.

    Sellers and products are gathered as sets, deduplicated in every task before the one
    shuffle. The sets of an order with very many items (`busy`) could outgrow a task: those
    are counted by shuffling their distinct values.
    """

    def totals(part: DataFrame, distinct: Callable[[str], Column]) -> DataFrame:
        return part.groupBy("order_id").agg(
            F.count(F.lit(1)).alias("item_count"),
            distinct("seller_id").alias("seller_count"),
            distinct("product_id").alias("product_count"),
            F.sum("price").alias("gross_price"),
            F.sum("freight_value").alias("gross_freight"),
            F.sum(F.col("price") + F.col("freight_value")).alias("order_total"),
            F.lit(True).alias("_has_items"),
        )

    def in_set(column: str) -> Column:
        return F.size(F.collect_set(column)).cast("bigint")

    if busy is None:
        return totals(items, in_set)
    few, many = (join_small(items, busy, ["order_id"], how) for how in ("left_anti", "left_semi"))
    return totals(few, in_set).unionByName(totals(many, F.countDistinct))


def fct_orders(
    int_orders_current: DataFrame,
    stg_order_items: DataFrame,
    dim_order_status_history: DataFrame,
    busy_orders: DataFrame | None = None,
) -> DataFrame:
    """One row per live order, with or without items."""
    items = _item_totals(stg_order_items, busy_orders)
    history = dim_order_status_history.groupBy("order_id").agg(
        F.max("total_status_versions").alias("status_versions"),
        F.count_if("is_shipped_before_approved").alias("_inverted"),
        F.count_if("is_approved_at_purchase_instant").alias("_instant"),
    )

    def count_or_zero(name: str):
        return F.coalesce(name, F.lit(0)).alias(name)

    delivered = F.col("delivered_at")
    days = F.datediff(delivered.cast("date"), F.col("purchased_at").cast("date"))
    joined = int_orders_current.join(items, "order_id", "left").join(history, "order_id", "left")
    return joined.select(
        "order_id", "customer_unique_id", "order_status",
        "purchased_at", "approved_at", "shipped_at", "delivered_at", "estimated_delivery_date",
        F.col("purchased_at").cast("date").alias("purchased_date"),
        count_or_zero("item_count"), count_or_zero("seller_count"),
        count_or_zero("product_count"),
        "gross_price", "gross_freight", "order_total", "status_versions",
        F.col("_has_items").isNull().alias("is_missing_items"),
        F.col("order_status").isin("delivered").alias("is_delivered"),
        F.col("order_status").isin("canceled", "unavailable").alias("is_terminated"),
        late_flag("delivered_at", "estimated_delivery_date").alias("is_delivered_late"),
        F.when(delivered.isNotNull(), days).alias("days_to_deliver"),
        (F.coalesce("_inverted", F.lit(0)) > 0).alias("has_inverted_timestamps"),
        (F.coalesce("_instant", F.lit(0)) > 0).alias("has_instant_approval"),
    )


def orders_with_customer_version(
    int_orders_current: DataFrame,
    dim_customer: DataFrame,
    strategy: str = "range",
    hot: HotKeys | None = None,
    key: str = "customer_key",
) -> DataFrame:
    """Live orders with the customer version valid when the order was placed."""
    versions = dim_customer.withColumnRenamed("version", "customer_version")
    return as_of_join(
        int_orders_current,
        versions,
        "customer_unique_id",
        "purchased_at",
        [key, "customer_version"],
        strategy=strategy,
        hot=hot,
    )


def _light(dim: DataFrame, key: str, *parts: str) -> DataFrame:
    """The key under `_<key>`: empty where it is the digest of `parts`, else as it is."""
    usual = F.col(key).eqNullSafe(surrogate_key(*parts))
    return dim.withColumn(f"_{key}", F.when(usual, "").otherwise(F.concat(F.lit("="), key))).drop(key)


def _full(light: str, *parts: str) -> Column:
    """The key that `_light` stands for; NULL where no row was met."""
    return F.when(F.col(light) == "", surrogate_key(*parts)).otherwise(F.substr(light, F.lit(2)))


def fct_order_items(
    stg_order_items: DataFrame,
    int_orders_current: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    hot_facts: HotKeys | None = None,
    busy_orders: DataFrame | None = None,
) -> DataFrame:
    """One row per item of a live order, tied to the address at purchase time.

    The as-of join runs on orders, before they meet their more numerous items. Items find
    their product and seller before their order: those joins shuffle them, so Spark splits a
    popular one itself, and without the order's columns they are half as wide. Orders may
    already lie by their key, without a shuffle to split, hence `busy_orders`. Keys are digests,
    which nothing packs: those that follow from other columns are made after the last join.
    """
    people = _light(dim_customer, "customer_key", "customer_unique_id", "version")
    orders = orders_with_customer_version(int_orders_current, people, hot=hot_facts, key="_customer_key")
    products = _light(dim_product.select("product_id", "product_key"), "product_key", "product_id")
    shops = _light(dim_seller.select("seller_id", "seller_key"), "seller_key", "seller_id")
    items = stg_order_items.join(products, "product_id", "left").join(shops, "seller_id", "left")
    joined = parent_join(items, orders, "order_id", busy=busy_orders)
    joined = joined.withColumns(
        {
            "product_key": _full("_product_key", "product_id"),
            "seller_key": _full("_seller_key", "seller_id"),
            "customer_key": _full("_customer_key", "customer_unique_id", "customer_version"),
        }
    )
    return joined.select(
        surrogate_key("order_id", "order_item_id").alias("order_item_key"),
        "order_id", "order_item_id",
        F.coalesce("customer_key", F.lit(UNMATCHED)).alias("customer_key"),
        "product_key", "seller_key", "customer_unique_id", "order_status",
        "price", "freight_value",
        (F.col("price") + F.col("freight_value")).alias("item_total"),
        "purchased_at", "approved_at", "shipped_at", "delivered_at", "estimated_delivery_date",
        F.col("purchased_at").cast("date").alias("purchased_date"),
        late_flag("delivered_at", "estimated_delivery_date").alias("is_delivered_late"),
        F.col("customer_key").isNull().alias("is_customer_version_unmatched"),
    )


# --- models by name ----------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """`build` takes the inputs in order, or the log's rows of `source` if there are none.

    A model ordered along a key's history names the table whose keys may be hot in
    `hot_table`, and the key's column.
    """

    build: Callable[..., DataFrame]
    inputs: tuple[str, ...] = ()
    materialized: str = "table"
    source: str | None = None
    hot_table: str | None = None
    hot_key: str | None = None


PERSON, ORDER_ID = ("customer", "customer_unique_id"), ("order", "order_id")

# Inputs come before the models that read them.
MODELS: dict[str, Model] = {
    "customer_events": Model(customer_events, (), "view", "customer"),
    "order_events": Model(order_events, (), "view", "order"),
    "stg_customer_events": Model(
        stg_customer_events, ("customer_events",), "view", None, *PERSON
    ),
    "stg_order_events": Model(stg_order_events, ("order_events",), "view", None, *ORDER_ID),
    "stg_order_items": Model(stg_order_items, (), "view", "order_item"),
    "stg_products": Model(stg_products, (), "view", "product"),
    "stg_sellers": Model(stg_sellers, (), "view", "seller"),
    "int_orders_current": Model(int_orders_current, (), "view", "order"),
    "dim_customer": Model(dim_customer, ("customer_events",), "table", None, *PERSON),
    "dim_order_status_history": Model(
        dim_order_status_history, ("order_events",), "table", None, *ORDER_ID
    ),
    "dim_product": Model(dim_product, ("stg_products",)),
    "dim_seller": Model(dim_seller, ("stg_sellers",)),
    "fct_orders": Model(
        fct_orders, ("int_orders_current", "stg_order_items", "dim_order_status_history")
    ),
    "fct_order_items": Model(
        fct_order_items,
        (
            "stg_order_items",
            "int_orders_current",
            "dim_customer",
            "dim_product",
            "dim_seller",
        ),
    ),
}


@dataclass
class Marts:
    """The models over one event log; `ref` resolves a model by name.

    `log` is the whole log or a mapping from table to its part. With `path`, tables are
    written there as Parquet the first time they are needed and read back; without, all
    models are composed lazily. With `store_views` the staged views are written as well:
    several models and checks read them, and each reading would decode the JSON images
    again. `stored` names the models to write instead. `on_delete` is passed to the history dimensions. `heavy` (see `heavy_keys`) saves
    counting all keys.
    """

    log: DataFrame | Mapping[str, DataFrame]
    path: str | None = None
    rows_per_chunk: int = ROWS_PER_CHUNK
    on_delete: str = "close"
    store_views: bool = False
    heavy: Mapping[str, Heavy] = field(default_factory=dict)
    stored: Collection[str] | None = None
    _built: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    _hot: dict[str, HotKeys | DataFrame | None] = field(default_factory=dict, repr=False)

    def source(self, table: str) -> DataFrame:
        part = self.log if isinstance(self.log, DataFrame) else self.log[table]
        return part.filter(F.col("source_table") == table)

    def hot_keys(self, table: str) -> HotKeys | None:
        """Keys with too many events for one task; measured once per table.

        Where the log's summaries name all that can be, no others are counted.
        """
        if table not in self._hot:
            events = ordered_events(self.source(table), table)
            known = self.heavy.get(table)
            if known is not None and known.sure and known.limit <= self.rows_per_chunk:
                among = known.among(events.sparkSession, "pk") if known.keys else None
                hot = among and find_hot_keys(events, ["pk"], ORDER, self.rows_per_chunk, among)
            else:
                hot = find_hot_keys(events, ["pk"], ORDER, self.rows_per_chunk)
            self._hot[table] = hot
        return self._hot[table]

    def ref(self, name: str) -> DataFrame:
        if name not in self._built:
            frame = self._compose(name)
            if self.path and self._is_stored(name):
                target = f"{self.path.rstrip('/')}/{name}"
                # keys are digests in hex, which only an entropy coder makes smaller
                frame.write.mode("overwrite").option("compression", "zstd").parquet(target)
                frame = frame.sparkSession.read.parquet(target)
            self._built[name] = frame
        return self._built[name]

    def _is_stored(self, name: str) -> bool:
        if self.stored is not None:
            return name in self.stored
        return self.store_views or MODELS[name].materialized == "table"

    def use(self, name: str, frame: DataFrame) -> None:
        """Take a model that is already built."""
        self._built[name] = frame

    def create_views(self, *names: str) -> None:
        """Register models as temporary views for SQL users."""
        for name in names or MODELS:
            self.ref(name).createOrReplaceTempView(name)

    def _compose(self, name: str) -> DataFrame:
        model = MODELS[name]
        if not model.inputs:
            return model.build(self.source(model.source))
        options = {}
        if model.hot_table:
            hot = self.hot_keys(model.hot_table)
            options["hot"] = hot and hot.named(model.hot_key)
        if name in ("dim_customer", "dim_order_status_history"):
            options["on_delete"] = self.on_delete
        if name == "fct_order_items":
            options["hot_facts"] = self.hot_facts()
        if name in ("fct_orders", "fct_order_items"):
            options["busy_orders"] = self.busy_orders()
        return model.build(*[self.ref(i) for i in model.inputs], **options)

    def busy_orders(self) -> DataFrame | None:
        """Orders with too many items for one task; measured once."""
        if "busy" not in self._hot:
            order_id = F.split_part("pk", F.lit(":"), F.lit(1)).alias("order_id")
            items = self.source("order_item").select(order_id)
            self._hot["busy"] = large_keys(items, ["order_id"], self.rows_per_chunk)
        return self._hot["busy"]

    def hot_facts(self) -> HotKeys | None:
        """Customers with too many orders and versions for one task; measured once."""
        if "facts" not in self._hot:
            self._hot["facts"] = self._find_hot_facts()
        return self._hot["facts"]

    def _find_hot_facts(self) -> HotKeys | None:
        orders, customers = self.ref("int_orders_current"), self.ref("dim_customer")
        return find_hot_facts(orders, customers, "customer_unique_id", "purchased_at")
