"""The registered queries: every operator, model and check over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import quality as q
from tidelog.operators import (
    ORDER,
    as_of_join,
    changed_rows,
    detect_changes,
    find_hot_facts,
    find_hot_keys,
    first_state,
    hash_sample,
    latest_state,
    lifecycle_events,
    newest_event,
    out_of_order_count,
    rewind,
    scd2,
    terminal_time,
    transitions_by_status,
)
from tidelog.operators.ordered import ROWS_PER_CHUNK
from tidelog.plans import marts as m
from tidelog.plans import replay, retail
from tidelog.plans.kept import KEPT
from tidelog.plans.marts import ADDRESS, MODELS, Marts
from tidelog.quality import contracts
from tidelog.quality.logs import union_all
from tidelog.quality.totals import RANK_ERROR, total_drift
from tidelog.schemas import CSV_TABLES, MESSAGE, ORDER_STATUSES, TABLES
from tidelog.session import scratch_dir
from tidelog.sources import (
    append_log,
    compact_log,
    decode_envelope,
    load_summary,
    quarantined,
    read_csv,
    read_log,
    valid_events,
    write_messages,
)
from tidelog.sources.log import commit_events, rebuild, write_events
from tidelog.streaming import (
    Kept,
    follow_log,
    rebuild_log,
    tail,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query; its result is made comparable across engines."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


def portable(df: DataFrame) -> DataFrame:
    """Times as epoch millis, dates as text, money as double, integers as bigint if they are no wider."""
    out = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            column = F.unix_millis(column)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.DecimalType) and field.dataType.scale:
            column = column.cast("double")
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        out.append(column.alias(field.name))
    return df.select(*out)


def _marts(spark, sf_dir, names=TABLES, deletes=False, **options) -> Marts:
    log = retail.landed_log(spark, sf_dir, names, deletes)
    return Marts(log, heavy=retail.landed_heavy(spark, sf_dir, names, deletes), **options)


def _shared(spark, sf_dir, *stored, **options) -> Marts:
    """Models of which those that others read several times are written once, not decoded each time."""
    return _marts(spark, sf_dir, path=scratch_dir(spark, "marts"), stored=stored, **options)


def _order_log(spark, sf_dir) -> DataFrame:
    """Order events with deletes and re-inserted keys."""
    return retail.landed_log(spark, sf_dir, ["order"], deletes=True)["order"]


def _whole_log(spark, sf_dir) -> DataFrame:
    return contracts.whole_log(_marts(spark, sf_dir, deletes=True))


def _k(column: str = "order_id"):
    return F.col(column).cast("bigint")


# --- flagship ------------------------------------------------------------------


@query
def revenue_by_version_address(spark, sf_dir):
    """Revenue by the state customers lived in when they ordered, not where they live now."""
    marts = _marts(spark, sf_dir)
    address = marts.ref("dim_customer").select("customer_key", "state", "is_current")
    return (
        marts.ref("fct_order_items")
        .join(address, "customer_key", "left")
        .groupBy("state")
        .agg(
            F.count(F.lit(1)).alias("items"),
            F.count_if(~F.col("is_current")).alias("items_at_former_address"),
            F.sum("price").alias("revenue"),
            F.sum("freight_value").alias("freight"),
        )
    )


# --- sources and decoding --------------------------------------------------------


@query
def log_summary(spark, sf_dir):
    summary = load_summary(_whole_log(spark, sf_dir))
    return summary.select(
        F.coalesce("source_table", F.lit("(all)")).alias("source_table"),
        F.coalesce("op", F.lit("(all)")).alias("op"),
        "events",
    )


@query
def log_primary_keys(spark, sf_dir):
    return _whole_log(spark, sf_dir).select("source_table", "pk", "kafka_offset")


@query
def decoded_order_messages(spark, sf_dir):
    decoded = decode_envelope(retail.table_messages(spark, sf_dir, "order", deletes=True))
    return valid_events(decoded).select(
        "source_table", "op", "lsn", "tx_id", "event_ts_ms", "is_snapshot", "topic",
        "kafka_offset", "pk",
        F.get_json_object("before", "$.order_status").alias("status_before"),
        F.get_json_object("after", "$.order_status").alias("status_after"),
    )


def _rejected(spark, sf_dir) -> DataFrame:
    """Order messages with planted faults, as they lie in the quarantine."""
    fault = F.when(F.col("kafka_offset") % 8 == 0, F.floor(F.col("kafka_offset") / 8) % 500)
    value = F.col("value")
    broken = (
        F.when(fault == 1, F.expr("substring(value, 1, length(value) div 2)"))
        .when(fault == 2, F.replace(value, F.lit('"op":"r"'), F.lit('"code":"r"')))
        .when(fault == 3, F.replace(value, F.lit('"table":"order"'), F.lit('"table":"other"')))
        .when(fault == 4, F.lit(None).cast("string"))
        .when(fault == 5, F.replace(value, F.lit('"order_id"'), F.lit('"number"')))
        .when(fault == 6, F.regexp_replace(value, r'"after":\{.*\}\}$', '"after":{}}'))
        .when(fault == 7, F.replace(value, F.lit('"ts_ms"'), F.lit('"ts"')))
        .when(fault == 8, F.replace(value, F.lit('"table":"order"'), F.lit('"name":"order"')))
        .otherwise(value)
    )
    messages = retail.table_messages(spark, sf_dir, "order", deletes=True)
    return quarantined(decode_envelope(messages.withColumn("value", broken)))


@query
def rejected_messages(spark, sf_dir):
    """Messages with planted faults: what was quarantined, and why."""
    return _rejected(spark, sf_dir).select("problem", "kafka_offset")


@query
def gate_with_quarantine(spark, sf_dir):
    """What the gate counts where messages were quarantined."""
    return contracts.quarantine_check(q.Suite(), _rejected(spark, sf_dir)).counts()


def _export_orders(spark, sf_dir) -> DataFrame:
    return retail.orders_wide(spark, sf_dir).select(
        F.lpad("order_id", 10, "0").alias("order_id"),
        "customer_id",
        F.col("final_status").alias("order_status"),
        *[
            F.timestamp_millis(ms).alias(name)
            for ms, name in [
                ("purchased_ms", "order_purchase_timestamp"),
                ("approved_ms", "order_approved_at"),
                ("shipped_ms", "order_delivered_carrier_date"),
                ("delivered_ms", "order_delivered_customer_date"),
                ("estimated_ms", "order_estimated_delivery_date"),
            ]
        ],
    )


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).option("quoteAll", True).csv(path)


@query
def csv_orders(spark, sf_dir):
    """The wide orders written as CSV with a header and read back with a stated schema."""
    path = scratch_dir(spark, "csv")
    _write_csv(_export_orders(spark, sf_dir), path)
    return read_csv(spark, path, CSV_TABLES["orders"])


@query
def csv_mixed_headers(spark, sf_dir):
    """The same, where half of the files have their columns in another order."""
    orders, path = _export_orders(spark, sf_dir), scratch_dir(spark, "csv")
    odd = F.col("order_id").cast("bigint") % 2 == 1
    _write_csv(orders.where(odd).select(*reversed(orders.columns)), path)
    _write_csv(orders.where(~odd), path)
    return read_csv(spark, path, CSV_TABLES["orders"])


# --- staging and current state -----------------------------------------------------


@query
def stg_customer_events(spark, sf_dir):
    return _marts(spark, sf_dir, ["customer"]).ref("stg_customer_events")


@query
def stg_order_events(spark, sf_dir):
    return _marts(spark, sf_dir, ["order"], deletes=True).ref("stg_order_events")


@query
def stg_order_items(spark, sf_dir):
    return _marts(spark, sf_dir, ["order_item"]).ref("stg_order_items")


@query
def stg_products(spark, sf_dir):
    return _marts(spark, sf_dir, ["product"]).ref("stg_products")


@query
def stg_sellers(spark, sf_dir):
    return _marts(spark, sf_dir, ["seller"]).ref("stg_sellers")


@query
def int_orders_current(spark, sf_dir):
    return _marts(spark, sf_dir, ["order"], deletes=True).ref("int_orders_current")


@query
def latest_state_agg(spark, sf_dir):
    """Live orders by status, through the aggregate form."""
    events = m.order_events(_order_log(spark, sf_dir))
    live = latest_state(events, ["order_id"], ORDER, form="aggregate")
    return live.select("order_id", "order_status", "lsn", "kafka_offset")


@query
def latest_state_resurrected(spark, sf_dir):
    """Orders that were deleted at some time: are they live, and in what state."""
    events = m.order_events(_order_log(spark, sf_dir))
    deleted = events.filter("op = 'delete'").groupBy("order_id").agg(F.count("*").alias("deletes"))
    newest = newest_event(events, ["order_id"], ORDER)
    return newest.join(deleted, "order_id").select(
        "order_id", "deletes", (F.col("op") != "delete").alias("is_live"), "order_status"
    )


# --- history -----------------------------------------------------------------------


@query
def dim_customer(spark, sf_dir):
    return _marts(spark, sf_dir, ["customer"]).ref("dim_customer")


@query
def dim_order_status_history(spark, sf_dir):
    return _marts(spark, sf_dir, ["order"]).ref("dim_order_status_history")


def _status_versions(dim: DataFrame) -> DataFrame:
    return dim.select(
        "order_id", "version", "order_status", "valid_from", "valid_to", "is_current",
        "is_deleted", "seconds_in_status", "is_timestamp_clamped", "total_status_versions",
    )


@query
def scd2_on_delete_close(spark, sf_dir):
    marts = _marts(spark, sf_dir, ["order"], deletes=True)
    return _status_versions(marts.ref("dim_order_status_history"))


@query
def scd2_on_delete_keep(spark, sf_dir):
    marts = _marts(spark, sf_dir, ["order"], deletes=True, on_delete="keep")
    return _status_versions(marts.ref("dim_order_status_history"))


def _user_events(spark, sf_dir, busy: bool = False) -> DataFrame:
    """Events per user; if `busy`, one user owns the events of every third."""
    user = F.col("user_id")
    owner = F.when(user % 3 == 0, 0).otherwise(user) if busy else user
    return retail.table(spark, sf_dir, "events").select(
        owner.cast("bigint").alias("user_id"),
        "event_id",
        F.col("ts").cast("timestamp").alias("at"),
        "event_type",
    )


USER, EVENT = ["user_id"], ["event_id"]


def _user_history(events: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    hot = find_hot_keys(events, USER, EVENT, rows_per_chunk)
    changes = changed_rows(events, USER, EVENT, ["event_type"], hot)
    return scd2(changes, USER, EVENT, "at", on_delete="keep", hot=hot)


def _user_versions(versions: DataFrame) -> DataFrame:
    return versions.select(
        "user_id", "version", "event_type", "is_current", "has_history", "total_versions",
        F.unix_micros("valid_from").alias("valid_from_us"),
        F.unix_micros("valid_to").alias("valid_to_us"),
    )


@query
def user_state_history(spark, sf_dir):
    return _user_versions(_user_history(_user_events(spark, sf_dir)))


@query
def user_state_history_hot_key(spark, sf_dir):
    """One user holds a third of all events and is cut into chunks."""
    events = _user_events(spark, sf_dir, busy=True)
    return _user_versions(_user_history(events, events.count() // 20))


# --- dimensions and facts --------------------------------------------------------------


@query
def dim_product(spark, sf_dir):
    return _marts(spark, sf_dir, ["product"]).ref("dim_product")


@query
def dim_seller(spark, sf_dir):
    return _marts(spark, sf_dir, ["seller"]).ref("dim_seller")


@query
def fct_orders(spark, sf_dir):
    return _marts(spark, sf_dir).ref("fct_orders")


@query
def fct_orders_after_deletes(spark, sf_dir):
    return _marts(spark, sf_dir, deletes=True).ref("fct_orders")


@query
def fct_order_items(spark, sf_dir):
    return _marts(spark, sf_dir).ref("fct_order_items")


def _as_of(spark, sf_dir, strategy) -> DataFrame:
    marts = _marts(spark, sf_dir, ["order", "customer"])
    orders = marts.ref("int_orders_current").select(
        "order_id", "customer_unique_id", "purchased_at"
    )
    return m.orders_with_customer_version(orders, marts.ref("dim_customer"), strategy)


@query
def as_of_join_range(spark, sf_dir):
    return _as_of(spark, sf_dir, "range")


@query
def as_of_join_window(spark, sf_dir):
    return _as_of(spark, sf_dir, "window")


def _state_at_event(spark, sf_dir, strategy) -> DataFrame:
    """The state version every event falls into; one user holds a third of the events."""
    events = _user_events(spark, sf_dir, busy=True)
    limit = events.count() // 20
    history = _user_history(events, limit).select(
        "user_id", "version", F.col("event_type").alias("state"), "valid_from", "valid_to"
    )
    facts = events.select("user_id", "event_id", "at")
    hot = find_hot_facts(facts, history, "user_id", "at", limit)
    joined = as_of_join(
        facts, history, "user_id", "at", ["version", "state"], strategy=strategy, hot=hot
    )
    return joined.select("user_id", "event_id", "version", "state")


@query
def as_of_join_range_hot_key(spark, sf_dir):
    return _state_at_event(spark, sf_dir, "range")


@query
def as_of_join_window_hot_key(spark, sf_dir):
    return _state_at_event(spark, sf_dir, "window")


# --- change events from wide tables ---------------------------------------------------


def _lifecycle(spark, sf_dir) -> DataFrame:
    orders = retail.orders_wide(spark, sf_dir)
    return lifecycle_events(orders, ["order_id"], retail.STEPS_MS, "final_status")


@query
def lifecycle(spark, sf_dir):
    return _lifecycle(spark, sf_dir).withColumnRenamed("at", "at_ms")


@query
def terminal_hops(spark, sf_dir):
    """Steps without a time of their own, with the business time they are given."""
    updated = F.coalesce("delivered_ms", "shipped_ms", "approved_ms", "purchased_ms")
    orders = retail.orders_wide(spark, sf_dir).withColumn("updated_ms", updated)
    keep = ["order_id", "updated_ms", "delivered_ms", "shipped_ms", "approved_ms", "purchased_ms"]
    hops = lifecycle_events(orders, keep, retail.STEPS_MS, "final_status").filter("is_terminal_hop")
    at = terminal_time("updated_ms", "delivered_ms", "shipped_ms", "approved_ms", "purchased_ms")
    return hops.select("order_id", "seq", "status", at.alias("at_ms"))


@query
def out_of_order_steps(spark, sf_dir):
    return out_of_order_count(_lifecycle(spark, sf_dir))


@query
def transitions_per_status(spark, sf_dir):
    return transitions_by_status(_lifecycle(spark, sf_dir))


PERSON, VISITS = ["customer_unique_id"], ["purchased_ms", "k"]


@query
def address_changes(spark, sf_dir):
    visits = retail.addresses(spark, sf_dir)
    hot = find_hot_keys(visits, PERSON, VISITS)
    changes = detect_changes(visits, PERSON, VISITS, ADDRESS, hot)
    return changes.select(*PERSON, *ADDRESS, "purchased_ms").orderBy("purchased_ms")


@query
def initial_customers(spark, sf_dir):
    first = first_state(retail.addresses(spark, sf_dir), PERSON, VISITS)
    return first.select(*PERSON, *ADDRESS, F.col("purchased_ms").alias("updated_ms"))


@query
def seller_anchor(spark, sf_dir):
    return retail.sellers(spark, sf_dir).drop("k")


@query
def product_translation(spark, sf_dir):
    return retail.products(spark, sf_dir).drop("k")


@query
def orders_rewound(spark, sf_dir):
    orders = retail.orders_wide(spark, sf_dir).withColumnRenamed("final_status", "order_status")
    later = ["approved_ms", "shipped_ms", "delivered_ms"]
    rewound = rewind(orders, "order_status", later, "purchased_ms", "updated_ms")
    return rewound.select(
        "order_id", "customer_id", "customer_unique_id", "order_status", "purchased_ms", *later,
        "estimated_ms", "updated_ms",
    )


@query
def rewound_not_created(spark, sf_dir):
    """Statuses in the initial state that differ from it before rewinding, and after."""
    orders = retail.orders_wide(spark, sf_dir).withColumnRenamed("final_status", "order_status")
    later = ["approved_ms", "shipped_ms", "delivered_ms"]
    before = q.accepted_values(orders, "order_status", ["created"])
    after = q.accepted_values(
        rewind(orders, "order_status", later, "purchased_ms", "updated_ms"),
        "order_status",
        ["created"],
    )
    return union_all(
        [
            f.agg(F.count(F.lit(1)).alias("not_created")).select(F.lit(n).alias("state"), "not_created")
            for n, f in [("before", before), ("after", after)]
        ]
    )


@query
def items_initial(spark, sf_dir):
    return retail.order_items(spark, sf_dir).drop("k")


@query
def hash_sample_10pct(spark, sf_dir):
    return hash_sample(retail.orders_wide(spark, sf_dir), "order_id", 10).select(
        "order_id", "final_status"
    )


@query
def status_distribution_drift(spark, sf_dir):
    """Statuses of the live orders against those of the source, which still has all."""
    live = _marts(spark, sf_dir, ["order"], deletes=True).ref("int_orders_current")
    source = retail.orders_wide(spark, sf_dir).withColumnRenamed("final_status", "order_status")
    return q.distribution_drift(live, source, "order_status").orderBy(F.desc("actual"))


@query
def status_total_drift(spark, sf_dir):
    return total_drift(status_distribution_drift(spark, sf_dir))


def _replayed(spark, sf_dir, names=TABLES) -> Marts:
    """Models over the messages that lead from the export's initial to its end state."""
    export, log = retail.export(spark, sf_dir), {}
    for name in names:
        path = scratch_dir(spark, f"replayed-{name}")
        append_log(valid_events(decode_envelope(replay.change_messages(export, name))), path, 0)
        log[name] = read_log(spark, path)
    return Marts(log, path=scratch_dir(spark, "marts"), stored=["int_orders_current"])


@query
def replayed_status_history(spark, sf_dir):
    return _status_versions(_replayed(spark, sf_dir, ["order"]).ref("dim_order_status_history"))


@query
def replayed_customer_history(spark, sf_dir):
    dim = _replayed(spark, sf_dir, ["customer"]).ref("dim_customer")
    return dim.drop("cdc_observed_at")


@query
def replayed_items(spark, sf_dir):
    items = _replayed(spark, sf_dir).ref("fct_order_items")
    return items.select(
        "order_item_key", "order_id", "order_item_id", "customer_key", "product_key",
        "seller_key", "order_status", "item_total", "purchased_at",
    )


@query
def replayed_status_drift(spark, sf_dir):
    """No drift: the changes lead exactly to the export."""
    live = _replayed(spark, sf_dir, ["order"]).ref("int_orders_current")
    return replay.status_drift(live, retail.export(spark, sf_dir))


# --- generic checks ---------------------------------------------------------------------


@query
def dq_not_null(spark, sf_dir):
    orders = _marts(spark, sf_dir, ["order"]).ref("int_orders_current")
    return q.not_null(orders, "approved_at").select("order_id")


@query
def dq_unique(spark, sf_dir):
    orders = _marts(spark, sf_dir, ["order"]).ref("int_orders_current")
    return q.unique(orders, "customer_unique_id")


@query
def dq_unique_combination(spark, sf_dir):
    lines = retail.table(spark, sf_dir, "lineitem")
    return q.unique_combination(lines, ["l_orderkey", "l_linenumber"])


@query
def dq_accepted_values(spark, sf_dir):
    orders = _marts(spark, sf_dir, ["order"]).ref("int_orders_current")
    regular = [s for s in ORDER_STATUSES if s not in ("canceled", "unavailable")]
    return q.accepted_values(orders, "order_status", regular).select("order_id", "order_status")


@query
def dq_relationships(spark, sf_dir):
    """Items whose order was deleted."""
    marts = _marts(spark, sf_dir, ["order", "order_item"], deletes=True)
    items, orders = marts.ref("stg_order_items"), marts.ref("int_orders_current")
    return q.relationships(items, "order_id", orders, "order_id")


@query
def dq_expression(spark, sf_dir):
    history = _marts(spark, sf_dir, ["order"]).ref("dim_order_status_history")
    idle = q.expression_is_true(history, "seconds_in_status > 0 OR seconds_in_status IS NULL")
    return idle.select("order_id", "version", "order_status")


@query
def dq_range(spark, sf_dir):
    items = _marts(spark, sf_dir, ["order_item"]).ref("stg_order_items")
    free = q.accepted_range(items, "freight_value", minimum=0, inclusive=False)
    return free.select("order_id", "order_item_id", "freight_value")


# --- invariants, on data with planted faults ------------------------------------------------


@query
def dq_one_current(spark, sf_dir):
    """First versions of some orders claim to be current as well."""
    dim = _marts(spark, sf_dir, ["order"], deletes=True).ref("dim_order_status_history")
    claimed = F.col("is_current") | ((_k() % 500 == 3) & (F.col("version") == 1))
    faulty = dim.withColumn("is_current", claimed)
    return q.one_current(faulty, "order_id", "dim_order_status_history")


@query
def dq_tiling(spark, sf_dir):
    """Closed windows of some orders end a millisecond late."""
    dim = _marts(spark, sf_dir, ["order"], deletes=True).ref("dim_order_status_history")
    late = F.when(
        (_k() % 500 == 3) & ~F.col("is_current"),
        F.timestamp_millis(F.unix_millis("valid_to") + 1),
    ).otherwise(F.col("valid_to"))
    faulty = dim.withColumn("valid_to", late)
    return q.no_gaps_or_overlaps(faulty, "order_id", "dim_order_status_history")


@query
def dq_no_fan_out(spark, sf_dir):
    """First windows start a second late, closed ones end 30 days late."""
    marts = _marts(spark, sf_dir, ["order", "customer"])
    starts = F.unix_millis("valid_from") + F.when(F.col("version") == 1, 1000).otherwise(0)
    ends = F.unix_millis("valid_to") + F.when(F.col("is_current"), 0).otherwise(30 * 86_400_000)
    faulty = marts.ref("dim_customer").withColumns(
        {"valid_from": F.timestamp_millis(starts), "valid_to": F.timestamp_millis(ends)}
    )
    orders = marts.ref("int_orders_current")
    return q.as_of_no_fan_out(orders, "order_id", faulty, "customer_unique_id", "purchased_at")


@query
def dq_versions_match(spark, sf_dir):
    """Second versions of some customers are missing."""
    marts = _marts(spark, sf_dir, ["customer"])
    lost = (F.col("version") == 2) & (_k("customer_unique_id") % 20 == 0)
    faulty = marts.ref("dim_customer").filter(~lost)
    return q.versions_match_log(marts.ref("stg_customer_events"), faulty, "customer_unique_id")


@query
def dq_generations(spark, sf_dir):
    """Some orders were read by a second snapshot."""
    log = _order_log(spark, sf_dir)
    again = log.filter((F.col("op") == "read") & (_k("pk") % 500 == 1))
    return q.no_duplicate_generations(log.unionByName(again))


def _resurrecting_state(log: DataFrame) -> DataFrame:
    """Current orders built the wrong way: deletes dropped before ranking."""
    events = m.order_events(log).filter("op <> 'delete'")
    return newest_event(events, ["order_id"], ORDER)


@query
def dq_deleted(spark, sf_dir):
    """Deleted orders in a model that drops deletes before ranking, and in the right one."""
    log = _order_log(spark, sf_dir)
    right = m.int_orders_current(log)
    wrong = {"order": ("wrong_orders", _resurrecting_state(log), ["order_id"])}
    good = {"order": ("int_orders_current", right, ["order_id"])}
    return q.deleted_do_not_reappear(log, wrong).unionByName(
        q.deleted_do_not_reappear(log, good)
    )


@query
def dq_fact_reconcile(spark, sf_dir):
    log = _order_log(spark, sf_dir)
    return q.fact_reconciles_to_log(log, "order", _resurrecting_state(log))


@query
def dq_items_reconcile(spark, sf_dir):
    """First items of some orders are missing from the item fact."""
    marts = _shared(spark, sf_dir, "int_orders_current")
    lost = (_k() % 500 == 3) & (F.col("order_item_id") == 1)
    return q.facts_reconcile(marts.ref("fct_orders"), marts.ref("fct_order_items").filter(~lost))


@query
def dq_counts(spark, sf_dir):
    """Models against the rows of their source, in which deleted orders still exist."""
    marts = _marts(spark, sf_dir, deletes=True)
    source = {
        "fct_orders": "orders",
        "fct_order_items": "lineitem",
        "dim_product": "part",
        "dim_seller": "supplier",
    }
    expected = {t: retail.table(spark, sf_dir, s).count() for t, s in source.items()}
    return q.assert_counts({t: marts.ref(t) for t in source}, expected)


@query
def dq_invariants(spark, sf_dir):
    """Business facts of the models against those of the source, as above."""
    marts = _shared(spark, sf_dir, "int_orders_current", "stg_order_items", "dim_customer", deletes=True)
    lines = retail.raw_items(spark, sf_dir)
    orders = retail.orders_wide(spark, sf_dir)
    revenue = lines.agg(F.sum(F.col("price").cast("decimal(10,2)"))).first()[0]
    empty = orders.join(lines, "order_id", "left_anti").count()
    dim, history = marts.ref("dim_customer"), marts.ref("dim_order_status_history")
    items, fact = marts.ref("fct_order_items"), marts.ref("fct_orders")
    former = dim.filter("NOT is_current").select("customer_key")
    backwards = q.expression_is_true(history, "valid_to >= valid_from")
    ambiguous = q.one_current(dim, "customer_unique_id", "dim_customer")
    movers = dim.filter("has_history").select("customer_unique_id").distinct()

    def rows(frame: DataFrame) -> DataFrame:
        return frame.agg(F.count(F.lit(1)).alias("n"))

    return q.assert_invariants(
        [
            ("revenue to the cent", items.agg(F.round(F.sum("price"), 2).alias("n")), revenue),
            ("orders without items", fact.agg(F.count_if("is_missing_items").alias("n")), empty),
            ("customers with history", rows(movers), 0),
            ("items at a former address", rows(items.join(former, "customer_key")), 0),
            ("customers without one current version", rows(ambiguous), 0),
            ("windows running backwards", rows(backwards), 0),
        ]
    )


@query
def dq_log_vs_source(spark, sf_dir):
    """The log against source tables that still hold the deleted orders."""
    sources = {
        "customer": first_state(retail.addresses(spark, sf_dir), PERSON, VISITS),
        "seller": retail.table(spark, sf_dir, "supplier"),
        "product": retail.table(spark, sf_dir, "part"),
        "order": retail.table(spark, sf_dir, "orders"),
        "order_item": retail.table(spark, sf_dir, "lineitem"),
    }
    return q.log_matches_source(_whole_log(spark, sf_dir), sources)


@query
def dq_op_mix(spark, sf_dir):
    """Operations per table; the source is said to hold one message per order only."""
    log = _whole_log(spark, sf_dir)
    messages = retail.messages(spark, sf_dir, [t for t in TABLES if t != "order"])
    ends = messages.groupBy(F.element_at(F.split("topic", r"\."), -1).alias("source_table")).agg(
        F.count(F.lit(1)).alias("messages")
    )
    orders = retail.table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("messages"))
    said = orders.select(F.lit("order").alias("source_table"), "messages")
    return q.op_reconcile(log, ends.unionByName(said))


@query
def dq_lsn(spark, sf_dir):
    """Some streamed events lost their log position."""
    lost = (F.col("kafka_offset") % 8 == 1) & (_k("pk") % 500 == 2)
    faulty = _order_log(spark, sf_dir).withColumn("lsn", F.when(~lost, F.col("lsn")))
    return q.streamed_without_position(faulty).select("pk", "op", "kafka_offset")


@query
def dq_offset_gaps(spark, sf_dir):
    """The order topic numbers its messages with gaps."""
    return q.offset_gaps(_order_log(spark, sf_dir)).select(
        "topic", "partition", "kafka_offset", "previous", "missing"
    )


@query
def dq_offset_gaps_hot_key(spark, sf_dir):
    """The same with the topic cut into chunks."""
    log = _order_log(spark, sf_dir)
    return q.offset_gaps(log, rows_per_chunk=log.count() // 20).select(
        "topic", "partition", "kafka_offset", "previous", "missing"
    )


@query
def dq_order_key(spark, sf_dir):
    """Address changes are committed by time of purchase but numbered by order; second
    updates of an order repeat the position of the first."""
    log = _whole_log(spark, sf_dir).filter("source_table IN ('customer', 'order')")
    second = (F.col("source_table") == "order") & (F.col("kafka_offset") % 8 == 2)
    faulty = log.withColumn("lsn", F.when(second, F.col("lsn") - 1).otherwise(F.col("lsn")))
    return q.order_key_sound(faulty)


@query
def gate_counts(spark, sf_dir):
    """Offences per declared check on sound data."""
    path = scratch_dir(spark, "marts")
    return contracts.all_checks(_marts(spark, sf_dir, path=path, store_views=True)).counts()


def _faulty(sound: Marts) -> Marts:
    """The same models with faults planted in the log, both histories, products, orders and items."""
    log = contracts.whole_log(sound)
    seller, offset = F.col("source_table") == "seller", F.col("kafka_offset")
    again = log.filter("source_table = 'product'").filter(offset % 101 == 7)
    log = log.unionByName(again).withColumns(
        {
            "op": F.when(seller & (offset % 3 == 1), "merge").otherwise(F.col("op")),
            "pk": F.when(~seller | (offset % 5 != 2), F.col("pk")),
        }
    )
    broken = Marts(log)
    for name in MODELS:
        broken.use(name, sound.ref(name))
    person, version = _k("customer_unique_id"), F.col("version")
    customers = sound.ref("dim_customer").filter(~((version == 2) & (person % 3 == 0)))
    customers = customers.unionByName(customers.filter((version == 1) & (person % 41 == 5)))
    broken.use("dim_customer", customers.withColumn("is_current", F.col("is_current") | (person % 29 == 4)))
    backwards = ~F.col("is_current") & (_k() % 50 == 11)
    status = F.when((version == 1) & (_k() % 70 == 9), F.lit("lost")).when(
        (version != 1) | (_k() % 90 != 1), F.col("order_status")
    )
    history = sound.ref("dim_order_status_history").withColumns(
        {
            "valid_to": F.when(backwards, F.expr("valid_from - INTERVAL 1 SECOND")).otherwise(F.col("valid_to")),
            "order_status": status,
        }
    )
    broken.use("dim_order_status_history", history)
    product = _k("product_id")
    products = sound.ref("dim_product").filter(product % 53 != 0)
    broken.use("dim_product", products.withColumn("category_name", F.when(product % 37 != 3, F.col("category_name"))))
    broken.use("fct_orders", sound.ref("fct_orders").filter(_k() % 45 != 0))
    items = sound.ref("fct_order_items").filter((_k() % 20 != 0) | (F.col("order_item_id") != 1))
    price = F.when(_k() % 33 == 2, -F.col("price")).otherwise(F.col("price"))
    broken.use("fct_order_items", items.withColumn("price", price))
    return broken


@query
def gate_counts_of_faults(spark, sf_dir):
    """Offences per declared check on models with planted faults."""
    sound = _marts(spark, sf_dir, path=scratch_dir(spark, "marts"), store_views=True)
    return contracts.all_checks(_faulty(sound)).counts()


# --- profile and latency -----------------------------------------------------------------


@query
def profile_findings(spark, sf_dir):
    """What profiling the source shows: keys, drift, inversions, unknown values."""
    marts = _shared(spark, sf_dir, "int_orders_current")
    history, fact = marts.ref("dim_order_status_history"), marts.ref("fct_orders")
    customers = marts.ref("dim_customer")
    orders = q.profile(
        marts.ref("int_orders_current"), "customer_unique_id", ["approved_at", "delivered_at"]
    )
    products = q.profile(marts.ref("stg_products"), "product_id", ["category_name"])
    moves = customers.agg(F.count_if(~F.col("is_current")).alias("address_changes"))
    flags = fact.agg(
        F.count_if("is_missing_items").alias("orders_without_items"),
        F.count_if("has_inverted_timestamps").alias("orders_with_inverted_times"),
        F.count_if("has_instant_approval").alias("orders_approved_at_purchase"),
    )
    clamped = history.agg(F.count_if("is_timestamp_clamped").alias("clamped_versions"))

    def listed(prefix: str, frame: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(prefix + c).alias("finding"), F.col(c).alias("value")) for c in frame.columns]
        return frame.select(F.inline(F.array(*pairs)))

    return union_all(
        [
            listed("orders.", orders),
            listed("products.", products),
            listed("", moves),
            listed("", flags),
            listed("", clamped),
        ]
    )


def _narrowed(few: DataFrame, column: str) -> DataFrame:
    """One row per operation, a sum of them as bigint where every sum fits; wider ones stay decimals."""
    kept = few.sparkSession.createDataFrame(few.collect(), few.schema)
    widest = kept.agg(F.max(F.abs(column))).first()[0]
    if widest is not None and widest >= 2**63:
        return kept
    return kept.withColumn(column, F.col(column).cast("bigint"))


@query
def cdc_latency(spark, sf_dir):
    events = m.order_events(_order_log(spark, sf_dir))
    return _narrowed(q.cdc_latency(events), "sum_ms")


# --- streaming -----------------------------------------------------------------------------


def _streamed(spark, sf_dir, names, parts=3) -> str:
    """Messages as files, tailed in several micro-batches into a log.

    Every task writes a file of its own, so files grow in number with the messages and
    a micro-batch takes as many of them as makes `parts` batches of each table.
    """
    root = scratch_dir(spark, "stream")
    for name in names:
        messages = retail.table_messages(spark, sf_dir, name, deletes=True)
        part = F.pmod(F.coalesce("kafka_offset", F.lit(0)), F.lit(parts))
        for i in range(parts):
            write_messages(messages.where(part == i), f"{root}/topics")
    files = len(spark.read.schema(MESSAGE).parquet(f"{root}/topics").inputFiles())
    tail(
        spark,
        {"format": "parquet", "path": f"{root}/topics"},
        f"{root}/log",
        f"{root}/checkpoint",
        f"{root}/quarantine",
        batch_limit=-(-files // (parts * len(names))),
    ).awaitTermination()
    return root


@query
def stream_log_roundtrip(spark, sf_dir):
    root = _streamed(spark, sf_dir, ["order", "customer"])
    return read_log(spark, f"{root}/log").select(
        "source_table", "op", "lsn", "kafka_offset", "pk", "is_snapshot"
    )


LOGGED = ["source_table", "op", "lsn", "kafka_offset", "pk"]


def _drained(spark, root: str) -> None:
    """Land what lies in the topics and not yet in the log."""
    source = {"format": "parquet", "path": f"{root}/topics"}
    tail(
        spark, source, f"{root}/log", f"{root}/checkpoint", f"{root}/quarantine"
    ).awaitTermination()


def _thirds(spark, sf_dir) -> list[DataFrame]:
    messages = retail.table_messages(spark, sf_dir, "customer")
    return [messages.where(F.col("kafka_offset") % 3 == i) for i in range(3)]


@query
def log_append_between_tails(spark, sf_dir):
    """Two writers in turn: a stream, appended events, the stream again."""
    root, parts = scratch_dir(spark, "log-writers"), _thirds(spark, sf_dir)
    write_messages(parts[0], f"{root}/topics")
    _drained(spark, root)
    append_log(valid_events(decode_envelope(parts[1])), f"{root}/log")
    write_messages(parts[2], f"{root}/topics")
    _drained(spark, root)
    return read_log(spark, f"{root}/log").select(*LOGGED)


@query
def log_rebuild_then_tail(spark, sf_dir):
    """A stream, a rebuild of all there is, and the stream going on from its checkpoint."""
    root, parts = scratch_dir(spark, "log-rebuilt"), _thirds(spark, sf_dir)
    write_messages(parts[0], f"{root}/topics")
    _drained(spark, root)
    write_messages(parts[1], f"{root}/topics")
    source = {"format": "parquet", "path": f"{root}/topics"}
    rebuild_log(spark, source, f"{root}/log", f"{root}/quarantine")
    write_messages(parts[2], f"{root}/topics")
    _drained(spark, root)
    return read_log(spark, f"{root}/log").select(*LOGGED)


@query
def log_repeated_positions(spark, sf_dir):
    """Messages given twice in one append and once more in another."""
    path, parts = scratch_dir(spark, "log-repeated"), _thirds(spark, sf_dir)
    events = [valid_events(decode_envelope(p)) for p in parts]
    append_log(events[0].union(events[1]).union(events[0]), path)
    append_log(events[1].union(events[2]), path)
    return read_log(spark, path).select(*LOGGED)


def _events(messages: DataFrame) -> DataFrame:
    return valid_events(decode_envelope(messages))


@query
def log_concurrent_writers(spark, sf_dir):
    """Two appends of overlapping messages and a stream, all begun before any has committed."""
    root, parts = scratch_dir(spark, "log-at-once"), _thirds(spark, sf_dir)
    path = f"{root}/log"
    write_messages(parts[1].union(parts[2]), f"{root}/topics")
    written = [write_events(_events(parts[i].union(parts[i + 1])), path) for i in (0, 1)]
    _drained(spark, root)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda i: commit_events(spark, path, written[i], f"writer-{i}", 0), (0, 1)))
    return read_log(spark, path).select(*LOGGED)


@query
def log_rebuild_while_tailing(spark, sf_dir):
    """A stream lands a third of the messages after the rebuild has read its own and before the switch."""
    root, parts = scratch_dir(spark, "log-fenced"), _thirds(spark, sf_dir)
    path = f"{root}/log"
    write_messages(parts[0], f"{root}/topics")
    _drained(spark, root)

    def write():
        name = write_events(_events(parts[0]), path)
        write_messages(parts[1], f"{root}/topics")
        _drained(spark, root)
        return name, ()

    rebuild(spark, path, write)
    write_messages(parts[2], f"{root}/topics")
    _drained(spark, root)
    return read_log(spark, path).select(*LOGGED)


def _compacted(spark, sf_dir, root: str) -> str:
    """The customers' log in many appends, merged on the way."""
    events = _events(retail.table_messages(spark, sf_dir, "customer")).persist()
    for i in range(20):
        append_log(events.where(F.col("kafka_offset") % 20 == i), f"{root}/log", i, "part")
        compact_log(spark, f"{root}/log")
    events.unpersist()
    return f"{root}/log"


@query
def log_after_compaction(spark, sf_dir):
    """Twenty appends, merged as they gather."""
    return read_log(spark, _compacted(spark, sf_dir, scratch_dir(spark, "log-merged"))).select(*LOGGED)


@query
def log_offset_gaps(spark, sf_dir):
    """Missing offsets of a log that lacks every ninth customer, from its versions' ranges."""
    path = scratch_dir(spark, "log-gaps")
    messages = retail.table_messages(spark, sf_dir, "customer")
    events = _events(messages.where(F.col("kafka_offset") % 9 != 0))
    append_log(events.where("op = 'read'"), path)
    append_log(events.where("op <> 'read'"), path)
    return q.log_gaps(spark, path).select("previous", "kafka_offset", "missing")


# --- states that follow the log ------------------------------------------------------------

STATUS_HISTORY, ORDER_LATENCY = KEPT["dim_order_status_history"], KEPT["order_latency"]
LATEST_ORDERS = Kept(m.order_events, ["order_id"], ORDER)


def _followed(spark, sf_dir, kept: Kept) -> DataFrame:
    """Orders landed in several batches, in any order, a state following after each."""
    root = scratch_dir(spark, "followed")
    messages = retail.table_messages(spark, sf_dir, "order", deletes=True)
    for i in (2, 0, 1):
        write_messages(messages.where(F.col("kafka_offset") % 3 == i), f"{root}/topics")
        _drained(spark, root)
        follow_log(spark, f"{root}/log", f"{root}/state", {"kept": kept})
    return kept.read(spark, f"{root}/state/kept", read_log(spark, f"{root}/log"))


@query
def stream_scd2_incremental(spark, sf_dir):
    """Status history kept up to date batch by batch, events arriving in any order."""
    return _status_versions(_followed(spark, sf_dir, STATUS_HISTORY))


@query
def stream_latest_state(spark, sf_dir):
    """Newest events kept up to date batch by batch, events arriving in any order."""
    return _followed(spark, sf_dir, LATEST_ORDERS).select("order_id", "order_status", "lsn", "kafka_offset")


@query
def stream_latest_after_rebuild(spark, sf_dir):
    """A state that follows a log which is rebuilt between its runs."""
    root = scratch_dir(spark, "followed-rebuild")
    messages = retail.table_messages(spark, sf_dir, "order", deletes=True)
    source = {"format": "parquet", "path": f"{root}/topics"}
    for i in range(2):
        write_messages(messages.where(F.col("kafka_offset") % 2 == i), f"{root}/topics")
        _drained(spark, root)
        follow_log(spark, f"{root}/log", f"{root}/state", {"kept": LATEST_ORDERS})
        rebuild_log(spark, source, f"{root}/log", f"{root}/quarantine")
    follow_log(spark, f"{root}/log", f"{root}/state", {"kept": LATEST_ORDERS})
    state = LATEST_ORDERS.read(spark, f"{root}/state/kept", read_log(spark, f"{root}/log"))
    return state.select("order_id", "order_status", "lsn", "kafka_offset")


@query
def stream_latency_sketch(spark, sf_dir):
    """Delays of order events, summed up batch by batch; quantiles hold to within the sketch's error of rank."""
    merged = _narrowed(q.latency_quantiles(_followed(spark, sf_dir, ORDER_LATENCY)), "sum_ms")
    events = m.order_events(_order_log(spark, sf_dir)).filter("changed_at IS NOT NULL")
    exact = events.select("op", (F.unix_millis("event_at") - F.unix_millis("changed_at")).alias("ms"))
    ranks = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    met = exact.join(F.broadcast(merged), "op").groupBy("op", "events", "min_ms", "max_ms", "sum_ms").agg(
        *[F.avg((F.col("ms") < F.col(p)).cast("int")).alias(f"below_{p}") for p in ranks],
        *[F.avg((F.col("ms") <= F.col(p)).cast("int")).alias(f"upto_{p}") for p in ranks],
    )
    close = [
        ((F.col(f"below_{p}") <= r + RANK_ERROR) & (F.col(f"upto_{p}") >= r - RANK_ERROR)).alias(f"{p}_is_close")
        for p, r in ranks.items()
    ]
    return met.select("op", "events", "min_ms", "max_ms", "sum_ms", *close)
