"""The checks declared for the retail log and models, and a build that honours them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidelog.plans.marts import MODELS, Marts
from tidelog.quality.checks import (
    expression_rule,
    null_rule,
    range_rule,
    relationships,
    unique,
    unique_combination,
    value_rule,
)
from tidelog.quality.gate import Suite, run_gate
from tidelog.quality.history import as_of_no_fan_out, history_checks, opening_events
from tidelog.quality.logs import deleted_do_not_reappear, no_duplicate_generations, order_key_sound, union_all
from tidelog.quality.totals import fact_reconciles_to_log, facts_reconcile
from tidelog.schemas import OPS, ORDER_STATUSES, TABLES

LOG = "cdc_events"

# --- fixed values: what is declared per table --------------------------------
NOT_NULL = {
    LOG: ["source_table", "op", "pk"],
    "stg_customer_events": ["customer_unique_id", "event_seq", "city", "state"],
    "stg_order_events": ["order_id", "order_status", "purchased_at", "event_seq"],
    "stg_order_items": ["order_id", "order_item_id", "product_id", "seller_id", "price"],
    "stg_products": ["product_id"],
    "stg_sellers": ["seller_id"],
    "int_orders_current": ["order_id", "order_status", "purchased_at", "customer_unique_id"],
    "dim_customer": [
        "customer_key", "customer_unique_id", "version", "valid_from", "valid_to", "is_current",
    ],
    "dim_order_status_history": [
        "order_status_key", "order_id", "order_status", "valid_from", "valid_to",
    ],
    "dim_seller": ["seller_key", "seller_id"],
    "dim_product": ["product_key", "product_id", "category_name"],
    "fct_orders": [
        "order_id", "customer_unique_id", "order_status", "item_count", "status_versions",
    ],
    "fct_order_items": [
        "order_item_key", "order_id", "customer_key", "product_key", "seller_key", "price",
    ],
}
UNIQUE = {
    "stg_products": ["product_id"],
    "stg_sellers": ["seller_id"],
    "int_orders_current": ["order_id"],
    "dim_customer": ["customer_key"],
    "dim_order_status_history": ["order_status_key"],
    "dim_seller": ["seller_key", "seller_id"],
    "dim_product": ["product_key", "product_id"],
    "fct_orders": ["order_id"],
    "fct_order_items": ["order_item_key"],
}
UNIQUE_COMBINATION = {
    "stg_customer_events": ["customer_unique_id", "event_seq"],
    "stg_order_events": ["order_id", "event_seq"],
    "stg_order_items": ["order_id", "order_item_id"],
    "dim_customer": ["customer_unique_id", "version"],
    "dim_order_status_history": ["order_id", "version"],
    "fct_order_items": ["order_id", "order_item_id"],
}
ACCEPTED_VALUES = {
    LOG: {"source_table": TABLES, "op": OPS},
    "stg_order_events": {"order_status": ORDER_STATUSES},
    "dim_order_status_history": {"order_status": ORDER_STATUSES},
    "fct_orders": {"order_status": ORDER_STATUSES},
}
EXPRESSIONS = {
    LOG: {"streamed_events_have_lsn": "lsn IS NOT NULL OR is_snapshot"},
    "dim_customer": {"windows_have_positive_width": "valid_to > valid_from"},
    "dim_order_status_history": {
        "windows_never_run_backwards": "valid_to >= valid_from",
        "duration_is_not_negative": "seconds_in_status >= 0 OR seconds_in_status IS NULL",
    },
}
RELATIONSHIPS = {
    "fct_orders": [("customer_unique_id", "dim_customer", "customer_unique_id")],
    "fct_order_items": [
        ("order_id", "fct_orders", "order_id"),
        ("product_key", "dim_product", "product_key"),
        ("seller_key", "dim_seller", "seller_key"),
    ],
}
CURRENT_STATE = {
    "product": ("dim_product", ["product_id"]),
    "seller": ("dim_seller", ["seller_id"]),
    "order": ("fct_orders", ["order_id"]),
    "order_item": ("fct_order_items", ["order_id", "order_item_id"]),
}

# history: key, source table, and the events that its versions are counted against
HISTORIES = {
    "dim_customer": ("customer_unique_id", "customer", "stg_customer_events"),
    "dim_order_status_history": ("order_id", "order", None),
}

# An event that ends a row has no image; these columns are known on all others.
NULL_ON_DELETE = {
    "stg_customer_events": ["city", "state"],
    "stg_order_events": ["order_status", "purchased_at"],
}


def whole_log(marts: Marts) -> DataFrame:
    if isinstance(marts.log, DataFrame):
        return marts.log
    return union_all([marts.source(t) for t in marts.log])


def table_checks(marts: Marts, name: str, suite: Suite | None = None) -> Suite:
    """The declared checks of the log or of one model."""
    suite = suite or Suite()
    df = whole_log(marts) if name == LOG else marts.ref(name)

    rules = {}
    for column in NOT_NULL.get(name, []):
        rule = null_rule(column)
        if column in NULL_ON_DELETE.get(name, []):
            rule = rule & expression_rule("op = 'delete'")
        rules[f"not_null_{column}"] = rule
    for column, values in ACCEPTED_VALUES.get(name, {}).items():
        rules[f"accepted_values_{column}"] = value_rule(column, values)
    for label, expression in EXPRESSIONS.get(name, {}).items():
        rules[label] = expression_rule(expression)
    if name == "fct_order_items":
        rules["price_is_positive"] = range_rule("price", minimum=0, inclusive=False)
    suite.add_rules(name, df, rules)

    for column in UNIQUE.get(name, []):
        suite.add(f"{name}.unique_{column}", unique(df, column))
    if name in UNIQUE_COMBINATION:
        columns = UNIQUE_COMBINATION[name]
        label = f"{name}.unique_{'_'.join(columns)}"
        if name in HISTORIES:
            _history_checks(marts, name, label, suite)
        else:
            suite.add(label, unique_combination(df, columns))
    for column, parent, parent_column in RELATIONSHIPS.get(name, []):
        orphans = relationships(df, column, marts.ref(parent), parent_column)
        suite.add(f"{name}.relationship_{column}", orphans)
    return suite


def _history_checks(marts: Marts, name: str, repeated: str, suite: Suite) -> None:
    """All that is said of a history, in one pass over it."""
    key, source, events = HISTORIES[name]
    names = {
        "current": "exactly_one_current_version",
        "tiling": "windows_have_no_gaps_or_overlaps",
        "repeated": repeated,
    }
    opening = None
    if events:
        names["versions"] = "version_counts_match_log"
        opening = opening_events(marts.ref(events), marts.on_delete)
    # versions of a key are no more than its events, so its events say whether it is hot
    hot = marts.hot_keys(source)
    counts = history_checks(marts.ref(name), key, names, hot and hot.named(key), opening)
    suite.add_counted(list(names.values()), counts)


def invariant_checks(marts: Marts, suite: Suite | None = None) -> Suite:
    """Checks that span tables."""
    suite = suite or Suite()
    log = whole_log(marts)
    customers, person = marts.ref("dim_customer"), "customer_unique_id"
    orders, items = marts.ref("fct_orders"), marts.ref("fct_order_items")

    suite.add("no_duplicate_generations", no_duplicate_generations(log))
    models = {t: (m, marts.ref(m), keys) for t, (m, keys) in CURRENT_STATE.items()}
    suite.add("deleted_rows_do_not_reappear", deleted_do_not_reappear(log, models))
    suite.add("fct_orders_reconciles_to_log", fact_reconciles_to_log(log, "order", orders))
    suite.add("facts_reconcile", facts_reconcile(orders, items))
    resolved = as_of_no_fan_out(
        marts.ref("int_orders_current"), "order_id", customers, person, "purchased_at",
        hot=marts.hot_facts(),
    )
    suite.add("as_of_join_does_not_fan_out", resolved)
    return suite


def all_checks(marts: Marts) -> Suite:
    suite = Suite()
    for name in [LOG, *MODELS]:
        table_checks(marts, name, suite)
    return invariant_checks(marts, suite)


QUARANTINE_CHECK = "quarantine_is_empty"


def quarantine_check(suite: Suite, quarantine: DataFrame | None) -> Suite:
    """Any quarantined message is an offence; without a quarantine nothing is added."""
    return suite if quarantine is None else suite.add(QUARANTINE_CHECK, quarantine)


def log_checks(suite: Suite, log: DataFrame, gaps: DataFrame) -> Suite:
    """Missing offsets and streamed log positions that run backwards or repeat."""
    return suite.add("offsets_are_complete", gaps).add("order_key_is_sound", order_key_sound(log))


def build_gated(marts: Marts, quarantine: DataFrame | None = None) -> dict[str, int]:
    """Build every model, each only after the checks of all models it reads have passed.

    A log that lacks messages is no ground to build on: with `quarantine` nothing is built
    unless it is empty.
    """
    results = run_gate(quarantine_check(table_checks(marts, LOG), quarantine))
    for name in MODELS:
        marts.ref(name)
        checks = table_checks(marts, name)
        if checks.names():
            results |= run_gate(checks)
    return results | run_gate(invariant_checks(marts))
