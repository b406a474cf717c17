"""Fixed schemas and values of the change stream."""

from __future__ import annotations

# --- fixed values: operation codes and names -------------------------------
OP_NAMES = {"r": "read", "c": "insert", "u": "update", "d": "delete"}
OPS = ["read", "insert", "update", "delete"]

# --- fixed values: source tables and their business keys -------------------
PRIMARY_KEYS = {
    "customer": ["customer_unique_id"],
    "seller": ["seller_id"],
    "product": ["product_id"],
    "order": ["order_id"],
    "order_item": ["order_id", "order_item_id"],
}
TABLES = list(PRIMARY_KEYS)

# --- fixed values: statuses an order may hold ------------------------------
ORDER_STATUSES = [
    "created",
    "approved",
    "invoiced",
    "processing",
    "shipped",
    "delivered",
    "unavailable",
    "canceled",
]

# --- fixed values: lifecycle column -> status it marks, in lifecycle order --
ORDER_LIFECYCLE = [
    ("approved_at", "approved"),
    ("delivered_carrier_at", "shipped"),
    ("delivered_customer_at", "delivered"),
]

# --- fixed values: open end of a validity window, anchor of undated rows ----
OPEN_END = "9999-12-31 23:59:59"
OPEN_END_SECONDS = 253402300799
FALLBACK_ANCHOR = "2016-09-01 00:00:00"
FALLBACK_ANCHOR_MS = 1472688000000
UNMATCHED = "_unmatched"
UNKNOWN = "unknown"

# The change message. The images stay text, so one schema serves every table;
# `snapshot` arrives as text or as a JSON boolean and reads as text either way.
ENVELOPE = (
    "op string, ts_ms bigint, "
    "source struct<`table`: string, lsn: bigint, txId: bigint, snapshot: string>, "
    "before string, after string, _corrupt string"
)

# fixed value: first two parts of a topic's name unless a source says otherwise
TOPIC_PREFIX = "commerce"

MESSAGE = "topic string, partition int, kafka_offset bigint, value string"

EVENT_LOG = (
    "source_table string, op string, lsn bigint, tx_id bigint, event_ts_ms bigint, "
    "is_snapshot boolean, topic string, partition int, kafka_offset bigint, pk string, "
    "before string, after string"
)

# Row images. Times are epoch milliseconds and money is text on the wire.
IMAGES = {
    "customer": (
        "customer_unique_id string, zip_code_prefix string, city string, state string, "
        "updated_at bigint"
    ),
    "seller": (
        "seller_id string, zip_code_prefix string, city string, state string, updated_at bigint"
    ),
    "product": (
        "product_id string, category_name string, category_name_en string, weight_g int, "
        "length_cm int, height_cm int, width_cm int, updated_at bigint"
    ),
    "order": (
        "order_id string, customer_id string, customer_unique_id string, order_status string, "
        "purchased_at bigint, approved_at bigint, delivered_carrier_at bigint, "
        "delivered_customer_at bigint, estimated_delivery_at bigint, updated_at bigint"
    ),
    "order_item": (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_at bigint, price string, freight_value string, updated_at bigint"
    ),
}

MONEY = "decimal(10,2)"

# CSV inputs are read with a stated schema: inference would turn "01151" into 1151.
CSV_TABLES = {
    "orders": (
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp, order_approved_at timestamp, "
        "order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, "
        "order_estimated_delivery_date timestamp"
    ),
    "order_items": (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp, price string, freight_value string"
    ),
    "customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string"
    ),
    "products": (
        "product_id string, product_category_name string, product_weight_g int, "
        "product_length_cm int, product_height_cm int, product_width_cm int"
    ),
    "sellers": (
        "seller_id string, seller_zip_code_prefix string, seller_city string, "
        "seller_state string"
    ),
    "category_translation": (
        "product_category_name string, product_category_name_english string"
    ),
}
