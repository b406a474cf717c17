"""A small export in CSV files, walked from its initial state to its end."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidelog.operators import unreadable_images
from tidelog.plans import marts as m
from tidelog.plans import replay
from tidelog.plans.marts import Marts
from tidelog.schemas import TABLES
from tidelog.sources import decode_envelope, quarantined, valid_events

FILES = {
    "orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2018-01-01 10:00:00,2018-01-01 10:00:00,2018-01-03 00:00:00,2018-01-05 08:00:00,2018-01-04 00:00:00
o2,c2,canceled,2018-02-01 10:00:00,2018-02-03 00:00:00,2018-02-02 00:00:00,,2018-02-09 00:00:00
o3,c3,created,2018-03-01 10:00:00,,,,2018-03-09 00:00:00
""",
    "order_items": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2018-01-02 00:00:00,10.10,1.05
o1,2,p2,s1,2018-01-02 00:00:00,20.20,0.00
o2,1,p1,s1,2018-02-02 00:00:00,5.00,2.00
""",
    "customers": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,01151,a,SP
c2,u1,02222,b,SP
c3,u2,03333,c,RJ
""",
    "products": """product_id,product_category_name,extra,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1,livros,9,100,10,5,7
p2,,9,,10,5,7
""",
    "sellers": """seller_id,seller_zip_code_prefix,seller_city,seller_state
s1,00001,x,SP
s2,00002,y,SP
""",
    "category_translation": """product_category_name,product_category_name_english
livros,books
""",
}


@pytest.fixture(scope="module")
def export(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("export")
    paths = {}
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text)
        paths[name] = str(folder / f"{name}.csv")
    return replay.read_export(spark, paths)


@pytest.fixture(scope="module")
def marts(spark, export):
    decoded = {t: decode_envelope(replay.change_messages(export, t, partitions=3)) for t in TABLES}
    assert all(quarantined(d).count() == 0 for d in decoded.values())
    return Marts({t: valid_events(d) for t, d in decoded.items()})


def test_initial_state(export):
    tables = replay.initial_state(export)
    assert set(tables) == set(TABLES)
    people = tables["customer"].select("customer_unique_id", "zip_code_prefix")
    assert rows(people) == [("u1", "01151"), ("u2", "03333")]
    assert {r[0] for r in tables["order"].select("order_status").collect()} == {"created"}
    assert tables["order"].filter("approved_at IS NOT NULL").count() == 0
    dated = tables["seller"].select("seller_id", F.col("updated_at").cast("string"))
    assert rows(dated) == [("s1", "2018-01-01 10:00:00"), ("s2", "2016-09-01 00:00:00")]


def test_status_history(marts):
    dim = marts.ref("dim_order_status_history")
    found = rows(dim.select("order_id", "version", "order_status", "is_timestamp_clamped"))
    assert found == [
        ("o1", 1, "created", False), ("o1", 2, "approved", False), ("o1", 3, "shipped", False),
        ("o1", 4, "delivered", False),
        ("o2", 1, "created", False), ("o2", 2, "approved", False), ("o2", 3, "shipped", True),
        ("o2", 4, "canceled", True),
        ("o3", 1, "created", False),
    ]
    first = dim.filter("order_id = 'o1' AND version = 1")
    assert first.select("seconds_in_status", "is_instantaneous").first() == (0, True)


def test_facts(marts):
    items = marts.ref("fct_order_items").join(marts.ref("dim_customer"), "customer_key")
    found = items.select("order_id", "order_item_id", "zip_code_prefix", "is_delivered_late")
    assert rows(found) == [
        ("o1", 1, "01151", True), ("o1", 2, "01151", True), ("o2", 1, "02222", None),
    ]
    orders = marts.ref("fct_orders").select("order_id", "item_count", "order_total", "days_to_deliver")
    assert [(r[0], r[1], r[2] and str(r[2]), r[3]) for r in rows(orders)] == [
        ("o1", 2, "31.35", 4), ("o2", 1, "7.00", None), ("o3", 0, None, None),
    ]
    products = marts.ref("dim_product").select("product_id", "category_name", "category_name_en")
    assert rows(products) == [("p1", "livros", "books"), ("p2", "unknown", "unknown")]


def test_the_end_state_is_that_of_the_export(marts, export):
    drift = replay.status_drift(marts.ref("int_orders_current"), export)
    assert drift.filter("drift <> 0").count() == 0


def test_a_sample_changes_only_the_sampled_orders(export):
    log = valid_events(decode_envelope(replay.change_messages(export, "order", percent=1)))
    assert dict(rows(log.groupBy("op").count())) == {"read": 3}


def test_offsets_are_dense_per_partition(marts):
    log = marts.source("order")
    spans = log.groupBy("partition").agg(
        F.count("*").alias("n"), F.max("kafka_offset").alias("top"), F.countDistinct("kafka_offset").alias("d")
    )
    assert all(r["n"] == r["top"] + 1 == r["d"] for r in spans.collect())


def test_an_unreadable_image_stops_the_job_unless_told_otherwise(spark, marts):
    log = marts.source("order")
    after = F.replace("after", F.lit('"updated_at":'), F.lit('"updated_at":"x","was":'))
    broken = log.withColumn("after", F.when(F.col("op") == "read", after).otherwise(F.col("after")))
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        m.order_events(broken).collect()
    assert unreadable_images(broken, "order").count() == 3
    assert unreadable_images(log, "order").count() == 0
    from tidelog.operators import stage_events

    lenient = stage_events(broken, "order", "order_id", ["order_status"], mode="PERMISSIVE")
    assert lenient.filter("op = 'read' AND changed_at IS NULL").count() == 3
