"""Pinned numbers at scale 0.001."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.plans import retail
from tidelog.plans.marts import MODELS, Marts
from tidelog.sources import append_log, heavy_keys, read_log
from tidelog.sources.commits import Committed, Folder
from tidelog.sources.heavy import merge_summaries, missed_share, summarise


@pytest.fixture(scope="module")
def marts(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("marts"))
    return Marts(retail.landed_log(spark, sf_dir), path=path)


@pytest.fixture(scope="module")
def with_deletes(spark, sf_dir):
    return retail.landed_log(spark, sf_dir, deletes=True)


def numbers(df, *expressions):
    return tuple(df.agg(*[F.expr(e) for e in expressions]).first())


def test_log(with_deletes):
    ops = dict(with_deletes["order"].groupBy("op").count().collect())
    assert ops == {"read": 1500, "update": 3084, "insert": 8, "delete": 15}


def test_status_history(marts):
    assert numbers(
        marts.ref("dim_order_status_history"),
        "count(*)", "count_if(is_timestamp_clamped)", "count_if(is_instantaneous)",
        "count_if(is_current)", "count_if(valid_to < valid_from)", "sum(seconds_in_status)",
        "min(order_status_key)",
    ) == (4468, 197, 683, 1500, 0, 395150400, "000acb4351c4aaad0044f6f9c01e6336")
    assert numbers(marts.ref("stg_order_events"), "count_if(is_no_op_update)") == (116,)


def test_status_history_with_deletes(with_deletes):
    closed = Marts(with_deletes).ref("dim_order_status_history")
    assert numbers(
        closed, "count(*)", "count_if(is_current)", "count_if(is_deleted)",
        "count_if(valid_to < valid_from)",
    ) == (4476, 1493, 15, 0)
    kept = Marts(with_deletes, on_delete="keep").ref("dim_order_status_history")
    assert kept.count() == 4491
    assert Marts(with_deletes).ref("int_orders_current").count() == 1493


def test_customers(marts):
    assert numbers(
        marts.ref("dim_customer"),
        "count(*)", "count(DISTINCT CASE WHEN has_history THEN customer_unique_id END)",
        "max(version)",
    ) == (198, 13, 7)


def test_items(marts):
    items = marts.ref("fct_order_items")
    price, freight = numbers(items, "sum(price)", "sum(freight_value)")
    assert (items.count(), str(price), str(freight)) == (6000, "317364757.31", "123877.22")
    former = marts.ref("dim_customer").filter("NOT is_current")
    assert items.join(former, "customer_key").count() == 461
    assert numbers(items, "count_if(is_customer_version_unmatched)") == (0,)


def test_orders(marts):
    assert numbers(
        marts.ref("fct_orders"),
        "count(*)", "count_if(is_missing_items)", "sum(seller_count)", "sum(product_count)",
        "count_if(is_delivered_late)", "sum(days_to_deliver)", "count_if(is_terminated)",
        "count_if(has_inverted_timestamps)", "count_if(has_instant_approval)",
        "count_if(gross_price IS NULL)",
    ) == (1500, 27, 4951, 5942, 181, 3445, 31, 187, 375, 27)


def test_products_and_sellers(spark, sf_dir, marts):
    assert numbers(
        marts.ref("dim_product"), "count_if(is_category_missing)",
        "count_if(NOT is_category_missing AND category_name_en = 'unknown')",
    ) == (4, 38)
    sellers = retail.sellers(spark, sf_dir)
    assert numbers(sellers, "count(*)", "sum(unix_millis(updated_at))") == (10, 7891180830000)


def test_views_by_name(spark, marts):
    marts.create_views()
    assert spark.sql("SELECT count(*) FROM fct_orders").first()[0] == 1500
    assert len(MODELS) == 14


def test_hot_keys_give_the_same_models(spark, with_deletes):
    plain, hot = Marts(with_deletes), Marts(with_deletes, rows_per_chunk=3)
    for name in ("dim_order_status_history", "stg_order_events", "dim_customer"):
        assert hot.ref(name).exceptAll(plain.ref(name)).count() == 0
        assert hot.ref(name).count() == plain.ref(name).count()


def test_busy_orders_give_the_same_items(spark, marts, with_deletes):
    hot = Marts(with_deletes, rows_per_chunk=9)
    found = hot.ref("fct_order_items")
    assert found._jdf.queryExecution().analyzed().toString().count("LeftAnti") == 1
    plain = Marts(with_deletes).ref("fct_order_items")
    assert found.exceptAll(plain).count() == 0
    assert found.count() == plain.count()


def test_history_is_one_shuffle_and_one_parse(with_deletes):
    plan = Marts(with_deletes).ref("dim_order_status_history")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Sort [") == 1
    assert text.count("from_json") == 2  # the images after and before
    assert "PartitionFilters: [isnotnull(source_table" in text


def test_items_are_counted_without_an_expand(marts, with_deletes):
    plan = Marts(with_deletes).ref("fct_orders")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    # items by pk and by order, orders by pk, history by key; orders and totals lie by order already
    assert plan.count("Exchange hashpartitioning") == 4
    plan = Marts(with_deletes).ref("fct_order_items")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(order_id") <= 2


def test_busy_orders_give_the_same_totals(with_deletes):
    hot, plain = Marts(with_deletes, rows_per_chunk=5), Marts(with_deletes)
    assert hot.busy_orders().count() > 100
    found, want = hot.ref("fct_orders"), plain.ref("fct_orders")
    assert found.exceptAll(want).count() == want.exceptAll(found).count() == 0


def test_summaries_save_counting_all_keys(spark, sf_dir, tmp_path):
    path = str(tmp_path / "log")
    events = retail.event_log(spark, sf_dir, ["order"], deletes=True)["order"]
    for i in range(3):
        append_log(events.where(F.col("kafka_offset") % 3 == i), path)
    log = read_log(spark, path)
    sizes = {r.pk: r["count"] for r in events.groupBy("pk").count().collect()}
    limit = sorted(sizes.values())[-10]
    heavy = heavy_keys(spark, path, limit)
    assert heavy["order"].sure and set(heavy["order"].keys) == {k for k, n in sizes.items() if n > limit}
    with_summary, counted = Marts(log, rows_per_chunk=limit, heavy=heavy), Marts(log, rows_per_chunk=limit)
    named = lambda m: sorted(r.pk for r in m.hot_keys("order").frame.collect())
    assert named(with_summary) == named(counted) == sorted(heavy["order"].keys)
    assert Marts(log, heavy=heavy_keys(spark, path, 10**6)).hot_keys("order") is None
    assert heavy_keys(spark, str(tmp_path / "none"), 1) == {}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6))
def test_no_hot_key_is_missed(spark, tmp_path_factory, seed):
    """Sketches that track few of many keys, over several batches and a merge."""
    draw = random.Random(seed)
    path, tracked, hot = str(tmp_path_factory.mktemp("heavy")), 200, {}
    table = Committed(spark, path)
    for _ in range(4):
        keys = [f"h{draw.randrange(9)}" for _ in range(draw.randrange(1500))]
        keys += [f"c{draw.randrange(10**6)}" for _ in range(2000)]
        for k in keys:
            hot[k] = hot.get(k, 0) + 1
        rows = spark.createDataFrame([("t", k) for k in keys], "source_table string, pk string")
        name = table.write(rows)
        summarise(table, name, rows, tracked)
        table.publish(table.newest(), added=[Folder(name, "w", 0, len(keys))])
    limit = math.ceil(missed_share(tracked) * sum(hot.values()))
    found = heavy_keys(spark, path, limit, tracked)["t"]
    assert found.sure and {k for k, n in hot.items() if n > limit} <= set(found.keys)
    assert not heavy_keys(spark, path, limit - 1, tracked)["t"].sure
    merged = table.write(spark.createDataFrame([("t", "x")], "source_table string, pk string"))
    merge_summaries(table, list(table.newest().folders), merged, tracked)
    seen = table.newest()
    table.publish(seen, kind="merge", folders=(Folder(merged, "merge", 0, 1),))
    again = heavy_keys(spark, path, limit, tracked)["t"]
    assert again.sure and {k for k, n in hot.items() if n > limit} <= set(again.keys)
