"""What is moved and kept where logs and messages are made, on rows with nulls, ties and copies."""

from pyspark.sql import functions as F

from conftest import rows
from tidelog.functions import surrogate_key
from tidelog.operators import number_messages
from tidelog.operators.ordered import number_rows, over_history
from tidelog.plans import catalog, marts, retail
from tidelog.plans.kept import KEPT
from tidelog.schemas import EVENT_LOG
from tidelog.sources import append_log, read_log, write_messages
from tidelog.sources.commits import Committed
from tidelog.sources.log import _blocks, _positions
from tidelog.streaming import keep_history, read_history
from tidelog.streaming.upkeep import _of_keys, ddl


def events(spark, offsets):
    columns = [f.split() for f in EVENT_LOG.split(", ")]
    known = {"source_table": "order", "op": "read", "topic": "t", "partition": 0, "pk": "1"}
    found = [[o if c == "kafka_offset" else known.get(c) for c, *_ in columns] for o in offsets]
    return spark.createDataFrame(found, EVENT_LOG).coalesce(1)


def test_positions_of_a_block_are_shuffled_as_one_row(spark):
    blocks = _blocks(events(spark, [*range(640), *range(5), None, None]))
    assert blocks.count() == 11


def test_positions_are_counted_exactly(spark, tmp_path):
    offsets = [-65, -64, -1, 0, 1, 1, 63, 64, 127, 2**62, None, None]
    append_log(events(spark, offsets), str(tmp_path))
    kept = [r.kafka_offset for r in read_log(spark, str(tmp_path)).select("kafka_offset").collect()]
    assert sorted(kept, key=repr) == sorted(set(offsets), key=repr)
    table = Committed(spark, str(tmp_path))
    (folder,) = table.newest().folders
    assert _positions(table, folder.name)[1:] == (len(set(offsets)), len(set(offsets)))


def test_rows_are_numbered_across_ranges(spark):
    values = [(k, (i * 7919) % 1000, i) for k in ("a", "b", None) for i in range(700)]
    df = spark.createDataFrame(values, "k string, at long, i long").repartition(3)
    found = rows(number_rows(df, ["k"], ["at", "i"], "n"))
    expected = []
    for key in ("a", "b", None):
        own = sorted((at, i) for k, at, i in values if k == key)
        expected += [(key, at, i, n) for n, (at, i) in enumerate(own, 1)]
    assert found == sorted(expected, key=repr)


def test_messages_are_numbered_without_a_second_pass_over_their_source(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.range(500).selectExpr("id", "cast(id % 50 AS string) AS key", "'r' AS op").write.parquet(source)
    numbered = number_messages(spark.read.parquet(source), "key", ["id"], 4, 0)
    assert numbered.count() == 500
    assert not [f for f in numbered.inputFiles() if source in f]


def test_items_meet_their_orders_where_they_were_numbered(spark, tmp_path):
    spark.sql(
        "SELECT id AS o_orderkey, id % 5 AS o_custkey, 'F' AS o_orderstatus, DATE'2020-01-01' AS o_orderdate FROM range(40)"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(
        "SELECT id % 41 AS l_orderkey, id AS l_linenumber, id AS l_partkey, id AS l_suppkey, "
        "DATE'2020-01-01' AS l_shipdate, 1.5D AS l_extendedprice, 1 AS l_quantity, 0 AS l_discount, "
        "0 AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus FROM range(200)"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = retail.order_items(spark, str(tmp_path))
        plan = items._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
        assert items.count() == sum(i % 41 < 40 for i in range(200))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_items_meet_products_and_sellers_before_the_wide_orders(spark):
    items = spark.sql(
        "SELECT * FROM VALUES ('1', 1, 'p', 's', 2.0, 1.0), ('1', 2, 'q', NULL, 3.0, 1.0), ('9', 1, 'p', 's', 4.0, 1.0) "
        "AS t(order_id, order_item_id, product_id, seller_id, price, freight_value)"
    )
    at = "TIMESTAMP'2020-01-01'"
    orders = spark.sql(
        f"SELECT '1' AS order_id, 'c' AS customer_unique_id, 'created' AS order_status, {at} AS purchased_at, {at} AS "
        f"approved_at, {at} AS shipped_at, {at} AS delivered_at, DATE'2020-01-02' AS estimated_delivery_date"
    )
    people = spark.sql(
        f"SELECT 'c' AS customer_unique_id, 'c1' AS customer_key, 1L AS version, {at} AS valid_from, "
        "TIMESTAMP'2021-01-01' AS valid_to, true AS is_current"
    )
    goods = spark.sql("SELECT 'p' AS product_id, 'P' AS product_key")
    shops = spark.sql("SELECT 's' AS seller_id, 'S' AS seller_key")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # rows, which the optimizer cannot fold into the plan
        inputs = [spark.createDataFrame(df.collect(), df.schema) for df in (items, orders, people, goods, shops)]
        fact = marts.fct_order_items(*inputs)
        found = rows(fact.select("order_id", "order_item_id", "customer_key", "product_key", "seller_key"))
        assert found == [("1", 1, "c1", "P", "S"), ("1", 2, "c1", None, None)]
        plan = fact._jdf.queryExecution().executedPlan().toString()
        last = next(line for line in plan.splitlines() if "Join " in line)
        assert "order_id" in last and "seller_id" not in last
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_messages_of_orders_are_made_by_as_many_tasks_as_there_are_orders_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(retail, "ORDERS_PER_TASK", 50, raising=False)
    spark.sql(
        "SELECT nullif(id % 190, 3) AS o_orderkey, nullif(id % 7, 2) AS o_custkey, nullif(substr('FOP', 1 + id % 3, 1), 'P') "
        "AS o_orderstatus, date_add(DATE'2020-01-01', cast(id % 30 AS int)) AS o_orderdate FROM range(400)"
    ).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    made = retail.table_messages(spark, str(tmp_path), "order", deletes=True)
    by_task = made.groupBy(F.spark_partition_id()).count().collect()
    assert len(by_task) > 4 and max(r["count"] for r in by_task) < made.count() / 3
    monkeypatch.setattr(retail, "ORDERS_PER_TASK", 10**6, raising=False)
    assert rows(made) == rows(retail.table_messages(spark, str(tmp_path), "order", deletes=True))


def test_written_models_are_packed_with_their_hex_keys(spark, tmp_path):
    log = spark.sql(
        "SELECT 'product' AS source_table, 'read' AS op, cast(NULL AS bigint) AS lsn, id AS tx_id, id AS event_ts_ms, true AS "
        "is_snapshot, 't' AS topic, 0 AS partition, id AS kafka_offset, cast(id AS string) AS pk, cast(NULL AS string) AS before, "
        "'{\"product_id\":\"x\"}' AS after FROM range(4000)"
    )
    built = marts.Marts(log, path=str(tmp_path)).ref("dim_product")
    assert built.count() == 4000
    size = sum(f.stat().st_size for f in (tmp_path / "dim_product").glob("*.parquet"))
    assert size < 4000 * 32


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_that_follow_from_other_columns_are_not_shuffled(spark):
    at, end = "TIMESTAMP'2020-01-01'", "TIMESTAMP'2021-01-01'"
    items = spark.sql(
        "SELECT cast(id % 3 AS string) AS order_id, id AS order_item_id, substr('pqrs', cast(id % 5 + 1 AS int), 1) AS product_id, "
        "nullif(substr('tuv', cast(id % 4 + 1 AS int), 1), '') AS seller_id, 2.0 AS price, 1.0 AS freight_value FROM range(40)"
    )
    orders = spark.sql(
        f"SELECT cast(id AS string) AS order_id, concat('c', nullif(id, 2)) AS customer_unique_id, 'created' AS order_status, {at} AS "
        f"purchased_at, {at} AS approved_at, {at} AS shipped_at, {at} AS delivered_at, DATE'2020-01-02' AS estimated_delivery_date FROM range(3)"
    )
    people = spark.createDataFrame([("c0", 1), ("c1", 2)], "customer_unique_id string, version long").selectExpr(
        "*", f"{at} AS valid_from", f"{end} AS valid_to"
    )
    people = people.withColumn("customer_key", F.when(F.col("version") == 1, surrogate_key("customer_unique_id", "version")).otherwise("own"))
    # usual keys, one of its own, an empty one, and none
    goods = spark.createDataFrame([(k,) for k in "pqrs"], "product_id string")
    product_key = F.when(F.col("product_id") == "p", surrogate_key("product_id")).when(F.col("product_id") == "q", "")
    goods = goods.withColumn("product_key", product_key.when(F.col("product_id") == "r", "="))
    shops = spark.createDataFrame([("t",), ("u",)], "seller_id string").withColumn("seller_key", surrogate_key("seller_id"))
    inputs = [spark.createDataFrame(df.collect(), df.schema) for df in (items, orders, people, goods, shops)]
    fact = marts.fct_order_items(*inputs)
    joined = inputs[0].join(inputs[3], "product_id", "left").join(inputs[4], "seller_id", "left").join(inputs[1], "order_id")
    joined = joined.join(inputs[2].select("customer_unique_id", "customer_key"), "customer_unique_id", "left")
    keys = ["order_id", "order_item_id", "customer_key", "product_key", "seller_key"]
    assert rows(fact.select(*keys)) == rows(joined.withColumn("customer_key", F.coalesce("customer_key", F.lit("_unmatched"))).select(*keys))
    after_the_last_join = plan_of(fact).split("Join ")[0]
    assert after_the_last_join.count("md5") >= 4
    light = marts._light(inputs[4], "seller_key", "seller_id")
    assert {r._seller_key for r in light.collect()} == {""}


def test_lines_are_numbered_by_what_items_say_of_them(spark, tmp_path):
    line = "1L AS l_orderkey, {p}L AS l_partkey, 2L AS l_suppkey, {n} AS l_linenumber, {q}D AS l_quantity, 5D AS l_extendedprice, " \
        "0D AS l_discount, {q}D AS l_tax, 'R' AS l_returnflag, 'F' AS l_linestatus, TIMESTAMP'1995-01-01' AS l_shipdate"
    given = [(1, 7, 3), (1, 7, 1), (1, 6, 9), (2, 1, 0)]
    spark.sql(" UNION ALL ".join("SELECT " + line.format(n=n, p=p, q=q) for n, p, q in given)).write.parquet(f"{tmp_path}/lineitem.parquet")
    items = retail.raw_items(spark, str(tmp_path))
    assert rows(items.select("order_item_id", "product_id")) == [(1, "6"), (2, "7"), (3, "7"), (4, "1")]
    assert "l_tax" not in plan_of(items) and "l_extendedprice" in plan_of(items)


def test_a_history_batch_of_many_keys_is_shuffled_once(spark, tmp_path):
    values = [(None if i % 11 == 0 else f"k{i % 7}", i, i % 3, 0) for i in range(60)]
    values += [(f"old{i}", i, 0, 0) for i in range(5)]
    known = spark.createDataFrame(values, "k string, at long, batch long, bucket int").repartition(3)
    own = known.where("batch = 2")
    kept = [_of_keys(known, own, 2, ["k"], many) for many in (True, False)]
    assert rows(kept[0]) == rows(kept[1]) and rows(kept[0]) == sorted((v for v in values if not str(v[0]).startswith("old")), key=repr)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        path = f"{tmp_path}/known"
        known.write.parquet(path)
        known = spark.read.parquet(path)
        numbered = over_history(_of_keys(known, known.where("batch = 2"), 2, ["k"], True), ["k"], ["at"], number="n")
        assert plan_of(numbered).count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_versions_of_the_newest_batch_stand_for_their_keys(spark, tmp_path):
    def batch(i, *found):
        keep_history(spark.createDataFrame(found, "k string, at long"), i, str(tmp_path), ["k"], lambda e: e)

    given = [[("a", 1), ("b", 1), (None, 1)], [("b", 2), ("c", 2)], [("a", 3), (None, 3), ("d", 3)]]
    for i, found in enumerate(given):
        batch(i, *found)
    schema = "`k` string, `at` bigint"
    kept = read_history(spark, str(tmp_path), schema, ["k"])
    assert rows(kept) == sorted((r for found in given for r in found), key=repr)


def test_digests_of_a_kept_history_are_made_as_it_is_read(spark, sf_dir, tmp_path):
    log = retail.event_log(spark, sf_dir, ["customer"])["customer"]
    state = KEPT["dim_customer"]
    events = state.stage(log)
    state.take(events, 0, str(tmp_path), False)
    (folder,) = Committed(spark, f"{tmp_path}/versions").newest().folders
    assert "customer_key" not in spark.read.parquet(Committed(spark, f"{tmp_path}/versions").place(folder.name)).columns
    found, made = state.read(spark, str(tmp_path), log), state.build(events)
    assert found.columns == made.columns and ddl(found) == ddl(made)
    assert rows(found) == rows(made)


def test_shared_models_are_written_once_and_summaries_save_counting_keys(spark, sf_dir):
    shared = catalog._shared(spark, sf_dir, "int_orders_current")
    stored, composed = shared.ref("int_orders_current"), shared.ref("stg_sellers")
    assert "int_orders_current" in stored.inputFiles()[0] and not [f for f in composed.inputFiles() if "marts-" in f]
    assert rows(stored) == rows(catalog._marts(spark, sf_dir).ref("int_orders_current"))
    assert set(shared.heavy) == {"customer", "order"} and all(h.sure for h in shared.heavy.values())
    assert shared.hot_keys("order") is None


def test_messages_and_times_are_packed(spark, tmp_path):
    write_messages(spark.sql("SELECT 't' AS topic, 0 AS partition, 1L AS kafka_offset, '{}' AS value"), f"{tmp_path}/m")
    assert [f for f in spark.read.parquet(f"{tmp_path}/m").inputFiles() if ".zstd." in f]
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == "TIMESTAMP_MICROS"
