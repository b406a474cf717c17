"""Checks pass on sound data, and each finds the fault planted for it."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidelog import quality as q
from tidelog.operators import find_hot_keys
from tidelog.plans import retail
from tidelog.plans.marts import MODELS, Marts
from tidelog.quality import contracts
from tidelog.quality.totals import total_drift


@pytest.fixture(scope="module")
def marts(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("marts"))
    return Marts(retail.landed_log(spark, sf_dir, deletes=True), path=path)


@pytest.fixture(scope="module")
def sound(spark, sf_dir, tmp_path_factory):
    built = Marts(retail.landed_log(spark, sf_dir), path=str(tmp_path_factory.mktemp("sound")))
    return built, contracts.build_gated(built)


def test_all_declared_checks_pass_on_sound_data(sound):
    _, results = sound
    assert len(results) == 88
    assert set(results.values()) == {0}


def test_all_declared_checks_pass_with_deletes(marts):
    found = {r["check"]: r["violations"] for r in contracts.all_checks(marts).counts().collect()}
    assert len(found) == 88
    assert set(found.values()) == {0}


MUTATIONS = [
    ("fct_orders", lambda df: df.filter("order_id <> '4'"), "fct_orders_reconciles_to_log"),
    ("fct_orders", lambda df: df.unionByName(df.filter("order_id = '4'")), "fct_orders.unique_order_id"),
    ("fct_order_items", lambda df: df.filter("order_id <> '7'"), "facts_reconcile"),
    (
        "fct_order_items",
        lambda df: df.withColumn("product_key", F.lit("nowhere")),
        "fct_order_items.relationship_product_key",
    ),
    (
        "fct_order_items",
        lambda df: df.withColumn("price", -F.col("price")),
        "fct_order_items.price_is_positive",
    ),
    (
        "dim_customer",
        lambda df: df.withColumn("is_current", F.lit(True)),
        "exactly_one_current_version",
    ),
    (
        "dim_customer",
        lambda df: df.withColumn("valid_to", F.expr("valid_to + INTERVAL 40 DAY")),
        "windows_have_no_gaps_or_overlaps",
    ),
    (
        "dim_customer",
        lambda df: df.withColumn("valid_from", F.expr("valid_from + INTERVAL 1 SECOND")),
        "as_of_join_does_not_fan_out",
    ),
    ("dim_customer", lambda df: df.filter("version < 2"), "version_counts_match_log"),
    (
        "dim_customer",
        lambda df: df.withColumn("valid_to", F.col("valid_from")),
        "dim_customer.windows_have_positive_width",
    ),
    (
        "dim_order_status_history",
        lambda df: df.withColumn("order_status", F.lit("lost")),
        "dim_order_status_history.accepted_values_order_status",
    ),
    (
        "dim_order_status_history",
        lambda df: df.withColumn("order_status", F.lit(None).cast("string")),
        "dim_order_status_history.not_null_order_status",
    ),
]


@pytest.mark.parametrize("model, corrupt, check", MUTATIONS, ids=[c for _, _, c in MUTATIONS])
def test_each_corruption_fails_its_check(sound, model, corrupt, check):
    built, _ = sound
    broken = Marts(built.log)
    for name in MODELS:
        broken.use(name, built.ref(name))
    broken.use(model, corrupt(built.ref(model)))
    suite = contracts.table_checks(broken, model)
    if "." not in check and check not in suite.names():
        contracts.invariant_checks(broken, suite)
    with pytest.raises(q.GateFailure) as failure:
        q.run_gate(suite)
    assert failure.value.failures[check] > 0


HISTORY_CHECKS = {"current": "c", "tiling": "t", "repeated": "r", "versions": "v"}


@pytest.mark.parametrize("rows_per_chunk", [10**6, 3])
def test_a_history_is_checked_in_one_pass_as_by_the_single_checks(spark, marts, rows_per_chunk):
    dim, key = marts.ref("dim_order_status_history"), "order_id"
    k = F.col(key).cast("int")
    faulty = (
        dim.filter((k % 11 != 3) | (F.col("version") != 2))
        .withColumn("is_current", F.col("is_current") | ((k % 13 == 5) & (F.col("version") == 1)))
        .withColumn("valid_to", F.when(k % 17 == 7, F.timestamp_millis(F.unix_millis("valid_to") + 1)).otherwise(F.col("valid_to")))
    )
    faulty = faulty.unionByName(faulty.filter((k % 19 == 2) & (F.col("version") == 1)))
    events = marts.ref("stg_order_events")
    hot = find_hot_keys(faulty, [key], ["version"], rows_per_chunk)
    assert (hot is None) == (rows_per_chunk > 3)
    counts = q.history_checks(faulty, key, HISTORY_CHECKS, hot, q.opening_events(events))
    single = {
        "c": q.one_current(faulty, key, "m").count(),
        "r": q.unique_combination(faulty, [key, "version"]).count(),
        "v": q.versions_match_log(events, faulty, key).count(),
    }
    found = {r["check"]: r["violations"] for r in counts.collect()}
    # copies of a version have no order among them, so tiling is compared without them
    once = faulty.dropDuplicates([key, "version"])
    tiling = q.history_checks(once, key, {"tiling": "t"}, hot).first()["violations"]
    assert {n: found[n] for n in single} == single and min(single.values()) > 0
    assert tiling == q.no_gaps_or_overlaps(once, key, "m").count() > 0


def test_a_history_is_shuffled_once_for_all_its_checks(marts):
    dim = marts.ref("dim_order_status_history")
    opening = q.opening_events(marts.ref("stg_order_events"))
    counts = q.history_checks(dim, "order_id", HISTORY_CHECKS, None, opening)
    text = counts._jdf.queryExecution().executedPlan().toString()
    # the history, the events, and the one row of totals
    assert text.count("Exchange hashpartitioning") == 2 and text.count("Exchange SinglePartition") == 1


def test_an_empty_history_has_no_offences(marts):
    none = marts.ref("dim_order_status_history").limit(0)
    opening = q.opening_events(marts.ref("stg_order_events").limit(0))
    assert {r[1] for r in q.history_checks(none, "order_id", HISTORY_CHECKS, None, opening).collect()} == {0}


def test_a_failed_check_stops_the_build(spark, sf_dir):
    log = retail.landed_log(spark, sf_dir)
    lost = {**log, "order": log["order"].withColumn("lsn", F.lit(None).cast("bigint"))}
    with pytest.raises(q.GateFailure) as failure:
        contracts.build_gated(Marts(lost))
    assert set(failure.value.failures) == {"cdc_events.streamed_events_have_lsn"}


def test_unknown_is_no_offence_unless_said(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "n int")
    assert q.expression_is_true(df, "n > 0").count() == 1
    assert q.expression_is_true(df, "n > 0", null_offends=True).count() == 2
    assert q.accepted_values(df, "n", [1]).count() == 1
    assert q.not_null(df, "n").count() == 1


def test_range_bounds(spark):
    df = spark.createDataFrame([(0,), (1,), (5,), (6,), (None,)], "n int")
    assert rows(q.accepted_range(df, "n", 0, 5)) == [(6,)]
    assert rows(q.accepted_range(df, "n", 0, 5, inclusive=False)) == [(0,), (5,), (6,)]
    assert rows(q.accepted_range(df, "n", minimum=1)) == [(0,)]


def test_unique_ignores_unknown_and_combinations_do_not(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 2), (None, 2)], "a int, b int")
    assert rows(q.unique(df, "a")) == [(1, 2)]
    assert rows(q.unique_combination(df, ["a", "b"])) == [(1, 1, 2), (None, 2, 2)]


def test_relationships_count_orphans(spark):
    child = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "k string")
    parent = spark.createDataFrame([("x",)], "id string")
    assert rows(q.relationships(child, "k", parent, "id")) == [("y", 2)]


def test_counts_and_invariants(spark):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    assert q.assert_counts({"t": df}, {"t": 2}).count() == 0
    assert rows(q.assert_counts({"t": df, "u": df}, {"t": 2, "u": 3})) == [("u", 3, 2)]
    total = df.agg(F.sum("n").cast("decimal(10,2)").alias("s"))
    held, failed = ("held", total, "3.00"), ("failed", total, 3.01)
    assert [r[0] for r in q.assert_invariants([held, failed]).collect()] == ["failed"]
    nothing = df.filter("false").agg(F.sum("n").alias("s"))
    assert q.assert_invariants([("empty", nothing, 0)]).count() == 1


def test_distribution_drift_counts_missing_values_as_zero(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "s string")
    b = spark.createDataFrame([("x",), ("z",)], "s string")
    drift = q.distribution_drift(a, b, "s")
    assert rows(drift) == [("x", 2, 1, 1), ("y", 1, 0, 1), ("z", 0, 1, -1)]
    assert total_drift(drift).first()[0] == 3


def test_log_matches_a_source_without_the_deleted_rows(spark, sf_dir, marts):
    log = marts.source("order")
    live = marts.ref("int_orders_current")
    assert q.log_matches_source(log, {"order": live}).count() == 0
    assert q.log_matches_source(log, {"order": live, "seller": live}).count() == 1


def test_offset_gaps_in_and_between_chunks(spark):
    offsets = [o for o in range(200) if o not in (0, 37, 38, 120)]
    log = spark.createDataFrame(
        [("t", 0, o) for o in offsets] + [("u", 1, 5), ("u", 1, 7)],
        "topic string, partition int, kafka_offset bigint",
    )
    expected = [("t", 39, 36, 2), ("t", 121, 119, 1), ("u", 7, 5, 1)]
    for limit in (10**6, 20, 3):
        found = q.offset_gaps(log, limit).select("topic", "kafka_offset", "previous", "missing")
        assert rows(found, "topic", "kafka_offset") == expected


def test_order_key(spark):
    log = spark.createDataFrame(
        [("t", 0, 1, 10), ("t", 0, 2, 12), ("t", 0, 3, 11), ("t", 0, 4, 12), ("u", 0, 1, 5), ("u", 0, 2, None)],
        "topic string, partition int, kafka_offset bigint, lsn bigint",
    )
    found = rows(q.order_key_sound(log).select("problem", "topic", "lsn", "events"))
    assert found == [("backwards", "t", 11, 1), ("collision", "t", 12, 2)]


def test_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "k string, v int")
    assert rows(q.profile(df, "k", ["v"])) == [(3, 2, 1, 1)]
