import hashlib

from pyspark.sql import functions as F

from conftest import rows
from tidelog.functions import (
    is_snapshot,
    late_flag,
    no_op_update,
    op_name,
    primary_key,
    seconds_between,
    surrogate_key,
    timestamp_defects,
)


def test_op_names(spark):
    df = spark.createDataFrame([(c,) for c in "rcudt"] + [(None,)], "op string")
    named = [r[0] for r in df.select(op_name("op")).collect()]
    assert named == ["read", "insert", "update", "delete", "t", None]


def test_snapshot_flag(spark):
    df = spark.createDataFrame([("true",), ("false",), (None,), ("last",)], "s string")
    assert [r[0] for r in df.select(is_snapshot("s")).collect()] == [True, False, False, True]


def test_primary_key_needs_every_part(spark):
    images = [
        ("order_item", '{"order_id":"a","order_item_id":2}', "a:2"),
        ("order_item", '{"order_id":"a"}', None),
        ("order_item", '{"order_id":"a","order_item_id":null}', None),
        ("customer", '{"customer_unique_id":"p"}', "p"),
        ("nowhere", '{"customer_unique_id":"p"}', None),
        ("customer", None, None),
    ]
    df = spark.createDataFrame([i[:2] for i in images], "t string, image string")
    found = [r[0] for r in df.select(primary_key("t", "image")).collect()]
    assert found == [i[2] for i in images]


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    found = [r[0] for r in df.select(surrogate_key("k", "v")).collect()]
    expected = ["a-1", "_dbt_utils_surrogate_key_null_-2"]
    assert found == [hashlib.md5(e.encode()).hexdigest() for e in expected]


def test_seconds_are_counted_by_boundary(spark):
    df = spark.createDataFrame([(900, 1100), (1100, 1900), (5000, 3999)], "a bigint, b bigint")
    seconds = seconds_between(F.timestamp_millis("a"), F.timestamp_millis("b"))
    assert [r[0] for r in df.select(seconds).collect()] == [1, 0, -2]


def test_no_op_takes_null_as_a_value(spark):
    df = spark.createDataFrame(
        [
            ("update", "x", None, "x", None),
            ("update", "x", None, "x", "y"),
            ("update", "x", "z", "x", "z"),
            ("insert", None, None, None, None),
            ("delete", None, None, "x", None),
        ],
        "op string, a string, b string, prev_a string, prev_b string",
    )
    found = [r[0] for r in df.select(no_op_update("op", ["a", "b"])).collect()]
    assert found == [True, False, True, False, False]


def test_late_is_unknown_until_delivered(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (timestamp'2018-01-02 00:00', date'2018-01-01'), "
        "(timestamp'2018-01-01 23:59', date'2018-01-01'), (NULL, date'2018-01-01') AS t(d, e)"
    )
    assert [r[0] for r in df.select(late_flag("d", "e")).collect()] == [True, False, None]


def test_defect_flags_are_false_where_a_time_is_missing(spark):
    df = spark.createDataFrame(
        [(10, 5, 4, 3), (10, 10, 12, 12), (10, None, None, 3)], "p int, a int, s int, d int"
    )
    flags = timestamp_defects("p", "a", "s", "d")
    found = rows(df.select(F.monotonically_increasing_id().alias("i"), *flags.values()), "i")
    assert [r[1:] for r in found] == [
        (True, True, True, False),
        (False, False, False, True),
        (False, False, False, False),
    ]
