import hashlib
import random

from pyspark.sql import functions as F

from conftest import rows
from tidelog.operators import (
    changed_rows,
    detect_changes,
    find_hot_keys,
    first_activity,
    hash_sample,
    large_keys,
    lifecycle_events,
    out_of_order_count,
    parent_join,
    rewind,
    terminal_time,
    transitions_by_status,
    translate,
)

STEPS = [("approved", "approved"), ("shipped", "shipped"), ("delivered", "delivered")]
WIDE = "id int, final string, approved bigint, shipped bigint, delivered bigint"


def expected_events(wide):
    """The same expansion, one order at a time."""
    out = []
    for order, final, *times in wide:
        reached = [(s, t) for (_, s), t in zip(STEPS, times, strict=True) if t is not None]
        for i, (status, t) in enumerate(reached):
            early = i > 0 and t < reached[i - 1][1]
            out.append((order, i + 1, status, t, False, early))
        derived = reached[-1][0] if reached else "created"
        if final != derived:
            out.append((order, len(reached) + 1, final, None, True, False))
    return sorted(out, key=repr)


def wide_rows():
    draw = random.Random(1)
    finals = ["created", "approved", "shipped", "delivered", "canceled", "invoiced", None]
    return [
        (i, draw.choice(finals), *[draw.choice([None, draw.randrange(100)]) for _ in STEPS])
        for i in range(120)
    ]


def test_lifecycle_equals_a_walk_over_the_rows(spark):
    wide = wide_rows()
    events = lifecycle_events(spark.createDataFrame(wide, WIDE), ["id"], STEPS, "final")
    assert events.columns == ["id", "seq", "status", "at", "is_terminal_hop", "is_out_of_order"]
    expected = expected_events(wide)
    assert rows(events) == expected
    assert out_of_order_count(events).first()[0] == sum(e[5] for e in expected) > 0
    per_status = {}
    for e in expected:
        per_status[e[2]] = per_status.get(e[2], 0) + 1
    assert dict(rows(transitions_by_status(events))) == per_status


def test_lifecycle_needs_no_shuffle(spark):
    events = lifecycle_events(spark.createDataFrame(wide_rows(), WIDE), ["id"], STEPS, "final")
    assert "Exchange" not in events._jdf.queryExecution().executedPlan().toString()


def test_terminal_time(spark):
    df = spark.createDataFrame(
        [(9, None, 5, 7, 3), (2, 8, 5, 7, 3), (2, None, None, None, 3)],
        "updated int, delivered int, shipped int, approved int, purchased int",
    )
    at = terminal_time("updated", "delivered", "shipped", "approved", "purchased")
    assert [r[0] for r in df.select(at).collect()] == [9, 8, 3]


def test_rewind(spark):
    df = spark.createDataFrame([("delivered", 5, 9, 1, 9)], "status string, a int, d int, p int, u int")
    back = rewind(df, "status", ["a", "d"], "p", "u")
    assert rows(back) == [("created", None, None, 1, 1)]
    assert back.schema == df.schema or back.dtypes == df.dtypes


VISITS = [
    ("p", 1, "x", "c"), ("p", 2, "y", "c"), ("p", 3, "y", "c"), ("p", 4, "x", "c"),
    ("q", 1, None, "c"), ("q", 2, "z", "c"), ("q", 3, "z", None), ("q", 4, "z", "d"),
]


def test_changes_there_and_back_count_twice(spark):
    df = spark.createDataFrame(VISITS, "k string, t bigint, zip string, city string")
    changes = detect_changes(df, ["k"], ["t"], ["zip", "city"])
    # unknown values differ from nothing, and a row after an unknown zip is no change
    assert rows(changes.select("k", "t")) == [("p", 2), ("p", 4)]


def test_changed_rows_keep_the_first_and_tell_null_apart(spark):
    df = spark.createDataFrame(VISITS, "k string, t bigint, zip string, city string")
    found = rows(changed_rows(df, ["k"], ["t"], ["zip", "city"]).select("k", "t"))
    assert found == [("p", 1), ("p", 2), ("p", 4), ("q", 1), ("q", 2), ("q", 3), ("q", 4)]
    hot = find_hot_keys(df, ["k"], ["t"], 2)
    assert rows(changed_rows(df, ["k"], ["t"], ["zip", "city"], hot).select("k", "t")) == found


def test_hash_sample(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("id"))

    def bucket(i):
        return int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 100

    for percent, limit in [(10, 10), (-5, 1), (250, 100)]:
        found = {int(r[0]) for r in hash_sample(df, "id", percent).collect()}
        assert found == {i for i in range(3000) if bucket(i) < limit}
    assert hash_sample(df, "id", None).count() == hash_sample(df, "id", 0).count() == 3000


def test_translate_keeps_what_has_no_translation(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, code string")
    lookup = spark.createDataFrame([("a", "A")], "c string, t string")
    found = rows(translate(df, lookup, "code", "c", "t", "text"))
    assert found == [(1, "a", "A"), (2, "b", None), (3, None, None)]


def test_parent_join_with_busy_keys(spark):
    children = spark.createDataFrame([("a", i) for i in range(30)] + [("b", 1), ("c", 1)], "k string, n int")
    parents = spark.createDataFrame([("a", "A"), ("b", "B"), ("d", "D")], "k string, name string")
    busy = large_keys(children, ["k"], 10)
    assert [r[0] for r in busy.collect()] == ["a"]
    assert large_keys(children, ["k"], 30) is None
    for how in ("inner", "left"):
        found = parent_join(children, parents, "k", how, busy)
        assert rows(found) == rows(children.join(parents, "k", how))


def test_first_activity_falls_back(spark):
    sellers = spark.createDataFrame([("s",), ("idle",)], "seller string")
    lines = spark.createDataFrame([("s", 1), ("s", 2), ("s", 9)], "seller string, o int")
    orders = spark.sql("SELECT * FROM VALUES (1, timestamp_millis(50)), (2, timestamp_millis(20)) AS t(o, at)")
    dated = first_activity(sellers, lines, orders, "seller", "o", "at", "first", 7)
    assert rows(dated.select("seller", F.unix_millis("first"))) == [("idle", 7), ("s", 20)]
