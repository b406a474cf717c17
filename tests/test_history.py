import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidelog.operators import find_hot_keys, scd2, with_duration

SCHEMA = (
    "k string, lsn bigint, kafka_offset bigint, op string, v string, changed bigint, "
    "seen bigint, is_no_op_update boolean"
)
ORDER = ["lsn", "kafka_offset"]
END = 253402300799000


def build(spark, events, **options):
    hot_rows = options.pop("rows_per_chunk", None)
    df = spark.createDataFrame([(*e, False) if len(e) == 7 else e for e in events], SCHEMA)
    df = df.withColumns(
        {"changed_at": F.timestamp_millis("changed"), "event_at": F.timestamp_millis("seen")}
    )
    hot = find_hot_keys(df, ["k"], ORDER, hot_rows) if hot_rows else None
    return scd2(df, ["k"], ORDER, hot=hot, **options)


def windows(df):
    shown = df.select(
        "k", "version", "v", F.unix_millis("valid_from").alias("f"),
        F.unix_millis("valid_to").alias("t"), "is_current", "is_deleted",
    )
    return rows(shown, "k", "version")


PLAIN = [("a", 0, 0, "read", "x", 10, 1), ("a", 5, 1, "update", "y", 20, 2)]


def test_versions_tile(spark):
    assert windows(build(spark, PLAIN)) == [
        ("a", 1, "x", 10, 20, False, False),
        ("a", 2, "y", 20, END, True, False),
    ]


def test_no_op_opens_no_version(spark):
    same = ("a", 3, 9, "update", "x", 15, 2, True)
    found = build(spark, [(*e, False) for e in PLAIN] + [same])
    assert [r[1:5] for r in windows(found)] == [(1, "x", 10, 20), (2, "y", 20, END)]


def test_order_comes_from_the_log_and_clamp_from_time(spark):
    events = [
        ("a", 0, 0, "read", "x", 10, 1),
        ("a", 1, 1, "update", "y", 30, 2),
        ("a", 2, 2, "update", "z", 5, 3),
        ("a", 3, 3, "update", "w", 40, 4),
    ]
    plain = windows(build(spark, events))
    assert [r[3:5] for r in plain] == [(10, 30), (30, 5), (5, 40), (40, END)]
    clamped = build(spark, events, clamp=True)
    assert [r[2:5] for r in windows(clamped)] == [
        ("x", 10, 30), ("y", 30, 30), ("z", 30, 40), ("w", 40, END),
    ]
    flagged = rows(with_duration(clamped).select("version", "is_timestamp_clamped", "is_instantaneous"))
    assert flagged == [(1, False, False), (2, False, True), (3, True, False), (4, False, False)]


DELETED = [*PLAIN, ("a", 7, 2, "delete", None, None, 50)]
RESURRECTED = [*DELETED, ("a", 8, 3, "insert", "z", 45, 60)]


def test_delete_closes_the_open_version(spark):
    assert windows(build(spark, DELETED)) == [
        ("a", 1, "x", 10, 20, False, False),
        ("a", 2, "y", 20, 50, False, True),
    ]


def test_delete_does_not_overrun_a_resurrected_version(spark):
    assert windows(build(spark, RESURRECTED)) == [
        ("a", 1, "x", 10, 20, False, False),
        ("a", 2, "y", 20, 45, False, True),
        ("a", 3, "z", 45, END, True, False),
    ]


def test_delete_leaves_a_gap_before_a_later_insert(spark):
    later = [*DELETED, ("a", 8, 3, "insert", "z", 70, 80)]
    assert [r[3:5] for r in windows(build(spark, later))] == [(10, 20), (20, 50), (70, END)]


def test_delete_does_not_end_before_its_version_starts(spark):
    early = [*PLAIN, ("a", 7, 2, "delete", None, None, 3)]
    assert windows(build(spark, early))[1][3:5] == (20, 20)


def test_no_op_between_version_and_delete(spark):
    events = [(*e, False) for e in PLAIN]
    events += [("a", 6, 8, "update", "y", 25, 4, True), ("a", 7, 9, "delete", None, None, 50, False)]
    assert windows(build(spark, events))[1] == ("a", 2, "y", 20, 50, False, True)


def test_leading_and_repeated_deletes(spark):
    events = [
        ("a", 1, 0, "delete", None, None, 1),
        ("a", 2, 1, "insert", "x", 10, 2),
        ("a", 3, 2, "delete", None, None, 30),
        ("a", 4, 3, "delete", None, None, 40),
    ]
    assert windows(build(spark, events)) == [("a", 1, "x", 10, 30, False, True)]


def test_keep_makes_deletes_versions(spark):
    kept = windows(build(spark, DELETED, on_delete="keep"))
    # no business time on the delete: the version before it looks current as well
    assert [r[5] for r in kept] == [False, True, True]
    clamped = windows(build(spark, DELETED, on_delete="keep", clamp=True))
    assert [r[3:6] for r in clamped] == [(10, 20, False), (20, 20, False), (20, END, True)]


def test_modes_agree_without_deletes(spark):
    keep, close = (build(spark, PLAIN, on_delete=m) for m in ("keep", "close"))
    assert rows(keep) == rows(close)


@pytest.mark.parametrize("clamp", [False, True])
@pytest.mark.parametrize("on_delete", ["keep", "close"])
def test_hot_keys_give_the_same_history(spark, clamp, on_delete):
    events, offset = [], 0
    for key, n in [("hot", 60), ("cold", 4)]:
        for i in range(n):
            op = "read" if i == 0 else "delete" if i % 11 == 7 else "insert" if i % 11 == 8 else "update"
            value, at = (None, None) if op == "delete" else (str(i), 1000 + i * 10 - (i % 7) * 15)
            same = op == "update" and i % 5 == 3
            events.append((key, 0 if i == 0 else i, offset, op, value, at, 5000 + i, same))
            offset += 1
    options = dict(clamp=clamp, on_delete=on_delete)
    assert rows(build(spark, events, rows_per_chunk=7, **options)) == rows(
        build(spark, events, **options)
    )


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        build(spark, PLAIN, on_delete="ignore")
