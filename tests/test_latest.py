import pytest

from conftest import rows
from tidelog.operators import first_state, latest_state, newest_event

SCHEMA = "k string, lsn bigint, kafka_offset bigint, op string, v string"
EVENTS = [
    ("live", 0, 0, "read", "a"),
    ("live", 5, 1, "update", "b"),
    ("gone", 0, 2, "read", "a"),
    ("gone", 9, 3, "delete", None),
    ("back", 0, 4, "read", "a"),
    ("back", 6, 5, "delete", None),
    ("back", 7, 6, "insert", "c"),
    ("tie", 8, 7, "insert", "a"),
    ("tie", 8, 9, "update", "c"),
    ("tie", 8, 8, "update", "b"),
]


@pytest.mark.parametrize("form", ["window", "aggregate"])
def test_latest_state(spark, form):
    df = spark.createDataFrame(EVENTS, SCHEMA).repartition(3)
    live = latest_state(df, ["k"], ["lsn", "kafka_offset"], form=form)
    assert live.columns == df.columns
    assert rows(live.select("k", "v")) == [("back", "c"), ("live", "b"), ("tie", "c")]


def test_deletes_are_dropped_after_ranking(spark):
    df = spark.createDataFrame(EVENTS, SCHEMA)
    newest = newest_event(df, ["k"], ["lsn", "kafka_offset"])
    assert ("gone", "delete") in rows(newest.select("k", "op"))


def test_unknown_form(spark):
    with pytest.raises(ValueError):
        newest_event(spark.createDataFrame(EVENTS, SCHEMA), ["k"], ["lsn"], form="guess")


def test_first_state(spark):
    df = spark.createDataFrame([("p", 3, "b"), ("p", 1, "a"), ("q", 2, "c")], "k string, t int, v string")
    assert rows(first_state(df, ["k"], ["t"])) == [("p", 1, "a"), ("q", 2, "c")]


def test_ranking_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame(EVENTS, SCHEMA)
    plan = latest_state(df, ["k"], ["lsn", "kafka_offset"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan.split("== Physical Plan ==")[1]
