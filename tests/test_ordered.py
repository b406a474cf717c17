"""The chunked form against the plain window and against plain Python."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from pyspark.sql import functions as F

from tidelog.operators import by_heat, cut_keys, find_hot_keys, over_history
from tidelog.operators.ordered import _levels, cuts_before

SCHEMA = "k string, a bigint, b bigint, v bigint"


def brute_force(data):
    out = []
    for key in {r[0] for r in data}:
        mine = sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[2]))
        top = None
        for i, r in enumerate(mine):
            top = r[3] if top is None else top if r[3] is None else max(top, r[3])
            after = mine[i + 1][3] if i + 1 < len(mine) else None
            before = mine[i - 1][3] if i else None
            out.append((*r, i + 1, len(mine), top, after, before))
    return sorted(out, key=repr)


def computed(df, hot):
    added = dict(
        number="n", total="t", running_max={"m": "v"}, lead={"nx": "v"}, lag={"pv": "v"}
    )
    return rows(by_heat(df, hot, lambda d, h: over_history(d, ["k"], ["a", "b"], hot=h, **added)))


def skewed(seed, n=200):
    draw = random.Random(seed)
    keys = ["hot"] * 6 + ["warm"] * 2 + ["c1", "c2", "c3"]
    taken = set()
    data = []
    while len(data) < n:
        row = (draw.choice(keys), draw.choice([0, 0, draw.randrange(2**62)]), draw.randrange(10**6))
        if row not in taken:
            taken.add(row)
            data.append((*row, draw.choice([None, draw.randrange(100)])))
    return data


@pytest.mark.parametrize("rows_per_chunk", [1, 7, 50, 10**6])
def test_chunked_equals_brute_force(spark, rows_per_chunk):
    data = skewed(rows_per_chunk)
    df = spark.createDataFrame(data, SCHEMA)
    hot = find_hot_keys(df, ["k"], ["a", "b"], rows_per_chunk)
    assert (hot is None) == (rows_per_chunk == 10**6)
    assert computed(df, hot) == brute_force(data)


def test_only_large_keys_are_hot_and_are_cut_by_size(spark):
    df = spark.createDataFrame([("x", 0, i, i) for i in range(100)] + [("y", 0, 1, 1)], SCHEMA)
    found = cut_keys(df, find_hot_keys(df, ["k"], ["a", "b"], 10)).frame.collect()
    assert [r["k"] for r in found] == ["x"]
    assert 7 <= len(found[0]["_cuts"][0]) <= 9


def test_rows_that_tie_in_the_leading_position_come_apart(spark):
    """One constant instant for all rows: the rest of the order cuts them."""
    df = spark.createDataFrame([("x", 5, i, i) for i in range(1000)], SCHEMA)
    hot = find_hot_keys(df, ["k"], ["a"], 50)
    seen = over_history(df, ["k"], ["a", "b"], number="n", hot=hot)
    assert rows(seen.select("b", "n"), "b") == [(i, i + 1) for i in range(1000)]
    assert dict(seen.dtypes)["n"] == "bigint"
    ranged = df.repartitionByRange(hot.chunks, "k", "a", "b")
    assert ranged.groupBy(F.spark_partition_id()).count().count() > 10


def test_cuts_are_counted_level_by_level(spark):
    cuts = [float(3 * i) for i in range(10_000)]
    df = spark.createDataFrame([(_levels(cuts),)], "cuts array<array<double>>")
    at = [-1.0, 0.0, 1.0, 189.0, 192.0, 12_287.0, 12_288.0, 29_997.0, 1e9]
    found = df.select(F.explode(F.array(*map(F.lit, at))).alias("p"), "cuts").select(cuts_before("cuts", F.col("p")))
    assert [r[0] for r in found.collect()] == [sum(c <= p for c in cuts) for p in at]


def test_null_key_can_be_hot(spark):
    data = [(None, 0, i, i % 5) for i in range(40)]
    df = spark.createDataFrame(data, SCHEMA)
    hot = find_hot_keys(df, ["k"], ["a", "b"], 10)
    assert computed(df, hot) == computed(df, None)


def test_hot_keys_of_another_key_are_refused(spark):
    df = spark.createDataFrame([("x", 0, i, i) for i in range(20)], SCHEMA)
    hot = find_hot_keys(df, ["k"], ["a", "b"], 5)
    with pytest.raises(ValueError):
        over_history(df, ["v"], ["a", "b"], number="n", hot=hot)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["p", "q"]),
            st.integers(0, 3),
            st.integers(0, 40),
            st.one_of(st.none(), st.integers(0, 9)),
        ),
        min_size=1,
        max_size=40,
        unique_by=lambda r: r[:3],
    )
)
def test_chunked_equals_brute_force_on_any_rows(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    assert computed(df, find_hot_keys(df, ["k"], ["a", "b"], 3)) == brute_force(data)


def test_only_named_keys_are_counted(spark):
    df = spark.createDataFrame([("x", 0, i, i) for i in range(30)] + [("y", 0, i, i) for i in range(30)], SCHEMA)
    among = spark.createDataFrame([("x",), ("z",)], "k string")
    assert [r["k"] for r in find_hot_keys(df, ["k"], ["a"], 20, among).frame.collect()] == ["x"]
    assert find_hot_keys(df, ["k"], ["a"], 40, among) is None
