"""Every registered query against its SQL, and the contract of the entry file."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_file
import oracle_queries
from conftest import SF_DIR
from tidelog.plans import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# what the text operators add has tests of its own, beside them
QUERIES, ORACLE = catalog.QUERIES, oracle_queries.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_names():
    assert set(ORACLE) == set(QUERIES) <= set(entry_file.queries())
    assert set(ORACLE) <= set(entry_file.oracle_sql()) <= set(entry_file.queries())


def test_flagship(spark):
    assert entry_file.entry(spark).count() > 0


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr)
    cursor = duck.execute(ORACLE[name])
    at = [d[0] for d in cursor.description]
    assert sorted(at) == columns
    order = [at.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    assert found == expected
