"""Tables that several test modules use."""

import random

import pytest


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows and extra columns."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    long = " ".join(rng.choice(vocabulary) for _ in range(60_000))
    some = " ".join(rng.choice(vocabulary) for _ in range(120))
    near = " ".join(some.split()[:-1] + ["changed"])
    rows = [
        (1, some, "en"),
        (2, near, "en"),
        (3, some, None),
        (3, some, None),
        (4, None, "en"),
        (5, "", "en"),
        (6, " \t\n\v ", "en"),
        (7, "One", "en"),
        (8, "one", "en"),
        (9, "one two", "en"),
        (10, long, "en"),
        (11, long + " tail", "en"),
        (None, "nobody knows whose text this is", "en"),
        (12, "ÉTÉ  école\x1cx " * 7, None),
        (13, "x" * 5000, "de"),
    ]
    schema = "doc_id long, text string, score string"
    return spark.createDataFrame(rows, schema).selectExpr("*", "score AS component_id", "doc_id AS node", "1 AS n")
