import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidelog import configure  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tidelog-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows(df, *order):
    """Rows as plain tuples, sorted by the given columns or by everything."""
    found = [tuple(r) for r in df.collect()]
    if order:
        at = [df.columns.index(c) for c in order]
        return sorted(found, key=lambda r: tuple((r[i] is not None, r[i]) for i in at))
    return sorted(found, key=repr)
