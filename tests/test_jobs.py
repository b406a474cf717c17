"""The jobs in their order, on files."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_replay import FILES
from tidelog import jobs
from tidelog.plans.kept import KEPT
from tidelog.plans.marts import Marts
from tidelog.quality import Suite, contracts, log_gaps
from tidelog.schemas import MESSAGE
from tidelog.sources import append_log, read_log


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    (folder / "csv").mkdir()
    for name, text in FILES.items():
        (folder / "csv" / f"{name}.csv").write_text(text)
    assert jobs.main(["derive", "--csv", f"{folder}/csv", "--out", f"{folder}/topics"]) == 0
    return folder


def load(root, *more):
    return jobs.main(["load", "--path", f"{root}/topics", "--log", f"{root}/log", *more])


def test_jobs_from_csv_to_checked_models(spark, root, capsys):
    stream = ["--checkpoint", f"{root}/checkpoint", "--quarantine", f"{root}/quarantine"]
    assert load(root, *stream) == 0
    first = rows(read_log(spark, f"{root}/log").drop("batch"))
    initial = 2 + 2 + 2 + 3 + 3  # customers, sellers, products, orders, items
    assert len(first) == initial + 6 + 1  # status steps, moves
    assert load(root, *stream) == 0  # nothing new
    assert rows(read_log(spark, f"{root}/log").drop("batch")) == first

    where = ["--log", f"{root}/log", "--marts", f"{root}/marts", "--quarantine", f"{root}/quarantine"]
    assert jobs.main(["build", *where, "--store-views"]) == 0
    assert jobs.main(["verify", *where]) == 0
    assert "89 checks passed" in capsys.readouterr().out

    items = f"{root}/marts/fct_order_items"
    spark.read.parquet(items).write.mode("append").parquet(items)
    assert jobs.main(["verify", *where]) == 1


def test_rebuild_gives_the_same_log(spark, root):
    before = rows(read_log(spark, f"{root}/log").drop("batch"))
    assert load(root, "--rebuild", "--quarantine", f"{root}/quarantine") == 0
    assert rows(read_log(spark, f"{root}/log").drop("batch")) == before


def test_upkeep_follows_the_log_and_compaction_leaves_it_alone(spark, root, capsys):
    state = ["upkeep", "--log", f"{root}/log", "--state", f"{root}/state"]
    assert jobs.main(state) == 0
    first = capsys.readouterr().out
    assert first.count("at version") == len(KEPT) and "order_latency" in first
    before = rows(read_log(spark, f"{root}/log"))
    assert jobs.main(["compact", "--log", f"{root}/log", "--keep-versions", "3", "--older-than-hours", "0"]) == 0
    assert rows(read_log(spark, f"{root}/log")) == before
    assert jobs.main([*state, "--only", "dim_customer"]) == 0
    kept = KEPT["dim_customer"].read(spark, f"{root}/state/dim_customer", read_log(spark, f"{root}/log"))
    assert rows(kept) == rows(Marts(read_log(spark, f"{root}/log")).ref("dim_customer"))


def test_missing_offsets_are_an_offence_where_asked(spark, root, tmp_path):
    log = read_log(spark, f"{root}/log")
    held = {tuple(r) for r in log.select("topic", "partition", "kafka_offset").collect()}
    topic, partition, inner = next(p for p in sorted(held) if {(*p[:2], p[2] - 1), (*p[:2], p[2] + 1)} <= held)
    holed = log.where(~((F.col("topic") == topic) & (F.col("partition") == partition) & (F.col("kafka_offset") == inner)))
    counts = {}
    for name, part in (("whole", log), ("holed", holed)):
        append_log(part, f"{tmp_path}/{name}")
        checks = contracts.log_checks(Suite(), part, log_gaps(spark, f"{tmp_path}/{name}"))
        counts[name] = {r["check"]: r["violations"] for r in checks.counts().collect()}
    assert set(counts["whole"]) == {"offsets_are_complete", "order_key_is_sound"}
    assert counts["holed"]["offsets_are_complete"] == counts["whole"]["offsets_are_complete"] + 1


def test_load_needs_its_folders(root):
    with pytest.raises(SystemExit):
        load(root)


def test_quarantine_stops_the_build(spark, root, tmp_path):
    value = '{"op": "r", "ts_ms": 1, "source": {}, "after": {"customer_unique_id": "p"}}'
    topic = spark.read.parquet(f"{root}/topics").first()["topic"]
    row = spark.createDataFrame([(topic, 0, 10**9, value)], MESSAGE)
    row.write.parquet(f"{tmp_path}/topics")
    spark.read.parquet(f"{root}/topics").write.mode("append").parquet(f"{tmp_path}/topics")
    where = ["--log", f"{tmp_path}/log", "--quarantine", f"{tmp_path}/quarantine"]
    assert jobs.main(["load", "--path", f"{tmp_path}/topics", "--rebuild", *where]) == 0
    build = ["build", *where, "--marts", f"{tmp_path}/marts", "--store-views"]
    assert jobs.main(build) == 1
    assert jobs.main([*build, "--allow-quarantined"]) == 0
