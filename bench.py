"""Times the headline jobs and prints one JSON line.

Change messages of all five tables are prepared as files first (not timed). Then the
event log is tailed from them, quarantine included, the models are built from the log,
and all declared checks run over the built tables. Every figure is the median of warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from tidelog import configure
from tidelog.operators import detect_changes, lifecycle_events
from tidelog.plans import retail
from tidelog.plans.catalog import PERSON, QUERIES, VISITS
from tidelog.plans.marts import ADDRESS, Marts
from tidelog.quality import contracts
from tidelog.schemas import TABLES
from tidelog.sources import read_log, write_messages
from tidelog.streaming import tail

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
MODELS = [
    "stg_order_events",
    "int_orders_current",
    "dim_customer",
    "dim_order_status_history",
    "fct_orders",
    "fct_order_items",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tidelog-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    root = tempfile.mkdtemp(prefix="tidelog-bench-")
    source = {"format": "parquet", "path": f"{root}/topics"}
    for table in TABLES:
        write_messages(retail.table_messages(spark, SF_DIR, table), source["path"], files=int(CPUS))
    loads = iter(range(1000))
    latest = {}

    def load() -> None:
        path = f"{root}/log-{next(loads)}"
        tail(spark, source, path, f"{path}-checkpoint", f"{path}-quarantine").awaitTermination()
        latest["log"] = path

    def log():
        return read_log(spark, latest["log"])

    def gate() -> None:
        contracts.all_checks(latest["marts"]).counts().collect()

    def build_all() -> None:
        marts = Marts(log(), path=f"{root}/marts-{next(loads)}", store_views=True)
        for name in ("dim_product", "dim_seller", "fct_orders", "fct_order_items"):
            marts.ref(name)
        latest["marts"] = marts

    def replay() -> None:
        orders = retail.orders_wide(spark, SF_DIR)
        run(lifecycle_events(orders, ["order_id"], retail.STEPS_MS, "final_status"))
        visits = retail.addresses(spark, SF_DIR)
        run(detect_changes(visits, PERSON, VISITS, ADDRESS))

    jobs = {"load_log": load}
    jobs |= {name: (lambda n=name: run(Marts(log()).ref(n))) for name in MODELS}
    jobs |= {
        "replay_transitions": replay,
        "user_state_history": lambda: run(QUERIES["user_state_history"](spark, SF_DIR)),
        "build_marts": build_all,
        "quality_gate": gate,
    }

    times = {}
    for name, job in jobs.items():
        taken = []
        for i in range(RUNS + 1):
            started = time.perf_counter()
            job()
            if i:  # the first run warms up
                taken.append(time.perf_counter() - started)
        times[name] = round(statistics.median(taken), 3)
        print(f"{name}: {times[name]} s", file=sys.stderr, flush=True)

    events = log().count()
    steps = lifecycle_events(
        retail.orders_wide(spark, SF_DIR), ["order_id"], retail.STEPS_MS, "final_status"
    ).count()
    print(
        json.dumps(
            {
                "metric": "headline jobs, total of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "events": events,
                "load_events_per_sec": round(events / times["load_log"]),
                "replay_transitions_per_sec": round(steps / times["replay_transitions"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
