"""Command-line jobs, for `spark-submit` or `python -m tidelog.jobs`.

    derive   CSV export -> change messages as files
    load     change messages (files or Kafka) -> event log; resumes, or rebuilds
    upkeep   event log -> histories and latest states, from what came in since the last run
    compact  merge the log's small folders, and delete what no recent version names
    build    event log -> models, each checked before the next reads it
    verify   event log and models -> summary and all checks, non-zero exit on failure
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidelog.operators.ordered import ROWS_PER_CHUNK
from tidelog.plans.kept import KEPT
from tidelog.plans.marts import MODELS, Marts
from tidelog.plans.replay import change_messages, read_export
from tidelog.quality import GateFailure, contracts, log_gaps, run_gate
from tidelog.schemas import CSV_TABLES, TABLES
from tidelog.session import configure
from tidelog.sources import compact_log, heavy_keys, load_summary, read_log, write_messages
from tidelog.sources.commits import Committed
from tidelog.streaming import follow_log, read_quarantine, rebuild_log, tail


def derive(spark: SparkSession, args: argparse.Namespace) -> None:
    names = dict(pair.split("=", 1) for pair in args.file)
    files = {t: names.get(t, f"{args.csv}/{t}.csv") for t in CSV_TABLES}
    export = read_export(spark, files)
    partitions = args.partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for table in TABLES:
        messages = change_messages(export, table, args.sample_pct, partitions)
        write_messages(messages, args.out, args.format)


def _source(args: argparse.Namespace) -> dict[str, str]:
    options = dict(pair.split("=", 1) for pair in args.option)
    return {"format": args.format, **({"path": args.path} if args.path else {}), **options}


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.rebuild:
        rebuild_log(spark, _source(args), args.log, args.quarantine)
    else:
        query = tail(
            spark,
            _source(args),
            args.log,
            args.checkpoint,
            args.quarantine,
            drain=not args.follow,
            batch_limit=args.batch_limit,
        )
        query.awaitTermination()
    log = read_log(spark, args.log)
    if log is not None:
        for row in load_summary(log).orderBy("source_table", "op").collect():
            print(f"{row['source_table'] or 'all':<12} {row['op'] or 'all':<8} {row['events']}")
    print(f"{read_quarantine(spark, args.log, args.quarantine).count()} messages in quarantine")
    print(f"{log_gaps(spark, args.log).count()} gaps in offsets")


def upkeep(spark: SparkSession, args: argparse.Namespace) -> None:
    chosen = {name: KEPT[name] for name in args.only or KEPT}
    for name, version in follow_log(spark, args.log, args.state, chosen).items():
        print(f"{name:<26} at version {version}")


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    print(f"{compact_log(spark, args.log)} folders merged")
    if args.keep_versions:
        table = Committed(spark, args.log)
        print(f"{table.remove_unnamed(args.keep_versions, args.older_than_hours * 3_600_000)} folders deleted")


def _quarantine(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    if args.allow_quarantined or not args.quarantine:
        return None
    return read_quarantine(spark, args.log, args.quarantine)


def build(spark: SparkSession, args: argparse.Namespace) -> None:
    heavy = heavy_keys(spark, args.log, ROWS_PER_CHUNK)
    marts = Marts(read_log(spark, args.log), path=args.marts, store_views=args.store_views, heavy=heavy)
    results = contracts.build_gated(marts, _quarantine(spark, args))
    print(f"{len(MODELS)} models built, {len(results)} checks passed")


def verify(spark: SparkSession, args: argparse.Namespace) -> None:
    marts = Marts(read_log(spark, args.log), heavy=heavy_keys(spark, args.log, ROWS_PER_CHUNK))
    for name, model in MODELS.items():
        if model.materialized == "table":
            marts.use(name, spark.read.parquet(f"{args.marts.rstrip('/')}/{name}"))
    suite = contracts.all_checks(marts)
    suite = contracts.quarantine_check(suite, _quarantine(spark, args))
    if args.no_gaps:
        suite = contracts.log_checks(suite, read_log(spark, args.log), log_gaps(spark, args.log))
    results = run_gate(suite)
    print(f"{len(results)} checks passed")


def _gate_arguments(job: argparse.ArgumentParser) -> None:
    job.add_argument("--quarantine", help="fail if a message lies there")
    job.add_argument("--allow-quarantined", action="store_true")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidelog", description=__doc__.splitlines()[0])
    jobs = top.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("derive")
    job.add_argument("--csv", required=True, help="folder of the export")
    job.add_argument("--file", action="append", default=[], help="table=path, where named otherwise")
    job.add_argument("--out", required=True)
    job.add_argument("--format", default="parquet", choices=["json", "parquet"])
    job.add_argument("--partitions", type=int, help="topic partitions; by default the session's shuffle partitions")
    job.add_argument("--sample-pct", type=int)
    job.set_defaults(run=derive)

    job = jobs.add_parser("load")
    job.add_argument("--format", default="parquet", choices=["json", "parquet", "kafka"])
    job.add_argument("--path")
    job.add_argument("--option", action="append", default=[], help="reader option, name=value")
    job.add_argument("--log", required=True)
    job.add_argument("--checkpoint")
    job.add_argument("--quarantine", required=True)
    job.add_argument("--batch-limit", type=int, help="messages (Kafka) or files of a micro-batch")
    job.add_argument("--follow", action="store_true", help="keep running")
    job.add_argument("--rebuild", action="store_true", help="from the first offset")
    job.set_defaults(run=load)

    job = jobs.add_parser("upkeep")
    job.add_argument("--log", required=True)
    job.add_argument("--state", required=True)
    job.add_argument("--only", action="append", choices=sorted(KEPT), help="one of the states; all by default")
    job.set_defaults(run=upkeep)

    job = jobs.add_parser("compact")
    job.add_argument("--log", required=True)
    job.add_argument("--keep-versions", type=int, help="delete folders that no newer version names")
    job.add_argument("--older-than-hours", type=int, default=24, help="leave younger folders: a writer may yet commit them")
    job.set_defaults(run=compact)

    job = jobs.add_parser("build")
    job.add_argument("--log", required=True)
    job.add_argument("--marts", required=True)
    job.add_argument("--store-views", action="store_true")
    _gate_arguments(job)
    job.set_defaults(run=build)

    job = jobs.add_parser("verify")
    job.add_argument("--log", required=True)
    job.add_argument("--marts", required=True)
    _gate_arguments(job)
    job.add_argument("--no-gaps", action="store_true", help="fail on missing offsets or a log position that runs backwards")
    job.set_defaults(run=verify)
    return top


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.job == "load" and not args.rebuild and not args.checkpoint:
        parser().error("load needs --checkpoint unless it rebuilds")
    spark = configure(SparkSession.builder.appName(f"tidelog-{args.job}").getOrCreate())
    try:
        args.run(spark, args)
    except GateFailure as failure:
        print(failure, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
