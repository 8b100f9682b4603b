"""Scheduled-job entry point: the loads as spark-submit commands.

    spark-submit chatlake/jobs.py initial     --namespace lake --change-log s3://.../changes \\
        --table analytics.conversation_messages [--path s3://.../curated] [--offset-minutes -240]
    spark-submit chatlake/jobs.py incremental --namespace lake --change-log ... --table ...
    spark-submit chatlake/jobs.py stream      --namespace lake --change-log ... \\
        --sink s3://.../stream_sink --checkpoint s3://.../stream_ckpt [--after-version 41]
    spark-submit chatlake/jobs.py live        --namespace lake --change-log ... --sink ... --checkpoint ... (runs on)
    spark-submit chatlake/jobs.py compact     --table ... --target analytics.messages_by_date
    spark-submit chatlake/jobs.py refresh     --table ... --target analytics.messages_by_date

Each command prints one JSON line with the outcome. The session is the
cluster's (``SparkSession.builder.getOrCreate()``); nothing here sets a master.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from dataclasses import asdict

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from chatlake.config import LoadConfig  # noqa: E402
from chatlake.plans.compact import compact_by_date, refresh_by_date  # noqa: E402
from chatlake.plans.loads import incremental_load, initial_load  # noqa: E402
from chatlake.streaming.incremental import run_incremental_stream, start_live_stream  # noqa: E402


def config_from_args(a: argparse.Namespace) -> LoadConfig:
    kw = dict(
        namespace=a.namespace,
        change_log=a.change_log,
        change_log_format=a.change_log_format,
        curated_table=a.table,
        curated_path=a.path,
        tz_offset_minutes=a.offset_minutes,
        epoch_unit=a.epoch_unit,
        local_date=a.local_date,
        dedupe_users=a.dedupe_users,
        salvage_payloads=not a.no_salvage,
        rejects_path=a.rejects_path,
    )
    if a.transcript_table:
        kw["transcript_table"] = a.transcript_table
    if a.user_table:
        kw["user_table"] = a.user_table
    return LoadConfig(**kw)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="chatlake.jobs", description=__doc__.splitlines()[0])
    p.add_argument("command", choices=["initial", "incremental", "stream", "live", "compact", "refresh"])
    p.add_argument("--namespace")
    p.add_argument("--transcript-table")
    p.add_argument("--user-table")
    p.add_argument("--change-log")
    p.add_argument("--change-log-format", default="parquet", choices=["parquet", "delta"])
    p.add_argument("--table", default=LoadConfig.curated_table)
    p.add_argument("--path", help="location of the curated table's files (external table)")
    p.add_argument("--offset-minutes", type=int, default=LoadConfig.tz_offset_minutes)
    p.add_argument("--epoch-unit", default="s", choices=["s", "ms"])
    p.add_argument("--local-date", action="store_true")
    p.add_argument("--dedupe-users", action="store_true")
    p.add_argument("--no-salvage", action="store_true", help="drop payload arrays with unreadable elements whole")
    p.add_argument("--rejects-path", help="folder for payloads that could not be read, with the reason")
    p.add_argument("--version", type=int, help="initial: baseline version to load as of")
    p.add_argument("--end", type=int, help="incremental: last version to load (default: latest)")
    p.add_argument("--sink", help="stream: sink folder")
    p.add_argument("--checkpoint", help="stream: checkpoint folder")
    p.add_argument("--after-version", type=int, help="stream: skip versions up to this one")
    p.add_argument(
        "--max-files-per-trigger",
        type=int,
        help="stream: bound each micro-batch (availableNow drains a backlog in several batches)",
    )
    p.add_argument("--target", help="compact, refresh: date-partitioned copy to (re)write")
    p.add_argument("--target-path", help="compact: location of the copy's files")
    return p


def run(spark: SparkSession, argv: list[str]) -> dict:
    a = parser().parse_args(argv)
    cfg = config_from_args(a)
    if a.command == "initial":
        return asdict(initial_load(spark, cfg, version=a.version))
    if a.command == "incremental":
        return asdict(incremental_load(spark, cfg, end=a.end))
    if a.command in ("compact", "refresh") and not a.target:
        raise SystemExit(f"{a.command} needs --target")
    if a.command == "refresh":
        dates = refresh_by_date(spark, cfg.curated_table, a.target, a.target_path)
        return {"status": "refreshed", "target": a.target, "dates": dates}
    if a.command == "compact":
        compact_by_date(spark, cfg.curated_table, a.target, a.target_path)
        return {"status": "compacted", "target": a.target}
    if not (a.sink and a.checkpoint and cfg.change_log):
        raise SystemExit(f"{a.command} needs --change-log, --sink and --checkpoint")
    if a.command == "live":
        start_live_stream(
            spark, cfg, a.sink, a.checkpoint,
            after_version=a.after_version, max_files_per_trigger=a.max_files_per_trigger,
        ).awaitTermination()
        return {"status": "stopped"}
    result = run_incremental_stream(
        spark, cfg, a.sink, a.checkpoint,
        after_version=a.after_version, max_files_per_trigger=a.max_files_per_trigger,
    )
    return asdict(result)


def main() -> None:
    spark = SparkSession.builder.appName("chatlake-load").getOrCreate()
    print(json.dumps(run(spark, sys.argv[1:]), default=str))


if __name__ == "__main__":
    main()
