"""The job entry point drives the same loads."""

from __future__ import annotations

from chatlake.jobs import run
from chatlake.session import scratch_path, unique_name
from chatlake.sources.fixtures import fixture_transcripts, fixture_users, write_change_log
from chatlake.sources.tables import read_curated


def test_jobs_initial_incremental_stream(spark, sf_small):
    log = write_change_log(spark, sf_small, scratch_path(spark, "jobs_log"))
    users = scratch_path(spark, "jobs_users")
    fixture_users(spark, sf_small).write.parquet(users)
    table = unique_name("jobs_cm")
    common = ["--change-log", log, "--user-table", users, "--table", table, "--path", scratch_path(spark, "jobs_c")]
    r0 = run(spark, ["initial", *common, "--version", "4"])
    assert r0["status"] == "loaded" and r0["end_version"] == 4
    r1 = run(spark, ["incremental", *common])
    assert r1["status"] == "loaded" and r1["end_version"] == 11
    assert run(spark, ["incremental", *common])["status"] == "no_changes"
    n_transcripts = fixture_transcripts(spark, sf_small).count()
    got = read_curated(spark, table)
    assert got.select("id").distinct().count() == n_transcripts
    sink, ckpt = scratch_path(spark, "jobs_sink"), scratch_path(spark, "jobs_ckpt")
    r2 = run(spark, ["stream", "--change-log", log, "--user-table", users, "--sink", sink, "--checkpoint", ckpt,
                     "--max-files-per-trigger", "3"])
    assert r2["status"] == "drained" and r2["details"]["batches"] > 1
    assert spark.read.parquet(sink).count() == got.count()
    target = unique_name("jobs_by_date")
    r3 = run(spark, ["compact", "--table", table, "--target", target, "--target-path", scratch_path(spark, "jobs_bd")])
    assert r3["status"] == "compacted" and read_curated(spark, target).count() == got.count()
