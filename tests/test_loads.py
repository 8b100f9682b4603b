"""Load properties: increments equal one-shot, reruns are idempotent, stream = batch."""

from __future__ import annotations

import pytest

from chatlake.config import BaselineMissing, LoadConfig
from chatlake.plans.curated import build_curated
from chatlake.plans.loads import incremental_load, initial_load
from chatlake.plans.sinks import get_baseline, replace_versions, set_baseline
from chatlake.schema import COMMIT_VERSION, CURATED_COLUMNS
from chatlake.session import scratch_path, unique_name
from chatlake.sources.changes import inserts_only, latest_version, read_changes
from chatlake.sources.fixtures import fixture_transcripts, fixture_users, write_change_log
from chatlake.sources.tables import project_transcripts, project_users, read_curated
from chatlake.streaming.incremental import read_live_sink, read_stream_sink, run_incremental_stream, start_live_stream


@pytest.fixture(scope="module")
def log(spark, sf_small):
    return write_change_log(spark, sf_small, scratch_path(spark, "test_log"))


@pytest.fixture(scope="module")
def users(spark, sf_small):
    return project_users(fixture_users(spark, sf_small)).cache()


@pytest.fixture(scope="module")
def one_shot(spark, sf_small, users):
    t = project_transcripts(fixture_transcripts(spark, sf_small))
    return _rows(build_curated(t, users, LoadConfig(tz_offset_minutes=-240)))


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*CURATED_COLUMNS).collect())


def _cfg(spark, log):
    return LoadConfig(
        change_log=log,
        curated_table=unique_name("cm"),
        curated_path=scratch_path(spark, "test_curated"),
        tz_offset_minutes=-240,
    )


def test_latest_version_and_partition_pruning(spark, log):
    assert latest_version(spark, log) == 11
    df = read_changes(spark, log, 4, 7)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "_commit_version" in plan
    formatted = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PartitionFilters: [isnotnull(_commit_version" in formatted
    assert "> 4" in formatted and "<= 7" in formatted
    versions = {r[0] for r in df.select(COMMIT_VERSION).distinct().collect()}
    assert versions <= {5, 6, 7}


@pytest.mark.parametrize("cut", [2, 4, 7])
def test_initial_plus_increments_equals_one_shot(spark, log, users, one_shot, cut):
    cfg = _cfg(spark, log)
    r0 = initial_load(spark, cfg, users=users, version=cut)
    assert r0.status == "loaded" and get_baseline(spark, cfg.curated_table) == cut
    r1 = incremental_load(spark, cfg, users=users, end=9)
    assert r1.start_version == cut + 1 and r1.end_version == 9
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {cfg.curated_table}").collect()}
    assert parts == {f"_commit_version={v}" for v in range(cut, 10)}  # exactly the written versions
    assert r1.inserted_transcripts == r1.change_rows  # versions <= 9 hold inserts only
    assert r0.messages + r1.messages == len(one_shot)
    r2 = incremental_load(spark, cfg, users=users)  # to the latest: updates and deletes only
    assert r2.status == "loaded" and r2.end_version == 11 and r2.inserted_transcripts == 0
    assert r2.messages == 0
    assert _rows(read_curated(spark, cfg.curated_table)) == one_shot
    r3 = incremental_load(spark, cfg, users=users)
    assert r3.status == "no_changes"
    assert _rows(read_curated(spark, cfg.curated_table)) == one_shot


def test_crash_between_write_and_baseline_is_repaired(spark, log, users, one_shot):
    cfg = _cfg(spark, log)
    initial_load(spark, cfg, users=users, version=4)
    crashed = build_curated(
        inserts_only(read_changes(spark, log, 4, 7), keep_version=True), users, cfg, carry=[COMMIT_VERSION]
    )
    replace_versions(crashed, cfg.curated_table)  # written, baseline not moved
    assert get_baseline(spark, cfg.curated_table) == 4
    incremental_load(spark, cfg, users=users, end=9)
    incremental_load(spark, cfg, users=users, end=11)
    assert _rows(read_curated(spark, cfg.curated_table)) == one_shot


def test_baseline_missing(spark, log, users):
    cfg = _cfg(spark, log)
    with pytest.raises(BaselineMissing):
        incremental_load(spark, cfg, users=users)
    spark.range(1).write.option("path", scratch_path(spark, "t")).saveAsTable(cfg.curated_table)
    with pytest.raises(BaselineMissing):
        get_baseline(spark, cfg.curated_table)
    set_baseline(spark, cfg.curated_table, 3)
    assert get_baseline(spark, cfg.curated_table) == 3


def test_initial_load_from_log_snapshot(spark, log, users, one_shot):
    """Without a given version the initial load captures the latest version once and
    reads the table state as of it (deleted and edited transcripts as they stand)."""
    cfg = _cfg(spark, log)
    r = initial_load(spark, cfg, users=users)
    assert r.end_version == 11 and get_baseline(spark, cfg.curated_table) == 11
    got = read_curated(spark, cfg.curated_table)
    assert got.where("text = 'EDITED'").count() > 0
    assert incremental_load(spark, cfg, users=users).status == "no_changes"


def test_stream_equals_batch_and_rerun_adds_nothing(spark, log, users, one_shot):
    cfg = _cfg(spark, log)
    sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    first = run_incremental_stream(spark, cfg, sink, ckpt, users=users)
    assert first.status == "drained" and first.change_rows > 0
    assert _rows(read_stream_sink(spark, sink)) == one_shot
    again = run_incremental_stream(spark, cfg, sink, ckpt, users=users)
    assert again.status == "no_changes" and again.change_rows == 0
    assert _rows(read_stream_sink(spark, sink)) == one_shot


def test_stream_after_initial_load(spark, log, users, one_shot):
    cfg = _cfg(spark, log)
    initial_load(spark, cfg, users=users, version=4)
    sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    run_incremental_stream(spark, cfg, sink, ckpt, users=users, after_version=4, max_files_per_trigger=2)
    both = read_curated(spark, cfg.curated_table).unionByName(read_stream_sink(spark, sink))
    assert _rows(both) == one_shot


def test_input_order_does_not_matter(spark, sf_small, users, one_shot):
    t = project_transcripts(fixture_transcripts(spark, sf_small))
    shuffled = t.repartition(3).orderBy("content")
    assert _rows(build_curated(shuffled, users, LoadConfig(tz_offset_minutes=-240))) == one_shot


def test_zone_aware_change_log_batch_equals_stream(spark, sf_small, users):
    """A change log whose start time is a zone-aware TIMESTAMP (as source tables
    usually store it) loads the same through batch and stream."""
    from pyspark.sql import functions as F

    from chatlake.sources.fixtures import change_log_from_transcripts, save_change_log

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        ltz = change_log_from_transcripts(fixture_transcripts(spark, sf_small)).withColumn(
            "conversationstarttime", F.col("conversationstarttime").cast("timestamp")
        )
        log = save_change_log(ltz, scratch_path(spark, "ltz_log"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    cfg = _cfg(spark, log)
    initial_load(spark, cfg, users=users, version=4)
    incremental_load(spark, cfg, users=users)
    batch = _rows(read_curated(spark, cfg.curated_table))
    sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    run_incremental_stream(spark, cfg, sink, ckpt, users=users, after_version=-1)
    assert _rows(read_stream_sink(spark, sink)) == batch


def test_no_baseline_without_a_version(spark, sf_small, log, users):
    cfg = LoadConfig(curated_table=unique_name("cm"), curated_path=scratch_path(spark, "test_curated"))
    r = initial_load(spark, cfg, transcripts=fixture_transcripts(spark, sf_small), users=users)
    assert r.status == "loaded" and r.end_version is None
    with pytest.raises(BaselineMissing):
        get_baseline(spark, cfg.curated_table)


def test_versions_past_the_latest_are_not_stored(spark, log, users):
    cfg = _cfg(spark, log)
    assert initial_load(spark, cfg, users=users, version=99).end_version == 11
    assert incremental_load(spark, cfg, users=users, end=99).status == "no_changes"
    assert get_baseline(spark, cfg.curated_table) == 11


def test_unreadable_start_times_are_null_and_counted(spark, sf_small, users):
    from pyspark.sql import functions as F

    raw = fixture_transcripts(spark, sf_small).withColumn("conversationstarttime", F.lit("no time at all"))
    cfg = LoadConfig(curated_table=unique_name("cm"), curated_path=scratch_path(spark, "test_curated"))
    r = initial_load(spark, cfg, transcripts=raw, users=users)
    assert r.messages > 0 and r.details["null_start_times"] == r.messages


def test_stream_counts_equal_batch_counts_and_start_at_the_baseline(spark, log, users):
    cfg = _cfg(spark, log)
    initial_load(spark, cfg, users=users, version=4)
    sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    streamed = run_incremental_stream(spark, cfg, sink, ckpt, users=users, max_files_per_trigger=1)
    batch = incremental_load(spark, cfg, users=users)
    assert (streamed.change_rows, streamed.inserted_transcripts) == (batch.change_rows, batch.inserted_transcripts)
    assert run_incremental_stream(spark, cfg, sink, ckpt, users=users).status == "no_changes"


def test_stream_rejects_other_formats(spark, log):
    with pytest.raises(ValueError, match="parquet"):
        run_incremental_stream(spark, LoadConfig(change_log=log, change_log_format="delta"), "s", "c")


def test_live_stream_repeats_a_broken_batch_and_reads_users_anew(spark, log, users, one_shot):
    cfg = _cfg(spark, log)
    sink, ckpt = scratch_path(spark, "live"), scratch_path(spark, "live_ckpt")
    calls = []

    def now(session):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("users are not there")
        return users

    def drain():
        q = start_live_stream(
            spark, cfg, sink, ckpt, users=now, after_version=-1, max_files_per_trigger=2, availableNow=True
        )
        q.awaitTermination()

    with pytest.raises(Exception, match="users are not there"):
        drain()
    assert 0 < read_live_sink(spark, sink).count() < len(one_shot)
    drain()
    assert len(calls) > 4 and _rows(read_live_sink(spark, sink)) == one_shot
    # the last batch once more, as after a crash between its write and its commit
    import os

    commits = f"{ckpt}/commits".replace("file:", "")
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    for f in (str(last), f".{last}.crc"):
        if os.path.exists(f"{commits}/{f}"):
            os.remove(f"{commits}/{f}")
    drain()
    assert _rows(read_live_sink(spark, sink)) == one_shot


def test_a_stream_broadcasts_users_only_if_all_its_batches_together_may(spark, log, users):
    from dataclasses import replace

    from chatlake.streaming.incremental import changes_now, curated_stream, micro_batches

    now = changes_now(spark, log)
    batches = micro_batches(now, 1)
    assert batches >= 12 and micro_batches(now, None) == 1 and micro_batches(now, batches - 1) == 2
    assert micro_batches(changes_now(spark, log + "/none"), 1) == 1
    cfg = replace(_cfg(spark, log), broadcast_max_rows=users.count() * batches)

    def hinted(cfg, **kw):
        plan = curated_stream(spark, cfg, users, after_version=-1, **kw)._jdf.queryExecution().analyzed().toString()
        return "strategy=broadcast" in plan

    assert hinted(cfg, max_files_per_trigger=1)
    cfg = replace(cfg, broadcast_max_rows=cfg.broadcast_max_rows - 1)
    assert hinted(cfg) and not hinted(cfg, max_files_per_trigger=1)

    def streamed(cfg):
        sink = scratch_path(spark, "sink")
        out = run_incremental_stream(
            spark, cfg, sink, scratch_path(spark, "ckpt"), users=users, after_version=-1, max_files_per_trigger=4
        )
        return out.change_rows, out.inserted_transcripts, sorted(map(str, read_stream_sink(spark, sink).collect()))

    assert streamed(cfg) == streamed(replace(cfg, broadcast_max_rows=0))
