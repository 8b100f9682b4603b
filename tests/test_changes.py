"""Change-log semantics: table state as of a version, inserts only, load stats."""

from __future__ import annotations

import datetime as dt

from chatlake.schema import CHANGE_LOG_SCHEMA
from chatlake.sources.changes import inserts_only, load_stats, snapshot_as_of

T0 = dt.datetime(2024, 1, 1)


def _log(spark, rows):
    data = [(i, T0, "A", "bot-a", c, kind, v) for i, c, kind, v in rows]
    return spark.createDataFrame(data, CHANGE_LOG_SCHEMA)


ROWS = [
    ("keep", "k0", "insert", 0),
    ("upd", "u0", "insert", 0),
    ("upd", "u0", "update_preimage", 2),
    ("upd", "u1", "update_postimage", 2),
    ("gone", "g0", "insert", 1),
    ("gone", "g0", "delete", 3),
    ("back", "b0", "insert", 0),
    ("back", "b0", "delete", 1),
    ("back", "b1", "insert", 4),
    ("late", "l0", "insert", 5),
]


def _state(df):
    return sorted((r["id"], r["content"]) for r in df.collect())


def test_snapshot_as_of_versions(spark):
    log = _log(spark, ROWS)
    at = lambda v: snapshot_as_of(log.where(f"_commit_version <= {v}"))
    assert _state(at(0)) == [("back", "b0"), ("keep", "k0"), ("upd", "u0")]
    assert _state(at(2)) == [("gone", "g0"), ("keep", "k0"), ("upd", "u1")]
    assert _state(at(3)) == [("keep", "k0"), ("upd", "u1")]
    assert _state(at(5)) == [("back", "b1"), ("keep", "k0"), ("late", "l0"), ("upd", "u1")]


def test_snapshot_append_only_path_does_not_shuffle_content(spark):
    log = _log(spark, ROWS)
    snap = snapshot_as_of(log)
    plan = snap._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    only_inserts = _log(spark, [r for r in ROWS if r[2] == "insert"][:2])
    assert _state(snapshot_as_of(only_inserts)) == [("keep", "k0"), ("upd", "u0")]


def test_inserts_only_and_stats(spark):
    log = _log(spark, ROWS)
    ins = inserts_only(log, keep_version=True)
    assert ins.count() == 6 and "_commit_version" in ins.columns
    assert "conversation_starttime" in ins.columns and "conversationstarttime" not in ins.columns
    s = load_stats(log).first()
    assert (s.change_rows, s.insert_rows) == (10, 6)


def test_versions_and_ranges_from_folder_names(spark, sf_small):
    from chatlake.schema import COMMIT_VERSION
    from chatlake.session import scratch_path
    from chatlake.sources.changes import latest_version, read_changes, versions
    from chatlake.sources.fixtures import write_change_log

    log = write_change_log(spark, sf_small, scratch_path(spark, "log"))
    sc = spark.sparkContext
    sc.setJobGroup("metadata", "versions from folder names")
    try:
        assert list(versions(spark, log)) == list(range(12)) and list(versions(spark, log, 4, 7)) == [5, 6, 7]
        assert latest_version(spark, log) == 11 and latest_version(spark, log, after=11) is None
        assert latest_version(spark, scratch_path(spark, "none")) is None
        assert not sc.statusTracker().getJobIdsForGroup("metadata")  # no Spark job for any of it
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    whole = read_changes(spark, log).inputFiles()
    one = read_changes(spark, log, 4, 5)
    assert one.inputFiles() and all(f"{COMMIT_VERSION}=5/" in f for f in one.inputFiles())
    assert len(one.inputFiles()) < len(whole)
    assert {r[0] for r in one.select(COMMIT_VERSION).distinct().collect()} == {5}
    assert read_changes(spark, log, 11, 99).count() == 0
    assert read_changes(spark, log, None, 4).count() + read_changes(spark, log, 4).count() == read_changes(spark, log).count()


def test_versions_of_a_catalog_table(spark, sf_small):
    from chatlake.session import unique_name
    from chatlake.sources.changes import latest_version, read_changes
    from chatlake.sources.fixtures import change_log_from_transcripts, fixture_transcripts

    table = unique_name("changes")
    log = change_log_from_transcripts(fixture_transcripts(spark, sf_small))
    log.write.partitionBy("_commit_version").saveAsTable(table)
    assert latest_version(spark, table) == 11 and latest_version(spark, table, after=3) == 11
    assert read_changes(spark, table, 10, 11).count() == log.where("_commit_version = 11").count()
