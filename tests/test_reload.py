"""Full loads and copies appear whole or not at all; refreshes leave untouched dates alone."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from chatlake.config import BaselineMissing, LoadConfig
from chatlake.plans import sinks
from chatlake.plans.compact import COMPACTED_TO, DATE, compact_by_date, refresh_by_date
from chatlake.plans.curated import build_curated
from chatlake.plans.loads import incremental_load, initial_load
from chatlake.schema import COMMIT_VERSION, CURATED_COLUMNS
from chatlake.session import scratch_path, unique_name
from chatlake.sources.fixtures import fixture_transcripts, fixture_users, write_change_log
from chatlake.sources.tables import project_transcripts, project_users, read_curated


@pytest.fixture(scope="module")
def users(spark, sf_small):
    return project_users(fixture_users(spark, sf_small)).cache()


@pytest.fixture(scope="module")
def curated(spark, sf_small, users):
    t = project_transcripts(fixture_transcripts(spark, sf_small))
    return build_curated(t, users, LoadConfig()).cache()


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*CURATED_COLUMNS).collect())


@pytest.mark.parametrize("managed", [False, True])
def test_broken_reload_leaves_rows_and_baseline(spark, curated, managed):
    table, path = unique_name("cm"), None if managed else scratch_path(spark, "reload")
    few = curated.where("from_role = 0")
    sinks.write_curated(few, table, 3, path, baseline=3)
    before = _rows(read_curated(spark, table))
    sinks.stage_curated(curated, table, 7, path, baseline=7)  # ... and nothing more
    assert _rows(read_curated(spark, table)) == before == _rows(few)
    assert sinks.get_baseline(spark, table) == 3
    sinks.write_curated(curated, table, 8, path, baseline=8)
    assert _rows(read_curated(spark, table)) == _rows(curated) and sinks.get_baseline(spark, table) == 8


def test_a_write_that_fails_leaves_the_table(spark, curated):
    table = unique_name("cm")
    sinks.write_curated(curated, table, 3, scratch_path(spark, "reload"), baseline=3)
    bad = curated.withColumn("text", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        sinks.write_curated(bad, table, 4, scratch_path(spark, "reload"), baseline=4)
    assert _rows(read_curated(spark, table)) == _rows(curated) and sinks.get_baseline(spark, table) == 3


def test_swap_that_broke_between_its_renames_is_ended(spark, curated):
    table, path = unique_name("cm"), scratch_path(spark, "reload")
    sinks.write_curated(curated.where("from_role = 0"), table, 3, path, baseline=3)
    sinks.stage_curated(curated, table, 7, path, baseline=7)
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__old")
    assert sinks.get_baseline(spark, table) == 7
    assert _rows(read_curated(spark, table)) == _rows(curated)
    with pytest.raises(BaselineMissing):
        sinks.get_baseline(spark, unique_name("none"))


def test_running_readers_keep_the_files_they_started_with(spark, curated):
    table, path = unique_name("cm"), scratch_path(spark, "reload")
    sinks.write_curated(curated, table, 1, path)
    reader = read_curated(spark, table)
    files = reader.inputFiles()
    sinks.write_curated(curated.limit(1), table, 2, path)
    assert spark.read.parquet(*files).count() == curated.count()


def _files(spark, table):
    files = spark.table(table).select(F.col("_metadata.file_path").alias("f"), DATE).distinct().collect()
    out = {}
    for r in files:
        out.setdefault(r[DATE], set()).add(r.f)
    return out


def test_refresh_after_increments_equals_curated(spark, curated):
    table, copy = unique_name("cm"), unique_name("by_date")
    dates = [r[0] for r in curated.select(DATE).distinct().orderBy(DATE).collect()]
    old, new = dates[:-1], dates[-1]
    sinks.write_curated(curated.where(F.col(DATE) < F.lit(new)), table, 0, scratch_path(spark, "touched"), baseline=0)
    compact_by_date(spark, table, copy, scratch_path(spark, "copy"))
    before = _files(spark, copy)
    more = curated.where(F.col(DATE).isin([new, old[0]])).unionByName(curated.limit(5).withColumn(DATE, F.lit(None).cast("date")))
    sinks.replace_versions(more.withColumn(COMMIT_VERSION, F.lit(1).cast("bigint")), table)
    sinks.set_baseline(spark, table, 1)
    assert set(refresh_by_date(spark, table, copy)) == {new, old[0], None}
    after = _files(spark, copy)
    assert {d: after[d] for d in old[1:]} == {d: before[d] for d in old[1:]}
    assert not after[old[0]] & before[old[0]]
    assert _rows(read_curated(spark, copy)) == _rows(read_curated(spark, table))
    assert sinks.table_properties(spark, copy)[COMPACTED_TO] == "1"
    assert refresh_by_date(spark, table, copy) == []
    # a full reload is another table: the whole copy is written anew
    sinks.write_curated(curated.where("from_role = 0"), table, 2, scratch_path(spark, "touched"), baseline=2)
    assert refresh_by_date(spark, table, copy) is None
    assert _rows(read_curated(spark, copy)) == _rows(read_curated(spark, table))


@pytest.mark.parametrize("given", [False, True])
def test_version_before_the_latest_needs_a_source_as_of_it(spark, sf_small, users, given):
    log = write_change_log(spark, sf_small, scratch_path(spark, "log"))
    source = scratch_path(spark, "transcripts")
    fixture_transcripts(spark, sf_small).write.parquet(source)
    cfg = LoadConfig(
        change_log=log, curated_table=unique_name("cm"), curated_path=scratch_path(spark, "cm"),
        transcript_table=source, initial_from="table",
    )
    raw = fixture_transcripts(spark, sf_small) if given else None
    with pytest.raises(ValueError, match="before the latest"):
        initial_load(spark, cfg, transcripts=raw, users=users, version=4)
    assert not spark.catalog.tableExists(cfg.curated_table)
    assert initial_load(spark, cfg, transcripts=raw, users=users, version=11).end_version == 11
    assert incremental_load(spark, cfg, users=users).status == "no_changes"
