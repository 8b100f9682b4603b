"""Plan checks: one from_json, one narrow stage before the join, pushdown, no global sort."""

from __future__ import annotations

import re

from chatlake.config import LoadConfig
from chatlake.operators import report as R
from chatlake.plans.curated import build_curated
from chatlake.plans.loads import initial_load
from chatlake.plans.sinks import _ordered
from chatlake.schema import COMMIT_VERSION
from chatlake.session import scratch_path, unique_name
from chatlake.sources.fixtures import fixture_transcripts, fixture_users
from chatlake.sources.tables import project_transcripts, project_users, read_curated
from pyspark.sql import functions as F


def _formatted(spark, df) -> str:
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def _curated(spark, sf):
    return build_curated(
        project_transcripts(fixture_transcripts(spark, sf)),
        project_users(fixture_users(spark, sf)),
        LoadConfig(tz_offset_minutes=-240),
    )


def test_from_json_once(spark, sf_small):
    c = _curated(spark, sf_small)
    optimized = c._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_json(") == 1


def test_message_path_has_no_shuffle_before_broadcast_join(spark, sf_small):
    c = _curated(spark, sf_small)
    plan = c._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan
    # Exchanges come only from the fixture's grouping of turns into transcripts.
    assert plan.count("Exchange hashpartitioning") <= 1


def test_write_path_sorts_within_partitions_only(spark, sf_small):
    c = _curated(spark, sf_small).withColumn(COMMIT_VERSION, F.lit(1).cast("bigint"))
    plan = _ordered(c)._jdf.queryExecution().sparkPlan().toString()
    assert re.search(r"Sort \[.*\], false", plan)
    assert not re.search(r"Sort \[.*\], true", plan)
    assert "rangepartitioning" not in plan


def test_report_filters_reach_the_scan(spark, sf_small):
    cfg = LoadConfig(
        curated_table=unique_name("cm"), curated_path=scratch_path(spark, "plan_curated"), tz_offset_minutes=-240
    )
    initial_load(
        spark,
        cfg,
        transcripts=fixture_transcripts(spark, sf_small),
        users=project_users(fixture_users(spark, sf_small)),
        version=0,
    )
    c = read_curated(spark, cfg.curated_table)
    flt = R.ReportFilter(date_start="2024-01-02", date_end="2024-01-03", exclude_channels=("msteams",))
    q = R.conversations_by_agent(flt.apply(c))
    text = _formatted(spark, q)
    pushed = [line for line in text.splitlines() if "PushedFilters" in line]
    assert pushed and "conversation_startdate" in pushed[0]
    read_schema = [line for line in text.splitlines() if "ReadSchema" in line][0]
    # Only the columns the query needs are read.
    assert "text" not in read_schema and "userfullname" not in read_schema


def test_message_list_pre_aggregates_and_splits_hot_times(spark, sf_small):
    cfg = LoadConfig(
        curated_table=unique_name("cm"), curated_path=scratch_path(spark, "plan_curated"), tz_offset_minutes=-240
    )
    initial_load(
        spark,
        cfg,
        transcripts=fixture_transcripts(spark, sf_small),
        users=project_users(fixture_users(spark, sf_small)),
        version=0,
    )
    text = _formatted(spark, R.message_list(read_curated(spark, cfg.curated_table)))
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 2
    assert re.search(r"rangepartitioning\(conversation_part_starttime#\d+ ASC NULLS FIRST, xxhash64", text)
    # map-side partial aggregation below the hash exchange
    lines = tree.splitlines()
    first_ex = max(i for i, line in enumerate(lines) if "Exchange" in line)
    assert any("HashAggregate" in line for line in lines[first_ex + 1 :])


def test_compacted_copy_prunes_dates(spark, sf_small):
    from chatlake.plans.compact import compact_by_date

    cfg = LoadConfig(
        curated_table=unique_name("cm"), curated_path=scratch_path(spark, "plan_curated"), tz_offset_minutes=-240
    )
    initial_load(
        spark,
        cfg,
        transcripts=fixture_transcripts(spark, sf_small),
        users=project_users(fixture_users(spark, sf_small)),
        version=0,
    )
    copy = unique_name("cm_by_date")
    compact_by_date(spark, cfg.curated_table, copy, scratch_path(spark, "plan_by_date"))
    c = read_curated(spark, copy)
    assert c.count() == read_curated(spark, cfg.curated_table).count()
    text = _formatted(spark, R.by_date(c, "2024-01-02", "2024-01-02"))
    part = [line for line in text.splitlines() if "PartitionFilters" in line]
    assert part and "conversation_startdate" in part[0]


def test_increment_scan_pushes_insert_filter_and_prunes_versions(spark, sf_small):
    from chatlake.sources.changes import inserts_only, read_changes
    from chatlake.sources.fixtures import write_change_log

    log = write_change_log(spark, sf_small, scratch_path(spark, "plan_log"))
    text = _formatted(spark, inserts_only(read_changes(spark, log, 4, 9), keep_version=True))
    scan = [line for line in text.splitlines() if "PushedFilters" in line or "PartitionFilters" in line]
    assert any("EqualTo(_change_type,insert)" in line for line in scan)
    assert any("_commit_version" in line and "> 4" in line and "<= 9" in line for line in scan)


def test_compaction_splits_a_hot_date(spark, sf_small):
    import glob

    from chatlake.plans.compact import compact_by_date
    from chatlake.plans.sinks import write_curated

    base = build_curated(
        project_transcripts(fixture_transcripts(spark, sf_small)),
        project_users(fixture_users(spark, sf_small)),
        LoadConfig(tz_offset_minutes=-240),
    )
    hot_day = F.lit("2024-01-01").cast("date")
    skewed = base.withColumn(
        "conversation_startdate",
        F.when(F.xxhash64("id", "text") % 3 != 0, hot_day).otherwise(F.col("conversation_startdate")),
    )
    src = unique_name("hot_src")
    write_curated(skewed.repartition(16), src, 0, scratch_path(spark, "hot_src"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        path = scratch_path(spark, "hot_by_date")
        compact_by_date(spark, src, unique_name("hot_by_date"), path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = glob.glob(path.replace("file:", "") + "/load-*/conversation_startdate=2024-01-01/*.parquet")
    assert len(files) > 1  # the hot date is written by several tasks, not one
