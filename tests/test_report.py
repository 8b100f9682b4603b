"""Report queries: filter semantics and aggregate identities."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chatlake.config import LoadConfig
from chatlake.operators import report as R
from chatlake.operators.semantic import semantic_view
from chatlake.plans.curated import build_curated
from chatlake.schema import CURATED_COLUMNS, DISPLAY_NAMES
from chatlake.sources.fixtures import fixture_transcripts, fixture_users
from chatlake.sources.tables import project_transcripts, project_users
from tests.helpers import msg, payload, transcripts, users


@pytest.fixture(scope="module")
def curated(spark, sf_small):
    c = build_curated(
        project_transcripts(fixture_transcripts(spark, sf_small)),
        project_users(fixture_users(spark, sf_small)),
        LoadConfig(tz_offset_minutes=-240),
    )
    return c.cache()


def test_exclusion_keeps_nulls(spark):
    t = transcripts(
        spark,
        [
            ("c1", None, "A", payload(msg(channel="msteams"))),
            ("c2", None, "B", payload(msg(channel=None))),
            ("c3", None, None, payload(msg(channel="webchat"))),
        ],
    )
    c = build_curated(t, users(spark, [("u", "x", "n", "e")]), LoadConfig(tz_offset_minutes=0))
    assert sorted(r.id for r in R.excluding(c, "channel", ["msteams"]).collect()) == ["c2", "c3"]
    # Plain NOT IN would drop the NULL channel row.
    assert c.where(~F.col("channelId").isin("msteams")).count() == 1
    t2 = transcripts(spark, [("c9", None, "Z", payload(msg()))]).withColumn(
        "bot_conversationtranscriptidname", F.lit(None).cast("string")
    )
    c2 = build_curated(t2, users(spark, [("u", "x", "n", "e")]))
    assert R.excluding(c2, "agent", ["A"]).count() == 1


def test_date_range_is_inclusive(spark, curated):
    rows = [
        (f"c{d}", dt.datetime(2024, 1, d, 23, 59, 59), "A", payload(msg()))
        for d in (1, 2, 3, 4)
    ]
    c = build_curated(transcripts(spark, rows), users(spark, [("u", "x", "n", "e")]))
    days = R.by_date(c, "2024-01-02", "2024-01-03").select("conversation_startdate")
    assert sorted(r[0] for r in days.collect()) == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    assert R.by_date(curated).count() == curated.count()
    only_start = R.by_date(curated, start=dt.date(2024, 1, 2))
    assert only_start.where(F.col("conversation_startdate") < dt.date(2024, 1, 2)).count() == 0


def test_message_totals_identity(curated):
    per = R.messages_by_date_agent(curated).agg(F.sum("messages")).first()[0]
    assert per == curated.count()
    assert R.total_conversations(curated).first()[0] == curated.select("id").distinct().count()
    by_agent = R.conversations_by_agent(curated).agg(F.sum("conversations")).first()[0]
    assert by_agent == R.total_conversations(curated).first()[0]  # each conversation has one agent


def test_bars_sorted_descending(curated):
    rows = R.conversations_by_agent(curated).collect()
    counts = [r.conversations for r in rows]
    assert counts == sorted(counts, reverse=True)


def test_lists_sorted(curated):
    starts = [r[0] for r in R.conversation_list(curated).collect()]
    assert starts == sorted(starts, reverse=True)
    times = [r[0] for r in R.message_list(curated).collect()]
    assert times == sorted(times)


def test_message_list_drops_null_text(spark):
    t = transcripts(spark, [("c1", None, None, payload(msg(text=None), msg(text="x"), msg(text="x")))])
    c = build_curated(t, users(spark, [("u", "aad-1", "n", "e")]), LoadConfig(tz_offset_minutes=0))
    assert c.count() == 3
    ml = R.message_list(c).collect()
    assert len(ml) == 1 and ml[0].text == "x" and ml[0].icon == "👤"


def test_report_filter_composes(curated):
    f = R.ReportFilter(
        agents=("Agent 1", "Agent 2"),
        date_start="2024-01-01",
        date_end="2024-01-02",
        exclude_channels=("msteams",),
        selection=(("channel", "webchat"),),
    )
    got = f.apply(curated)
    assert got.where(~F.col("bot_conversationtranscriptidname").isin("Agent 1", "Agent 2")).count() == 0
    assert got.where(F.col("channelId") != "webchat").count() == 0
    assert R.ReportFilter().apply(curated).count() == curated.count()
    page = R.summary_page(curated, f)
    assert set(page) == {"total_conversations", "conversations_by_agent", "conversations_by_channel", "messages_by_date_agent"}
    detail = R.detail_page(curated, "Agent 1", f)
    assert detail["agent_header"].first()[0] in ("Agent 1", None)


def test_filter_domains(curated):
    d = R.filter_domains(curated)
    assert [r[0] for r in d["agents"].collect()] == sorted({r[0] for r in curated.select("bot_conversationtranscriptidname").collect()})
    dates = d["dates"].first()
    assert dates.date_min <= dates.date_max


def test_semantic_view_names(curated):
    v = semantic_view(curated)
    assert v.columns == [n for n in DISPLAY_NAMES.values() if n]
    assert len(v.columns) == 16
    hidden = semantic_view(curated, include_hidden=True)
    assert len(hidden.columns) == 18 and set(CURATED_COLUMNS) & set(hidden.columns) == {
        "conversation_part_timestamp",
        "userid",
    }


def test_null_id_counting(spark):
    t = transcripts(spark, [("c1", None, "A", payload(msg(), msg())), ("c2", None, "A", payload(msg()))])
    c = build_curated(t, users(spark, [("u", "x", "n", "e")]), LoadConfig(tz_offset_minutes=0))
    with_null = c.unionByName(c.limit(1).withColumn("id", F.lit(None).cast("string")))
    assert R.total_conversations(with_null).first()[0] == 2  # Spark: NULL skipped
    assert R.total_conversations(with_null, blank_as_value=True).first()[0] == 3  # report host: blank counted
    assert R.total_conversations(c, blank_as_value=True).first()[0] == 2  # no NULL: same number
    bars = {r[0]: r[1] for r in R.conversations_by_agent(with_null, blank_as_value=True).collect()}
    assert bars == {"A": 3}


def test_message_list_splits_a_hot_time(spark, curated):
    """A third of the rows share one time (NULL): the (time, hash) range sort still
    spreads them over several partitions, and the order by time holds."""
    hot = curated.withColumn(
        "conversation_part_starttime",
        F.when(F.xxhash64("id", "text") % 3 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
            F.col("conversation_part_starttime")
        ),
    )
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ml = R.message_list(hot)
        n_null = ml.where(F.col("conversation_part_starttime").isNull()).count()
        per_part = (
            ml.where(F.col("conversation_part_starttime").isNull())
            .groupBy(F.spark_partition_id().alias("p"))
            .count()
            .collect()
        )
        times = [r[0] for r in ml.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert n_null > 0 and len(per_part) > 1 and max(r["count"] for r in per_part) < n_null
    nulls_first = [t for t in times if t is None]
    assert times[: len(nulls_first)] == nulls_first
    rest = times[len(nulls_first):]
    assert rest == sorted(rest)


def test_a_pick_spares_the_visual_it_was_made_in(curated):
    agent = curated.select("bot_conversationtranscriptidname").first()[0]
    pick = ("bot_conversationtranscriptidname", agent)
    bars = R.conversations_by_agent(curated).collect()
    page = R.summary_page(curated, R.ReportFilter(selection=((*pick, "conversations_by_agent"),)))
    assert page["conversations_by_agent"].collect() == bars
    everywhere = R.summary_page(curated, R.ReportFilter(selection=(pick,)))
    assert len(everywhere["conversations_by_agent"].collect()) == 1
    assert page["total_conversations"].collect() == everywhere["total_conversations"].collect()


def test_page_in_one_scan(spark, sf_small):
    from chatlake.plans.sinks import write_curated
    from chatlake.session import scratch_path, unique_name
    from chatlake.sources.tables import read_curated

    table = unique_name("cm")
    t = project_transcripts(fixture_transcripts(spark, sf_small))
    curated = build_curated(t, project_users(fixture_users(spark, sf_small)), LoadConfig(tz_offset_minutes=-240))
    write_curated(curated, table, 0, scratch_path(spark, "one_scan"))
    c = read_curated(spark, table)
    flt = R.ReportFilter(exclude_channels=("msteams",), selection=(("agent", "Agent 1", "conversations_by_agent"),))
    long = R.summary_page_long(c, flt)
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "text#" not in plan.split("ReadSchema")[1]
    page = R.summary_page(c, flt)
    got = {(r.visual, r.conversation_startdate, r.bot_conversationtranscriptidname, r.channelId): r.value for r in long.collect()}
    expected = {("total_conversations", None, None, None): page["total_conversations"].first()[0]}
    expected |= {("conversations_by_agent", None, a, None): n for a, n in page["conversations_by_agent"].collect()}
    expected |= {("conversations_by_channel", None, None, x): n for x, n in page["conversations_by_channel"].collect()}
    expected |= {("messages_by_date_agent", d, a, None): n for d, a, n in page["messages_by_date_agent"].collect()}
    assert got == expected
    none = R.ReportFilter(date_start="1999-01-01", date_end="1999-01-02")
    assert [(r.visual, r.value) for r in R.summary_page_long(c, none).collect()] == [("total_conversations", 0)]
    rest = R.detail_page_long(c, "Agent 2", none).collect()
    assert sorted((r.visual, r.value) for r in rest) == [("agent_header", None), ("total_conversations", 0)]
