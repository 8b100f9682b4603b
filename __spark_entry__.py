"""

``entry(spark)`` runs the flagship query (the curated message table) on
sf0.001. ``queries()`` maps every implemented operator / query to a callable
``(spark, sf_dir) -> DataFrame``; each one derives its raw inputs from the
driver's ``conversations`` and ``customer`` tables with Spark (FIXTURES.md)
and runs over the whole tables. ``oracle_sql()`` gives, per query, DuckDB SQL
that computes the same rows straight from those tables, without any JSON, so
it is an independent check of the parse / explode / join path.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import logging
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chatlake.config import LoadConfig  # noqa: E402
from chatlake.functions.payload import (  # noqa: E402
    first_array_column,
    flatten_payload,
    infer_payload_schema,
    merged_payload_schema,
    parse_payload,
    payload_rejects,
    sample_payload,
)
from chatlake.operators import report as R  # noqa: E402
from chatlake.operators.enrich import enrich_users  # noqa: E402
from chatlake.operators.parts import PART, activity_counts, explode_parts  # noqa: E402
from chatlake.operators.semantic import semantic_view  # noqa: E402
from chatlake.plans.compact import compact_by_date, date_domain, refresh_by_date  # noqa: E402
from chatlake.plans.counts import conversations_by, messages_by, read_counts, update_counts  # noqa: E402
from chatlake.plans.curated import build_curated, messages_from_transcripts  # noqa: E402
from chatlake.plans.loads import incremental_load, initial_load  # noqa: E402
from chatlake.plans.sinks import replace_versions, stage_curated  # noqa: E402
from chatlake.schema import CHANGE_TYPE, COMMIT_VERSION, CURATED_COLUMNS, TRANSCRIPT_COLUMNS  # noqa: E402
from chatlake.session import scratch_path, unique_name  # noqa: E402
from chatlake.sources.changes import (  # noqa: E402
    change_summary,
    inserts_only,
    load_stats,
    read_changes,
    snapshot_as_of,
)
from chatlake.sources.fixtures import (  # noqa: E402
    EDITED_CONTENT,
    change_log_from_transcripts,
    damaged_transcripts,
    fixture_transcripts,
    fixture_users,
    write_change_log,
)
from chatlake.sources.tables import project_transcripts, project_users, read_curated  # noqa: E402
from chatlake.streaming.incremental import (  # noqa: E402
    read_live_sink,
    read_stream_sink,
    run_incremental_stream,
    start_live_stream,
)

SF_SMOKE = "/root/testdata/sf0.001"

# Fixed parameters of the registered queries (the fixture's standard run).
CFG = LoadConfig(tz_offset_minutes=-240)
INITIAL_VERSION = 4  # initial load of versions 0-4, increments (4, 9] and (9, 11]
FIRST_END, SECOND_END = 9, 11
FILTER_AGENTS = ("Agent 1", "Agent 3")
FILTER_DATE_START, FILTER_DATE_END = "2024-01-02", "2024-01-04"
EXCLUDE_CHANNELS = ("msteams",)
EXCLUDE_AGENTS = ("Agent 0",)
PAGE_FILTER = R.ReportFilter(
    date_start="2024-01-02", date_end="2024-01-06", exclude_channels=EXCLUDE_CHANNELS
)
DRILL_AGENT = "Agent 2"
# Cross-filter pick on the detail page: the start time of conversation 22
# (2024-01-01 + 22 * 97 min, shifted by -240 min), which passes the page filter.
PICKED_START = dt.datetime(2024, 1, 2, 7, 34)


# ---- shared derivations ------------------------------------------------------


def _transcripts(spark: SparkSession, sf: str) -> DataFrame:
    return project_transcripts(fixture_transcripts(spark, sf))


def _users(spark: SparkSession, sf: str) -> DataFrame:
    return project_users(fixture_users(spark, sf))


def _curated(spark: SparkSession, sf: str) -> DataFrame:
    return build_curated(_transcripts(spark, sf), _users(spark, sf), CFG)


def _load_cfg(spark: SparkSession, sf: str) -> LoadConfig:
    log = write_change_log(spark, sf, scratch_path(spark, "change_log"))
    return LoadConfig(
        change_log=log,
        curated_table=unique_name("conversation_messages"),
        curated_path=scratch_path(spark, "curated"),
        tz_offset_minutes=CFG.tz_offset_minutes,
    )


# ---- queries -----------------------------------------------------------------


def q_transcript_scan(spark, sf):
    return _transcripts(spark, sf).select(*TRANSCRIPT_COLUMNS)


def q_user_scan(spark, sf):
    return _users(spark, sf)


def q_payload_activity_counts(spark, sf):
    return activity_counts(flatten_payload(parse_payload(_transcripts(spark, sf))))


def q_inferred_schema(spark, sf):
    """Schema inferred from the newest payload, then used to parse every transcript."""
    t = _transcripts(spark, sf)
    schema = infer_payload_schema(spark, sample_payload(t, 1))
    parsed = parse_payload(t, schema)
    arr = first_array_column(parsed.schema["content_json"].dataType)
    if arr is None:  # the sample has no array: no activities to count (D3)
        return parsed.select("id", F.lit(None).cast("int").alias("activities"), F.lit(None).cast("int").alias("messages"))
    elems = F.col(f"content_json.`{arr}`")
    return parsed.select(
        "id",
        F.size(elems).alias("activities"),
        F.size(F.filter(elems, lambda a: a["type"] == "message")).alias("messages"),
    )


def q_merged_schema(spark, sf):
    """The schema of all payloads together, then used to parse every transcript."""
    t = _transcripts(spark, sf)
    activities = F.col("content_json.activities")
    return parse_payload(t, merged_payload_schema(t)).select(
        "id",
        F.size(activities).alias("activities"),
        F.size(F.filter(activities, lambda a: a["type"] == "message")).alias("messages"),
    )


def q_parts_exploded(spark, sf):
    parts = explode_parts(parse_payload(_transcripts(spark, sf)))
    p = F.col(PART)
    return parts.select(
        "id",
        p["type"].alias("type"),
        p["channelId"].alias("channelId"),
        p["text"].alias("text"),
        F.expr(f"try_cast({PART}.timestamp AS DOUBLE)").alias("conversation_part_timestamp"),
        p["from"]["aadObjectId"].alias("from_aadObjectId"),
        p["from"]["id"].alias("from_id"),
        F.expr(f"try_cast({PART}.from.role AS BIGINT)").alias("from_role"),
    )


def q_messages_extracted(spark, sf):
    return messages_from_transcripts(_transcripts(spark, sf), CFG)


ENRICHED_COLUMNS = [
    "id", "conversation_part_timestamp", "from_role", "from_aadObjectId",
    "userid", "userentraid", "userfullname", "useremailaddress", "from", "from_icon",
]


def q_messages_local_date(spark, sf):
    """The ``local_date`` option: the start date of the shifted start time."""
    cfg = LoadConfig(tz_offset_minutes=CFG.tz_offset_minutes, local_date=True)
    return messages_from_transcripts(_transcripts(spark, sf), cfg)


def q_messages_enriched(spark, sf):
    m = messages_from_transcripts(_transcripts(spark, sf), CFG)
    return enrich_users(m, _users(spark, sf)).select(*ENRICHED_COLUMNS)


def q_messages_enriched_shuffle(spark, sf):
    """The same join through the salted shuffle path (used when users are too big to broadcast)."""
    m = messages_from_transcripts(_transcripts(spark, sf), CFG)
    return enrich_users(m, _users(spark, sf), force_strategy="shuffle").select(*ENRICHED_COLUMNS)


def q_curated_full(spark, sf):
    return _curated(spark, sf)


def q_semantic_view(spark, sf):
    return semantic_view(_curated(spark, sf))


def q_semantic_view_hidden(spark, sf):
    return semantic_view(_curated(spark, sf), include_hidden=True)


def q_total_conversations(spark, sf):
    return R.total_conversations(_curated(spark, sf))


def q_conversations_by_agent(spark, sf):
    return R.conversations_by_agent(_curated(spark, sf))


def q_conversations_by_channel(spark, sf):
    return R.conversations_by_channel(_curated(spark, sf))


def q_messages_by_date_agent(spark, sf):
    return R.messages_by_date_agent(_curated(spark, sf))


def q_conversations_by_date_agent(spark, sf):
    return R.conversations_by_date_agent(_curated(spark, sf))


def q_agent_header(spark, sf):
    return R.agent_header(_curated(spark, sf))


def q_conversation_list(spark, sf):
    return R.conversation_list(_curated(spark, sf))


def q_message_list(spark, sf):
    return R.message_list(_curated(spark, sf))


def q_filter_domain_agents(spark, sf):
    return R.filter_domain_agents(_curated(spark, sf))


def q_filter_domain_channels(spark, sf):
    return R.filter_domain_channels(_curated(spark, sf))


def q_filter_domain_dates(spark, sf):
    return R.filter_domain_dates(_curated(spark, sf))


def q_filter_domains(spark, sf):
    return R.filter_domains_long(_curated(spark, sf))


def q_filter_agent(spark, sf):
    return R.by_agent(_curated(spark, sf), FILTER_AGENTS)


def q_filter_date(spark, sf):
    return R.by_date(_curated(spark, sf), FILTER_DATE_START, FILTER_DATE_END)


def q_filter_excluding(spark, sf):
    c = R.excluding(_curated(spark, sf), "channel", EXCLUDE_CHANNELS)
    return R.excluding(c, "agent", EXCLUDE_AGENTS)


def _summary(spark, sf):
    return R.summary_page(_curated(spark, sf), PAGE_FILTER)


def _detail(spark, sf, selection=()):
    flt = R.ReportFilter(
        date_start=PAGE_FILTER.date_start,
        date_end=PAGE_FILTER.date_end,
        exclude_channels=PAGE_FILTER.exclude_channels,
        selection=selection,
    )
    return R.detail_page(_curated(spark, sf), DRILL_AGENT, flt)


def q_summary_page_total(spark, sf):
    return _summary(spark, sf)["total_conversations"]


def q_summary_page_by_agent(spark, sf):
    return _summary(spark, sf)["conversations_by_agent"]


def q_summary_page_by_channel(spark, sf):
    return _summary(spark, sf)["conversations_by_channel"]


def q_summary_page_by_date(spark, sf):
    return _summary(spark, sf)["messages_by_date_agent"]


def q_summary_page_filtered(spark, sf):
    """The summary page's bar chart under the shared filter state."""
    return _summary(spark, sf)["conversations_by_agent"]


def q_detail_page_drill(spark, sf):
    """Drill-through to one agent: the detail page's message transcript."""
    return _detail(spark, sf)["message_list"]


def q_detail_page_total(spark, sf):
    return _detail(spark, sf)["total_conversations"]


def q_detail_page_header(spark, sf):
    return _detail(spark, sf)["agent_header"]


def q_detail_page_conversations(spark, sf):
    return _detail(spark, sf)["conversation_list"]


def q_detail_page_messages(spark, sf):
    return _detail(spark, sf)["message_list"]


def q_detail_page_picked_messages(spark, sf):
    return _detail(spark, sf, (("conversation_starttime", PICKED_START),))["message_list"]


def q_detail_page_picked_by_id(spark, sf):
    """The same pick made by conversation id (D14): equal start times cannot merge."""
    return _detail(spark, sf, (("id", "conv-22"),))["message_list"]


def q_changes_inserts(spark, sf):
    cfg = _load_cfg(spark, sf)
    ins = inserts_only(read_changes(spark, cfg.change_log, INITIAL_VERSION, FIRST_END), keep_version=True)
    return ins.select(*TRANSCRIPT_COLUMNS, COMMIT_VERSION)


def q_load_stats(spark, sf):
    cfg = _load_cfg(spark, sf)
    return load_stats(read_changes(spark, cfg.change_log, INITIAL_VERSION, SECOND_END))


def q_changes_by_version(spark, sf):
    cfg = _load_cfg(spark, sf)
    return change_summary(read_changes(spark, cfg.change_log))


def q_snapshot_latest(spark, sf):
    cfg = _load_cfg(spark, sf)
    snap = project_transcripts(snapshot_as_of(read_changes(spark, cfg.change_log)))
    return activity_counts(flatten_payload(parse_payload(snap)))


def q_incremental_batch(spark, sf):
    cfg = _load_cfg(spark, sf)
    users = _users(spark, sf)
    initial_load(spark, cfg, users=users, version=INITIAL_VERSION)
    incremental_load(spark, cfg, users=users, end=FIRST_END)
    incremental_load(spark, cfg, users=users, end=SECOND_END)
    return read_curated(spark, cfg.curated_table)


def q_incremental_rerun(spark, sf):
    """Crash after writing (4, 7] but before moving the baseline, then rerun to 9 and 11."""
    cfg = _load_cfg(spark, sf)
    users = _users(spark, sf)
    initial_load(spark, cfg, users=users, version=INITIAL_VERSION)
    crashed = build_curated(
        inserts_only(read_changes(spark, cfg.change_log, INITIAL_VERSION, 7), keep_version=True),
        users, cfg, carry=[COMMIT_VERSION],
    )
    replace_versions(crashed, cfg.curated_table)
    incremental_load(spark, cfg, users=users, end=FIRST_END)
    incremental_load(spark, cfg, users=users, end=FIRST_END)  # no-op: nothing new
    incremental_load(spark, cfg, users=users, end=SECOND_END)
    return read_curated(spark, cfg.curated_table)


def q_incremental_stream(spark, sf):
    """Streaming twin over the whole change log, run twice (the second run adds nothing)."""
    cfg = _load_cfg(spark, sf)
    sink, ckpt = scratch_path(spark, "stream_sink"), scratch_path(spark, "stream_ckpt")
    users = _users(spark, sf)
    for _ in range(2):
        run_incremental_stream(spark, cfg, sink, ckpt, users=users)
    return read_stream_sink(spark, sink)


def q_initial_plus_stream(spark, sf):
    """Initial batch load of versions 0-4, then the stream for versions after the baseline."""
    cfg = _load_cfg(spark, sf)
    users = _users(spark, sf)
    initial_load(spark, cfg, users=users, version=INITIAL_VERSION)
    sink, ckpt = scratch_path(spark, "stream_sink"), scratch_path(spark, "stream_ckpt")
    run_incremental_stream(spark, cfg, sink, ckpt, users=users, after_version=INITIAL_VERSION)
    return read_curated(spark, cfg.curated_table).unionByName(read_stream_sink(spark, sink))


def q_overwrite_roundtrip(spark, sf):
    cfg = LoadConfig(
        curated_table=unique_name("conversation_messages"),
        curated_path=scratch_path(spark, "curated"),
        tz_offset_minutes=CFG.tz_offset_minutes,
    )
    t, u = fixture_transcripts(spark, sf), _users(spark, sf)
    initial_load(spark, cfg, transcripts=t, users=u, version=0)
    initial_load(spark, cfg, transcripts=t, users=u, version=0)
    return read_curated(spark, cfg.curated_table)


def q_compacted_by_date(spark, sf):
    """Initial load, then the date-partitioned reporting copy; a date filter on it
    prunes partitions, and its rows equal the curated table's."""
    cfg = LoadConfig(
        curated_table=unique_name("conversation_messages"),
        curated_path=scratch_path(spark, "curated"),
        tz_offset_minutes=CFG.tz_offset_minutes,
    )
    initial_load(spark, cfg, transcripts=fixture_transcripts(spark, sf), users=_users(spark, sf), version=0)
    copy = unique_name("conversation_messages_by_date")
    compact_by_date(spark, cfg.curated_table, copy, scratch_path(spark, "by_date"))
    return read_curated(spark, copy)


def _log_part(spark: SparkSession, sf: str, path: str, low: int, high: int) -> None:
    """Commit the fixture log's versions ``low`` to ``high`` to the log at ``path``."""
    log = change_log_from_transcripts(fixture_transcripts(spark, sf))
    part = log.where(F.col(COMMIT_VERSION).between(low, high))
    part.write.mode("append").partitionBy(COMMIT_VERSION).parquet(path)


def q_initial_table_then_increment(spark, sf):
    """Initial load from catalog tables of a namespace at the log's latest version, then an increment; no
    version is given anywhere."""
    ns = unique_name("lake")
    spark.sql(f"CREATE DATABASE {ns} LOCATION '{scratch_path(spark, ns)}'")
    number = F.regexp_extract("id", r"(\d+)$", 1).cast("long")
    early = fixture_transcripts(spark, sf).where(number % 10 <= INITIAL_VERSION)
    early.write.saveAsTable(f"{ns}.conversationtranscript")
    fixture_users(spark, sf).write.saveAsTable(f"{ns}.systemuser")
    log = scratch_path(spark, "change_log")
    _log_part(spark, sf, log, 0, INITIAL_VERSION)
    cfg = LoadConfig(
        namespace=ns, change_log=log, initial_from="table", curated_table=f"{ns}.conversation_messages",
        tz_offset_minutes=CFG.tz_offset_minutes,
    )
    initial_load(spark, cfg)
    _log_part(spark, sf, log, INITIAL_VERSION + 1, SECOND_END)
    incremental_load(spark, cfg)
    incremental_load(spark, cfg)  # no-op
    return read_curated(spark, cfg.curated_table)


def q_end_past_latest(spark, sf):
    """An increment asked to go beyond the last commit stops there; what comes later is still loaded."""
    cfg = LoadConfig(
        change_log=scratch_path(spark, "change_log"),
        curated_table=unique_name("conversation_messages"),
        curated_path=scratch_path(spark, "curated"),
        tz_offset_minutes=CFG.tz_offset_minutes,
    )
    users = _users(spark, sf)
    _log_part(spark, sf, cfg.change_log, 0, 2)
    initial_load(spark, cfg, users=users, version=INITIAL_VERSION)
    _log_part(spark, sf, cfg.change_log, 3, 6)
    incremental_load(spark, cfg, users=users, end=FIRST_END)
    _log_part(spark, sf, cfg.change_log, 7, SECOND_END)
    incremental_load(spark, cfg, users=users)
    return read_curated(spark, cfg.curated_table)


def q_snapshot_overwrite_commit(spark, sf):
    """A last commit that deletes and inserts every fifth transcript: the inserted rows are the state."""
    log = change_log_from_transcripts(fixture_transcripts(spark, sf))
    number = F.regexp_extract("id", r"(\d+)$", 1).cast("long")
    fifth = log.where((F.col(CHANGE_TYPE) == "insert") & (number % 5 == 0))
    commit = F.lit(SECOND_END + 1).cast(log.schema[COMMIT_VERSION].dataType)
    gone = fifth.withColumns({CHANGE_TYPE: F.lit("delete"), COMMIT_VERSION: commit})
    new = fifth.withColumns({"content": F.lit(EDITED_CONTENT), COMMIT_VERSION: commit})
    snap = project_transcripts(snapshot_as_of(log.unionByName(gone).unionByName(new)))
    return activity_counts(flatten_payload(parse_payload(snap)))


def q_reload_under_dynamic_mode(spark, sf):
    """A full reload replaces an incremented table and its date copy, though the session prefers dynamic overwrite."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        cfg, users = _load_cfg(spark, sf), _users(spark, sf)
        initial_load(spark, cfg, users=users, version=INITIAL_VERSION)
        incremental_load(spark, cfg, users=users)
        copy, path = unique_name("conversation_messages_by_date"), scratch_path(spark, "by_date")
        compact_by_date(spark, cfg.curated_table, copy, path)
        initial_load(spark, cfg, transcripts=fixture_transcripts(spark, sf), users=users)
        compact_by_date(spark, cfg.curated_table, copy, path)
    finally:
        spark.conf.set(key, before)
    return read_curated(spark, copy)


def q_stream_counts(spark, sf):
    """Change and insert rows of a stream over more batches than Spark's progress list holds."""
    cfg = _load_cfg(spark, sf)
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        out = run_incremental_stream(
            spark, cfg, scratch_path(spark, "stream_sink"), scratch_path(spark, "stream_ckpt"),
            users=_users(spark, sf), max_files_per_trigger=1,
        )
    finally:
        spark.conf.set(key, before)
    return spark.createDataFrame([(out.change_rows, out.inserted_transcripts)], "change_rows long, insert_rows long")


def q_detail_page_picked_conversations(spark, sf):
    """A start time picked in the conversation list leaves that list whole."""
    pick = ("conversation_starttime", PICKED_START, "conversation_list")
    return _detail(spark, sf, (pick,))["conversation_list"]


def q_summary_page_picked_bars(spark, sf):
    """A bar picked in the agent chart leaves all bars."""
    flt = dataclasses.replace(
        PAGE_FILTER, selection=(("bot_conversationtranscriptidname", DRILL_AGENT, "conversations_by_agent"),)
    )
    return R.summary_page(_curated(spark, sf), flt)["conversations_by_agent"]


def q_summary_page_one_scan(spark, sf):
    """All four visuals of the summary page in one pass, one of them with a bar picked in it."""
    flt = dataclasses.replace(
        PAGE_FILTER, selection=(("bot_conversationtranscriptidname", DRILL_AGENT, "conversations_by_agent"),)
    )
    return R.summary_page_long(_curated(spark, sf), flt)


def q_detail_page_one_scan(spark, sf):
    """Total, header and conversation list of the detail page in one pass, with a start time picked in the list."""
    flt = dataclasses.replace(PAGE_FILTER, selection=(("conversation_starttime", PICKED_START, "conversation_list"),))
    return R.detail_page_long(_curated(spark, sf), DRILL_AGENT, flt)


def q_stream_live_users(spark, sf):
    """One running stream; users that come between two of its batches are met by the later one."""
    cfg = LoadConfig(
        change_log=scratch_path(spark, "change_log"), user_table=scratch_path(spark, "users"),
        tz_offset_minutes=CFG.tz_offset_minutes,
    )
    users = fixture_users(spark, sf)
    even = F.regexp_extract("id", r"(\d+)$", 1).cast("long") % 2 == 0
    users.where(even).write.parquet(cfg.user_table)
    _log_part(spark, sf, cfg.change_log, 0, INITIAL_VERSION)
    sink = scratch_path(spark, "live_sink")
    stream = start_live_stream(
        spark, cfg, sink, scratch_path(spark, "live_ckpt"), after_version=-1, processingTime="0 seconds"
    )
    try:
        stream.processAllAvailable()
        users.where(~even).write.mode("append").parquet(cfg.user_table)
        _log_part(spark, sf, cfg.change_log, INITIAL_VERSION + 1, SECOND_END)
        stream.processAllAvailable()
    finally:
        stream.stop()
    return read_live_sink(spark, sink)


def q_messages_enriched_heavy(spark, sf):
    """The shuffle path for a sender of two thirds of all messages with a directory id: it alone is salted."""
    m = messages_from_transcripts(_transcripts(spark, sf), CFG)
    number = F.regexp_extract("from_aadObjectId", r"(\d+)$", 1).cast("long")
    m = m.withColumn("from_aadObjectId", F.when(number % 3 > 0, F.lit("aad-1")).otherwise(F.col("from_aadObjectId")))
    return enrich_users(m, _users(spark, sf), force_strategy="shuffle").select(*ENRICHED_COLUMNS)


def _one_off_cfg(spark: SparkSession, **options) -> LoadConfig:
    return LoadConfig(
        curated_table=unique_name("conversation_messages"),
        curated_path=scratch_path(spark, "curated"),
        tz_offset_minutes=CFG.tz_offset_minutes,
        **options,
    )


def q_reload_broken_after_write(spark, sf):
    """A reload that breaks when its rows are written: what readers see then, and after the next reload."""
    cfg, users = _load_cfg(spark, sf), _users(spark, sf)
    initial_load(spark, cfg, users=users, version=INITIAL_VERSION)
    full = build_curated(_transcripts(spark, sf), users, cfg)
    stage_curated(full, cfg.curated_table, SECOND_END, cfg.curated_path, baseline=SECOND_END)  # breaks here
    seen = scratch_path(spark, "seen")
    read_curated(spark, cfg.curated_table).write.parquet(seen)
    initial_load(spark, cfg, transcripts=fixture_transcripts(spark, sf), users=users)
    broken = spark.read.parquet(seen).select(F.lit("broken").alias("phase"), *CURATED_COLUMNS)
    return broken.unionByName(read_curated(spark, cfg.curated_table).select(F.lit("reloaded").alias("phase"), "*"))


def q_compacted_touched_dates(spark, sf):
    """Increments loaded one by one, each followed by a refresh of the dates that it touched in the reporting copy."""
    cfg, users = _load_cfg(spark, sf), _users(spark, sf)
    initial_load(spark, cfg, users=users, version=INITIAL_VERSION)
    copy, path = unique_name("conversation_messages_by_date"), scratch_path(spark, "by_date")
    compact_by_date(spark, cfg.curated_table, copy, path)
    for end in (FIRST_END, SECOND_END):
        incremental_load(spark, cfg, users=users, end=end)
        refresh_by_date(spark, cfg.curated_table, copy, path)
    return read_curated(spark, copy)


def q_counts_from_state(spark, sf):
    """The summary page's numbers from bitmaps that every load updates, in long form."""
    cfg, users, state = _load_cfg(spark, sf), _users(spark, sf), scratch_path(spark, "counts")
    initial_load(spark, cfg, users=users, version=INITIAL_VERSION)
    update_counts(spark, cfg.curated_table, state)
    for end in (FIRST_END, SECOND_END):
        incremental_load(spark, cfg, users=users, end=end)
        update_counts(spark, cfg.curated_table, state)
    cells = read_counts(spark, cfg.curated_table, state)
    none = F.lit(None).cast("string")
    per = lambda df, visual, date, agent, channel, n: df.select(
        F.lit(visual).alias("visual"), date.alias("date"), agent.alias("agent"), channel.alias("channel"), F.col(n).cast("long").alias("n")
    )
    no_date, date, agent, channel = F.lit(None).cast("date"), F.col(R.DATE), F.col(R.AGENT), F.col(R.CHANNEL)
    return (
        per(conversations_by(cells), "conversations", no_date, none, none, "conversations")
        .unionByName(per(conversations_by(cells, R.AGENT), "by_agent", no_date, agent, none, "conversations"))
        .unionByName(per(conversations_by(cells, R.CHANNEL), "by_channel", no_date, none, channel, "conversations"))
        .unionByName(per(conversations_by(cells, R.DATE, R.AGENT), "by_date_agent", date, agent, none, "conversations"))
        .unionByName(per(messages_by(cells, R.DATE, R.AGENT), "messages_by_date_agent", date, agent, none, "messages"))
    )


def q_filter_domain_dates_partitions(spark, sf):
    """The date slicer's domain from the partitions of the reporting copy, after increments and refreshes."""
    cfg, users = _load_cfg(spark, sf), _users(spark, sf)
    initial_load(spark, cfg, users=users, version=INITIAL_VERSION)
    copy, path = unique_name("conversation_messages_by_date"), scratch_path(spark, "by_date")
    compact_by_date(spark, cfg.curated_table, copy, path)
    incremental_load(spark, cfg, users=users, end=SECOND_END)
    refresh_by_date(spark, cfg.curated_table, copy, path)
    return date_domain(spark, copy)


def q_payload_rejects(spark, sf):
    """Payloads of faulty transcripts that could not be read as they are, as two loads leave them."""
    cfg = _one_off_cfg(spark, rejects_path=scratch_path(spark, "rejects"))
    raw = damaged_transcripts(fixture_transcripts(spark, sf))
    for _ in range(2):  # the second load replaces what the first one listed
        initial_load(spark, cfg, transcripts=raw, users=_users(spark, sf), version=0)
    return spark.read.parquet(cfg.rejects_path).select("id", "reason", "lost_elements")


def q_messages_salvaged(spark, sf):
    """Messages of faulty transcripts: arrays with stray elements keep their readable activities."""
    raw = damaged_transcripts(fixture_transcripts(spark, sf))
    return build_curated(project_transcripts(raw), _users(spark, sf), CFG)


def _details(spark, sf, transcripts: DataFrame) -> DataFrame:
    """What a load says of its payloads (one row), and its columns."""
    cfg = _one_off_cfg(spark)
    out = initial_load(spark, cfg, transcripts=transcripts, users=_users(spark, sf), version=0)
    counts = {k: out.details[k] for k in ("null_payloads", "rejected_payloads", "mixed_payloads", "lost_elements")}
    columns = len(read_curated(spark, cfg.curated_table).columns)
    row = [(out.messages, *counts.values(), columns)]
    return spark.createDataFrame(row, ", ".join(f"{c} long" for c in ("messages", *counts, "columns")))


def q_load_reject_counts(spark, sf):
    return _details(spark, sf, damaged_transcripts(fixture_transcripts(spark, sf)))


def q_empty_payload_batch(spark, sf):
    """A batch in which no transcript has content loads no messages, with the full schema."""
    return _details(spark, sf, fixture_transcripts(spark, sf).withColumn("content", F.lit(None).cast("string")))


def q_no_array_batch(spark, sf):
    """A payload schema without an array gives no activities for any transcript, with the full schema."""
    t = _transcripts(spark, sf)
    parts = explode_parts(parse_payload(t, "activities STRING, other STRING"), None)
    here = parts.groupBy("id").agg(F.count(PART).alias("activities"))
    counts = t.select("id").join(here, "id", "left").na.fill(0, ["activities"])
    return counts.withColumn("columns", F.lit(len(parts.columns)))


def q_messages_epoch_ms(spark, sf):
    """Message times in milliseconds (``epoch_unit="ms"``)."""
    ms = F.regexp_replace("content", r'"timestamp":(\d+)', r'"timestamp":$1250')
    t = _transcripts(spark, sf).withColumn("content", ms)
    return messages_from_transcripts(t, dataclasses.replace(CFG, epoch_unit="ms"))


def q_curated_deduped_users(spark, sf):
    """Every user twice under one directory id: the one with the lowest id is kept."""
    users = _users(spark, sf)
    again = users.withColumns({"id": F.concat("id", F.lit("-again")), "fullname": F.lit("Somebody Else")})
    return build_curated(_transcripts(spark, sf), users.unionByName(again), dataclasses.replace(CFG, dedupe_users=True))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "curated_full": q_curated_full,
    "transcript_scan": q_transcript_scan,
    "user_scan": q_user_scan,
    "payload_activity_counts": q_payload_activity_counts,
    "inferred_schema": q_inferred_schema,
    "parts_exploded": q_parts_exploded,
    "messages_extracted": q_messages_extracted,
    "messages_local_date": q_messages_local_date,
    "messages_enriched": q_messages_enriched,
    "messages_enriched_shuffle": q_messages_enriched_shuffle,
    "semantic_view": q_semantic_view,
    "semantic_view_hidden": q_semantic_view_hidden,
    "total_conversations": q_total_conversations,
    "conversations_by_agent": q_conversations_by_agent,
    "conversations_by_channel": q_conversations_by_channel,
    "messages_by_date_agent": q_messages_by_date_agent,
    "conversations_by_date_agent": q_conversations_by_date_agent,
    "agent_header": q_agent_header,
    "conversation_list": q_conversation_list,
    "message_list": q_message_list,
    "filter_domain_agents": q_filter_domain_agents,
    "filter_domain_channels": q_filter_domain_channels,
    "filter_domain_dates": q_filter_domain_dates,
    "filter_domains": q_filter_domains,
    "filter_agent": q_filter_agent,
    "filter_date": q_filter_date,
    "filter_excluding": q_filter_excluding,
    "summary_page_total": q_summary_page_total,
    "summary_page_by_agent": q_summary_page_by_agent,
    "summary_page_by_channel": q_summary_page_by_channel,
    "summary_page_by_date": q_summary_page_by_date,
    "summary_page_filtered": q_summary_page_filtered,
    "detail_page_drill": q_detail_page_drill,
    "detail_page_total": q_detail_page_total,
    "detail_page_header": q_detail_page_header,
    "detail_page_conversations": q_detail_page_conversations,
    "detail_page_messages": q_detail_page_messages,
    "detail_page_picked_messages": q_detail_page_picked_messages,
    "detail_page_picked_by_id": q_detail_page_picked_by_id,
    "changes_inserts": q_changes_inserts,
    "load_stats": q_load_stats,
    "changes_by_version": q_changes_by_version,
    "snapshot_latest": q_snapshot_latest,
    "incremental_batch": q_incremental_batch,
    "incremental_rerun": q_incremental_rerun,
    "incremental_stream": q_incremental_stream,
    "initial_plus_stream": q_initial_plus_stream,
    "overwrite_roundtrip": q_overwrite_roundtrip,
    "compacted_by_date": q_compacted_by_date,
    "initial_table_then_increment": q_initial_table_then_increment,
    "end_past_latest": q_end_past_latest,
    "snapshot_overwrite_commit": q_snapshot_overwrite_commit,
    "reload_under_dynamic_mode": q_reload_under_dynamic_mode,
    "stream_counts": q_stream_counts,
    "detail_page_picked_conversations": q_detail_page_picked_conversations,
    "summary_page_picked_bars": q_summary_page_picked_bars,
    "summary_page_one_scan": q_summary_page_one_scan,
    "detail_page_one_scan": q_detail_page_one_scan,
    "stream_live_users": q_stream_live_users,
    "messages_enriched_heavy": q_messages_enriched_heavy,
    "reload_broken_after_write": q_reload_broken_after_write,
    "compacted_touched_dates": q_compacted_touched_dates,
    "payload_rejects": q_payload_rejects,
    "messages_salvaged": q_messages_salvaged,
    "load_reject_counts": q_load_reject_counts,
    "empty_payload_batch": q_empty_payload_batch,
    "no_array_batch": q_no_array_batch,
    "messages_epoch_ms": q_messages_epoch_ms,
    "curated_deduped_users": q_curated_deduped_users,
    "merged_schema": q_merged_schema,
    "counts_from_state": q_counts_from_state,
    "filter_domain_dates_partitions": q_filter_domain_dates_partitions,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the curated message table on sf0.001."""
    return q_curated_full(spark, SF_SMOKE)


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators and their pipeline; empty where they are not shipped."""
    try:
        import corpus_pipeline
        from chatlake.llm import queries as llm
    except ImportError as e:  # the folders are gone, or a package that only they need is
        logging.getLogger("chatlake").warning("training-data operators are left out: %s", e)
        return {}, {}
    sql = dict(llm.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_training_data()[0]}


# ---- oracle ------------------------------------------------------------------

_TRANSCRIPTS = """
  SELECT 'conv-' || conv_id AS id,
    TIMESTAMP '2024-01-01' + to_minutes(conv_id * 97) AS conversation_starttime,
    (TIMESTAMP '2024-01-01' + to_minutes(conv_id * 97))::DATE AS conversation_startdate,
    'Agent ' || (conv_id % 5) AS bot_conversationtranscriptidname,
    'bot-' || (conv_id % 5) AS "bot_conversationtranscriptId",
    conv_id AS n
  FROM (SELECT DISTINCT conv_id FROM conversations)"""

_ACTIVITIES = """
  SELECT 'conv-' || conv_id AS id,
    CASE WHEN role = 'system' THEN 'event' ELSE 'message' END AS type,
    ['msteams', 'directline', 'webchat'][(conv_id % 3)::INT + 1] AS "channelId",
    text,
    (1704067200 + conv_id * 5820 + turn * 30)::DOUBLE AS conversation_part_timestamp,
    CASE WHEN role = 'user' AND conv_id % 4 <> 0 THEN 'aad-' || (conv_id % 40) END AS "from_aadObjectId",
    CASE WHEN role = 'assistant' THEN 'bot-' || (conv_id % 5) ELSE 'anon-' || conv_id END AS from_id,
    CASE WHEN role = 'assistant' THEN 0 ELSE 1 END::BIGINT AS from_role
  FROM conversations"""

_MESSAGES = """
  SELECT 'conv-' || conv_id AS id,
    TIMESTAMP '2024-01-01' + to_minutes(conv_id * 97 - 240) AS conversation_starttime,
    (TIMESTAMP '2024-01-01' + to_minutes(conv_id * 97))::DATE AS conversation_startdate,
    'Agent ' || (conv_id % 5) AS bot_conversationtranscriptidname,
    'bot-' || (conv_id % 5) AS "bot_conversationtranscriptId",
    ['msteams', 'directline', 'webchat'][(conv_id % 3)::INT + 1] AS "channelId",
    text,
    (1704067200 + conv_id * 5820 + turn * 30)::DOUBLE AS conversation_part_timestamp,
    CASE WHEN role = 'user' AND conv_id % 4 <> 0 THEN 'aad-' || (conv_id % 40) END AS "from_aadObjectId",
    CASE WHEN role = 'assistant' THEN 'bot-' || (conv_id % 5) ELSE 'anon-' || conv_id END AS from_id,
    CASE WHEN role = 'assistant' THEN 0 ELSE 1 END::BIGINT AS from_role,
    TIMESTAMP '2024-01-01' + to_minutes(conv_id * 97 - 240) + to_seconds(turn * 30)
      AS conversation_part_starttime
  FROM conversations WHERE role <> 'system'"""

_USERS = """
  SELECT 'user-' || c_custkey AS userid, 'aad-' || c_custkey AS userentraid,
    c_name AS userfullname, 'u' || c_custkey || '@example.com' AS useremailaddress
  FROM customer WHERE c_custkey % 10 <> 9"""

_CURATED = f"""
  SELECT m.*, u.*,
    CASE m.from_role WHEN 0 THEN m.bot_conversationtranscriptidname WHEN 1 THEN u.userfullname END AS "from",
    CASE m.from_role WHEN 0 THEN '🤖' WHEN 1 THEN '👤' ELSE '' END AS from_icon
  FROM ({_MESSAGES}) m LEFT JOIN ({_USERS}) u ON m."from_aadObjectId" = u.userentraid"""


def _with_c(body: str) -> str:
    return f"WITH c AS ({_CURATED})\n{body}"


_CURATED_SELECT = _with_c("SELECT * FROM c")
_ENRICHED_SELECT = ", ".join(f'"{c}"' for c in ENRICHED_COLUMNS)

_SEMANTIC_COLUMNS = '''id AS "Conversation Id", conversation_starttime AS "Conversation Start DateTime",
  bot_conversationtranscriptidname AS "Agent", "bot_conversationtranscriptId" AS "Agent Id",
  "channelId" AS "Channel", text AS "Conversation Text",
  "from_aadObjectId" AS "From Entra Object Id", from_id AS "From Id", from_role AS "From Role",
  conversation_part_starttime AS "Conversation Part Start DateTime",
  userentraid AS "User Entra Id", userfullname AS "User Full Name",
  useremailaddress AS "User Email Address", "from" AS "From",
  conversation_startdate AS "Conversation Start Date", from_icon AS "From Icon"'''

_SEMANTIC = _with_c(f"SELECT {_SEMANTIC_COLUMNS}\nFROM c")
_SEMANTIC_HIDDEN = _with_c(f"SELECT {_SEMANTIC_COLUMNS}, conversation_part_timestamp, userid\nFROM c")

_PAGE_WHERE = """conversation_startdate >= DATE '2024-01-02' AND conversation_startdate < DATE '2024-01-07'
  AND ("channelId" IS NULL OR "channelId" NOT IN ('msteams'))"""
_DETAIL_WHERE = _PAGE_WHERE + " AND bot_conversationtranscriptidname IN ('Agent 2')"

_MESSAGE_LIST = """SELECT DISTINCT conversation_part_starttime, "channelId", from_icon AS icon, "from", text
FROM c WHERE text IS NOT NULL{extra}"""

# The fixture assigns commit versions by rule (FIXTURES.md section 4): transcript n
# is inserted at version n % 10, updated at 10 when n % 11 = 0 and deleted at 11
# when n % 17 = 0. The modulo conditions below restate those version ranges; they
# are not row subsets, and every query reads the whole tables.
_LOG_IDS = "WITH t AS (SELECT DISTINCT conv_id AS n FROM conversations)"

_ORACLE: dict[str, str] = {
    "curated_full": _CURATED_SELECT,
    "transcript_scan": f"""SELECT id, conversation_starttime, conversation_startdate,
  bot_conversationtranscriptidname, "bot_conversationtranscriptId" FROM ({_TRANSCRIPTS})""",
    "user_scan": """SELECT 'user-' || c_custkey AS id, 'aad-' || c_custkey AS azureactivedirectoryobjectid,
  c_name AS fullname, 'u' || c_custkey || '@example.com' AS internalemailaddress
FROM customer WHERE c_custkey % 10 <> 9""",
    "payload_activity_counts": """SELECT 'conv-' || conv_id AS id, count(*)::INT AS activities
FROM conversations GROUP BY conv_id""",
    "inferred_schema": """SELECT 'conv-' || conv_id AS id, count(*)::INT AS activities,
  (count(*) FILTER (WHERE role <> 'system'))::INT AS messages
FROM conversations GROUP BY conv_id""",
    "parts_exploded": f"SELECT * FROM ({_ACTIVITIES})",
    "messages_extracted": f"SELECT * FROM ({_MESSAGES})",
    "messages_local_date": f"""SELECT * REPLACE (conversation_starttime::DATE AS conversation_startdate)
FROM ({_MESSAGES})""",
    "messages_enriched": _with_c(f"SELECT {_ENRICHED_SELECT} FROM c"),
    "messages_enriched_shuffle": _with_c(f"SELECT {_ENRICHED_SELECT} FROM c"),
    "semantic_view": _SEMANTIC,
    "semantic_view_hidden": _SEMANTIC_HIDDEN,
    "total_conversations": _with_c("SELECT count(DISTINCT id) AS total_conversations FROM c"),
    "conversations_by_agent": _with_c(
        """SELECT bot_conversationtranscriptidname, count(DISTINCT id) AS conversations
FROM c GROUP BY 1 ORDER BY conversations DESC, 1"""
    ),
    "conversations_by_channel": _with_c(
        """SELECT "channelId", count(DISTINCT id) AS conversations FROM c GROUP BY 1
ORDER BY conversations DESC, 1"""
    ),
    "messages_by_date_agent": _with_c(
        """SELECT conversation_startdate, bot_conversationtranscriptidname, count(id) AS messages
FROM c GROUP BY 1, 2 ORDER BY 1, 2"""
    ),
    "conversations_by_date_agent": _with_c(
        """SELECT conversation_startdate, bot_conversationtranscriptidname,
  count(DISTINCT id) AS conversations FROM c GROUP BY 1, 2 ORDER BY 1, 2"""
    ),
    "agent_header": _with_c("SELECT min(bot_conversationtranscriptidname) AS agent FROM c"),
    "conversation_list": _with_c(
        "SELECT DISTINCT conversation_starttime FROM c ORDER BY conversation_starttime DESC"
    ),
    "message_list": _with_c(_MESSAGE_LIST.format(extra="") + " ORDER BY 1"),
    "filter_domain_agents": _with_c(
        "SELECT DISTINCT bot_conversationtranscriptidname FROM c ORDER BY 1"
    ),
    "filter_domain_channels": _with_c('SELECT DISTINCT "channelId" FROM c ORDER BY 1'),
    "filter_domain_dates": _with_c(
        "SELECT min(conversation_startdate) AS date_min, max(conversation_startdate) AS date_max FROM c"
    ),
    "filter_domains": _with_c(
        """SELECT DISTINCT 'agent' AS domain, bot_conversationtranscriptidname AS value FROM c
UNION ALL SELECT DISTINCT 'channel', "channelId" FROM c
UNION ALL SELECT 'date_min', strftime(min(conversation_startdate), '%Y-%m-%d') FROM c
UNION ALL SELECT 'date_max', strftime(max(conversation_startdate), '%Y-%m-%d') FROM c"""
    ),
    "filter_agent": _with_c(
        "SELECT * FROM c WHERE bot_conversationtranscriptidname IN ('Agent 1', 'Agent 3')"
    ),
    "filter_date": _with_c(
        """SELECT * FROM c WHERE conversation_startdate >= DATE '2024-01-02'
  AND conversation_startdate < DATE '2024-01-05'"""
    ),
    "filter_excluding": _with_c(
        """SELECT * FROM c WHERE ("channelId" IS NULL OR "channelId" NOT IN ('msteams'))
  AND (bot_conversationtranscriptidname IS NULL OR bot_conversationtranscriptidname NOT IN ('Agent 0'))"""
    ),
    "summary_page_total": _with_c(
        f"SELECT count(DISTINCT id) AS total_conversations FROM c WHERE {_PAGE_WHERE}"
    ),
    "summary_page_by_agent": _with_c(
        f"""SELECT bot_conversationtranscriptidname, count(DISTINCT id) AS conversations
FROM c WHERE {_PAGE_WHERE} GROUP BY 1 ORDER BY conversations DESC, 1"""
    ),
    "summary_page_by_channel": _with_c(
        f"""SELECT "channelId", count(DISTINCT id) AS conversations
FROM c WHERE {_PAGE_WHERE} GROUP BY 1 ORDER BY conversations DESC, 1"""
    ),
    "summary_page_by_date": _with_c(
        f"""SELECT conversation_startdate, bot_conversationtranscriptidname, count(id) AS messages
FROM c WHERE {_PAGE_WHERE} GROUP BY 1, 2 ORDER BY 1, 2"""
    ),
    "summary_page_filtered": _with_c(
        f"""SELECT bot_conversationtranscriptidname, count(DISTINCT id) AS conversations
FROM c WHERE {_PAGE_WHERE} GROUP BY 1 ORDER BY conversations DESC, 1"""
    ),
    "detail_page_drill": _with_c(_MESSAGE_LIST.format(extra=f" AND {_DETAIL_WHERE}") + " ORDER BY 1"),
    "detail_page_total": _with_c(
        f"SELECT count(DISTINCT id) AS total_conversations FROM c WHERE {_DETAIL_WHERE}"
    ),
    "detail_page_header": _with_c(
        f"SELECT min(bot_conversationtranscriptidname) AS agent FROM c WHERE {_DETAIL_WHERE}"
    ),
    "detail_page_conversations": _with_c(
        f"""SELECT DISTINCT conversation_starttime FROM c WHERE {_DETAIL_WHERE}
ORDER BY conversation_starttime DESC"""
    ),
    "detail_page_messages": _with_c(
        _MESSAGE_LIST.format(extra=f" AND {_DETAIL_WHERE}") + " ORDER BY 1"
    ),
    "detail_page_picked_messages": _with_c(
        _MESSAGE_LIST.format(
            extra=f" AND {_DETAIL_WHERE} AND conversation_starttime = TIMESTAMP '2024-01-02 07:34:00'"
        )
        + " ORDER BY 1"
    ),
    "detail_page_picked_by_id": _with_c(
        _MESSAGE_LIST.format(extra=f" AND {_DETAIL_WHERE} AND id = 'conv-22'") + " ORDER BY 1"
    ),
    "changes_inserts": f"""SELECT id, conversation_starttime, conversation_startdate,
  bot_conversationtranscriptidname, "bot_conversationtranscriptId", (n % 10)::BIGINT AS _commit_version
FROM ({_TRANSCRIPTS}) WHERE n % 10 BETWEEN 5 AND 9""",
    "load_stats": f"""{_LOG_IDS}
SELECT (SELECT count(*) FROM t WHERE n % 10 BETWEEN 5 AND 9)
     + 2 * (SELECT count(*) FROM t WHERE n % 11 = 0)
     + (SELECT count(*) FROM t WHERE n % 17 = 0) AS change_rows,
  (SELECT count(*) FROM t WHERE n % 10 BETWEEN 5 AND 9) AS insert_rows""",
    "changes_by_version": f"""{_LOG_IDS}
SELECT (n % 10)::BIGINT AS _commit_version, 'insert' AS _change_type, count(*) AS rows FROM t GROUP BY 1
UNION ALL SELECT 10, 'update_preimage', count(*) FROM t WHERE n % 11 = 0 HAVING count(*) > 0
UNION ALL SELECT 10, 'update_postimage', count(*) FROM t WHERE n % 11 = 0 HAVING count(*) > 0
UNION ALL SELECT 11, 'delete', count(*) FROM t WHERE n % 17 = 0 HAVING count(*) > 0""",
    "snapshot_latest": """SELECT 'conv-' || conv_id AS id,
  (CASE WHEN conv_id % 11 = 0 THEN 1 ELSE count(*) END)::INT AS activities
FROM conversations WHERE conv_id % 17 <> 0 GROUP BY conv_id""",
    "incremental_batch": _CURATED_SELECT,
    "incremental_rerun": _CURATED_SELECT,
    "incremental_stream": _CURATED_SELECT,
    "initial_plus_stream": _CURATED_SELECT,
    "overwrite_roundtrip": _CURATED_SELECT,
    "compacted_by_date": _CURATED_SELECT,
    "initial_table_then_increment": _CURATED_SELECT,
    "end_past_latest": _CURATED_SELECT,
    "snapshot_overwrite_commit": """SELECT 'conv-' || conv_id AS id,
  (CASE WHEN conv_id % 11 = 0 OR conv_id % 5 = 0 THEN 1 ELSE count(*) END)::INT AS activities
FROM conversations WHERE conv_id % 17 <> 0 OR conv_id % 5 = 0 GROUP BY conv_id""",
    "reload_under_dynamic_mode": _CURATED_SELECT,
    "stream_counts": f"""{_LOG_IDS}
SELECT (SELECT count(*) FROM t) + 2 * (SELECT count(*) FROM t WHERE n % 11 = 0)
     + (SELECT count(*) FROM t WHERE n % 17 = 0) AS change_rows,
  (SELECT count(*) FROM t) AS insert_rows""",
    "detail_page_picked_conversations": _with_c(
        f"""SELECT DISTINCT conversation_starttime FROM c WHERE {_DETAIL_WHERE}
ORDER BY conversation_starttime DESC"""
    ),
    "summary_page_picked_bars": _with_c(
        f"""SELECT bot_conversationtranscriptidname, count(DISTINCT id) AS conversations
FROM c WHERE {_PAGE_WHERE} GROUP BY 1 ORDER BY conversations DESC, 1"""
    ),
    "summary_page_one_scan": _with_c(
        f"""SELECT 'total_conversations' AS visual, NULL::DATE AS conversation_startdate,
  NULL::VARCHAR AS bot_conversationtranscriptidname, NULL::VARCHAR AS "channelId",
  NULL::TIMESTAMP AS conversation_starttime, count(DISTINCT id) AS value
FROM c WHERE {_DETAIL_WHERE}
UNION ALL SELECT 'conversations_by_agent', NULL, bot_conversationtranscriptidname, NULL, NULL, count(DISTINCT id)
FROM c WHERE {_PAGE_WHERE} GROUP BY bot_conversationtranscriptidname
UNION ALL SELECT 'conversations_by_channel', NULL, NULL, "channelId", NULL, count(DISTINCT id)
FROM c WHERE {_DETAIL_WHERE} GROUP BY "channelId"
UNION ALL SELECT 'messages_by_date_agent', conversation_startdate, bot_conversationtranscriptidname, NULL, NULL, count(id)
FROM c WHERE {_DETAIL_WHERE} GROUP BY conversation_startdate, bot_conversationtranscriptidname"""
    ),
    "detail_page_one_scan": _with_c(
        f"""SELECT 'total_conversations' AS visual, NULL::DATE AS conversation_startdate,
  NULL::VARCHAR AS bot_conversationtranscriptidname, NULL::VARCHAR AS "channelId",
  NULL::TIMESTAMP AS conversation_starttime, count(DISTINCT id) AS value
FROM c WHERE {_DETAIL_WHERE} AND conversation_starttime = TIMESTAMP '2024-01-02 07:34:00'
UNION ALL SELECT 'agent_header', NULL, min(bot_conversationtranscriptidname), NULL, NULL, NULL
FROM c WHERE {_DETAIL_WHERE} AND conversation_starttime = TIMESTAMP '2024-01-02 07:34:00'
UNION ALL SELECT DISTINCT 'conversation_list', NULL::DATE, NULL, NULL, conversation_starttime, NULL::BIGINT
FROM c WHERE {_DETAIL_WHERE}"""
    ),
    "messages_enriched_heavy": f"""WITH m AS (SELECT * REPLACE (
  CASE WHEN substr("from_aadObjectId", 5)::BIGINT % 3 > 0 THEN 'aad-1' ELSE "from_aadObjectId" END AS "from_aadObjectId")
  FROM ({_MESSAGES})),
c AS (SELECT m.*, u.*,
  CASE m.from_role WHEN 0 THEN m.bot_conversationtranscriptidname WHEN 1 THEN u.userfullname END AS "from",
  CASE m.from_role WHEN 0 THEN '🤖' WHEN 1 THEN '👤' ELSE '' END AS from_icon
  FROM m LEFT JOIN ({_USERS}) u ON m."from_aadObjectId" = u.userentraid)
SELECT {_ENRICHED_SELECT} FROM c""",
    "stream_live_users": f"""SELECT m.*, u.*,
  CASE m.from_role WHEN 0 THEN m.bot_conversationtranscriptidname WHEN 1 THEN u.userfullname END AS "from",
  CASE m.from_role WHEN 0 THEN '🤖' WHEN 1 THEN '👤' ELSE '' END AS from_icon
FROM ({_MESSAGES}) m LEFT JOIN ({_USERS}) u ON m."from_aadObjectId" = u.userentraid
  AND (substr(m.id, 6)::BIGINT % 10 > 4 OR substr(u.userid, 6)::BIGINT % 2 = 0)""",
    "reload_broken_after_write": f"""WITH c AS ({_CURATED})
SELECT 'broken' AS phase, * FROM c WHERE substr(id, 6)::BIGINT % 10 <= 4
UNION ALL SELECT 'reloaded', * FROM c""",
    "compacted_touched_dates": _CURATED_SELECT,
    # The fixture damages payloads by conversation number modulo 9 (``damaged_transcripts``); the conditions
    # below restate that rule.
    "payload_rejects": """SELECT 'conv-' || conv_id AS id,
  ['malformed', 'mixed_array', NULL, 'not_object', 'no_array', 'not_array'][(conv_id % 9)::INT + 1] AS reason,
  CASE WHEN conv_id % 9 = 1 THEN 3 END::BIGINT AS lost_elements
FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id % 9 IN (0, 1, 3, 4, 5)""",
    "messages_salvaged": _with_c("SELECT * FROM c WHERE substr(id, 6)::BIGINT % 9 NOT IN (0, 2, 3, 4, 5)"),
    "load_reject_counts": """SELECT
  count(*) FILTER (role <> 'system' AND conv_id % 9 NOT IN (0, 2, 3, 4, 5)) AS messages,
  count(DISTINCT conv_id) FILTER (conv_id % 9 = 2) AS null_payloads,
  count(DISTINCT conv_id) FILTER (conv_id % 9 IN (0, 3, 4, 5)) AS rejected_payloads,
  count(DISTINCT conv_id) FILTER (conv_id % 9 = 1) AS mixed_payloads,
  3 * count(DISTINCT conv_id) FILTER (conv_id % 9 = 1) AS lost_elements, 18::BIGINT AS columns
FROM conversations""",
    "empty_payload_batch": """SELECT 0::BIGINT AS messages, count(DISTINCT conv_id) AS null_payloads,
  0::BIGINT AS rejected_payloads, 0::BIGINT AS mixed_payloads, 0::BIGINT AS lost_elements, 18::BIGINT AS columns
FROM conversations""",
    "no_array_batch": """SELECT DISTINCT 'conv-' || conv_id AS id, 0::BIGINT AS activities, 6 AS columns FROM conversations""",
    "messages_epoch_ms": f"""SELECT * REPLACE (
  conversation_part_timestamp * 1000 + 250 AS conversation_part_timestamp) FROM ({_MESSAGES})""",
    "curated_deduped_users": _CURATED_SELECT,
    "merged_schema": """SELECT 'conv-' || conv_id AS id, count(*)::INT AS activities,
  (count(*) FILTER (WHERE role <> 'system'))::INT AS messages
FROM conversations GROUP BY conv_id""",
    "counts_from_state": _with_c(
        """SELECT 'conversations' AS visual, NULL::DATE AS date, NULL::VARCHAR AS agent, NULL::VARCHAR AS channel,
  count(DISTINCT id) AS n FROM c
UNION ALL SELECT 'by_agent', NULL, bot_conversationtranscriptidname, NULL, count(DISTINCT id) FROM c GROUP BY 3
UNION ALL SELECT 'by_channel', NULL, NULL, "channelId", count(DISTINCT id) FROM c GROUP BY 4
UNION ALL SELECT 'by_date_agent', conversation_startdate, bot_conversationtranscriptidname, NULL, count(DISTINCT id)
FROM c GROUP BY 2, 3
UNION ALL SELECT 'messages_by_date_agent', conversation_startdate, bot_conversationtranscriptidname, NULL, count(id)
FROM c GROUP BY 2, 3"""
    ),
    "filter_domain_dates_partitions": _with_c(
        "SELECT min(conversation_startdate) AS date_min, max(conversation_startdate) AS date_max FROM c"
    ),
}


def oracle_sql() -> dict[str, str]:
    return {**{k: v for k, v in _ORACLE.items() if k in _QUERIES}, **_training_data()[1]}
