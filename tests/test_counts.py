"""Counts from maintained state equal those from messages, whatever the cut of the history."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from chatlake.config import LoadConfig
from chatlake.functions.payload import merged_payload_schema, parse_payload
from chatlake.operators import report as R
from chatlake.plans import counts, sinks
from chatlake.plans.compact import compact_by_date, date_domain
from chatlake.plans.curated import build_curated
from chatlake.schema import COMMIT_VERSION, CURATED_COLUMNS
from chatlake.session import scratch_path, unique_name
from chatlake.sources.fixtures import fixture_transcripts, fixture_users
from chatlake.sources.tables import project_transcripts, project_users, read_curated


@pytest.fixture(scope="module")
def versions(spark, sf_small):
    """Curated rows with versions 0 to 11 by message, so that conversations span versions; some without id or channel."""
    t, u = project_transcripts(fixture_transcripts(spark, sf_small)), project_users(fixture_users(spark, sf_small))
    rows = build_curated(t, u, LoadConfig()).select(*CURATED_COLUMNS)
    h = F.xxhash64("id", "text", "conversation_part_timestamp")
    rows = rows.withColumn(COMMIT_VERSION, F.pmod(h, F.lit(12)))
    rows = rows.withColumn("id", F.when(F.pmod(h, F.lit(17)) != 0, F.col("id")))
    return rows.withColumn(R.CHANNEL, F.when(F.pmod(h, F.lit(13)) != 0, F.col(R.CHANNEL))).cache()


def _load(spark, rows, table, path, low, high):
    part = rows.where(F.col(COMMIT_VERSION).between(low, high))
    if low == 0:
        sinks.write_curated(part.drop(COMMIT_VERSION), table, high, path, baseline=high)
    else:
        sinks.replace_versions(part, table)
        sinks.set_baseline(spark, table, high)


def _same(spark, table, state, where="true"):
    cells, rows = counts.read_counts(spark, table, state).where(where), read_curated(spark, table).where(where)
    pairs = [
        (counts.conversations_by(cells), R.total_conversations(rows)),
        (counts.conversations_by(cells, R.AGENT), R.conversations_by_agent(rows)),
        (counts.conversations_by(cells, R.CHANNEL), R.conversations_by_channel(rows)),
        (counts.conversations_by(cells, R.DATE, R.AGENT), R.conversations_by_date_agent(rows)),
        (counts.messages_by(cells, R.DATE, R.AGENT), R.messages_by_date_agent(rows)),
    ]
    for ours, theirs in pairs:
        assert sorted(map(repr, map(tuple, ours.collect()))) == sorted(map(repr, map(tuple, theirs.collect())))


@pytest.mark.parametrize("cuts", [(11,), (4, 9, 11)])
def test_any_cut_of_the_history(spark, versions, cuts):
    table, path, state = unique_name("cm"), scratch_path(spark, "counts"), scratch_path(spark, "state")
    low = 0
    for high in cuts:
        _load(spark, versions, table, path, low, high)
        assert counts.update_counts(spark, table, state) == high == counts.update_counts(spark, table, state)
        low = high + 1
    _same(spark, table, state)
    _same(spark, table, state, f"{R.DATE} >= '2024-01-03' AND {R.AGENT} <> 'Agent 1'")


def test_broken_batch_is_replaced_and_a_reload_begins_anew(spark, versions, monkeypatch):
    table, path, state = unique_name("cm"), scratch_path(spark, "counts"), scratch_path(spark, "state")
    _load(spark, versions, table, path, 0, 4)
    counts.update_counts(spark, table, state)
    _load(spark, versions, table, path, 5, 7)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(counts, "_mark", broken)
        with pytest.raises(OSError):
            counts.update_counts(spark, table, state)
    assert counts.counted_to(spark, table, state) == 4
    early = counts.conversations_by(counts.read_counts(spark, table, state)).first()[0]
    assert early == versions.where(F.col(COMMIT_VERSION) <= 4).agg(F.count_distinct("id")).first()[0]
    _load(spark, versions, table, path, 8, 11)  # the next batch takes in what the broken one had
    counts.update_counts(spark, table, state)
    _same(spark, table, state)
    sinks.write_curated(versions.where("from_role = 0").drop(COMMIT_VERSION), table, 2, path, baseline=2)
    assert counts.read_counts(spark, table, state).count() == 0
    counts.update_counts(spark, table, state)
    _same(spark, table, state)


def test_date_domain_equals_that_of_the_rows(spark, versions):
    table, path = unique_name("cm"), scratch_path(spark, "counts")
    rows = versions.withColumn(R.DATE, F.when(F.col("from_role") == 0, F.col(R.DATE)))
    sinks.write_curated(rows.drop(COMMIT_VERSION), table, 0, path, baseline=0)
    copy = unique_name("by_date")
    compact_by_date(spark, table, copy, scratch_path(spark, "by_date"))
    assert date_domain(spark, copy).collect() == R.filter_domain_dates(rows).collect()


def test_merged_schema_has_every_field_of_every_payload(spark):
    payloads = [
        '{"activities": [{"type": "message", "n": 1}], "a": null}',
        '{"activities": [{"type": "event", "n": 2.5, "from": {"id": "x"}}], "b": [true]}',
        '{"rare `name": {"deep": 1}, "void": "s", "OBJECT<": 3, "c": 1}',
        '{"c": "text", "e": {}}', "[1]", "not json", None,
    ]
    t = spark.createDataFrame([(p,) for p in payloads], "content string")
    schema = merged_payload_schema(t)
    assert set(schema.fieldNames()) == {"activities", "a", "b", "rare `name", "void", "OBJECT<", "c", "e"}
    element = schema["activities"].dataType.elementType
    assert set(element.fieldNames()) == {"type", "n", "from"} and element["from"].dataType.fieldNames() == ["id"]
    assert schema["rare `name"].dataType.fieldNames() == ["deep"]
    parsed = [r[0] for r in parse_payload(t, schema).select("content_json").collect()]
    assert [float(a["n"]) for p in parsed[:2] for a in p["activities"]] == [1.0, 2.5] and parsed[3]["c"] == "text"
    assert merged_payload_schema(t.limit(0)) is None and merged_payload_schema(t.where("content = '[1]'")) is None
