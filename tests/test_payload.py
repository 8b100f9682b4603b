"""Edge rows of the payload path (FIXTURES.md section 6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Observation

from chatlake.config import LoadConfig
from chatlake.functions.payload import (
    first_array_column,
    infer_payload_schema,
    parse_payload,
    payload_rejects,
    sample_payload,
)
from chatlake.operators.parts import explode_parts
from chatlake.plans.curated import build_curated, messages_from_transcripts
from chatlake.schema import CURATED_COLUMNS, CURATED_SCHEMA
from tests.helpers import START, msg, payload, transcripts, users

CFG0 = LoadConfig(tz_offset_minutes=0)


def _messages(spark, contents, cfg=CFG0):
    t = transcripts(spark, [(f"c{i}", None, None, c) for i, c in enumerate(contents)])
    return messages_from_transcripts(t, cfg)


def test_bad_payloads_give_no_messages(spark):
    contents = [
        None,
        "not json",
        '{"activities": [',
        "{}",
        '{"activities": []}',
        '{"activities":[{"type":"event"}]}',
        '{"activities":[{"text":"x"}]}',
        '{"activities": "nope"}',
        "[1, 2]",
    ]
    assert _messages(spark, contents).count() == 0


def test_numbers_as_strings_and_text_as_number(spark):
    content = '{"activities":[{"type":"message","text":5,"timestamp":"17","from":{"role":"1"}}]}'
    row = _messages(spark, [content]).first()
    assert row.text == "5"
    assert row.conversation_part_timestamp == 17.0
    assert row.from_role == 1
    assert row.conversation_part_starttime == dt.datetime(1970, 1, 1, 0, 0, 17)


def test_odd_roles_do_not_fail(spark):
    acts = [msg(role=None), msg(role=2), msg(role="bot")]
    t = transcripts(spark, [("c1", None, None, payload(*acts))])
    u = users(spark, [("u1", "aad-1", "Ann", "a@x")])
    rows = build_curated(t, u, CFG0).collect()
    assert len(rows) == 3
    for r in rows:
        assert r["from"] is None
        assert r["from_icon"] == ""


def test_fractional_epoch_truncates_and_missing_epoch_keeps_message(spark):
    acts = [msg(ts=1700000000.9), msg(ts=None, text="no time")]
    rows = {r.text: r for r in _messages(spark, [payload(*acts)]).collect()}
    assert rows["hi"].conversation_part_starttime == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert rows["no time"].conversation_part_starttime is None
    assert rows["no time"].conversation_part_timestamp is None


def test_out_of_range_epoch_is_null_not_error(spark):
    rows = _messages(spark, [payload(msg(ts=1e20), msg(ts="abc"))]).collect()
    assert [r.conversation_part_starttime for r in rows] == [None, None]


def test_millisecond_epoch_option(spark):
    cfg = LoadConfig(tz_offset_minutes=0, epoch_unit="ms")
    row = _messages(spark, [payload(msg(ts=1700000000900))], cfg).first()
    assert row.conversation_part_starttime == dt.datetime(2023, 11, 14, 22, 13, 20)


def test_events_are_dropped_messages_kept(spark):
    content = payload(msg(typ="event"), msg(text="a"), msg(typ="typing"), msg(text="b"))
    assert sorted(r.text for r in _messages(spark, [content]).collect()) == ["a", "b"]


def test_all_null_batch_gives_empty_full_schema(spark):
    t = transcripts(spark, [("c1", None, None, None), ("c2", None, None, None)])
    u = users(spark, [("u1", "aad-1", "Ann", "a@x")])
    c = build_curated(t, u, CFG0)
    assert c.count() == 0
    assert c.columns == CURATED_COLUMNS
    assert [f.dataType for f in c.schema.fields] == [f.dataType for f in CURATED_SCHEMA.fields]


def test_curated_schema_is_contract(spark, sf_small):
    from chatlake.sources.fixtures import fixture_transcripts, fixture_users
    from chatlake.sources.tables import project_transcripts, project_users

    c = build_curated(
        project_transcripts(fixture_transcripts(spark, sf_small)),
        project_users(fixture_users(spark, sf_small)),
    )
    assert c.columns == CURATED_COLUMNS
    assert [f.dataType for f in c.schema.fields] == [f.dataType for f in CURATED_SCHEMA.fields]


def test_no_array_field_gives_empty_result(spark):
    t = transcripts(spark, [("c1", None, None, '{"x": 1}')])
    parsed = parse_payload(t, "struct<x int>")
    parts = explode_parts(parsed, array_col=None)
    assert parts.count() == 0
    assert "conversation_part_json" in parts.columns


def test_no_array_field_full_path_gives_empty_curated_schema(spark):
    from chatlake.operators.enrich import enrich_users
    from chatlake.operators.parts import extract_fields, messages_only

    t = transcripts(spark, [("c1", None, None, '{"x": 1}')])
    parts = explode_parts(parse_payload(t, "struct<x int>"), array_col=None)
    c = enrich_users(extract_fields(messages_only(parts)), users(spark, [("u", "k", "n", "e")]))
    assert c.count() == 0 and c.columns == CURATED_COLUMNS


def test_schema_inference_from_newest_sample(spark):
    old = payload(msg(text="old"))
    new = '{"messages":[{"type":"message","text":"new"}],"extra":1}'
    t = transcripts(
        spark,
        [("c1", START, None, old), ("c2", START + dt.timedelta(days=1), None, new), ("c3", None, None, None)],
    )
    sample = sample_payload(t, 1)
    assert sample == [new]
    schema = infer_payload_schema(spark, sample)
    assert first_array_column(schema) == "messages"
    merged = infer_payload_schema(spark, sample_payload(t, 2))
    assert set(merged.fieldNames()) == {"activities", "extra", "messages"}
    assert infer_payload_schema(spark, []) is None


ODD = [
    ("whole", '{"activities":[{"type":"message","text":"a"}]}', None, 1),
    ("cut", '{"activities":[{"type":"message","text":"a"},{"typ', "malformed", 0),
    ("blank", "", "malformed", 0),
    ("number", "17", "not_object", 0),
    ("top", '[{"type":"message","text":"a"}]', "not_object", 0),
    ("other", '{"x":1}', "no_array", 0),
    ("null array", '{"activities":null}', "no_array", 0),
    ("object", '{"activities":{"type":"message","text":"a"}}', "not_array", 0),
    ("mixed", '{"activities":[5,{"type":"message","text":"a","timestamp":"17.5","from":{"role":"1"}},[1],"s"]}', "mixed_array", 1),
    ("stray only", '{"activities":[1,2]}', "mixed_array", 0),
    ("none", None, None, 0),
    ("empty", '{"activities":[]}', None, 0),
    ("null element", '{"activities":[null,{"type":"message","text":"a"}]}', None, 1),
    ("odd sender", '{"activities":[{"type":"message","text":"a","from":5}]}', None, 1),
]


def test_rejects_and_salvage_of_odd_payloads(spark):
    t = transcripts(spark, [(i, None, None, c) for i, c, _, _ in ODD])
    found = {r["id"]: r for r in payload_rejects(t).collect()}
    assert {i: r.reason for i, r in found.items()} == {i: why for i, _, why, _ in ODD if why}
    assert found["mixed"].lost_elements == 3 and found["stray only"].lost_elements == 2
    assert found["cut"].lost_elements is None and found["cut"].content == ODD[1][1]
    m = messages_from_transcripts(t, CFG0).groupBy("id").count().collect()
    assert {r["id"]: r["count"] for r in m} == {i: n for i, _, _, n in ODD if n}
    plain = messages_from_transcripts(t, LoadConfig(tz_offset_minutes=0, salvage_payloads=False))
    assert "mixed" not in {r["id"] for r in plain.collect()}
    one = messages_from_transcripts(t.where("id = 'mixed'"), CFG0).first()
    assert (one.text, one.conversation_part_timestamp, one.from_role) == ("a", 17.5, 1)


def test_salvage_reads_json_once_on_the_way(spark):
    t = transcripts(spark, [(i, None, None, c) for i, c, _, _ in ODD])
    for payloads in (None, Observation()):
        m = messages_from_transcripts(t, CFG0, payloads=payloads)
        assert m._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
