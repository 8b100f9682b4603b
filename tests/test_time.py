"""Offsets, date semantics and time-zone independence."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatlake.config import LoadConfig
from chatlake.functions.time import epoch_to_ntz, offset_interval, shift, to_utc_ntz
from chatlake.plans.curated import messages_from_transcripts
from tests.helpers import msg, payload, transcripts


@pytest.mark.parametrize("minutes", [-240, 0, 330])
def test_offsets_shift_start_and_part_times(spark, minutes):
    start = dt.datetime(2024, 3, 1, 2, 0, 0)
    t = transcripts(spark, [("c1", start, None, payload(msg(ts=1709258400)))])  # 2024-03-01 02:00 UTC
    row = messages_from_transcripts(t, LoadConfig(tz_offset_minutes=minutes)).first()
    delta = dt.timedelta(minutes=minutes)
    assert row.conversation_starttime == start + delta
    assert row.conversation_part_starttime == dt.datetime(2024, 3, 1, 2, 0, 0) + delta
    # The date is taken before the shift (parity with the source report).
    assert row.conversation_startdate == dt.date(2024, 3, 1)


def test_local_date_option_uses_shifted_start(spark):
    t = transcripts(spark, [("c1", dt.datetime(2024, 3, 1, 2, 0), None, payload(msg()))])
    row = messages_from_transcripts(t, LoadConfig(tz_offset_minutes=-240, local_date=True)).first()
    assert row.conversation_starttime == dt.datetime(2024, 2, 29, 22, 0)
    assert row.conversation_startdate == dt.date(2024, 2, 29)


def test_offset_must_be_whole_minutes():
    with pytest.raises(TypeError):
        offset_interval(5.5)


def test_epoch_unit_is_validated():
    with pytest.raises(ValueError):
        epoch_to_ntz("x", 0, unit="us")


def test_results_do_not_depend_on_session_zone(spark):
    df = spark.createDataFrame([(1700000000.9,)], "s double")
    out = []
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ["UTC", "America/New_York", "Asia/Kolkata"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            out.append(df.select(epoch_to_ntz("s", -240).alias("t")).first().t)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert len(set(out)) == 1
    assert out[0] == dt.datetime(2023, 11, 14, 18, 13, 20)


def test_zone_aware_source_timestamp_becomes_utc_wall_clock(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:00Z' AS ts")
        row = df.select(to_utc_ntz("ts", T.TimestampType()).alias("n")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert row.n == dt.datetime(2024, 1, 1, 0, 0, 0)


def test_shift_zero_is_identity(spark):
    df = spark.range(1).select(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("t"))
    assert df.select(shift("t", 0).alias("x")).first().x == dt.datetime(2024, 1, 1)
