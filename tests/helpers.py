"""Hand-built raw rows for unit tests."""

from __future__ import annotations

import datetime as dt
import json

from chatlake.schema import TRANSCRIPT_SCHEMA, USER_SCHEMA
from chatlake.sources.tables import project_transcripts, project_users

START = dt.datetime(2024, 3, 1, 12, 0, 0)


def msg(text="hi", role=1, aad="aad-1", ts=1700000000, channel="webchat", typ="message", sender_id="u-1"):
    a = {"type": typ, "channelId": channel, "text": text, "timestamp": ts,
         "from": {"aadObjectId": aad, "id": sender_id, "role": role}}
    return {k: v for k, v in a.items() if v is not None}


def payload(*acts) -> str:
    return json.dumps({"activities": list(acts)})


def transcripts(spark, rows):
    """rows: (id, start datetime, agent name, content)."""
    data = [(i, s or START, n or "Agent A", "bot-a", c) for i, s, n, c in rows]
    return project_transcripts(spark.createDataFrame(data, TRANSCRIPT_SCHEMA))


def users(spark, rows):
    """rows: (id, directory id, full name, email)."""
    return project_users(spark.createDataFrame(rows, USER_SCHEMA))
