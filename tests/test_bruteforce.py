"""Randomised transcripts vs a plain-Python model of the curated semantics.

The generator mixes valid messages with events, missing fields, wrong JSON
types, numbers as strings, odd roles, malformed payloads, duplicate and missing
user keys and hot keys; the model computes the expected curated rows row by row.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import random

import pytest

from chatlake.config import LoadConfig
from chatlake.plans.curated import build_curated
from chatlake.schema import AGENT_ICON, CURATED_COLUMNS, USER_ICON
from tests.helpers import transcripts, users

EPOCH = dt.datetime(1970, 1, 1)
MAX_S = 253402300799


def _rand_value(rng, kind):
    if kind == "ts":
        return rng.choice([
            1700000000 + rng.randint(0, 10**6), 1700000000.5, str(1700000000 + rng.randint(0, 999)),
            None, "abc", 1e20, -5,
        ])
    if kind == "role":
        return rng.choice([0, 1, 1, 0, 2, "0", "1", "bot", None])
    if kind == "text":
        return rng.choice(["hello", "", "é ü 你好", None, 42, "line\nbreak", "x" * 300])
    if kind == "aad":
        return rng.choice(["aad-hot"] * 4 + ["aad-1", "aad-2", "aad-dup", "aad-none", None, None])
    raise ValueError(kind)


def _activity(rng):
    a = {}
    if rng.random() < 0.95:
        a["type"] = rng.choice(["message"] * 6 + ["event", "typing", 7, None])
    if rng.random() < 0.9:
        a["channelId"] = rng.choice(["msteams", "webchat", None])
    if rng.random() < 0.9:
        a["text"] = _rand_value(rng, "text")
    if rng.random() < 0.9:
        a["timestamp"] = _rand_value(rng, "ts")
    if rng.random() < 0.9:
        f = {}
        if rng.random() < 0.9:
            f["aadObjectId"] = _rand_value(rng, "aad")
        if rng.random() < 0.9:
            f["id"] = rng.choice(["s1", "s2", None])
        if rng.random() < 0.9:
            f["role"] = _rand_value(rng, "role")
        a["from"] = f
    if rng.random() < 0.1:
        a["extra"] = {"nested": [1, 2]}
    return a


def _content(rng):
    r = rng.random()
    if r < 0.05:
        return None
    if r < 0.08:
        return rng.choice(["not json", '{"activities": [', "[]", '{"activities": {}}'])
    if r < 0.1:
        return "{}"
    return json.dumps({"activities": [_activity(rng) for _ in range(rng.randint(0, 6))]})


def _num(v):
    """Spark reads the JSON value as text, then try_casts it."""
    if v is None or isinstance(v, bool):
        return None
    if isinstance(v, (int, float)):
        return float(v)
    try:
        return float(v)
    except ValueError:
        return None


def _int(v):
    if v is None or isinstance(v, bool):
        return None
    if isinstance(v, int):
        return v
    if isinstance(v, str) and v.lstrip("-").isdigit():
        return int(v)
    return None


def _text(v):
    if v is None:
        return None
    return v if isinstance(v, str) else json.dumps(v)


def _model(rows, user_rows, offset):
    by_key = {}
    for uid, key, name, mail in user_rows:
        if key is not None:
            by_key.setdefault(key, []).append((uid, key, name, mail))
    delta = dt.timedelta(minutes=offset)
    out = []
    for cid, start, agent, content in rows:
        try:
            obj = json.loads(content) if content is not None else None
        except ValueError:
            obj = None
        acts = obj.get("activities") if isinstance(obj, dict) else None
        if not isinstance(acts, list):
            continue
        for a in acts:
            if not isinstance(a, dict) or a.get("type") != "message":
                continue
            f = a.get("from") if isinstance(a.get("from"), dict) else {}
            ts = _num(a.get("timestamp"))
            part = None
            if ts is not None and not math.isnan(ts) and -62135596800 <= ts <= MAX_S:
                part = EPOCH + dt.timedelta(seconds=math.floor(ts)) + delta
            role = _int(f.get("role"))
            key = f.get("aadObjectId")
            base = [
                cid, start + delta, start.date(), agent, "bot-a", a.get("channelId"), _text(a.get("text")),
                ts, key, f.get("id"), role, part,
            ]
            for u in by_key.get(key, [(None, None, None, None)]):
                label = agent if role == 0 else (u[2] if role == 1 else None)
                icon = AGENT_ICON if role == 0 else (USER_ICON if role == 1 else "")
                out.append(tuple(base + list(u) + [label, icon]))
    return out


def _norm(rows):
    return sorted(tuple("<N>" if v is None else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_random_transcripts_match_model(spark, seed, strategy):
    rng = random.Random(seed)
    start0 = dt.datetime(2024, 1, 1, 1, 30)
    rows = [
        (f"c{i}", start0 + dt.timedelta(minutes=37 * i), rng.choice(["Agent A", "Agent B"]), _content(rng))
        for i in range(250)
    ]
    user_rows = [
        ("u-hot", "aad-hot", "Hot", "h@x"),
        ("u1", "aad-1", "One", "1@x"),
        ("u2", "aad-2", "Two", "2@x"),
        ("u-d1", "aad-dup", "Dup A", "da@x"),
        ("u-d2", "aad-dup", "Dup B", "db@x"),
        ("u-null", None, "No key", "n@x"),
    ]
    offset = rng.choice([-240, 0, 330])
    t = transcripts(spark, [(i, s, a, c) for i, s, a, c in rows])
    u = users(spark, user_rows)
    got = build_curated(t, u, LoadConfig(tz_offset_minutes=offset), force_strategy=strategy)
    assert got.columns == CURATED_COLUMNS
    expected = _model(rows, user_rows, offset)
    assert len(expected) > 300  # the generator must keep producing a rich mix
    assert _norm(got.collect()) == _norm(expected)
