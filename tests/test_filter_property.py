"""ReportFilter against a plain-Python model, over random filter states."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chatlake.operators.report import ReportFilter
from chatlake.schema import CURATED_SCHEMA

AGENTS = ["A", "B", "C", None]
CHANNELS = ["msteams", "webchat", None]
DATES = [dt.date(2024, 1, d) for d in (1, 2, 3, 4)] + [None]


def _rows():
    out = []
    i = 0
    for a in AGENTS:
        for c in CHANNELS:
            for d in DATES:
                start = dt.datetime.combine(d, dt.time(10, i % 60)) if d else None
                row = {f.name: None for f in CURATED_SCHEMA.fields}
                row.update(
                    id=f"m{i}", bot_conversationtranscriptidname=a, channelId=c,
                    conversation_startdate=d, conversation_starttime=start, text="t",
                )
                out.append(row)
                i += 1
    return out


ROWS = _rows()


@pytest.fixture(scope="module")
def curated(spark):
    data = [tuple(r[f.name] for f in CURATED_SCHEMA.fields) for r in ROWS]
    return spark.createDataFrame(data, CURATED_SCHEMA).cache()


def _model(f: ReportFilter) -> list[str]:
    keep = []
    for r in ROWS:
        a, c, d = r["bot_conversationtranscriptidname"], r["channelId"], r["conversation_startdate"]
        if f.agents is not None and a not in f.agents:
            continue
        if f.date_start is not None and (d is None or d < f.date_start):
            continue
        if f.date_end is not None and (d is None or d > f.date_end):
            continue
        if f.exclude_agents and a is not None and a in f.exclude_agents:
            continue
        if f.exclude_channels and c is not None and c in f.exclude_channels:
            continue
        ok = True
        for name, value in f.selection:
            col = {"agent": "bot_conversationtranscriptidname", "channel": "channelId"}.get(name, name)
            v = r[col]
            ok &= (v is None) if value is None else (v is not None and v == value)
        if ok:
            keep.append(r["id"])
    return sorted(keep)


names = st.sampled_from(["A", "B", "C"])
filters = st.builds(
    ReportFilter,
    agents=st.one_of(st.none(), st.lists(names, max_size=2).map(tuple)),
    date_start=st.one_of(st.none(), st.sampled_from(DATES[:-1])),
    date_end=st.one_of(st.none(), st.sampled_from(DATES[:-1])),
    exclude_agents=st.lists(names, max_size=2).map(tuple),
    exclude_channels=st.lists(st.sampled_from(["msteams", "webchat"]), max_size=1).map(tuple),
    selection=st.lists(
        st.tuples(st.sampled_from(["channel", "agent"]), st.sampled_from(["webchat", "A", None])), max_size=1
    ).map(tuple),
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(f=filters)
def test_report_filter_matches_model(curated, f):
    got = sorted(r["id"] for r in f.apply(curated).select("id").collect())
    assert got == _model(f)
