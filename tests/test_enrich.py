"""User join: semantics, strategies, skew handling and plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatlake.config import LoadConfig
from chatlake.operators.enrich import SURROGATE_PREFIX, enrich_users, measure_users, rename_users
from chatlake.plans.curated import messages_from_transcripts
from chatlake.schema import CURATED_COLUMNS
from tests.helpers import msg, payload, transcripts, users

CFG0 = LoadConfig(tz_offset_minutes=0)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _skewed_messages(spark, n_conv=60):
    """A third of all messages from one sender, a third anonymous, the rest spread."""
    rows = []
    for i in range(n_conv):
        acts = [
            msg(text=f"hot{i}", aad="aad-hot", ts=1700000000 + i),
            msg(text=f"anon{i}", aad=None, ts=1700000001 + i),
            msg(text=f"agent{i}", aad=None, role=0, ts=1700000002 + i, sender_id="bot"),
            msg(text=f"cold{i}", aad=f"aad-{i % 7}", ts=1700000003 + i),
            msg(text=f"miss{i}", aad="aad-unknown", ts=1700000004 + i),
            msg(text=f"hot2{i}", aad="aad-hot", ts=1700000005 + i),
        ]
        rows.append((f"c{i}", None, f"Agent {i % 3}", payload(*acts)))
    return messages_from_transcripts(transcripts(spark, rows), CFG0)


def _users(spark):
    rows = [("u-hot", "aad-hot", "Hot User", "hot@x")]
    rows += [(f"u{i}", f"aad-{i}", f"User {i}", f"u{i}@x") for i in range(7)]
    rows += [("u-none", None, "No Directory", "n@x")]
    return users(spark, rows)


def _sorted(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_strategies_agree_under_skew(spark):
    m, u = _skewed_messages(spark), _users(spark)
    b = enrich_users(m, u, force_strategy="broadcast")
    s = enrich_users(m, u, force_strategy="shuffle", salt_buckets=8)
    s1 = enrich_users(m, u, force_strategy="shuffle", salt_buckets=1)
    assert b.columns == CURATED_COLUMNS
    rb = _sorted(b)
    assert len(rb) == m.count()  # unique user keys: the left join keeps every message once
    assert rb == _sorted(s) == _sorted(s1)


def test_left_join_semantics(spark):
    c = enrich_users(_skewed_messages(spark), _users(spark), force_strategy="shuffle")
    by_text = {r.text: r for r in c.collect()}
    assert by_text["hot0"].userfullname == "Hot User" and by_text["hot0"]["from"] == "Hot User"
    assert by_text["anon0"].userid is None and by_text["anon0"]["from"] is None
    assert by_text["anon0"].from_icon == "👤"
    assert by_text["agent0"]["from"] == "Agent 0" and by_text["agent0"].from_icon == "🤖"
    assert by_text["miss0"].userentraid is None and by_text["miss0"].from_aadObjectId == "aad-unknown"


def test_duplicate_directory_ids_double_by_default_and_dedupe_keeps_lowest(spark):
    t = transcripts(spark, [("c1", None, None, payload(msg(aad="aad-d")))])
    m = messages_from_transcripts(t, CFG0)
    u = users(spark, [("u2", "aad-d", "Second", "2@x"), ("u1", "aad-d", "First", "1@x")])
    assert enrich_users(m, u).count() == 2
    one = enrich_users(m, u, dedupe=True).collect()
    assert len(one) == 1 and one[0].userid == "u1" and one[0]["from"] == "First"
    for strategy in ("broadcast", "shuffle"):
        assert enrich_users(m, u, force_strategy=strategy).count() == 2


def test_size_check_picks_the_strategy(spark):
    m, u = _skewed_messages(spark, 5), _users(spark)
    side = measure_users(rename_users(u))
    assert side.rows == 8 and side.string_bytes > 0
    small = enrich_users(m, u)
    assert "BroadcastHashJoin" in _plan(small) or "BroadcastHashJoin" in small._jdf.queryExecution().toString()
    big = enrich_users(m, u, broadcast_max_rows=3)
    plan = big._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan
    assert _sorted(small) == _sorted(big)


def test_shuffle_plan_spreads_null_keys(spark):
    m, u = _skewed_messages(spark), _users(spark)
    s = enrich_users(m, u, force_strategy="shuffle", salt_buckets=8)
    plan = s._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    # The join key is the coalesced surrogate, so no partition gets every NULL key.
    keyed = m.withColumn(
        "_jk", F.coalesce("from_aadObjectId", F.concat(F.lit(SURROGATE_PREFIX), "id", "from_id"))
    )
    parts = keyed.repartition(8, "_jk").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in parts) < m.count() * 0.6


def test_salting_spreads_a_hot_sender(spark):
    """With AQE's own skew split and broadcast conversion off, the salt alone must
    keep the hot sender (a third of all messages) from filling one partition."""
    m, u = _skewed_messages(spark, 120), _users(spark)
    n = m.count()
    keys = {
        "spark.sql.adaptive.skewJoin.enabled": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)

        def largest(salt):
            j = enrich_users(m, u, force_strategy="shuffle", salt_buckets=salt)
            rows = j.groupBy(F.spark_partition_id().alias("p")).count().collect()
            return max(r["count"] for r in rows)

        assert largest(1) >= n / 3
        assert largest(8) < n / 3
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
