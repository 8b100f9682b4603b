"""Only heavy senders are salted, and only their users replicated."""

from __future__ import annotations

from chatlake.operators.enrich import enrich_users, heavy_senders
from tests.test_enrich import _skewed_messages, _sorted, _users


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_heavy_senders_are_found_with_their_share(spark):
    m = _skewed_messages(spark)
    salts = heavy_senders(m, 1024)
    assert "aad-hot" in salts and None not in salts
    assert salts["aad-hot"] == max(salts.values()) > 2
    assert heavy_senders(m.where("false"), 1024) == {}


def test_no_replication_without_a_heavy_sender(spark):
    m, u = _skewed_messages(spark), _users(spark)
    salted = enrich_users(m, u, force_strategy="shuffle")
    assert "_usalt" in _plan(salted)
    # each sender once in 3000 messages: no one is heavy
    even = spark.range(3000).selectExpr(
        "concat('c', id) AS id", "TIMESTAMP_NTZ'2024-01-01' AS conversation_starttime",
        "DATE'2024-01-01' AS conversation_startdate", "'A' AS bot_conversationtranscriptidname",
        "'b' AS bot_conversationtranscriptId", "'web' AS channelId", "'t' AS text", "1D AS conversation_part_timestamp",
        "concat('aad-', id) AS from_aadObjectId", "'f' AS from_id", "1L AS from_role",
        "TIMESTAMP_NTZ'2024-01-01' AS conversation_part_starttime",
    )
    plain = enrich_users(even, u, force_strategy="shuffle")
    assert "_usalt" not in _plan(plain) and "Generate" not in _plan(plain)
    assert _sorted(plain) == _sorted(enrich_users(even, u, force_strategy="broadcast"))


def test_odd_names_of_heavy_senders(spark):
    m, u = _skewed_messages(spark), _users(spark)
    name = "o'b\\rien \"x\" ü"
    swap = {"aad-hot": name}
    m = m.replace(swap, subset=["from_aadObjectId"])
    u = u.replace(swap, subset=["azureactivedirectoryobjectid"])
    s = enrich_users(m, u, force_strategy="shuffle")
    assert "_usalt" in _plan(s)
    assert _sorted(s) == _sorted(enrich_users(m, u, force_strategy="broadcast"))
    assert s.where("userid = 'u-hot'").count() == 120
