"""Left join of messages to the user dimension, and the sender columns.

Join strategy:

* **Broadcast** when one aggregation over the user dimension proves it small
  (row count and string bytes under the configured bounds). Messages are never
  shuffled then, so neither hot senders nor anonymous (NULL-key) messages skew.
  A stream sends the user side anew with each micro-batch; the bounds hold for all micro-batches of a run together.
* **Shuffle** otherwise, with two guards against skew:
  - messages without a directory id get a spread surrogate key that can match
    nothing (an extra ``IS NOT NULL`` condition keeps the join exact), so they do
    not all hash to one reducer;
  - senders that hold a 1 / ``HEAVY_SHARE`` part of all messages or more are found by a
    mergeable sketch of frequent keys (one aggregation over the key column), and only
    they are salted, each over as many reducers as its share asks for; only their
    users are replicated. Without such a sender nothing is replicated. The sketch decides where
    rows go, never which rows match. AQE's skew-join split stays on as well.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from chatlake.functions.sender import sender_icon_sql, sender_label_sql
from chatlake.schema import CURATED_COLUMNS

USER_COLUMNS = ["userid", "userentraid", "userfullname", "useremailaddress"]
# Prefix of the spread key given to messages without a directory id. It only
# spreads them over reducers: the join condition's IS NOT NULL keeps them from
# ever matching, whatever the key text.
SURROGATE_PREFIX = "~nokey~"


# A sender is heavy from this part of all messages on; there can be no more such senders than this number.
HEAVY_SHARE = 1000
# Keys that the sketch tracks per task and in all; it misses no key above 1 / (0.75 * TRACKED) of the rows.
TRACKED = 1 << 15


@dataclass(frozen=True)
class UserSide:
    rows: int
    string_bytes: int

    def fits(self, max_rows: int, max_bytes: int, times: int = 1) -> bool:
        return self.rows * times <= max_rows and self.string_bytes * times <= max_bytes


def rename_users(users: DataFrame) -> DataFrame:
    return users.selectExpr(
        "id AS userid",
        "azureactivedirectoryobjectid AS userentraid",
        "fullname AS userfullname",
        "internalemailaddress AS useremailaddress",
    )


def dedupe_users(renamed: DataFrame) -> DataFrame:
    """One user per directory id: the one with the lowest ``userid`` (aggregated
    partially per task, then per key)."""
    best = F.expr("min(struct(userid, userfullname, useremailaddress))").alias("u")
    return renamed.groupBy("userentraid").agg(best).selectExpr(
        "u.userid", "userentraid", "u.userfullname", "u.useremailaddress"
    )


def measure_users(renamed: DataFrame) -> UserSide:
    """Exact rows and string bytes of the user side, one number each.

    The two sums are observed on a single-stage pass over the user side (the
    ``noop`` sink executes the scan and discards rows): each task adds its
    partial sums, the driver gets the totals. That is the same exact figure a
    global aggregation gives, without its second stage and shuffle.
    """
    size = " + ".join(f"coalesce(octet_length({c}), 0)" for c in USER_COLUMNS)
    obs = Observation("user_side")
    observed = renamed.observe(
        obs, F.count(F.lit(1)).alias("rows"), F.expr(f"coalesce(sum({size}), 0)").alias("bytes")
    )
    observed.write.format("noop").mode("overwrite").save()
    got = obs.get
    return UserSide(int(got["rows"]), int(got["bytes"]))


def heavy_senders(messages: DataFrame, salt_buckets: int) -> dict[str, int]:
    """Over how many reducers each heavy sender is dealt (at most ``HEAVY_SHARE`` senders reach the driver)."""
    row = messages.selectExpr(
        "count(1) AS n",
        f"approx_top_k(from_aadObjectId, {HEAVY_SHARE}, {TRACKED}) AS keys",
    ).first()
    reducers = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = {k["item"]: k["count"] / row.n for k in row["keys"] or () if k["item"] is not None}
    return {
        key: min(salt_buckets, max(2, math.ceil(4 * share * reducers)))
        for key, share in found.items()
        if share * HEAVY_SHARE >= 1
    }


def _salts(key: str, salts: dict[str, int]) -> str:
    """Number of salts of a key as SQL; 1 for all but the heavy ones."""
    by_count: dict[int, list[str]] = {}
    for name, n in salts.items():
        by_count.setdefault(n, []).append("'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'")
    whens = " ".join(f"WHEN {key} IN ({', '.join(names)}) THEN {n}" for n, names in by_count.items())
    return f"(CASE {whens} ELSE 1 END)"


def join_users(
    messages: DataFrame,
    renamed_users: DataFrame,
    broadcast_users: bool,
    salt_buckets: int = 1024,
    like: DataFrame | None = None,
) -> DataFrame:
    """Left outer join on the directory id; both keys kept, unmatched rows kept.

    ``like``: for a stream, messages in which to look for heavy senders.
    """
    if broadcast_users:
        return messages.join(F.broadcast(renamed_users), F.expr("from_aadObjectId = userentraid"), "left")

    # Shuffle path: spread NULL keys, salt heavy keys.
    spread = f"concat('{SURROGATE_PREFIX}', coalesce(id, ''), coalesce(from_id, ''))"
    m = messages.selectExpr("*", f"coalesce(from_aadObjectId, {spread}) AS _jk")
    cond = "_jk = userentraid AND from_aadObjectId IS NOT NULL"
    u = renamed_users
    if messages.isStreaming and like is None:  # nothing to measure beforehand: all keys over a few reducers
        every = min(salt_buckets, 8)
        salts = {} if every < 2 else None
    else:
        salts = heavy_senders(messages if like is None else like, salt_buckets) if salt_buckets > 1 else {}
    if salts is None or salts:
        of_message = str(every) if salts is None else _salts("from_aadObjectId", salts)
        of_user = str(every) if salts is None else _salts("userentraid", salts)
        salt = f"CAST(pmod(xxhash64(id, conversation_part_timestamp, from_id), {of_message}) AS INT)"
        m = m.selectExpr("*", f"{salt} AS _msalt")
        u = u.selectExpr("*", f"explode(sequence(0, {of_user} - 1)) AS _usalt")
        cond += " AND _msalt = _usalt"
    # The size check ruled a broadcast out: say so to the planner, whose own
    # estimate (file sizes, not a proven bound) might otherwise broadcast anyway.
    # Sort-merge spills, so a large user partition never has to fit in memory.
    return m.join(u.hint("merge"), F.expr(cond), "left").drop("_jk", "_msalt", "_usalt")


def with_sender(joined: DataFrame, carry: list[str] = ()) -> DataFrame:
    """Add ``from`` and ``from_icon`` and put the columns in contract order."""
    derived = {"from": f"{sender_label_sql()} AS `from`", "from_icon": f"{sender_icon_sql()} AS from_icon"}
    return joined.selectExpr(*[derived.get(c, f"`{c}`") for c in CURATED_COLUMNS], *[f"`{c}`" for c in carry])


def enrich_users(
    messages: DataFrame,
    users: DataFrame,
    *,
    dedupe: bool = False,
    broadcast_max_rows: int = 2_000_000,
    broadcast_max_bytes: int = 128 * 1024 * 1024,
    salt_buckets: int = 1024,
    force_strategy: str | None = None,
    carry: list[str] = (),
    times: int = 1,
    like: DataFrame | None = None,
) -> DataFrame:
    """Messages with user details and sender label/icon (curated column order).

    ``times``: how often the join runs (micro-batches of a stream); ``like`` as for ``join_users``. ``force_strategy`` ("broadcast" / "shuffle") skips the size check; used by tests.
    """
    renamed = rename_users(users)
    if dedupe:
        renamed = dedupe_users(renamed)
    if force_strategy is None:
        side = measure_users(renamed)
        use_broadcast = side.fits(broadcast_max_rows, broadcast_max_bytes, times)
    else:
        use_broadcast = force_strategy == "broadcast"
    joined = join_users(messages, renamed, use_broadcast, salt_buckets, like)
    return with_sender(joined, carry)
