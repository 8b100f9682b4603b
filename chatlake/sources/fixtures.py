"""Raw inputs derived from the driver's tables (see FIXTURES.md).

``conversations(conv_id, turn, role, text)`` becomes the raw transcript table
(one JSON document per conversation, as the source system stores it),
``customer`` becomes the user dimension, and the transcripts become a change
log with inserts over versions 0-9, an update at 10 and deletes at 11.
Everything is a deterministic Spark derivation: no randomness, no driver data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.schema import CHANGE_TYPE, COMMIT_VERSION

# Fixed values of the fixture derivation (FIXTURES.md).
CHANNELS = ["msteams", "directline", "webchat"]
EPOCH_2024 = 1704067200  # 2024-01-01 00:00:00 UTC
SECONDS_PER_CONVERSATION = 5820
SECONDS_PER_TURN = 30
MINUTES_PER_CONVERSATION = 97
AGENTS = 5
DIRECTORY_USERS = 40
INSERT_VERSIONS = 10
UPDATE_VERSION, UPDATE_EVERY = 10, 11
DELETE_VERSION, DELETE_EVERY = 11, 17
EDITED_CONTENT = '{"activities":[{"type":"message","text":"EDITED"}]}'


def _str(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), n.cast("string"))


def activity(conv: Column, turn: Column, role: Column, text: Column) -> Column:
    """One transcript activity built from a conversation turn."""
    is_user = role == "user"
    is_agent = role == "assistant"
    sender = F.struct(
        F.when(is_user & (conv % 4 != 0), _str("aad-", conv % DIRECTORY_USERS)).alias("aadObjectId"),
        F.when(is_agent, _str("bot-", conv % AGENTS)).otherwise(_str("anon-", conv)).alias("id"),
        F.when(is_agent, F.lit(0)).otherwise(F.lit(1)).alias("role"),
    )
    return F.struct(
        turn.alias("turn"),
        F.when(role == "system", F.lit("event")).otherwise(F.lit("message")).alias("type"),
        F.element_at(F.array(*[F.lit(c) for c in CHANNELS]), (conv % 3).cast("int") + 1).alias("channelId"),
        text.alias("text"),
        (F.lit(EPOCH_2024) + conv * SECONDS_PER_CONVERSATION + turn * SECONDS_PER_TURN).alias("timestamp"),
        sender.alias("from"),
    )


def transcripts_from_turns(conversations: DataFrame) -> DataFrame:
    """Raw transcripts: one row per conversation with its turns as a JSON document.

    The grouping is per conversation (a transcript is one document in the
    source system); the aggregation runs partial per task, then per key.
    """
    conv = F.col("conv_id")
    acts = conversations.select(
        conv, activity(conv, F.col("turn"), F.col("role"), F.col("text")).alias("act")
    )
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), (conv * MINUTES_PER_CONVERSATION).cast("int")
    )
    grouped = acts.groupBy("conv_id").agg(F.sort_array(F.collect_list("act")).alias("activities"))
    return grouped.select(
        _str("conv-", conv).alias("id"),
        start.alias("conversationstarttime"),
        _str("Agent ", conv % AGENTS).alias("bot_conversationtranscriptidname"),
        _str("bot-", conv % AGENTS).alias("bot_conversationtranscriptId"),
        F.to_json(F.struct("activities")).alias("content"),
    )


def users_from_customers(customer: DataFrame) -> DataFrame:
    """User dimension: one user in ten has no directory id."""
    key = F.col("c_custkey")
    return customer.select(
        _str("user-", key).alias("id"),
        F.when(key % 10 != 9, _str("aad-", key)).alias("azureactivedirectoryobjectid"),
        F.col("c_name").alias("fullname"),
        F.concat(F.lit("u"), key.cast("string"), F.lit("@example.com")).alias("internalemailaddress"),
    )


def change_log_from_transcripts(transcripts: DataFrame) -> DataFrame:
    """Inserts over versions 0-9, update pre/post images at 10, deletes at 11."""
    n = F.substring(F.col("id"), 6, 1 << 20).cast("bigint")
    t = transcripts.withColumn("_n", n)
    meta = ["id", "conversationstarttime", "bot_conversationtranscriptidname", "bot_conversationtranscriptId"]

    def part(df: DataFrame, content: Column, kind: str, version: Column) -> DataFrame:
        return df.select(
            *meta,
            content.alias("content"),
            F.lit(kind).alias(CHANGE_TYPE),
            version.cast("bigint").alias(COMMIT_VERSION),
        )

    updated = t.where(F.col("_n") % UPDATE_EVERY == 0)
    deleted = t.where(F.col("_n") % DELETE_EVERY == 0)
    return (
        part(t, F.col("content"), "insert", F.col("_n") % INSERT_VERSIONS)
        .unionByName(part(updated, F.col("content"), "update_preimage", F.lit(UPDATE_VERSION)))
        .unionByName(part(updated, F.lit(EDITED_CONTENT), "update_postimage", F.lit(UPDATE_VERSION)))
        .unionByName(part(deleted, F.col("content"), "delete", F.lit(DELETE_VERSION)))
    )


def damaged_transcripts(transcripts: DataFrame) -> DataFrame:
    """Raw transcripts as a faulty writer might leave them: by conversation number modulo 9, payloads cut short (0), with
    stray elements among the activities (1), no content (2), an array at the top (3), no activities (4) or an
    object in their place (5)."""
    kind = F.substring(F.col("id"), 6, 1 << 20).cast("bigint") % 9
    content = F.col("content")
    damaged = (
        F.when(kind == 0, F.expr("substring(content, 1, length(content) - 4)"))
        .when(kind == 1, F.replace(content, F.lit('{"activities":['), F.lit('{"activities":[5,"x",null,')))
        .when(kind == 2, F.lit(None).cast("string"))
        .when(kind == 3, F.lit("[]"))
        .when(kind == 4, F.lit('{"other":1}'))
        .when(kind == 5, F.lit('{"activities":{"type":"message"}}'))
        .otherwise(content)
    )
    return transcripts.withColumn("content", damaged)


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts_from_turns(driver_table(spark, sf_dir, "conversations"))


def fixture_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_from_customers(driver_table(spark, sf_dir, "customer"))


def save_change_log(log: DataFrame, path: str) -> str:
    """Write a change log as a version-partitioned parquet folder.

    The REBALANCE hint lets AQE group rows by version into advisory-sized
    files: a few files per small commit, and a large commit (even one holding
    a third of all rows) split over many tasks rather than one.
    """
    log.hint("rebalance", COMMIT_VERSION).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy(COMMIT_VERSION).parquet(path)
    return path


def write_change_log(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Materialise the fixture change log as a version-partitioned parquet folder."""
    return save_change_log(change_log_from_transcripts(fixture_transcripts(spark, sf_dir)), path)
