"""The one transform shared by every load: transcripts + users -> curated messages.

``build_curated`` takes and returns DataFrames only: no action on the message
path, no collect, no sort. The batch loads, the streaming twin and the report
queries all call it, so they produce the same rows. The only action is the
size check on the (static) user dimension that picks the join strategy.

Plan: scan -> from_json -> explode_outer -> filter(type = message) -> project,
all in one whole-stage-codegen stage, then the user join (broadcast when the
dimension is proven small, else a salted shuffle join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from chatlake.config import LoadConfig
from chatlake.functions.payload import LOST, REASON, parse_payload
from chatlake.operators.enrich import enrich_users
from chatlake.operators.parts import explode_parts, extract_fields, messages_only
from chatlake.schema import PAYLOAD_SCHEMA


def observe_payloads(parsed: DataFrame, observation: Observation) -> DataFrame:
    """Counts what could not be read, on the job that reads it."""
    return parsed.observe(
        observation,
        F.count_if(F.col("content").isNull()).alias("null_payloads"),
        F.count_if(F.col(REASON) != "mixed_array").alias("rejected_payloads"),
        F.count_if(F.col(REASON) == "mixed_array").alias("mixed_payloads"),
        F.coalesce(F.sum(LOST), F.lit(0).cast("long")).alias("lost_elements"),
    )


def messages_from_transcripts(
    transcripts: DataFrame,
    cfg: LoadConfig = LoadConfig(),
    carry: list[str] = (),
    payloads: Observation | None = None,
) -> DataFrame:
    """Parsed, exploded, filtered and extracted messages (12 columns, no user data).

    ``carry`` names extra transcript columns (e.g. the commit version) kept on
    every message. ``payloads`` observes how many payloads could not be read.
    """
    salvage = cfg.salvage_payloads and cfg.array_col in (None, *PAYLOAD_SCHEMA.fieldNames())
    parsed = parse_payload(transcripts, PAYLOAD_SCHEMA, salvage=salvage, reasons=payloads is not None)
    if payloads is not None:
        parsed = observe_payloads(parsed, payloads)
    parts = explode_parts(parsed, cfg.array_col, carry)
    return extract_fields(
        messages_only(parts),
        tz_offset_minutes=cfg.tz_offset_minutes,
        epoch_unit=cfg.epoch_unit,
        local_date=cfg.local_date,
        carry=carry,
    )


def build_curated(
    transcripts: DataFrame,
    users: DataFrame,
    cfg: LoadConfig = LoadConfig(),
    force_strategy: str | None = None,
    carry: list[str] = (),
    payloads: Observation | None = None,
    times: int = 1,
    like: DataFrame | None = None,
) -> DataFrame:
    """The 18-column curated message table for the given transcripts (+ ``carry``).

    ``times`` as for ``enrich_users``; ``like``: for a stream, transcripts in which to look for heavy senders.
    """
    messages = messages_from_transcripts(transcripts, cfg, carry, payloads)
    return enrich_users(
        messages,
        users,
        dedupe=cfg.dedupe_users,
        broadcast_max_rows=cfg.broadcast_max_rows,
        broadcast_max_bytes=cfg.broadcast_max_bytes,
        salt_buckets=cfg.salt_buckets,
        force_strategy=force_strategy,
        carry=carry,
        times=times,
        like=None if like is None else messages_from_transcripts(like, cfg),
    )
