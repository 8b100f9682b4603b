"""Activities to rows: explode the payload array, keep messages, extract fields."""

from __future__ import annotations

from pyspark.sql import DataFrame

from chatlake.functions.payload import PARSED, first_array_column
from chatlake.functions.time import epoch_to_ntz_sql, shift_sql
from chatlake.schema import ACTIVITY_SCHEMA, MESSAGE_TYPE, TRANSCRIPT_COLUMNS, sql_type

PART = "conversation_part_json"


def _q(name: str) -> str:
    return f"`{name}`"


def explode_parts(
    parsed: DataFrame, array_col: str | None = "activities", carry: list[str] = ()
) -> DataFrame:
    """One row per payload element, transcript metadata kept, element as a struct.

    ``array_col=None`` picks the first array field of the parsed payload. With
    no array field at all the result is empty but keeps its schema.

    ``explode_outer`` (not ``explode``) on purpose: with the inner form Catalyst
    infers a ``size(from_json(...)) > 0`` filter and the optimized plan would
    evaluate ``from_json`` more than once per row. Outer rows carry a NULL
    element and are dropped by the message filter that always follows.
    """
    keep = [_q(c) for c in (*TRANSCRIPT_COLUMNS, *carry)]
    payload_type = parsed.schema[PARSED].dataType
    name = array_col or first_array_column(payload_type)
    if name is None or name not in payload_type.fieldNames():
        empty = f"CAST(NULL AS {sql_type(ACTIVITY_SCHEMA)}) AS {PART}"
        return parsed.selectExpr(*keep, empty).where("false")
    return parsed.selectExpr(*keep, f"explode_outer({PARSED}.{_q(name)}) AS {PART}")


def messages_only(parts: DataFrame) -> DataFrame:
    """Elements whose type is "message"; NULL types and outer rows drop out."""
    return parts.where(f"{PART}.type = '{MESSAGE_TYPE}'")


def extract_fields(
    messages: DataFrame,
    tz_offset_minutes: int = 0,
    epoch_unit: str = "s",
    local_date: bool = False,
    carry: list[str] = (),
) -> DataFrame:
    """The twelve message columns of the curated table, before the user join.

    Numbers inside the payload are read with ``try_cast``: a non-numeric value
    becomes NULL rather than failing the load (ANSI casts raise). One
    ``selectExpr``: the whole projection is parsed JVM-side in one call.
    """
    part_ts = f"try_cast({PART}.timestamp AS DOUBLE)"
    start = shift_sql("conversation_starttime", tz_offset_minutes)
    date = f"to_date({start})" if local_date else "conversation_startdate"
    return messages.selectExpr(
        "id",
        f"{start} AS conversation_starttime",
        f"{date} AS conversation_startdate",
        "bot_conversationtranscriptidname",
        "bot_conversationtranscriptId",
        f"{PART}.channelId AS channelId",
        f"{PART}.text AS text",
        f"{part_ts} AS conversation_part_timestamp",
        f"{PART}.`from`.aadObjectId AS from_aadObjectId",
        f"{PART}.`from`.id AS from_id",
        f"try_cast({PART}.`from`.role AS BIGINT) AS from_role",
        f"{epoch_to_ntz_sql(part_ts, tz_offset_minutes, epoch_unit)} AS conversation_part_starttime",
        *[_q(c) for c in carry],
    )


def activity_counts(flat: DataFrame, array_col: str = "activities") -> DataFrame:
    """Number of payload elements per transcript, from the flattened payload
    (``flatten_payload``); a NULL payload gives NULL."""
    return flat.selectExpr("id", f"size({_q(array_col)}) AS activities")
