"""Declared schemas and the column contract of the curated message table.

The payload schema is declared instead of being inferred from one sampled row,
so every load parses the same fields in the same types, whatever the batch holds.
Only the fields the curated table reads are declared: the JSON parser skips the
rest, which keeps ``from_json`` cheap on large transcripts.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Names shared with existing tables and the source system.
BASELINE_PROPERTY = "cdf.baseline_version"
COMMIT_VERSION = "_commit_version"
CHANGE_TYPE = "_change_type"
INSERT = "insert"
MESSAGE_TYPE = "message"
AGENT_ICON = "🤖"
USER_ICON = "👤"
ROLE_AGENT = 0
ROLE_USER = 1

# `timestamp` and `from.role` are strings on purpose: a numeric JSON value and a
# quoted one both survive as text, and `try_cast` turns either into a number.
# Declared as numbers, a quoted value would silently become NULL.
SENDER_SCHEMA = T.StructType(
    [
        T.StructField("aadObjectId", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("role", T.StringType()),
    ]
)

ACTIVITY_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("channelId", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("from", SENDER_SCHEMA),
    ]
)

def sql_type(dt: T.DataType) -> str:
    """SQL text of a data type, with every field name quoted."""
    if isinstance(dt, T.StructType):
        return "STRUCT<" + ", ".join(f"`{f.name}`: {sql_type(f.dataType)}" for f in dt.fields) + ">"
    if isinstance(dt, T.ArrayType):
        return f"ARRAY<{sql_type(dt.elementType)}>"
    if isinstance(dt, T.MapType):
        return f"MAP<{sql_type(dt.keyType)}, {sql_type(dt.valueType)}>"
    return dt.simpleString().upper()


PAYLOAD_SCHEMA = T.StructType(
    [T.StructField("activities", T.ArrayType(ACTIVITY_SCHEMA))]
)

TRANSCRIPT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("conversationstarttime", T.TimestampNTZType()),
        T.StructField("bot_conversationtranscriptidname", T.StringType()),
        T.StructField("bot_conversationtranscriptId", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)

USER_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("azureactivedirectoryobjectid", T.StringType()),
        T.StructField("fullname", T.StringType()),
        T.StructField("internalemailaddress", T.StringType()),
    ]
)

CHANGE_LOG_SCHEMA = T.StructType(
    TRANSCRIPT_SCHEMA.fields
    + [
        T.StructField(CHANGE_TYPE, T.StringType()),
        T.StructField(COMMIT_VERSION, T.LongType()),
    ]
)

# Transcript metadata carried onto every message, after the scan renames.
TRANSCRIPT_COLUMNS = [
    "id",
    "conversation_starttime",
    "conversation_startdate",
    "bot_conversationtranscriptidname",
    "bot_conversationtranscriptId",
]

# The curated table: column order is the contract.
CURATED_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("conversation_starttime", T.TimestampNTZType()),
        T.StructField("conversation_startdate", T.DateType()),
        T.StructField("bot_conversationtranscriptidname", T.StringType()),
        T.StructField("bot_conversationtranscriptId", T.StringType()),
        T.StructField("channelId", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("conversation_part_timestamp", T.DoubleType()),
        T.StructField("from_aadObjectId", T.StringType()),
        T.StructField("from_id", T.StringType()),
        T.StructField("from_role", T.LongType()),
        T.StructField("conversation_part_starttime", T.TimestampNTZType()),
        T.StructField("userid", T.StringType()),
        T.StructField("userentraid", T.StringType()),
        T.StructField("userfullname", T.StringType()),
        T.StructField("useremailaddress", T.StringType()),
        T.StructField("from", T.StringType()),
        T.StructField("from_icon", T.StringType()),
    ]
)
CURATED_COLUMNS = [f.name for f in CURATED_SCHEMA.fields]

# Display names of the semantic view, in the model's column order.
# The two hidden columns map to None. "Agent" and "Agent Id" stand for labels that name
# the source project; pass your own mapping to `semantic_view` to change them.
DISPLAY_NAMES = {
    "id": "Conversation Id",
    "conversation_starttime": "Conversation Start DateTime",
    "bot_conversationtranscriptidname": "Agent",
    "bot_conversationtranscriptId": "Agent Id",
    "channelId": "Channel",
    "text": "Conversation Text",
    "conversation_part_timestamp": None,
    "from_aadObjectId": "From Entra Object Id",
    "from_id": "From Id",
    "from_role": "From Role",
    "conversation_part_starttime": "Conversation Part Start DateTime",
    "userid": None,
    "userentraid": "User Entra Id",
    "userfullname": "User Full Name",
    "useremailaddress": "User Email Address",
    "from": "From",
    "conversation_startdate": "Conversation Start Date",
    "from_icon": "From Icon",
}
