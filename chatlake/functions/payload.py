"""JSON payload functions: parse with a declared schema, or infer one from samples.

Parsing is one `from_json` per transcript inside the scan stage; no Python runs
per row. Schema inference is kept as an exploration tool: it samples a bounded
number of payloads (a top-n, never the table) and lets Spark infer their schema.

One element that is no object makes ``from_json`` give up the whole array. Such a
payload is read again as a VARIANT, element by element, and its readable elements are
kept (``salvage``); what stays unreadable is listed with a reason
(``payload_rejects``). Both cost nothing on readable payloads: the second reading
stands behind a test of the first.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatlake.schema import ACTIVITY_SCHEMA, PAYLOAD_SCHEMA, TRANSCRIPT_COLUMNS, sql_type

PARSED = "content_json"


#: Columns that ``parse_payload(..., reasons=True)`` adds.
REASON, LOST = "reject_reason", "lost_elements"
#: Why a payload could not be read as it is. Of a mixed array the objects are kept.
REASONS = ("malformed", "not_object", "no_array", "not_array", "mixed_array")


def _is_object(variant: str) -> str:
    return f"schema_of_variant({variant}) LIKE 'OBJECT%'"


def _variant_sql(variant: str, dt: T.DataType, path: str = "$") -> str:
    """A declared type read from a variant; NULL where a field is absent or of another kind."""
    if isinstance(dt, T.StructType):
        fields = [f"'{f.name}', {_variant_sql(variant, f.dataType, f'{path}.{f.name}')}" for f in dt.fields]
        return f"named_struct({', '.join(fields)})"
    return f"try_variant_get({variant}, '{path}', '{sql_type(dt)}')"


def _elements_sql(content: str, array_col: str) -> str:
    return f"try_variant_get(try_parse_json({content}), '$.{array_col}', 'array<variant>')"


def salvage_sql(content: str, array_col: str = "activities") -> str:
    """The objects of a payload's array as activities; NULL where there is no array."""
    objects = f"filter({_elements_sql(content, array_col)}, e -> {_is_object('e')})"
    return f"transform({objects}, e -> {_variant_sql('e', ACTIVITY_SCHEMA)})"


def reason_sql(content: str, read: str, array_col: str = "activities") -> str:
    """Why ``read``, the array that ``from_json`` gave, is NULL; NULL for readable and for NULL payloads."""
    v = f"try_parse_json({content})"
    array = f"try_variant_get({v}, '$.{array_col}', 'variant')"
    return f"""CASE WHEN {content} IS NULL OR {read} IS NOT NULL THEN NULL
        WHEN {v} IS NULL THEN 'malformed'
        WHEN NOT {_is_object(v)} THEN 'not_object'
        WHEN {array} IS NULL OR is_variant_null({array}) THEN 'no_array'
        WHEN {_elements_sql(content, array_col)} IS NULL THEN 'not_array'
        ELSE 'mixed_array' END"""


def parse_payload(
    transcripts: DataFrame,
    schema: T.StructType | str = PAYLOAD_SCHEMA,
    content_col: str = "content",
    salvage: bool = False,
    reasons: bool = False,
) -> DataFrame:
    """Add ``content_json``: the payload parsed with ``schema``.

    PERMISSIVE: NULL, malformed or non-object payloads give NULL fields, never an error.
    ``salvage`` keeps the objects of an array that holds other elements too; ``reasons`` adds why a payload could
    not be read as it is, and how many elements of its array were left out. Both are for the declared schema.
    """
    parsed = transcripts.withColumn(
        PARSED, F.from_json(F.col(content_col), schema, {"mode": "PERMISSIVE"})
    )
    if not (salvage or reasons):
        return parsed
    array = PAYLOAD_SCHEMA.fieldNames()[0]
    kept = salvage_sql(f"`{content_col}`", array)
    keep = [f"`{c}`" for c in transcripts.columns]
    read = f"{PARSED}.`{array}`"
    payload = f"named_struct('{array}', coalesce({read}, {kept})) AS {PARSED}" if salvage else PARSED
    if not reasons:
        return parsed.selectExpr(*keep, payload)
    reason = reason_sql(f"`{content_col}`", read, array)
    return parsed.selectExpr(*keep, payload, f"{reason} AS {REASON}").withColumn(
        LOST,
        F.expr(
            f"CASE WHEN {REASON} = 'mixed_array' THEN size({_elements_sql(content_col, array)}) - size({kept}) END"
        ).cast("long"),
    )


def payload_rejects(transcripts: DataFrame, content_col: str = "content", carry: list[str] = ()) -> DataFrame:
    """Transcripts whose payload could not be read as it is: (id, reason, lost_elements, content)."""
    found = parse_payload(transcripts, content_col=content_col, reasons=True).where(f"{REASON} IS NOT NULL")
    return found.select("id", F.col(REASON).alias("reason"), LOST, F.col(content_col).alias("content"), *carry)


def flatten_payload(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Top-level payload fields as columns, beside the transcript metadata."""
    keep = TRANSCRIPT_COLUMNS if keep is None else keep
    return parsed.select(*keep, f"{PARSED}.*")


def first_array_column(schema: T.StructType) -> str | None:
    """Name of the first array-typed field, or None when there is none."""
    for f in schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            return f.name
    return None


def sample_payload(
    transcripts: DataFrame,
    n: int = 1,
    order_col: str = "conversation_starttime",
    content_col: str = "content",
) -> list[str]:
    """The ``n`` newest non-null payloads (a distributed top-n; only n rows reach the driver)."""
    rows = (
        transcripts.where(F.col(content_col).isNotNull())
        .orderBy(F.col(order_col).desc())
        .select(content_col)
        .limit(n)
        .collect()
    )
    return [r[0] for r in rows]


def infer_payload_schema(spark: SparkSession, samples: list[str]) -> T.StructType | None:
    """Schema Spark infers from the sampled payloads; None when there are none.

    Fields absent from every sample are absent from the result, which is why the
    loads use the declared ``PAYLOAD_SCHEMA`` instead.
    """
    if not samples:
        return None
    if len(samples) == 1:
        ddl = spark.range(1).select(F.schema_of_json(F.lit(samples[0]))).first()[0]
        # Resolve the DDL string into a StructType through the analyzer.
        probe = spark.range(0).select(F.from_json(F.lit(None).cast("string"), ddl).alias("p"))
        return probe.schema["p"].dataType
    rdd = spark.sparkContext.parallelize(samples, 1)
    return spark.read.json(rdd).schema


def merged_payload_schema(transcripts: DataFrame, content_col: str = "content") -> T.StructType | None:
    """The schema of all payloads together; None when none is a JSON object.

    One pass: each task merges the schemas of its payloads, and only the merged ones are shuffled, so cost and
    size go with the number of fields, not of payloads. Numbers of different kinds meet in the wider one, a field whose
    values have no common type becomes a string, and so does one that is always null. Payloads that are no object are left out.
    """
    payload = F.try_parse_json(content_col)
    objects = F.when(F.schema_of_variant(payload).startswith("OBJECT"), payload)
    merged = transcripts.agg(F.schema_of_variant_agg(objects).alias("s")).first()["s"]
    if not merged.startswith("OBJECT<") or merged == "OBJECT<>":
        return None
    ddl = re.sub(r"`(?:[^`]|``)*`|\bOBJECT<>|\bOBJECT<|\b(?:VOID|VARIANT)\b(?!:)", _as_ddl, merged)
    return T.StructType.fromDDL(f"p {ddl}").fields[0].dataType


def _as_ddl(found: re.Match) -> str:
    names = {"OBJECT<>": "STRING", "OBJECT<": "STRUCT<", "VOID": "STRING", "VARIANT": "STRING"}
    return names.get(found[0], found[0])
