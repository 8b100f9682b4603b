"""Scans of the raw transcript table, the user dimension and the curated table.

Each scan selects only the columns it needs and keeps predicates on raw
columns, so Catalyst prunes columns and pushes filters into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.config import LoadConfig, is_path
from chatlake.functions.time import to_utc_ntz_sql
from chatlake.schema import COMMIT_VERSION, CURATED_COLUMNS


def read_source(spark: SparkSession, ref: str) -> DataFrame:
    """A catalog table by name, or a parquet folder by path."""
    return spark.read.parquet(ref) if is_path(ref) else spark.table(ref)


def project_transcripts(raw: DataFrame, carry: list[str] = ()) -> DataFrame:
    """The six-column transcript projection: start time renamed, start date derived.

    The start time is normalised to TIMESTAMP_NTZ (UTC wall clock) so the rest
    of the pipeline is independent of the session time zone.
    """
    start = to_utc_ntz_sql("conversationstarttime", raw.schema["conversationstarttime"].dataType)
    return raw.selectExpr(
        "id",
        f"{start} AS conversation_starttime",
        f"to_date({start}) AS conversation_startdate",
        "bot_conversationtranscriptidname",
        "bot_conversationtranscriptId",
        "content",
        *[f"`{c}`" for c in carry],
    )


def read_transcripts(spark: SparkSession, cfg: LoadConfig | str, version: int | None = None) -> DataFrame:
    """The transcript table; of a Delta source its state as of ``version``."""
    ref = cfg if isinstance(cfg, str) else cfg.qualify(cfg.transcript_table)
    if version is not None and not isinstance(cfg, str) and cfg.change_log_format == "delta":
        reader = spark.read.format("delta").option("versionAsOf", version)
        return project_transcripts(reader.load(ref) if is_path(ref) else reader.table(ref))
    return project_transcripts(read_source(spark, ref))


def project_users(raw: DataFrame) -> DataFrame:
    """Users with a directory id (the join key); the NOT NULL filter reaches the scan."""
    return raw.where(F.col("azureactivedirectoryobjectid").isNotNull()).select(
        "id", "azureactivedirectoryobjectid", "fullname", "internalemailaddress"
    )


def read_users(spark: SparkSession, cfg: LoadConfig | str) -> DataFrame:
    ref = cfg if isinstance(cfg, str) else cfg.qualify(cfg.user_table)
    return project_users(read_source(spark, ref))


def read_curated(spark: SparkSession, table: str, keep_version: bool = False) -> DataFrame:
    """The curated table in contract order (the load version column dropped by default)."""
    df = read_source(spark, table)
    cols = CURATED_COLUMNS + ([COMMIT_VERSION] if keep_version else [])
    return df.select(*cols)
