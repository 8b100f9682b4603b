"""Writers of the curated table and its baseline version.

The curated table is a catalog table of parquet files partitioned by
``_commit_version``: the initial load stamps every row with the baseline
version, each increment with its own commit version. An increment replaces
exactly the version partitions it writes (dynamic partition overwrite), so a
rerun after a crash between the write and the baseline update replaces the
crashed rows instead of duplicating them. Spark's file commit protocol makes
each write job all-or-nothing, and task retries after a lost executor write to
fresh attempt files, so lost executors never leave partial output.

A full write never touches what readers see: rows go to a folder of their own and become
a table beside the old one (``stage_table``), with its partitions and its baseline; then
the two tables change names (``swap_in``, catalog operations only). A load that
breaks before that leaves the old table and its baseline as they were. One that breaks
between the two renames leaves no table of that name, and the next load or baseline
lookup ends the swap. Folders of earlier loads are left to running readers; remove them when none is left.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chatlake.config import BaselineMissing
from chatlake.schema import BASELINE_PROPERTY, COMMIT_VERSION, CURATED_COLUMNS


def _ordered(curated: DataFrame) -> DataFrame:
    # Each task sorts its own rows by version, then start date, then agent: the
    # writer needs the version order anyway, and the date/agent order gives
    # parquet row groups tight min/max statistics, so the report's date filter
    # and agent drill-through skip row groups. No shuffle, no global sort.
    return curated.select(*CURATED_COLUMNS, COMMIT_VERSION).sortWithinPartitions(
        COMMIT_VERSION, "conversation_startdate", "bot_conversationtranscriptidname"
    )


def _default_path(spark: SparkSession, table: str) -> str:
    """Where the catalog would put a managed table."""
    *database, name = table.split(".")
    database = ".".join(database) or spark.catalog.currentDatabase()
    rows = spark.sql(f"DESCRIBE DATABASE {database}").where("info_name = 'Location'").collect()
    return f"{rows[0]['info_value'].rstrip('/')}/{name}"


def _beside(table: str) -> tuple[str, str]:
    return f"{table}__next", f"{table}__old"


def stage_table(
    df: DataFrame,
    table: str,
    partition_by: str,
    path: str | None = None,
    compression: str = "zstd",
    properties: dict[str, str] | None = None,
) -> str:
    """Write ``df`` to a fresh folder under ``path`` and register it beside ``table``; returns the new table's name."""
    spark = df.sparkSession
    finish_swap(spark, table)
    following, _ = _beside(table)
    folder = f"{(path or _default_path(spark, table)).rstrip('/')}/load-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", compression).partitionBy(partition_by).parquet(folder)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {following}")
    spark.sql(
        f"CREATE TABLE {following} ({columns}) USING parquet PARTITIONED BY (`{partition_by}`) LOCATION '{folder}'"
    )
    for key, value in (properties or {}).items():
        spark.sql(f"ALTER TABLE {following} SET TBLPROPERTIES ('{key}' = '{value}')")
    if describe_table(spark, following).get("Partition Provider") == "Catalog":
        spark.sql(f"ALTER TABLE {following} RECOVER PARTITIONS")  # lists this load's folder only
    return following


def swap_in(spark: SparkSession, table: str) -> None:
    """Let the staged table take the place of ``table``."""
    following, old = _beside(table)
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    spark.catalog.refreshTable(table)


def finish_swap(spark: SparkSession, table: str) -> None:
    """End a swap that broke between its renames."""
    following, old = _beside(table)
    exists = spark.catalog.tableExists
    if not exists(table) and exists(old) and exists(following):
        spark.sql(f"ALTER TABLE {following} RENAME TO {table}")
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def stage_curated(
    curated: DataFrame,
    table: str,
    version: int,
    path: str | None = None,
    compression: str = "zstd",
    baseline: int | None = None,
) -> str:
    stamped = curated.withColumn(COMMIT_VERSION, F.lit(version).cast("bigint"))
    properties = {} if baseline is None else {BASELINE_PROPERTY: str(int(baseline))}
    return stage_table(_ordered(stamped), table, COMMIT_VERSION, path, compression, properties)


def write_curated(
    curated: DataFrame,
    table: str,
    version: int,
    path: str | None = None,
    compression: str = "zstd",
    baseline: int | None = None,
) -> None:
    """Replace the whole table by ``curated``, stamped with ``version``; rows and ``baseline`` appear together."""
    stage_curated(curated, table, version, path, compression, baseline)
    swap_in(curated.sparkSession, table)


def describe_table(spark: SparkSession, table: str) -> dict[str, str]:
    keys = ["Location", "Partition Provider"]
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name").isin(keys)).collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def _register_partitions(spark: SparkSession, table: str, versions: list[int], chunk: int = 500) -> None:
    """Add the written version partitions to a catalog that tracks partitions.

    Only the versions this write produced are added (cost grows with the
    increment, not with the table's history, unlike a full partition recovery).
    """
    for i in range(0, len(versions), chunk):
        specs = " ".join(f"PARTITION ({COMMIT_VERSION} = {int(v)})" for v in versions[i : i + chunk])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")


def replace_versions(curated_with_version: DataFrame, table: str, compression: str = "zstd") -> list[int]:
    """Write rows carrying ``_commit_version``, replacing those version partitions only.

    Returns the versions written (observed on the write job itself).
    """
    spark = curated_with_version.sparkSession
    info = describe_table(spark, table)
    location = info["Location"]
    written = Observation("written_versions")
    df = _ordered(curated_with_version).observe(
        written, F.collect_set(COMMIT_VERSION).alias("versions")
    )
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(COMMIT_VERSION)
        .parquet(location)
    )
    versions = sorted(int(v) for v in (written.get.get("versions") or []))
    if info.get("Partition Provider") == "Catalog" and versions:
        _register_partitions(spark, table, versions)
    spark.catalog.refreshTable(table)
    return versions


def append_curated(curated_with_version: DataFrame, table: str, compression: str = "zstd") -> list[int]:
    """Append new messages to the curated table, idempotently per commit version.

    The rows carry ``_commit_version``; writing them replaces exactly those
    version partitions, so appending the same versions twice (a rerun after a
    crash) leaves one copy. Returns the versions written.
    """
    return replace_versions(curated_with_version, table, compression)


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def set_baseline(spark: SparkSession, table: str, version: int) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{BASELINE_PROPERTY}' = '{int(version)}')")


def get_baseline(spark: SparkSession, table: str) -> int:
    """The stored baseline version; BaselineMissing when absent or the table is missing."""
    finish_swap(spark, table)
    if not spark.catalog.tableExists(table):
        raise BaselineMissing(f"table {table} does not exist: run the initial load first")
    props = table_properties(spark, table)
    if BASELINE_PROPERTY not in props:
        raise BaselineMissing(
            f"no '{BASELINE_PROPERTY}' property on {table}: run the initial load first"
        )
    return int(props[BASELINE_PROPERTY])
