"""Compaction of the curated table into a date-partitioned copy for reporting.

The curated table is partitioned by load version (what makes increments
idempotent); report filters are by start date. ``compact_by_date`` writes a copy
partitioned by ``conversation_startdate``, so date filters prune whole
folders. The REBALANCE hint lets AQE size the output files: small dates are
coalesced into one file, and a date holding a third of all rows is split over
many tasks rather than written by one. Rows inside each task are sorted by
agent, so the drill-through filter also skips row groups. The copy is written beside
the old one and takes its place when it is complete.

``refresh_by_date`` brings a copy up to date: it finds the dates that versions after the
copy's own (a property of the copy) brought rows for, a scan of one column of these
versions' partitions, and rewrites only them, each into a fresh folder that its
partition is then pointed to. Files of all other dates stay. A refresh that breaks is
repaired by the next one, since the copy's version moves last. After a full reload of the
curated table the whole copy is written anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.config import BaselineMissing
from chatlake.operators.report import filter_domain_dates
from chatlake.plans.sinks import describe_table, get_baseline, stage_table, swap_in, table_properties
from chatlake.schema import COMMIT_VERSION, CURATED_COLUMNS
from chatlake.sources.tables import read_curated

DATE = "conversation_startdate"
# The curated table's baseline that the copy holds, and the folder that it was read from.
COMPACTED_TO = "compacted.to_version"
COMPACTED_FROM = "compacted.from_location"


def _arranged(rows: DataFrame) -> DataFrame:
    return (
        rows.select(*CURATED_COLUMNS).hint("rebalance", DATE).sortWithinPartitions(DATE, "bot_conversationtranscriptidname")
    )


def _state(spark: SparkSession, curated_table: str) -> dict[str, str]:
    """What a copy of the curated table as it is now is marked with."""
    state = {COMPACTED_FROM: describe_table(spark, curated_table)["Location"]}
    try:
        state[COMPACTED_TO] = str(get_baseline(spark, curated_table))
    except BaselineMissing:
        pass
    return state


def compact_by_date(
    spark: SparkSession, curated_table: str, target_table: str, path: str | None = None, compression: str = "zstd"
) -> None:
    """Write the whole copy."""
    state = _state(spark, curated_table)  # before the rows are read: what comes meanwhile counts as new
    stage_table(_arranged(read_curated(spark, curated_table)), target_table, DATE, path, compression, state)
    swap_in(spark, target_table)


def refresh_by_date(
    spark: SparkSession, curated_table: str, target_table: str, path: str | None = None, compression: str = "zstd"
) -> list | None:
    """Rewrite the dates that increments since the last compaction touched; returns them (None: the whole copy)."""
    now = _state(spark, curated_table)
    done = table_properties(spark, target_table) if spark.catalog.tableExists(target_table) else {}
    tracked = done and describe_table(spark, target_table).get("Partition Provider") == "Catalog"
    if not tracked or COMPACTED_TO not in done or COMPACTED_TO not in now or done[COMPACTED_FROM] != now[COMPACTED_FROM]:
        compact_by_date(spark, curated_table, target_table, path, compression)
        return None
    rows = read_curated(spark, curated_table, keep_version=True)
    new = rows.where(F.col(COMMIT_VERSION) > int(done[COMPACTED_TO])).select(DATE).distinct()
    dates = [r[0] for r in new.collect()]  # as many as the calendar has
    if dates:
        known = [d for d in dates if d is not None]
        touched = F.col(DATE).isin(known) if known else F.lit(False)
        if len(known) < len(dates):
            touched = touched | F.col(DATE).isNull()
        folder = f"{describe_table(spark, target_table)['Location'].rstrip('/')}/refresh-{uuid.uuid4().hex[:12]}"
        _arranged(rows.where(touched)).write.option("compression", compression).partitionBy(DATE).parquet(folder)
        for d in dates:
            value, name = ("null", "__HIVE_DEFAULT_PARTITION__") if d is None else (f"'{d}'", d)
            partition = f"PARTITION ({DATE} = {value})"
            spark.sql(f"ALTER TABLE {target_table} ADD IF NOT EXISTS {partition}")
            spark.sql(f"ALTER TABLE {target_table} {partition} SET LOCATION '{folder}/{DATE}={name}'")
    spark.sql(f"ALTER TABLE {target_table} SET TBLPROPERTIES ('{COMPACTED_TO}' = '{now[COMPACTED_TO]}')")
    spark.catalog.refreshTable(target_table)
    return dates


def date_domain(spark: SparkSession, copy: str) -> DataFrame:
    """First and last start date of a copy (one row). Where the catalog tracks partitions, their names tell, as every partition
    has rows; no file is read."""
    if describe_table(spark, copy).get("Partition Provider") != "Catalog":
        return filter_domain_dates(read_curated(spark, copy))
    value = F.regexp_extract("partition", rf"^{DATE}=(\d{{4}}-\d\d-\d\d)$", 1)  # '' of the partition without a date
    dates = spark.sql(f"SHOW PARTITIONS {copy}").select(F.when(value != "", value).cast("date").alias(DATE))
    return filter_domain_dates(dates)
