"""Structured Streaming twin of the incremental load.

``readStream`` over the version-partitioned change log -> keep inserts -> the
same ``build_curated`` transform (stateless: from_json, explode, filter, and a
stream-static left join with the user dimension) -> file sink partitioned by
``_commit_version``. The checkpoint records which change files were processed
and the sink's own log commits each micro-batch exactly once, so a restarted or
re-run query (e.g. with ``availableNow``) never duplicates rows. No watermark
and no state store are needed because nothing is aggregated across batches.

The user dimension is read, measured and joined when the query starts (each micro-batch scans it again; it is
broadcast only if all these broadcasts together stay small, so what the driver gets does not grow with the
number of micro-batches), so a query
runs one ``availableNow`` pass over what exists and stops; a schedule starts it
anew, with the users of that time. Change and insert rows are observed on the
query itself and summed over all its batches.

``start_live_stream`` is for a query that keeps running: each micro-batch is a bounded
load (``foreachBatch``) that reads, measures and joins the user dimension as it is then, and
replaces the sink's partition of its batch id, so a batch that runs again after a
crash leaves one copy.

The sink folder of ``start_incremental_stream`` must be read as that sink's folder (its ``_spark_metadata`` log
decides which files count) and must not be written by the batch loads.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from chatlake.config import BaselineMissing, LoadConfig, LoadResult
from chatlake.plans.curated import build_curated
from chatlake.plans.sinks import get_baseline
from chatlake.schema import CHANGE_LOG_SCHEMA, CHANGE_TYPE, COMMIT_VERSION, CURATED_COLUMNS, INSERT
from chatlake.sources.changes import inserts_only
from chatlake.sources.tables import read_users


OBSERVED = "changes"


class _Counts(StreamingQueryListener):
    """Sums what one run of a query observed, batch by batch."""

    def __init__(self):
        self.batches: dict[tuple, tuple[int, int]] = {}
        self.ended: set = set()
        self.news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(OBSERVED)
        if row is not None:
            with self.news:
                key = (str(event.progress.runId), event.progress.batchId)
                self.batches[key] = (row["change_rows"], row["insert_rows"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.news:
            self.ended.add(str(event.runId))
            self.news.notify_all()

    def of(self, run_id, timeout: float = 60) -> list[tuple[int, int]]:
        """(change rows, inserts) of each batch of a run that has ended; listeners hear of it a little later."""
        with self.news:
            if not self.news.wait_for(lambda: str(run_id) in self.ended, timeout):
                raise TimeoutError(f"no report of the end of streaming run {run_id}")
            return [n for (run, _), n in sorted(self.batches.items()) if run == str(run_id) and n[0]]


def change_log_schema(spark: SparkSession, change_log: str) -> T.StructType:
    """The change log's own schema (e.g. a zone-aware start time), read from the
    existing files; the declared schema when the log is still empty."""
    try:
        return spark.read.option("basePath", change_log).parquet(change_log).schema
    except AnalysisException:
        return CHANGE_LOG_SCHEMA


def changes_now(spark: SparkSession, change_log: str, after_version: int | None = None) -> DataFrame | None:
    """What the change log holds now, if anything."""
    try:
        log = spark.read.option("basePath", change_log).parquet(change_log)
    except AnalysisException:
        return None
    return log if after_version is None else log.where(F.col(COMMIT_VERSION) > F.lit(after_version))


def micro_batches(log: DataFrame | None, max_files_per_trigger: int | None) -> int:
    """At most so many micro-batches drain the log."""
    if log is None or not max_files_per_trigger:
        return 1
    return max(1, -(-len(log.inputFiles()) // max_files_per_trigger))


def stream_changes(
    spark: SparkSession, change_log: str, after_version: int | None = None, max_files_per_trigger: int | None = None
) -> DataFrame:
    schema = change_log_schema(spark, change_log)
    reader = spark.readStream.schema(schema).option("basePath", change_log)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    changes = reader.parquet(change_log)
    if after_version is not None:
        changes = changes.where(F.col(COMMIT_VERSION) > F.lit(after_version))
    return changes.withColumn(COMMIT_VERSION, F.col(COMMIT_VERSION).cast("bigint"))


def curated_stream(
    spark: SparkSession,
    cfg: LoadConfig,
    users: DataFrame | None = None,
    after_version: int | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame of curated rows (18 columns + ``_commit_version``).

    ``after_version`` defaults to the baseline of the curated table, if it has one.
    """
    if cfg.change_log_format != "parquet":
        raise ValueError(f"the stream reads a parquet change log, not {cfg.change_log_format!r}")
    if after_version is None:
        try:
            after_version = get_baseline(spark, cfg.curated_table)
        except BaselineMissing:
            pass
    changes = stream_changes(spark, cfg.change_log, after_version, max_files_per_trigger)
    counts = [F.count(F.lit(1)).alias("change_rows"), F.count_if(F.col(CHANGE_TYPE) == INSERT).alias("insert_rows")]
    changes = changes.observe(OBSERVED, *counts)
    users = read_users(spark, cfg) if users is None else users
    log = changes_now(spark, cfg.change_log, after_version)
    return build_curated(
        inserts_only(changes, keep_version=True), users, cfg, carry=[COMMIT_VERSION],
        times=micro_batches(log, max_files_per_trigger), like=None if log is None else inserts_only(log),
    )


def start_incremental_stream(
    spark: SparkSession,
    cfg: LoadConfig,
    sink_path: str,
    checkpoint_path: str,
    users: DataFrame | None = None,
    after_version: int | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the streaming load; it drains what exists and stops."""
    curated = curated_stream(spark, cfg, users, after_version, max_files_per_trigger)
    writer = (
        curated.writeStream.format("parquet")
        .option("compression", cfg.compression)
        .partitionBy(COMMIT_VERSION)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
    )
    return writer.trigger(availableNow=True).start(sink_path)


def run_incremental_stream(
    spark: SparkSession, cfg: LoadConfig, sink_path: str, checkpoint_path: str, **kw
) -> LoadResult:
    """Run one pass to completion; counts are those of all its batches, however many."""
    counts = _Counts()
    spark.streams.addListener(counts)
    try:
        q = start_incremental_stream(spark, cfg, sink_path, checkpoint_path, **kw)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        batches = counts.of(q.runId)
    finally:
        spark.streams.removeListener(counts)
    return LoadResult(
        "drained" if batches else "no_changes",
        change_rows=sum(n for n, _ in batches),
        inserted_transcripts=sum(n for _, n in batches),
        details={"batches": len(batches), "sink": sink_path},
    )


BATCH_ID = "_batch_id"


def start_live_stream(
    spark: SparkSession,
    cfg: LoadConfig,
    sink_path: str,
    checkpoint_path: str,
    users: Callable[[SparkSession], DataFrame] | None = None,
    after_version: int | None = None,
    max_files_per_trigger: int | None = None,
    **trigger,
) -> StreamingQuery:
    """Start a streaming load that runs until it is stopped, with the users of each micro-batch's time.

    ``users`` is called for each micro-batch (default: the configured user table); ``trigger`` as for a stream writer.
    """
    if cfg.change_log_format != "parquet":
        raise ValueError(f"the stream reads a parquet change log, not {cfg.change_log_format!r}")
    if after_version is None:
        try:
            after_version = get_baseline(spark, cfg.curated_table)
        except BaselineMissing:
            pass
    read = users or (lambda session: read_users(session, cfg))

    def load(changes: DataFrame, batch_id: int) -> None:
        inserts = inserts_only(changes, keep_version=True)
        curated = build_curated(inserts, read(changes.sparkSession), cfg, carry=[COMMIT_VERSION])
        (
            curated.withColumn(BATCH_ID, F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", cfg.compression)
            .partitionBy(BATCH_ID)
            .parquet(sink_path)
        )

    changes = stream_changes(spark, cfg.change_log, after_version, max_files_per_trigger)
    writer = changes.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint_path)
    return writer.trigger(**trigger or {"processingTime": "1 minute"}).start()


def read_live_sink(spark: SparkSession, sink_path: str) -> DataFrame:
    """The rows of a live stream's sink, in curated column order."""
    return spark.read.parquet(sink_path).select(*CURATED_COLUMNS)


def read_stream_sink(spark: SparkSession, sink_path: str) -> DataFrame:
    """The streaming sink's committed rows, in curated column order."""
    return spark.read.parquet(sink_path).select(*CURATED_COLUMNS)
