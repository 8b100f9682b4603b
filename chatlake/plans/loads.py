"""Initial and incremental loads (bounded batch).

Initial load: capture the latest source version ``v`` once, load the source
state as of ``v``, and replace the curated table by rows stamped ``v`` with ``v`` as its
baseline, both at once. Without a version there is no baseline, so an increment cannot
load the same rows again. No version beyond the latest committed one is ever stored: what
is committed later would never be read. A version before the latest is refused unless
the source can be read as of it (the change log, a Delta table): rows of later
versions would be in the table and loaded again by the next increment.

Incremental load: read the baseline ``b``, capture the latest version ``e``
once, read the change log for ``b < version <= e`` (a partition filter), keep
inserts, run the same transform, replace those version partitions, then store
``e``. A crash between the write and the baseline update is repaired by the
next run, which rewrites the same partitions.

Each load runs the message path once (the write job); the message count comes
from an Observation on that job. The incremental load also counts change and
insert rows up front in one pass over the change-type column (AGG6), which
gives the early exit when the range holds no change rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chatlake.config import LoadConfig, LoadResult
from chatlake.functions.payload import payload_rejects
from chatlake.plans.curated import build_curated
from chatlake.plans.sinks import append_curated, get_baseline, set_baseline, write_curated
from chatlake.schema import COMMIT_VERSION
from chatlake.sources.changes import inserts_only, latest_version, load_stats, read_changes, snapshot_as_of
from chatlake.sources.tables import project_transcripts, read_transcripts, read_users


def _observe(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    counts = [
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("conversation_starttime").isNull()).alias("null_start_times"),
        F.count_if(F.col("conversation_part_starttime").isNull()).alias("null_message_times"),
    ]
    return df.observe(obs, *counts), obs


PAYLOAD_COUNTS = ("null_payloads", "rejected_payloads", "mixed_payloads", "lost_elements")


def _details(obs: Observation, payloads: Observation) -> dict:
    """Messages whose conversation or own time could not be read, payloads without content, payloads that could
    not be read at all, those of which some elements could not, and the number of these elements."""
    times = {k: obs.get.get(k, 0) for k in ("null_start_times", "null_message_times")}
    return times | {k: payloads.get.get(k, 0) for k in PAYLOAD_COUNTS}


def write_rejects(transcripts: DataFrame, cfg: LoadConfig) -> None:
    """Unreadable payloads of ``transcripts`` (with ``_commit_version``), replacing those of the same versions."""
    rejects = payload_rejects(transcripts, carry=[COMMIT_VERSION])
    rejects.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "compression", cfg.compression
    ).partitionBy(COMMIT_VERSION).parquet(cfg.rejects_path)


def initial_load(
    spark: SparkSession,
    cfg: LoadConfig,
    transcripts: DataFrame | None = None,
    users: DataFrame | None = None,
    version: int | None = None,
) -> LoadResult:
    """Full load of the curated table and its baseline version.

    Source state: ``transcripts`` when given (raw transcript columns), else, by
    ``cfg.initial_from``, the transcript table (of a Delta table the captured
    version) or the change log's state as of the captured version.
    """
    if cfg.change_log is not None:
        latest = latest_version(spark, cfg.change_log, cfg.change_log_format)
        latest = -1 if latest is None else latest  # an empty log: nothing of it is loaded yet
        version = latest if version is None else min(version, latest)
        delta = transcripts is None and cfg.change_log_format == "delta"
        as_of = delta or transcripts is None and cfg.initial_from == "log"
        if version < latest and not as_of:
            raise ValueError(
                f"version {version} is before the latest ({latest}), and the transcripts can't be read as of it: "
                'load from the change log (initial_from="log") or leave the version out'
            )
    if transcripts is None:
        if cfg.change_log is not None and cfg.initial_from == "log":
            changes = read_changes(spark, cfg.change_log, None, version, cfg.change_log_format)
            transcripts = project_transcripts(snapshot_as_of(changes))
        else:
            transcripts = read_transcripts(spark, cfg, version)
    elif "content" in transcripts.columns and "conversation_starttime" not in transcripts.columns:
        transcripts = project_transcripts(transcripts)
    users = read_users(spark, cfg) if users is None else users
    payloads = Observation("initial_payloads")
    curated, obs = _observe(build_curated(transcripts, users, cfg, payloads=payloads), "initial_load")
    stamp = -1 if version is None else version
    if cfg.rejects_path:
        write_rejects(transcripts.withColumn(COMMIT_VERSION, F.lit(stamp).cast("bigint")), cfg)
    write_curated(curated, cfg.curated_table, stamp, cfg.curated_path, cfg.compression, baseline=version)
    details = _details(obs, payloads)
    return LoadResult("loaded", end_version=version, messages=obs.get.get("messages", 0), details=details)


def incremental_load(
    spark: SparkSession,
    cfg: LoadConfig,
    users: DataFrame | None = None,
    end: int | None = None,
) -> LoadResult:
    """Load the inserts committed after the stored baseline, up to ``end`` (default and bound: the latest)."""
    if cfg.change_log is None:
        raise ValueError("incremental_load needs cfg.change_log")
    baseline = get_baseline(spark, cfg.curated_table)
    latest = latest_version(spark, cfg.change_log, cfg.change_log_format, after=baseline)
    if latest is not None and end is not None:
        latest = min(latest, end)
    if latest is None or latest <= baseline:
        return LoadResult("no_changes", start_version=baseline + 1, end_version=baseline)
    changes = read_changes(spark, cfg.change_log, baseline, latest, cfg.change_log_format)
    # Change and insert counts in one aggregation that reads only the change-type
    # column of the version range. (Observing them on the write job instead would
    # sit between the scan and the insert filter and stop that filter from
    # reaching the scan, so update and delete rows' content would be read.)
    stats = load_stats(changes).first()
    if stats["change_rows"] == 0:
        # Versions without change rows (e.g. maintenance commits): nothing to
        # write, and the range is done.
        set_baseline(spark, cfg.curated_table, latest)
        return LoadResult("no_changes", start_version=baseline + 1, end_version=latest, change_rows=0)
    users = read_users(spark, cfg) if users is None else users
    inserts = inserts_only(changes, keep_version=True)
    payloads = Observation("incremental_payloads")
    curated = build_curated(inserts, users, cfg, carry=[COMMIT_VERSION], payloads=payloads)
    curated, obs = _observe(curated, "incremental_load")
    if cfg.rejects_path:
        write_rejects(inserts, cfg)
    append_curated(curated, cfg.curated_table, cfg.compression)
    set_baseline(spark, cfg.curated_table, latest)
    return LoadResult(
        "loaded",
        start_version=baseline + 1,
        end_version=latest,
        change_rows=int(stats["change_rows"]),
        inserted_transcripts=int(stats["insert_rows"]),
        messages=obs.get.get("messages", 0),
        details=_details(obs, payloads),
    )
