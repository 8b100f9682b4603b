"""The transcript change log: versioned scans, the latest version, inserts only.

The default change log is a parquet folder partitioned by ``_commit_version``
(columns named as in Delta's change feed), or a catalog table so partitioned. Which
versions there are is known from metadata alone: the names of the log's folders (one
listing of its top level) or the catalog's partitions. A scan of a version range is given
the folders of that range only, so its files are the only ones that are listed, and the latest version
takes no Spark job. A Delta table with its
change feed enabled is read through the same functions (``fmt="delta"``; not
exercised here because the Delta jars are not installed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.config import is_path
from chatlake.schema import CHANGE_TYPE, COMMIT_VERSION, INSERT
from chatlake.sources.tables import project_transcripts


def _folders(spark: SparkSession, source: str) -> list[str]:
    """Names of what lies directly in a folder, in whatever file system it is; none if it doesn't exist."""
    jvm, jsc = spark._jvm, spark.sparkContext._jsc
    path = jvm.org.apache.hadoop.fs.Path(source)
    files = path.getFileSystem(jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []


def versions(spark: SparkSession, source: str, start: int | None = None, end: int | None = None) -> dict[int, str]:
    """The committed versions ``start < v <= end`` of a parquet change log and the names of their partitions."""
    if is_path(source):
        names = _folders(spark, source)
    else:
        names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {source}").collect()]
    prefix = f"{COMMIT_VERSION}="
    found = {int(n[len(prefix) :]): n for n in names if n.startswith(prefix)}
    return {v: found[v] for v in sorted(found) if (start is None or v > start) and (end is None or v <= end)}


def _scan(spark: SparkSession, source: str, start: int | None, end: int | None) -> DataFrame:
    if not is_path(source):
        return spark.table(source)
    source = source.rstrip("/")
    reader = spark.read.option("basePath", source)
    if start is None and end is None:
        return reader.parquet(source)
    there = versions(spark, source)
    inside = versions(spark, source, start, end)
    if not inside:  # some folder for the schema, of which the filter on the version leaves nothing
        return reader.parquet(*[f"{source}/{name}" for name in list(there.values())[:1]] or [source])
    return reader.parquet(*[f"{source}/{name}" for name in inside.values()])


def read_changes(
    spark: SparkSession,
    source: str,
    start: int | None = None,
    end: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Change rows with ``start < _commit_version <= end`` (open ends when None)."""
    if fmt == "delta":
        reader = spark.read.format("delta").option("readChangeFeed", "true")
        reader = reader.option("startingVersion", 0 if start is None else start + 1)
        if end is not None:
            reader = reader.option("endingVersion", end)
        df = reader.table(source) if not is_path(source) else reader.load(source)
    else:
        df = _scan(spark, source, start, end)
        # Predicates on the raw partition column become PartitionFilters.
        v = F.col(COMMIT_VERSION)
        if start is not None:
            df = df.where(v > F.lit(start))
        if end is not None:
            df = df.where(v <= F.lit(end))
    # A partition value read back from folder names is inferred as int.
    return df.withColumn(COMMIT_VERSION, F.col(COMMIT_VERSION).cast("bigint"))


def latest_version(
    spark: SparkSession, source: str, fmt: str = "parquet", after: int | None = None
) -> int | None:
    """Highest committed version of the change log, None when it is empty.

    ``after``: only versions above it count; None is returned when there is nothing above it.
    """
    if fmt == "delta":
        ref = f"delta.`{source}`" if is_path(source) else source
        rows = spark.sql(f"DESCRIBE HISTORY {ref} LIMIT 1").select("version").collect()
        v = int(rows[0][0]) if rows else None
        return None if v is None or (after is not None and v <= after) else v
    return max(versions(spark, source, start=after), default=None)


def inserts_only(changes: DataFrame, keep_version: bool = False) -> DataFrame:
    """Inserted transcripts in the scan projection; updates and deletes are ignored."""
    carry = [COMMIT_VERSION] if keep_version else []
    return project_transcripts(changes.where(F.col(CHANGE_TYPE) == INSERT), carry)


# Order of change rows inside one commit version: a row that the commit leaves
# behind wins, so a delete and an insert of one id (a table overwrite, or a merge
# that replaces rows) leave the inserted row.
_CHANGE_RANK = [("update_preimage", 0), ("delete", 1), ("insert", 2), ("update_postimage", 3)]


def snapshot_as_of(
    changes: DataFrame, broadcast_max_ids: int = 1_000_000, broadcast_max_bytes: int = 64 * 1024 * 1024
) -> DataFrame:
    """Raw transcript rows as the table stood after the last version in ``changes``.

    Pass ``read_changes(..., end=v)`` to get the state as of version ``v``.

    Transcripts are mostly append-only, so the work is split:

    * ids that ever had an update or delete are found from a two-column scan
      (id, change type) and de-duplicated with partial aggregation;
    * inserts of all other ids pass straight through: an anti-join against
      that id set, broadcast when its counted rows and bytes are within
      bounds, else a shuffle by id;
    * only the changed ids' rows are resolved per id (the latest change wins;
      max_by aggregates partially per task, then per id), and deleted ids and
      pre-images drop out.

    Within the bounds no transcript content is shuffled for the append-only
    majority.
    """
    cols = [c for c in changes.columns if c not in (CHANGE_TYPE, COMMIT_VERSION)]
    changed_ids = changes.where(F.col(CHANGE_TYPE) != INSERT).select("id").distinct()
    size = changed_ids.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col("id"))).alias("bytes")).first()
    n_changed = size["n"]
    small = n_changed <= broadcast_max_ids and (size["bytes"] or 0) <= broadcast_max_bytes
    ids = F.broadcast(changed_ids) if small else changed_ids

    stable = changes.where(F.col(CHANGE_TYPE) == INSERT).join(ids, "id", "left_anti").select(*cols)
    if n_changed == 0:
        return stable

    rank = F.lit(None).cast("int")
    for kind, r in reversed(_CHANGE_RANK):
        rank = F.when(F.col(CHANGE_TYPE) == kind, F.lit(r)).otherwise(rank)
    touched = changes.join(ids, "id", "left_semi")
    latest = touched.groupBy("id").agg(
        F.max_by(F.struct(*cols, CHANGE_TYPE), F.struct(COMMIT_VERSION, rank.alias("r"))).alias("s")
    )
    alive = F.col(f"s.{CHANGE_TYPE}").isin(INSERT, "update_postimage")
    resolved = latest.where(alive).select(*[F.col(f"s.{c}").alias(c) for c in cols])
    return stable.unionByName(resolved)


def load_stats(changes: DataFrame) -> DataFrame:
    """Change rows and inserted rows of a batch, in one aggregation pass."""
    return changes.agg(
        F.count(F.lit(1)).alias("change_rows"),
        F.count_if(F.col(CHANGE_TYPE) == INSERT).alias("insert_rows"),
    )


def change_summary(changes: DataFrame) -> DataFrame:
    """Rows per commit version and change type (partial aggregation before the shuffle)."""
    return changes.groupBy(COMMIT_VERSION, CHANGE_TYPE).agg(F.count(F.lit(1)).alias("rows"))
