"""Load parameters, load results and errors."""

from __future__ import annotations

from dataclasses import dataclass, field


class BaselineMissing(RuntimeError):
    """The curated table carries no baseline version: run the initial load first."""


@dataclass(frozen=True)
class LoadConfig:
    """Where the loads read and write, and how messages are derived.

    Sources are table names (qualified with ``namespace`` when given) or paths
    of parquet folders; a path is anything holding a ``/`` or a URI scheme.
    """

    namespace: str | None = None
    transcript_table: str = "conversationtranscript"
    user_table: str = "systemuser"
    # Change log of the transcript table: a parquet folder partitioned by
    # `_commit_version` with a `_change_type` column, or a Delta table with its
    # change feed enabled (`change_log_format="delta"`).
    change_log: str | None = None
    change_log_format: str = "parquet"
    # Where the initial load reads the source state: "log" replays the change log
    # up to the captured version (exact for any source); "table" reads
    # `transcript_table` (the captured version of a Delta table; a plain parquet
    # table is read as it stands, so nothing should be committed meanwhile).
    initial_from: str = "log"
    curated_table: str = "conversation_messages"
    # Location of the curated table's files (an external table). None lets the
    # catalog pick its warehouse location.
    curated_path: str | None = None
    # Signed whole minutes added to the transcript start time and message times.
    tz_offset_minutes: int = -240
    # Unit of the activity epoch: "s" (seconds) or "ms" (milliseconds).
    epoch_unit: str = "s"
    # Payload array that holds the activities; None picks the first array field.
    array_col: str | None = "activities"
    # False: the start date is taken before the offset is applied (as the source
    # report does). True: the date of the shifted start time.
    local_date: bool = False
    # Of a payload array that also holds elements that are no objects, load the
    # objects (False: such a payload gives no messages, as with a plain parse).
    salvage_payloads: bool = True
    # Folder for payloads that could not be read as they are, with the reason, one
    # partition per load version; None: they are only counted.
    rejects_path: str | None = None
    # Keep one user per directory id (the lowest `id`) instead of all of them.
    dedupe_users: bool = False
    # Broadcast the user dimension only when a counted bound proves it is at
    # most this many rows and this many bytes of string data (about a quarter
    # of a gigabyte of hash relation per executor at worst); else shuffle.
    broadcast_max_rows: int = 2_000_000
    broadcast_max_bytes: int = 128 * 1024 * 1024
    # Shuffle path only: most reducers that a heavy sender is dealt over (1: no salting).
    salt_buckets: int = 1024
    # Parquet codec of the curated table: mostly message text, which zstd
    # compresses markedly better than snappy (less storage and scan I/O).
    compression: str = "zstd"

    def qualify(self, table: str) -> str:
        if is_path(table) or self.namespace is None or "." in table:
            return table
        return f"{self.namespace}.{table}"


def is_path(ref: str) -> bool:
    return "/" in ref or ":" in ref


@dataclass
class LoadResult:
    """Outcome of a load: status, version range and row counts."""

    status: str
    start_version: int | None = None
    end_version: int | None = None
    change_rows: int | None = None
    inserted_transcripts: int | None = None
    messages: int | None = None
    details: dict = field(default_factory=dict)
