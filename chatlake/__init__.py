"""chatlake: conversation-history analytics on Spark.

Raw chat transcripts (one JSON document per conversation) become a typed
one-row-per-message table, kept current by idempotent incremental loads (batch
or Structured Streaming), and report queries run as plain DataFrame queries.
"""

from chatlake.config import BaselineMissing, LoadConfig, LoadResult
from chatlake.operators.report import ReportFilter, detail_page, summary_page
from chatlake.operators.semantic import semantic_view
from chatlake.plans.compact import compact_by_date
from chatlake.plans.curated import build_curated
from chatlake.plans.loads import incremental_load, initial_load
from chatlake.sources.tables import read_curated, read_transcripts, read_users
from chatlake.streaming.incremental import run_incremental_stream, start_incremental_stream

__all__ = [
    "BaselineMissing",
    "LoadConfig",
    "LoadResult",
    "ReportFilter",
    "build_curated",
    "compact_by_date",
    "detail_page",
    "incremental_load",
    "initial_load",
    "read_curated",
    "read_transcripts",
    "read_users",
    "run_incremental_stream",
    "semantic_view",
    "start_incremental_stream",
    "summary_page",
]
