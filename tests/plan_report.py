"""Write PLANS.md: the physical plans of the main jobs, trimmed to what matters.

    python tests/plan_report.py [/root/testdata/sf0.01]

For each plan: the operator tree, then per scan its ReadSchema /
PartitionFilters / PushedFilters, and per exchange and join its arguments.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from chatlake.config import LoadConfig  # noqa: E402
from chatlake.operators import report as R  # noqa: E402
from chatlake.plans.compact import compact_by_date  # noqa: E402
from chatlake.plans.curated import build_curated  # noqa: E402
from chatlake.plans.loads import initial_load  # noqa: E402
from chatlake.plans.sinks import _ordered  # noqa: E402
from chatlake.session import local_session, scratch_path, unique_name  # noqa: E402
from chatlake.sources.changes import inserts_only, read_changes  # noqa: E402
from chatlake.sources.fixtures import (  # noqa: E402
    change_log_from_transcripts,
    save_change_log,
    transcripts_from_turns,
    users_from_customers,
)
from chatlake.sources.tables import read_curated, read_transcripts, read_users  # noqa: E402

KEEP = re.compile(r"^(Output|ReadSchema|PartitionFilters|PushedFilters|Arguments|Join type|Left keys|Right keys|Join condition|Keys|Functions)")


def trimmed(spark, df) -> str:
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    tree, _, details = text.partition("\n\n\n")
    out = [tree.strip(), ""]
    for block in details.split("\n\n"):
        lines = block.strip().splitlines()
        if not lines:
            continue
        head = lines[0]
        if not re.search(r"Scan|Exchange|Join|HashAggregate|Sort|Generate", head):
            continue
        kept = [line for line in lines[1:] if KEEP.match(line) and not line.startswith("Output")]
        out.append(head)
        out.extend("    " + (line if len(line) < 240 else line[:237] + "...") for line in kept)
    return "\n".join(out)


def main(sf: str) -> None:
    spark = local_session()
    raw_t, raw_u, log = scratch_path(spark, "pl_t"), scratch_path(spark, "pl_u"), scratch_path(spark, "pl_log")
    transcripts_from_turns(spark.read.parquet(f"{sf}/conversations.parquet")).repartition(8).write.parquet(raw_t)
    users_from_customers(spark.read.parquet(f"{sf}/customer.parquet")).write.parquet(raw_u)
    save_change_log(change_log_from_transcripts(spark.read.parquet(raw_t)), log)
    T, U = read_transcripts(spark, raw_t), read_users(spark, raw_u)
    cfg = LoadConfig(transcript_table=raw_t, user_table=raw_u, change_log=log,
                     curated_table=unique_name("pl_cm"), curated_path=scratch_path(spark, "pl_c"))
    initial_load(spark, cfg, version=0)
    c = read_curated(spark, cfg.curated_table)
    copy = unique_name("pl_by_date")
    compact_by_date(spark, cfg.curated_table, copy, scratch_path(spark, "pl_bd"))
    page = R.ReportFilter(date_start="2024-01-02", date_end="2024-01-04", exclude_channels=("msteams",))
    plans = {
        "Initial load: the write job (broadcast path)":
            _ordered(build_curated(T, U, cfg).withColumn("_commit_version", F.lit(0).cast("bigint"))),
        "Incremental load: versions (4, 9] of the change log":
            build_curated(inserts_only(read_changes(spark, log, 4, 9), keep_version=True), U, cfg,
                          carry=["_commit_version"]),
        "User join when the size check rules a broadcast out (salted sort-merge)":
            build_curated(T, U, cfg, force_strategy="shuffle"),
        "Summary page: conversations by agent under the page filter": R.conversations_by_agent(page.apply(c)),
        "Total conversations": R.total_conversations(c),
        "Detail page: message list (drill-through agent)": R.detail_page(c, "Agent 2", page)["message_list"],
        "Date filter on the date-partitioned copy": R.messages_by_date_agent(R.by_date(read_curated(spark, copy), "2024-01-02", "2024-01-03")),
    }
    parts = [
        "# PLANS",
        "",
        f"Physical plans at {os.path.basename(sf)} (`python tests/plan_report.py`), generated, not hand-edited.",
        "Tree first, then each scan, exchange, join, aggregate and sort with its arguments.",
        "",
    ]
    for title, df in plans.items():
        parts += [f"## {title}", "", "```", trimmed(spark, df), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(parts))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
