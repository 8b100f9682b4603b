"""Best-fit packing of documents into fixed-size sequences under conflicts.

A sequence (bin) must not hold two documents of one source or two documents of
one duplicate cluster. Documents go longest first into the open bin with the
least room left that still holds them: bins are ordered by residual, a binary
search finds the tightest, and the search steps on to the next larger residual
until a bin carries neither the document's source nor its cluster. Each bin
carries both as bitmaps (Python integers, one bit per source or cluster of the
group). If no bin fits, a new one opens.

A document longer than a bin is cut into full bins of its own and a remainder
that is packed like any other document, so nothing is dropped.

Best-fit is sequential, so the corpus is dealt by a hash of the row into
groups of bounded expected size (``GROUP_ROWS`` pieces, ``GROUP_LENGTH`` units of
length) and each group is packed in one task, whatever its sources are: a hot
source spreads over all groups alike. The number of groups grows with the
corpus and nothing is ever held for more than one group. What this costs is at
most a few half-filled bins per group.

The length is that of the text in UTF-8 bytes plus one separator.

Defined results: a null text counts as empty (length 1). A null source or
cluster conflicts with nothing. Repeated rows are equal texts, so they share a
cluster and never a bin. Ties go by doc_id. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import stored, text_or_empty

CAPACITY = 8192
GROUP_ROWS = 4096
GROUP_LENGTH = 32 << 20

SCHEMA = "doc_id string, source string, cluster string, bin string, slot long, start long, piece long, length long, residual long"


class Bins:
    """Open bins ordered by (residual, number), with the source and cluster bits that each one carries."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """Put a piece into the tightest compatible bin; (bin, its room left before)."""
        at = bisect.bisect_left(self.order, (length, -1))
        while at < len(self.order):
            residual, b = self.order[at]
            if not (self.sources[b] & source or self.clusters[b] & cluster):
                del self.order[at]
                break
            at += 1
        else:
            residual, b = self.capacity, len(self.sources)
            self.sources.append(0)
            self.clusters.append(0)
        self.sources[b] |= source
        self.clusters[b] |= cluster
        if residual > length:
            bisect.insort(self.order, (residual - length, b))
        return b, residual


def _bits(values: pd.Series) -> list[int]:
    """One bit per distinct value; none for null."""
    codes = pd.factorize(values)[0]
    return [0 if c < 0 else 1 << int(c) for c in codes]


def pack_group(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pack the documents of one group (doc_id, source, cluster, length, grp)."""
    rows = rows.sort_values(["doc_id", "cluster", "length"], na_position="first", kind="stable").reset_index(drop=True)
    sources, clusters = _bits(rows["source"]), _bits(rows["cluster"])
    lengths = rows["length"].tolist()
    bins = Bins(capacity)
    placed = []  # (row, piece, bin, start, length)
    for i, n in enumerate(lengths):
        for piece in range(n // capacity):
            placed.append((i, piece, *_whole(bins, capacity)))
    for i in sorted(range(len(lengths)), key=lambda i: (-(lengths[i] % capacity), i)):
        if rest := lengths[i] % capacity:
            b, room = bins.place(rest, sources[i], clusters[i])
            placed.append((i, lengths[i] // capacity, b, capacity - room, rest))
    out = pd.DataFrame(placed, columns=["i", "piece", "b", "start", "length"])
    out["residual"] = capacity - out.groupby("b")["length"].transform("sum")
    out["slot"] = out.sort_values("start").groupby("b").cumcount()
    group = rows["grp"].iloc[0]
    out["bin"] = [f"{group}-{b}" for b in out["b"]]
    taken = rows.loc[out["i"], ["doc_id", "source", "cluster"]].reset_index(drop=True)
    return pd.concat([taken, out[["bin", "slot", "start", "piece", "length", "residual"]]], axis=1)


def _whole(bins: Bins, capacity: int) -> tuple[int, int, int]:
    """A full bin of its own."""
    bins.sources.append(0)
    bins.clusters.append(0)
    return len(bins.sources) - 1, 0, capacity


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    cluster_column: str | None = None,
    group_rows: int = GROUP_ROWS,
    group_length: int = GROUP_LENGTH,
) -> DataFrame:
    """One row per piece of a document: its bin, its place in it and the bin's room left.

    The duplicate cluster is ``cluster_column`` or, if none is given, the text
    itself in lower case with white space levelled.
    """
    text = text_or_empty()
    if cluster_column:
        cluster = F.col(cluster_column).cast("string")
    else:
        cluster = F.md5(F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " ")))
    rows = stored(
        docs.select(
            F.col("doc_id").cast("string").alias("doc_id"),  # pandas would turn a nullable long into floats
            F.col("source").cast("string").alias("source"),
            cluster.alias("cluster"),
            (F.octet_length(text) + 1).cast("long").alias("length"),
            F.xxhash64("doc_id", F.monotonically_increasing_id()).alias("spread"),
        ),
        "lengths",
    )
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("length")).first()
    groups = max(1, math.ceil(totals.n / group_rows), math.ceil((totals.length or 0) / group_length))
    return (
        rows.withColumn("grp", F.pmod("spread", F.lit(groups)))
        .drop("spread")
        .groupBy("grp")
        .applyInPandas(lambda g: pack_group(g, capacity), SCHEMA)
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    )
