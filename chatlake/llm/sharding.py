"""Shards of nearly equal bytes: groups that stay together, largest first, to the least-loaded shard.

Longest-processing-time scheduling needs all groups sorted in one place, and
the number of groups grows with the corpus. What the heap gets is bounded
instead: a group that holds ``1 / BIG_SHARE`` of all bytes or more is scheduled
alone (there are at most ``BIG_SHARE`` such groups); all smaller groups are
first bundled by their digest into ``BUNDLES`` bundles, whose sizes Spark sums.
The driver sorts at most ``BIG_SHARE + BUNDLES`` sizes and pops the least
loaded shard from a heap for each; the resulting maps have the same bound and
are broadcast. Every group stays whole, and no bundle is larger than its mean
plus a few small groups, so the shards differ by less than one bundle or, if a
single group is larger than that, by that group.

Slots are gapless per shard without a window over a whole shard: rows are
counted by (shard, block of doc_id hashes), the counts (shards x blocks rows)
are summed up in block order, and only rows of one block are numbered together.

Defined results: the size of a null text is 1, and it equals the empty text.
Equal texts share a shard, whatever their number. Repeated rows get slots of
their own. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatlake.llm.common import stored, text_or_empty

BIG_SHARE = 4096
BUNDLES = 16384
BLOCKS = 1024


def schedule(sizes: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Longest processing time first: (size, key) items to shards; ties by key, then shard number."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for size, key in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, s = heap[0]
        placed[key] = s
        heapq.heapreplace(heap, (load + size, s))
    return placed


def shard(docs: DataFrame, shards: int = 16, bundles: int = BUNDLES, big_share: int = BIG_SHARE) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, group_key) of every row of ``docs``."""
    spark = docs.sparkSession
    text = text_or_empty()
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.sha2(text, 256).alias("group_key"),
        ),
        "sizes",
    )
    total = rows.agg(F.sum("size").alias("t")).first().t or 0
    groups = rows.groupBy("group_key").agg(F.sum("size").alias("bytes"))
    big = stored(groups.where(F.col("bytes") * big_share >= F.lit(max(total, 1))), "big_groups")
    bundle = F.concat(F.lit("b"), F.pmod(F.xxhash64("group_key"), F.lit(bundles)))
    small = rows.join(F.broadcast(big.select("group_key")), "group_key", "left_anti").withColumn("unit", bundle)
    units = [(r.bytes, r.unit) for r in big.select("bytes", F.col("group_key").alias("unit")).collect()]
    units += [(r.bytes, r.unit) for r in small.groupBy("unit").agg(F.sum("size").alias("bytes")).collect()]
    placed = spark.createDataFrame(list(schedule(units, shards).items()), "unit string, shard int")

    unit = F.when(F.col("is_big").isNotNull(), F.col("group_key")).otherwise(bundle)
    marked = big.select("group_key", F.lit(True).alias("is_big"))
    dealt = (
        rows.join(F.broadcast(marked), "group_key", "left")
        .withColumn("unit", unit)
        .join(F.broadcast(placed), "unit")
        .withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(BLOCKS)))
    )
    counts = dealt.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "group_key")
    return (
        dealt.withColumn("at", F.row_number().over(within) - 1)
        .join(F.broadcast(starts), ["shard", "block"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("start") + F.col("at")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "group_key",
        )
    )
