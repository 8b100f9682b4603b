"""Exact duplicates through a persistent digest index (DataFrame functions only).

The index is a table of one row per known text: its SHA-256 digest, the doc_id
that stays, and the batch that brought it. It is bucketed and sorted by digest, so a
new batch meets it in a sort-merge anti-join without moving the index; digests that
it does not know yet are appended. An append is one Spark write, all or
nothing. A batch that runs again, however its rows are dealt over files and tasks, finds
its own entries and returns the same result: the index names what stays by doc_id
and digest, never by a position, and of truly repeated rows any one is the same row.

Only digests travel: texts are hashed where they are read. Copies are counted
map-side before the shuffle, and a batch's distinct digests meet the index. Rows get their
digest's verdict in a second join; a digest that holds 1/1000 of the batch's rows or
more is joined through a broadcast (there can be no more than 1000 of them).

Defined results: a null text counts as empty, so null and empty texts are
equal. Of equal texts the largest ``doc_id`` stays; a null ``doc_id`` is below
all others; of repeated rows with one ``doc_id`` exactly one stays. Texts of an
earlier batch stay, and all their copies in later batches go. ``group_size`` counts the
copies in all batches that are resolved together. An empty table
gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.llm.common import drop_named, join_skewed, row_name, stored, text_or_empty
from chatlake.session import scratch_path

BUCKETS = 256


def digests(docs: DataFrame) -> DataFrame:
    """(row, uid, doc_id, digest) of every document, written once so that ``row`` is stable while it is used."""
    hashed = docs.select(
        F.monotonically_increasing_id().alias("row"),
        row_name().alias("uid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(text_or_empty(), 256)).alias("digest"),
    )
    return stored(hashed, "digests")


def create_index(spark: SparkSession, name: str | None = None, buckets: int = BUCKETS) -> str:
    """An empty index table; returns its name."""
    name = name or f"digest_index_{uuid.uuid4().hex[:12]}"
    spark.sql(
        f"CREATE TABLE {name} (digest BINARY, keep_id LONG, batch STRING) "
        f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
        f"LOCATION '{scratch_path(spark, name)}'"
    )
    return name


def _buckets(spark: SparkSession, index: str) -> int:
    described = spark.sql(f"DESCRIBE EXTENDED {index}").where("col_name = 'Num Buckets'")
    return int(described.first().data_type)


def groups_of(rows: DataFrame) -> DataFrame:
    """(digest, keep_row, keep_id, n): each distinct text of a batch, its row with the largest id, its number of rows."""
    groups = rows.groupBy("digest").agg(
        F.max(F.struct("doc_id", (-F.col("row")).alias("at"))).alias("keep"),
        F.count(F.lit(1)).alias("n"),
    )
    # written, else the anti-join is pushed below the aggregation, and all copies travel
    return stored(
        groups.select("digest", (-F.col("keep.at")).alias("keep_row"), F.col("keep.doc_id").alias("keep_id"), "n"), "groups"
    )


def add_batch(spark: SparkSession, groups: DataFrame, index: str, batch: str) -> None:
    """Append the digests of a batch's ``groups`` that ``index`` does not know."""
    buckets = _buckets(spark, index)
    known = spark.table(index).select("digest")
    (
        groups.join(known.hint("merge"), "digest", "left_anti")
        .select("digest", "keep_id", F.lit(batch).alias("batch"))
        .repartition(buckets, "digest")
        .write.mode("append")
        .format("parquet")
        .bucketBy(buckets, "digest")
        .sortBy("digest")
        .saveAsTable(index)
    )
    spark.catalog.refreshTable(index)


def resolve(spark: SparkSession, batches: list[tuple[DataFrame, DataFrame, str]], index: str) -> DataFrame:
    """Each row of the batches (rows, groups, name) with what stays for its text (row, uid, doc_id, digest, keep_id,
    group_size, kept)."""
    known = spark.table(index).select("digest", F.col("keep_id").alias("stays"), "batch")
    sizes = reduce(DataFrame.unionByName, [groups.select("digest", "n") for _, groups, _ in batches])
    sizes = sizes.groupBy("digest").agg(F.sum("n").alias("group_size"))
    out = []
    for rows, groups, name in batches:
        judged = groups.join(known.hint("merge"), "digest").join(sizes.hint("merge"), "digest")
        own = F.when(F.col("batch") == name, F.col("keep_row"))
        judged = stored(judged.select("digest", "n", own.alias("keep_row"), "stays", "group_size"), "judged_groups")
        joined = join_skewed(rows, judged, "digest", "n", rows.count())
        kept = F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False))
        out.append(joined.select("row", "uid", "doc_id", "digest", F.col("stays").alias("keep_id"), "group_size", kept.alias("kept")))
    return reduce(DataFrame.unionByName, out)


def exact_dedup_batches(batches: list[tuple[DataFrame, str]], index: str) -> DataFrame:
    """Every row of the batches (documents, name), which enter ``index`` one after the other."""
    spark = batches[0][0].sparkSession
    entered = []
    for docs, name in batches:
        rows = digests(docs)
        groups = groups_of(rows)
        add_batch(spark, groups, index, name)
        entered.append((rows, groups, name))
    return resolve(spark, entered, index)


def exact_dedup(docs: DataFrame, index: str | None = None, batch: str | None = None) -> DataFrame:
    """Every row of ``docs`` resolved against ``index``, which then holds its digests; without one, against itself."""
    spark = docs.sparkSession
    own = index or create_index(spark)
    out = exact_dedup_batches([(docs, batch or uuid.uuid4().hex)], own)
    if index is None:
        out = stored(out, "resolved")
        spark.sql(f"DROP TABLE {own}")
    return out


def larger_ids_first(docs: DataFrame) -> DataFrame:
    """A whole table resolved as two batches: the upper half of the range of ids, which stays, then the rest."""
    spark = docs.sparkSession
    doc_id = F.col("doc_id").cast("long")
    ends = docs.agg(F.min(doc_id).alias("low"), F.max(doc_id).alias("high")).first()
    middle = 0 if ends.low is None else (ends.low + ends.high) // 2
    upper = F.coalesce(doc_id > middle, F.lit(False))
    index = create_index(spark)
    out = stored(exact_dedup_batches([(docs.where(upper), "upper"), (docs.where(~upper), "lower")], index), "resolved")
    spark.sql(f"DROP TABLE {index}")
    return out


def drop_duplicates(docs: DataFrame, index: str | None = None, batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    copies = exact_dedup(docs, index, batch).where("group_size > 1 OR NOT kept")
    judged = copies.groupBy("uid", "doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    return drop_named(docs, stored(judged, "judged"))
