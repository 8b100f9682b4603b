"""Conversation and message counts from maintained state, exact after every increment.

Distinct conversations can't be added up over increments, dates or channels. The state
therefore numbers the conversation ids and keeps, for each (start date, agent, channel)
and block of 32,768 numbers, a bitmap of the conversations and the count of messages.
Bitmaps are merged by OR, so any filter and grouping over the three columns gives
the same numbers as the messages do, without reading messages.

The state is a folder per full load of the curated table:

* ``ids/batch=N``: (id, number) of the conversations that batch N saw first. They are numbered in the order of
  date, agent and id, so a cell's numbers lie close together and its bitmaps are few.
* ``cells/batch=N``: (date, agent, channel, block, bits, messages) of the rows of batch N.
* ``marks``: how far the state goes, one row per batch, written last.

A batch is what lies between the last mark and the table's baseline, and is named by
that mark: a batch that broke is replaced as a whole by the next one. Its rows are added up per
(id, date, agent, channel), partially before the shuffle, before they meet the ids, so a conversation that holds
a third of all messages is one row there. The ids known so far are read once per
batch; the planner broadcasts the batch's own ids while they are small. Nothing but one offset per written
partition of new ids and the marks reaches the driver.

Rows without an id count no conversation and no message, but keep their group, as in the report's queries.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.operators.report import AGENT, CHANNEL, DATE
from chatlake.plans.sinks import describe_table, get_baseline
from chatlake.schema import COMMIT_VERSION
from chatlake.sources.tables import read_curated

CELL = (DATE, AGENT, CHANNEL)
BATCH, NUMBER, BLOCK, BITS, MESSAGES = "batch", "number", "block", "bits", "messages"
_IDS = "id string, number bigint, batch bigint"
_MARKS = "mark bigint"


def _folder(spark: SparkSession, curated_table: str, path: str) -> str:
    """The state of the table's present full load."""
    return f"{path.rstrip('/')}/{os.path.basename(describe_table(spark, curated_table)['Location'].rstrip('/'))}"


def _cells_schema(spark: SparkSession, curated_table: str) -> str:
    types = {f.name: f.dataType.simpleString() for f in read_curated(spark, curated_table).schema.fields}
    columns = ", ".join(f"`{c}` {types[c]}" for c in CELL)
    return f"{columns}, {BLOCK} bigint, {BITS} binary, {MESSAGES} bigint, {BATCH} bigint"


def _read(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A part of the state; empty where nothing was written yet."""
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(folder)
    files = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.schema(schema).parquet(folder) if files.exists(there) else spark.createDataFrame([], schema)


def counted_to(spark: SparkSession, curated_table: str, path: str) -> int | None:
    """The version up to which the state counts; None before the first batch."""
    return _read(spark, f"{_folder(spark, curated_table, path)}/marks", _MARKS).agg(F.max("mark")).first()[0]


def _replace_batch(rows: DataFrame, folder: str, batch: int) -> None:
    rows.withColumn(BATCH, F.lit(batch).cast("bigint")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(BATCH).parquet(folder)


def _number_new(spark: SparkSession, new: DataFrame, folder: str, after: int) -> DataFrame:
    """(id, number) of ``new`` ids, numbered from ``after`` + 1 without gaps, in the order of date and agent."""
    ordered = new.repartitionByRange(DATE, AGENT, "id").sortWithinPartitions(DATE, AGENT, "id")
    place = F.monotonically_increasing_id()
    path = f"{folder}/numbering-{uuid.uuid4().hex[:12]}"  # written once: the numbers below are of these rows
    ordered.select("id", place.alias("place")).write.parquet(path)
    placed = spark.read.schema("id string, place bigint").parquet(path)
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).count().orderBy("part").collect()  # one row per written partition
    offsets, at = [], after
    for size in sizes:
        offsets.append((size["part"], at))
        at += size["count"]
    starts = spark.createDataFrame(offsets, "part bigint, start bigint")
    inside = F.col("place") - F.shiftleft(F.col("part"), 33)
    joined = placed.withColumn("part", part).join(F.broadcast(starts), "part")
    return joined.select("id", (F.col("start") + inside + 1).alias(NUMBER))


def update_counts(spark: SparkSession, curated_table: str, path: str) -> int:
    """Bring the state up to the table's baseline; returns the version that it now counts to."""
    folder, baseline = _folder(spark, curated_table, path), get_baseline(spark, curated_table)
    done = counted_to(spark, curated_table, path)
    if done is not None and done >= baseline:
        return done
    batch = -1 if done is None else done
    rows = read_curated(spark, curated_table, keep_version=True)
    rows = rows.where(F.col(COMMIT_VERSION).between(batch + 1, baseline))
    groups = rows.groupBy("id", *CELL).agg(F.count("id").alias(MESSAGES))
    first = groups.where("id IS NOT NULL").groupBy("id").agg(F.min(F.struct(DATE, AGENT)).alias("first"))
    known = _read(spark, f"{folder}/ids", _IDS).where(F.col(BATCH) < batch)
    seen = known.join(first.select("id"), "id").select("id", NUMBER)
    new = first.join(seen.select("id"), "id", "left_anti").select("id", "first.*")
    after = known.agg(F.max(NUMBER)).first()[0] or 0
    _replace_batch(_number_new(spark, new, folder, after), f"{folder}/ids", batch)
    ids = _read(spark, f"{folder}/ids", _IDS).where(F.col(BATCH) <= batch).select("id", NUMBER)
    cells = (
        groups.join(ids, "id", "left")
        .groupBy(*CELL, F.bitmap_bucket_number(NUMBER).alias(BLOCK))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias(BITS), F.sum(MESSAGES).alias(MESSAGES))
    )
    _replace_batch(cells, f"{folder}/cells", batch)
    _mark(spark, folder, baseline)
    return baseline


def _mark(spark: SparkSession, folder: str, version: int) -> None:
    spark.range(1).select(F.lit(version).cast("bigint").alias("mark")).write.mode("append").parquet(f"{folder}/marks")


def read_counts(spark: SparkSession, curated_table: str, path: str) -> DataFrame:
    """The cells of all finished batches; filter them by date, agent and channel as messages are."""
    done = counted_to(spark, curated_table, path)
    cells = _read(spark, f"{_folder(spark, curated_table, path)}/cells", _cells_schema(spark, curated_table))
    return cells.where(F.lit(False) if done is None else F.col(BATCH) < done)


def conversations_by(cells: DataFrame, *keys: str) -> DataFrame:
    """Distinct conversations per ``keys``, from the cells."""
    blocks = cells.groupBy(*keys, BLOCK).agg(F.bitmap_or_agg(BITS).alias(BITS))
    return blocks.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).alias("conversations"))


def messages_by(cells: DataFrame, *keys: str) -> DataFrame:
    return cells.groupBy(*keys).agg(F.sum(MESSAGES).alias(MESSAGES))
