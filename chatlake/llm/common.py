"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.session import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: A key is hot when it holds at least this share of all rows. At most
#: ``HOT_SHARE`` keys can be, so a table of hot keys may be broadcast.
HOT_SHARE = 1000


def ship(spark: SparkSession) -> None:
    """Make the package importable in the Python workers of a ``local[...]`` session.

    On a cluster the package is deployed with the job (``--py-files`` or installed); a local session
    started from another folder would not find it.
    """
    sc = spark.sparkContext
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if not sc.master.startswith("local[") or ROOT in map(os.path.abspath, filter(None, known)):
        return
    if not any("chatlake_package" in f for f in sc.listFiles):
        folder = tempfile.mkdtemp(prefix="chatlake-")
        sc.addPyFile(shutil.make_archive(f"{folder}/chatlake_package", "zip", ROOT, "chatlake"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage: whatever executor is lost later, its rows are re-read
    instead of recomputed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows up to which a list of row names (some 20 to 50 bytes each) is broadcast.
BROADCAST_ROWS = 1_000_000


def row_name() -> Column:
    """A row's name by its doc_id and text; repeated rows share one. Taken together with the doc_id it stands for a
    row: two texts of one doc_id share it with a probability of 2 ** -64."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def drop_named(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``judged`` (uid, doc_id, kept, rows) names as not kept; of repeated rows one stays.

    The names are broadcast while they are few; beyond that the join is left to the planner. Texts travel in
    the second case only.
    """
    name, own = "uid", "own_id"
    while name in docs.columns:
        name += "_"
    while own in docs.columns:
        own += "_"
    judged = judged.select(F.col("uid").alias(name), F.col("doc_id").alias(own), "kept", "rows")

    def small(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows

    def join(rows: DataFrame, names: DataFrame, how: str) -> DataFrame:
        same = (rows[name] == names[name]) & rows[own].eqNullSafe(names[own])
        return rows.join(small(names), same, how)

    named = docs.withColumns({name: row_name(), own: F.col("doc_id").cast("long")})
    gone = judged.where(~F.col("kept")).select(name, own)
    repeated = judged.where("kept AND rows > 1").select(name, own)
    once = join(named, gone.unionByName(repeated), "left_anti")
    if repeated.isEmpty():
        return once.drop(name, own)
    again = join(named, repeated, "left_semi").dropDuplicates([name, own])
    return once.unionByName(again).drop(name, own)


def join_skewed(rows: DataFrame, groups: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """``rows`` joined with ``groups`` (one row per ``key``) where few keys may hold most rows.

    Keys that hold a ``1 / HOT_SHARE`` part of ``total`` rows or more are at
    most ``HOT_SHARE``; they are broadcast, so their rows stay where they are.
    All other keys meet in a sort-merge join whose partitions stay even.
    """
    hot = groups.where(F.col(count) * HOT_SHARE >= F.lit(max(total, 1)))
    cold = groups.where(F.col(count) * HOT_SHARE < F.lit(max(total, 1)))
    hot_rows = rows.join(F.broadcast(hot), key)
    cold_rows = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold.hint("merge"), key)
    return hot_rows.unionByName(cold_rows)
