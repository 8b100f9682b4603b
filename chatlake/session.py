"""Session helpers: a local session for tests and benches, and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench. On a cluster use the cluster's session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("chatlake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CHATLAKE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (to storage every executor can reach). Only
    in a ``local[...]`` session without the setting, as in tests, a fresh local
    folder is created and registered as the session's checkpoint directory.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            root = None
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        # `spark.checkpoint.dir` is a core setting that cannot change at run
        # time; register the folder on the context, where later calls find it
        # through getCheckpointDir().
        root = tempfile.mkdtemp(prefix="chatlake-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/chatlake/{name}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
