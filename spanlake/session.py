"""Session helpers.

``get_spark`` is for tests, benches and scripts; library code only reads the
session it is handed. ``scratch_dir`` resolves the shared folder used for
lineage cuts and materialised tables: the cluster's ``spark.checkpoint.dir``
when set, else (local master only: tests, local runs) a fixed local folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "spanlake") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    # Unset (tests, local runs): one fixed local folder so derived tables are reused.
    local = os.path.join(tempfile.gettempdir(), "spanlake-checkpoints")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder (never a machine-local temp dir on a cluster).

    The base is the folder the cluster names in `spark.checkpoint.dir`; when
    only a checkpoint directory was set programmatically, its parent (Spark
    appends a per-application uuid folder to it)."""
    ensure_checkpoint_dir(spark)
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = os.path.dirname(spark.sparkContext.getCheckpointDir().rstrip("/"))
    path = "/".join([root.rstrip("/"), "spanlake", *parts])
    if unique:
        path = f"{path}-{uuid.uuid4().hex[:12]}"
    return path
