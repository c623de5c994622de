"""Session helpers: a local session for tests/bench and a shared scratch area.

Library code never creates its own session; it takes the caller's.  Scratch
output (files written by loaders, checkpoints) goes under the folder the
cluster names in ``spark.checkpoint.dir`` so every executor can see it.  A
folder of our own is set only when that setting is absent (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session configured the way the library expects (UTC, AQE on)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cpus
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("usagelens")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("USAGELENS_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Where none is configured, a local session (one machine: tests, laptops) gets a
    folder of its own; on a cluster that is an error, as executors do not share
    the driver's folders."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="usagelens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/usagelens-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read from there: for tables that
    several steps read.  Nothing stays in the executors' memory and lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder, with its partitions and their order: for rows that
    very many short jobs read.  A task then carries a file's name instead of every step that made the rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
