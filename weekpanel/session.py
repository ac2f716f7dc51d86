"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "weekpanel") -> SparkSession:
    """Session for tests and the bench. A cluster job gets its session from the
    launcher instead and keeps the cluster's settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("WEEKPANEL_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir``, else the folder
    already set on the context. Only a local session without either (tests, the
    bench) gets a scratch folder, removed when Python ends; on a cluster every executor would write to
    a disk of its own, so a missing setting is an error."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if not sc.getCheckpointDir():
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        scratch = tempfile.TemporaryDirectory(prefix="weekpanel-ckpt-", ignore_cleanup_errors=True)
        atexit.register(scratch.cleanup)
        sc.setCheckpointDir(scratch.name)
    return sc.getCheckpointDir()


def cut_lineage(df, name: str = "stage"):
    """Materialise ``df`` as a Parquet table under the shared checkpoint
    folder and continue from a scan of it.

    One job computes the input exactly once (``Dataset.checkpoint`` without a
    persist computes it twice: once to count, once to write), the files live
    on the cluster's shared storage so a lost executor costs nothing, and
    the scan downstream gets fresh statistics for the planner."""
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
