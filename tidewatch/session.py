"""Session helpers: building a session for tests/bench, reading tables and
locating the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "tidewatch") -> SparkSession:
    """Session for tests and the bench. On a cluster the caller brings its own."""
    master = master or os.environ.get("TIDEWATCH_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIDEWATCH_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # plans here are built from thousands of Column calls; capturing the
        # Python call site of each one costs more than building the plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch outputs.

    Read from ``spark.checkpoint.dir`` (set by the cluster to a shared
    filesystem; Spark also uses it for ``checkpoint()``). Only when nothing is
    configured and the master is local (bare local runs), a folder under the
    system temp dir is registered with ``setCheckpointDir``; the config itself is not changed at
    runtime (Spark refuses that for core settings).
    """
    sc = spark.sparkContext
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(conf)
        return conf.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if sc.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tidewatch-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    import uuid

    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
