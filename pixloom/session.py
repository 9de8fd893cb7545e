"""Session construction and the two cluster conventions every operator relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "pixloom", cores: int | str = "*", **conf) -> SparkSession:
    """A local session with the settings the operators are tuned for (AQE, UTC, Arrow)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(os.cpu_count() if cores == "*" else cores))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder; on a cluster a missing
    setting is an error, since a machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if path is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
            path = tempfile.mkdtemp(prefix="pixloom-checkpoint-")
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably in the shared checkpoint folder and drop its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(scan: DataFrame) -> DataFrame:
    """A scan with at least a partition for each core, for work that is heavy for each row; larger scans stay as they are."""
    want = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= want else scan.repartition(want)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
