"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "callsheet",
                  checkpoint: str | None = None) -> SparkSession:
    """A local session configured the way the engine expects a cluster to be.

    AQE is on (runtime coalescing, skew-join splitting, runtime broadcast
    decisions based on measured shuffle sizes); the UI is off.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CALLSHEET_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if checkpoint:
        builder = builder.config("spark.checkpoint.dir", checkpoint)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, registered with
    the SparkContext.  An unset folder is an error everywhere; local sessions
    and tests set it when they build the session."""
    sc = spark.sparkContext
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        raise ValueError("set spark.checkpoint.dir to a folder on shared storage (HDFS, S3, ...)")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(conf)
    return conf


def cluster_settings(largest_shuffle_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Spark settings for a cluster run, sized from the largest shuffle.

    ``spark.sql.shuffle.partitions`` is chosen so each partition of the
    largest shuffle (for the lists: the de-duplicated usable phones) holds
    about ``partition_bytes``; AQE then coalesces the smaller shuffles down
    and splits skewed join partitions at run time.  Files are read in splits
    of the same size.
    """
    parts = max(200, -(-largest_shuffle_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.ui.enabled": "false",
    }
