"""Spark session helpers.

The library never creates a session on its own inside an operator; these
helpers exist for tests, the bench and the command line.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tierline") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(os.environ.get("TIERLINE_SHUFFLE_PARTITIONS", cpus))
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Path segments such as season=2019 or capture=20200101T000000Z stay strings.
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIERLINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_settings(shuffle_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """SQL settings for a large cluster run, sized from the expected shuffle
    volume of the heaviest stage (e.g. bronze dedup of the landed rows).

    * shuffle partitions ≈ shuffle bytes / 256 MiB, so one reduce partition
      fits an executor core's memory share and spills rarely; AQE then
      coalesces small ones and splits skewed ones (a key holding a third of
      the rows is cut into advisory-size pieces);
    * 256 MiB file splits keep scan tasks in the same size class;
    * broadcasts stay size-checked by AQE's runtime statistics (explicit
      broadcasts in this library are only for N-bounded key sets).

    The checkpoint folder is never set here: the cluster names a shared
    one in ``spark.checkpoint.dir``."""
    parts = max(200, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
    }


def apply_settings(spark: SparkSession, settings: dict[str, str]) -> None:
    """Set runtime SQL settings that the deployment has not set already."""
    for k, v in settings.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``.  Only when it is unset (local runs, tests) a
    scratch folder is created and registered."""
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tierline-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def checkpoint_dir(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark)
