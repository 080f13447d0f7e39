"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  Dates are compared as calendar days, so the
# session time zone is pinned; AQE re-plans joins and coalesces partitions at
# run time; the UI stays off (no listening port).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "recurwork", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster, use the session the platform hands you."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def cluster_conf(total_cores: int, input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle / split sizing for a cluster run, so partitions fit executor memory.

    * scan splits of ``target_partition_bytes`` (``maxPartitionBytes``);
    * initial shuffle partitions = max(3 x cores, input / target), rounded up
      to a multiple of the core count; AQE then coalesces small ones to the
      advisory size and splits skewed ones (joins) above 5 x the median.

    At 100 TB and 1000 executors x 8 cores this gives 416,000 partitions
    (409,600 rounded up to whole waves) of ~256 MB — each sorts / aggregates
    in memory or spills in bounded runs.
    """
    parts = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    parts = -(-parts // total_cores) * total_cores
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read again: cuts the lineage.  The folder's own retention removes it."""
    at = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; we only invent a local
    one when it is unset (tests, local runs).
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return d or ""
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: name a shared folder (HDFS / object store) "
                             "that every executor can reach")
        d = tempfile.mkdtemp(prefix="recurwork-ckpt-")  # single-machine runs and tests only
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d

