"""SparkSession helpers.

The library never creates its own cluster settings on a real cluster: it reads
what the session already has.  ``get_spark`` is a convenience for tests, the
bench and local runs only.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one (tests / bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or os.environ.get("TESSERA_MASTER", "local[8]"))
    conf = dict(_LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TESSERA_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only set one when unset.

    On a cluster this is a shared folder named by the deployment, and a
    missing setting is an error.  Only a local/test session without the
    setting gets a fresh scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/...) that "
                               "every executor can read; tessera writes lineage cuts there")
        current = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written intermediate tables."""
    return ensure_checkpoint_dir(spark)


def size_shuffle_partitions(spark: SparkSession, shuffle_bytes: int, target_bytes: int = 256 * 1024 * 1024,
                            max_partitions: int = 50_000) -> int:
    """Initial shuffle partitions for a shuffle of about ``shuffle_bytes``.

    Aim at ``target_bytes`` per reducer, never below twice the cluster's cores
    and never above ``max_partitions`` (each map task writes one index entry
    per reducer).  AQE then coalesces small partitions at run time
    (``advisoryPartitionSizeInBytes``) and splits skewed ones in joins.  The
    shuffles here carry partial aggregates or pruned columns, so a 100 TB scan
    typically shuffles a few TB: ~10k-50k initial partitions.
    """
    cores = spark.sparkContext.defaultParallelism
    n = min(max_partitions, max(2 * cores, -(-int(shuffle_bytes) // int(target_bytes))))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    return n
