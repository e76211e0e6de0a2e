"""Session construction and the shared scratch folder.

On a cluster the scratch root is the folder named by ``spark.checkpoint.dir`` (shared by all
executors). Only when that setting is missing on a local master (tests, a laptop) do we create one of
our own; on a cluster a folder of one machine would lose data, so a missing setting is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job wants regardless of scale. Partition counts are left to the caller:
# on local[8] a handful, on a 1000-executor cluster several thousand.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.ui.enabled": "false",
}


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a job reading ``input_bytes`` on ``total_cores`` executor cores.

    Scan splits and post-shuffle partitions aim at ``target_partition_bytes`` (a size a task
    sorts or hashes in memory without heavy spill); the initial shuffle partition count is large
    enough for that and at least twice the cores, and AQE coalesces what turns out smaller. A
    partition over 4x the median and over 1 GiB counts as skewed and is split.
    """
    partitions = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ferry", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a private one only when none is set."""
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext; use the setting as it is
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            configured = None
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ferry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder below the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/ferry-scratch/{label}-{uuid.uuid4().hex[:12]}"
