"""Session construction and the shared scratch folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(HDFS / object store).  Only a local session that has none gets one, under the
system temp folder; on a cluster that is an error.
"""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Names in the source data differ only by case ("Number of Certified
    # Beds" vs "number of certified beds"); keep resolution case-insensitive.
    "spark.sql.caseSensitive": "false",
    # Whole-stage codegen fuses the many per-column expressions of a staffing
    # row into one method; HotSpot refuses to JIT methods over 8000 bytes and
    # would interpret it.  Let it compile them.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


# Settings for a large cluster (~100 TB of staffing facts, ~1000 executors).
# Scan splits of 512 MB keep the task count near 200k; the only wide shuffle
# on the default path is the roll-up's partial aggregates, so AQE may start
# from many shuffle partitions and coalesce towards 256 MB each.  Skew-join
# splitting and rebalance splitting cover the sort-merge fallback and
# partitioned writes.  Applied only where the session has no value.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "zstd",
}


def apply_cluster_conf(spark: SparkSession) -> SparkSession:
    """Set :data:`CLUSTER_CONF` entries the session does not set itself."""
    explicit = _explicit_conf(spark)
    for k, v in CLUSTER_CONF.items():
        if k not in explicit:
            spark.conf.set(k, v)
    return spark


def _explicit_conf(spark: SparkSession) -> set[str]:
    return {k for k, _ in spark.sparkContext.getConf().getAll()}


def get_spark(master: str | None = None, app: str = "carelens", shuffle_partitions: int | None = None,
              conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    merged = dict(DEFAULT_CONF)
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    given = SparkConf()  # what spark-submit or the environment's defaults say
    for k in ("spark.driver.extraJavaOptions", "spark.executor.extraJavaOptions"):
        if given.get(k, None) and k not in (conf or {}):
            merged[k] = f"{given.get(k)} {merged[k]}"
    for k, v in merged.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``.

    Set one (local temp) only when the session has none, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc_dir = spark.sparkContext.getCheckpointDir()
        root = sc_dir if sc_dir else None
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="carelens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    stamp = time.strftime("%Y%m%dT%H%M%S", time.gmtime())
    leaf = f"{stamp}-{uuid.uuid4().hex[:12]}"
    return "/".join([checkpoint_root(spark), "carelens", *parts, leaf])
