"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators are written for: AQE re-plans joins from runtime sizes (broadcast only when the
# measured side is under the threshold, skew-join splitting otherwise) and coalesces small partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "innsight",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks; on a cluster the submitter's session is used as is."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("INNSIGHT_DRIVER_MEMORY", "16g")
    # Driver-side only: skip PySpark's per-call call-site capture (error context), which costs several JVM
    # round trips per function call while a plan with a few hundred expressions is built.
    conf["spark.python.sql.dataFrameDebugging.enabled"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local-mode session that names none (tests, benchmarks) gets a scratch folder. On a cluster a
    machine-local folder would be lost with its executor, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS or an "
                               "object store) for checkpoints and report output")
        configured = tempfile.mkdtemp(prefix="innsight-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def output_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for a sink written by a query."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cluster_conf(shuffle_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a cluster run whose largest shuffle writes about ``shuffle_bytes``.

    Shuffle partitions are set so that a partition holds ~``partition_bytes`` (bounded to 200..100000) and AQE
    coalesces smaller ones to the same advisory size; input splits are of the same size; a partition more than
    4x that and 5x the median counts as skewed and is split by the skew join.
    """
    partitions = min(100_000, max(200, -(-shuffle_bytes // partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        **runtime_filter_conf(),
    }


def runtime_filter_conf(scan_bytes: int = 1 << 30, build_bytes: int = 64 << 30, items: int = 64_000_000) -> dict[str, str]:
    """Settings under which a Bloom filter over the smaller side's keys drops rows of the larger side before they are
    shuffled: tax documents (and their parsing) are limited to bookings in the window.

    It is built where the larger side's scan is over ``scan_bytes`` and the smaller side, which must be filtered, under
    ``build_bytes``; it has eight bits for each of ``items`` keys, 64 MB by default, however large the data is. With
    more keys it lets more rows through, which the join drops."""
    prefix = "spark.sql.optimizer.runtime.bloomFilter"
    return {
        f"{prefix}.enabled": "true",
        f"{prefix}.applicationSideScanSizeThreshold": str(scan_bytes),
        f"{prefix}.creationSideThreshold": str(build_bytes),
        f"{prefix}.expectedNumItems": str(items),
        f"{prefix}.maxNumItems": str(items),
        f"{prefix}.numBits": str(8 * items),
        f"{prefix}.maxNumBits": str(8 * items),
    }

