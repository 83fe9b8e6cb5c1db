"""Session helpers: one place for the engine settings the marts rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings for a large cluster. AQE coalesces small partitions, splits
# skewed join partitions and reads shuffles locally where it can. Broadcasts
# come only from the planner's size estimate (small file-based dimensions);
# AQE's runtime demotion of sort-merge
# joins to broadcasts is off: the joins here are between aggregates already
# hash-partitioned on the join key, where a sort-merge join needs no extra
# shuffle and a runtime broadcast would collect a per-course table through
# the driver (measured 10-25 % slower locally as well).
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

# Driver-side: PySpark 4 captures the Python call stack for every Column it
# builds (error context only). The capture dominates plan-building time for
# wide aggregates, so jobs built here switch it off.
DRIVER_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "edumart", extra: dict | None = None) -> SparkSession:
    """Local/test session (cluster jobs get their conf from spark-submit)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(CLUSTER_CONF)
    # local sizing: a few cores and small shuffles. Without a lower floor AQE
    # folds a small shuffle into 2-3 partitions and leaves cores idle
    # (measured 15-24 % slower on the headline queries at sf0.1).
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or os.cpu_count() or 8)
    conf["spark.sql.files.maxPartitionBytes"] = "128m"
    conf["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = "64k"
    conf.update(DRIVER_CONF)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset (tests, a bare local session) do we pick a local
    folder ourselves; on a cluster the setting must point at shared storage.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc = spark.sparkContext
        root = sc.getCheckpointDir()
        if not root:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            root = tempfile.mkdtemp(prefix="edumart-ckpt-")
            sc.setCheckpointDir(root)
            return root
    else:
        sc = spark.sparkContext
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/edumart-scratch/{name}-{uuid.uuid4().hex}"


#: rows of the input that a task after a shuffle is sized for; bytes of files or of shuffled data a task may get
ROWS_A_TASK, BYTES_A_TASK = 200_000, 16 << 20


@contextmanager
def sized(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside deal their shuffles to as many tasks as ``rows`` rows ask
    for, never to fewer than the session sets, and read files in splits of
    ``BYTES_A_TASK`` at most, so that what a task sorts or hashes, also to combine
    rows before a shuffle, does not grow with the input. The session's settings
    return after."""
    parts, *targets = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                       "spark.sql.files.maxPartitionBytes")
    was = {k: spark.conf.get(k, None) for k in (parts, *targets)}
    spark.conf.set(parts, str(max(int(spark.conf.get(parts)), -(-rows // ROWS_A_TASK))))
    for k in targets:
        spark.conf.set(k, str(min(_bytes(spark, k), BYTES_A_TASK)))
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: bytes of an Arrow batch of texts; the JVM and the Python worker hold about two batches each
BYTES_A_BATCH = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of the session hold ``BYTES_A_BATCH`` at most, unless the
    user has set a bound. Rows of numbers stay below it and keep their batches
    of 10,000 rows; so many texts would be tens of MB."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BYTES_A_BATCH))


def _bytes(spark: SparkSession, name: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
