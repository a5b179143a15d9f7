"""Spark session and job-level settings shared by the library, tests and bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators assume. AQE re-plans joins from runtime sizes (so a side
# is broadcast only after its materialised size is checked) and splits skewed
# shuffle partitions; ANSI stays on so bad casts fail loudly unless `try_*` is used.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    # static plans broadcast only below Spark's default 10 MB estimate; AQE may
    # switch a join to broadcast once the side's *measured* shuffle output is small
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints are removed once no plan references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "homestat", extra: dict | None = None,
                  initial_partitions: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide, and set
    ``initial_partitions`` to roughly (shuffled bytes / 64 MB): every shuffle —
    including the range partitioning of the order-statistic operators, which
    AQE can merge but never split — starts that fine-grained and AQE coalesces it
    to ``advisoryPartitionSizeInBytes``. Locally the caller passes ``local[N]``
    and a matching shuffle partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if initial_partitions:
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints / intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster's shared storage, set at
    launch; it cannot be changed at run time). Where it is unset, a local session
    (tests) registers a scratch folder of its own; on a cluster that would be a folder
    of one machine, so there it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if path:
        if not current:
            spark.sparkContext.setCheckpointDir(path)
        return path
    if current:
        return current
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="homestat-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path
