"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job needs for correct results (UTC timestamps) and for
# runtime re-planning at scale (AQE coalesces small shuffle partitions,
# splits skewed join partitions and turns a sort-merge join into a broadcast
# join only when the *measured* shuffle size of a side is below the threshold).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Planning-time estimate from (compressed) file sizes: keep it conservative.
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Sizing for a large cluster (~100 TB inputs, ~1000 executors); pass as ``extra``.
# Shuffles start with many partitions and AQE coalesces them to ~128 MB each, so a
# stage never holds more than a few hundred MB per task whatever the input size;
# input splits of 256 MB keep the task count of a 100 TB scan near 400k.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cardlake", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the job defaults.

    On a cluster ``master`` is left to ``spark-submit`` and the shuffle
    partition count comes from the cluster configuration; tests pass
    ``local[*]`` and a small partition count.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")\
        .config("spark.ui.showConsoleProgress", "false")
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is used as is. Only a local master gets a
    fresh scratch folder when it is unset; elsewhere that is an error, as executors would
    not see a folder on the driver's disk.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not is_local(spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="cardlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder, e.g. for stream state."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin rows over at least ``min_partitions`` tasks (default: the cluster's
    parallelism) when the input arrives in fewer partitions, e.g. one unsplittable
    file read by a single task. Inputs that are already parallel pass unchanged.

    Used only in front of CPU-heavy per-row work (JSON encode/parse, document
    flattening, text parsing), where a round-robin shuffle costs a few microseconds
    per row against tens for the work it spreads. Partition count is the test
    because a single row group can still be listed as several (mostly empty) splits."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
