"""Session construction and shared-storage helpers.

On a cluster the session comes from ``spark-submit`` and already carries the
settings the operators rely on; ``get_session`` only fills in what is missing
so that local runs (tests, bench) behave the same way.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this library expects. UTC makes event days and hours
# independent of the machine; AQE coalesces small shuffles and splits skewed
# join partitions at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings meant for a large cluster reading ~100 TB (pass as ``extra`` or in
# spark-defaults). Shuffles start wide and AQE merges them down to ~256 MB
# reducers, so a task's window / aggregation input fits in executor memory
# and spills gracefully; skewed join partitions are split at run time; scans
# read 256 MB splits. The streaming state lives in RocksDB (off-heap, spills
# to local disk, snapshots to the checkpoint folder).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "clickweave", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {k: v for k, v in DEFAULT_CONF.items() if k.startswith("spark.ui.")}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for k, v in DEFAULT_CONF.items():  # what the cluster has set wins
        if k not in conf and not given.contains(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS / object store) folder there and it is used
    as is. Only when it is unset -- a local run -- a fresh scratch folder is
    created, which is fine because driver and executors share one machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="clickweave-ckpt-")
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub folder of the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else f"{base.rstrip('/')}/{name}"


def checkpoint(df, eager: bool = True):
    """``df.checkpoint()`` into the session's shared checkpoint folder
    (resolved first, so it also works on a session built elsewhere)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
