"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins at runtime (it turns a
# sort-merge join into a broadcast join only when the *measured* side is under
# spark.sql.adaptive.autoBroadcastJoinThreshold), splits skewed partitions and
# coalesces small ones.  UTC keeps date arithmetic identical to the oracle.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.ui.enabled": "false",
    # the record plan is thousands of column calls; without call sites it is built in half the time
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # checkpoint files of per-batch rebuild sets are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "carelake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle-partition count should then be sized to the data (about
    128-256 MB per partition after the largest shuffle), AQE coalesces down.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the executor; the wide record plan
            # needs more than the 1 GB default heap.
            b = b.config("spark.driver.memory", "16g")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder on the shared file system the cluster names in
    ``spark.checkpoint.dir``.

    The setting is read from the session; only a local master without it gets
    a private scratch folder.  On a cluster a machine-local folder would lose
    data, so there the setting must be there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base and not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    if not base:
        base = tempfile.mkdtemp(prefix="carelake-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, *parts) if parts else base


def sizing(input_bytes: int, executors: int, cores_per_executor: int,
           target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run, from the input size.

    Shuffle partitions: about one per ``target_partition_bytes`` of the
    largest shuffle (taken as the input size), at least two waves of all
    cores; AQE coalesces partitions that turn out small and splits skewed
    ones (a partition is skewed above 5× the median and 512 MB).  Scans read
    ``maxPartitionBytes`` splits.  The broadcast threshold stays at Spark's
    statistics-checked default; nothing that grows with the data is hinted."""
    cores = max(1, executors * cores_per_executor)
    parts = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 << 20),
    }
