"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import math
import os
import re
import tempfile

from pyspark.sql import SparkSession

# Session settings every job relies on. The session time zone is pinned so
# that date/hour boundaries are the same on every executor.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints hold fact-sized intermediates (the rolling-sum prefix);
    # their files are removed from the shared folder once no longer referenced
    "spark.checkpoint.compress": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(shuffle_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle sizing for a cluster run, from the bytes the largest shuffle
    moves (after column pruning and map-side combine, usually well under the
    input size): enough initial partitions that each holds about
    ``partition_bytes``; AQE then coalesces small ones to that size rather than
    keeping parallelism, and splits skewed join partitions."""
    n = max(200, math.ceil(shuffle_bytes / partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(min(partition_bytes, 512 << 20)),
    }


def get_spark(master: str | None = None, app: str = "clientlens",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the pipeline's settings.

    ``master`` is only set when given; on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared folder and is used as is; without
    it a cluster run is refused, since tasks and driver would not see each
    other's files. Only a local run without it gets a private folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder (master {master})")
        path = fallback or tempfile.mkdtemp(prefix="clientlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates;
    those of an application lie together."""
    return os.path.join(_scratch_root(spark), name)


def _scratch_root(spark: SparkSession) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"clientlens-{spark.sparkContext.applicationId}")


def release_scratch(spark: SparkSession) -> None:
    """Remove what the application has written with ``scratch_path``; for its
    end, since lazily read intermediates go too."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
