"""Session construction and the shared scratch location.

Scratch data (landing files of the ingest queries, pinned surrogate-key
inputs) lives under the cluster's ``spark.checkpoint.dir``.  A folder of our
own is only chosen on a local master without one, as in tests; on a cluster a
missing setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is under the threshold), coalesces
# small shuffle partitions and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "warehaus", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="warehaus-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _scratch_root(spark: SparkSession) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/warehaus/{spark.sparkContext.applicationId}"


# Writer options of the Parquet files of this library: smaller than Spark's default codec leaves them.
COMPACT = {"compression": "zstd"}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when it ends, not when the driver happens to collect its garbage.

    For runs of many queries, each executed once.  The session's setting comes back afterwards.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    return f"{_scratch_root(spark)}/{purpose}/{uuid.uuid4().hex}"


# Parquet input a shuffle partition stands for (a few times as much once decoded and joined).
PARTITION_BYTES = 4 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


LOCAL_MAPS = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def prefer_local_maps(spark: SparkSession) -> None:
    """Let AQE join by hashing a side whose shuffle partitions all measure at most its advisory size.

    Neither side is sorted then, and a task's map is bounded by that size; a larger
    (skewed) partition keeps the sort-merge join.  A setting of the session stays.
    """
    if spark.conf.get(LOCAL_MAPS, None) is None:
        spark.conf.set(LOCAL_MAPS, spark.conf.get(ADVISORY))


def partitions_for(spark: SparkSession, paths: Sequence[str]) -> int:
    """Let AQE start from shuffle partitions that grow with the input, so that a task's share does not.

    AQE puts small ones together again.  A larger setting of the session stays; returns the number in force.
    """
    size = 0
    for path in paths:
        fs, p = hadoop_path(spark, path)
        size += fs.getContentSummary(p).getLength() if fs.exists(p) else 0
    now = int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-size // PARTITION_BYTES)
    if wanted > now:
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    return max(now, wanted)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Hadoop objects."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def clean_scratch(spark: SparkSession) -> None:
    """Delete everything this application wrote to its scratch folders (at the end of a job)."""
    fs, p = hadoop_path(spark, _scratch_root(spark))
    fs.delete(p, True)
