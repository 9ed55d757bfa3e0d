"""Session set-up and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans rely on.  AQE splits skewed join partitions and
# skewed REBALANCE writes; the force flag lets it do so even where the split
# costs one more shuffle (a join whose result is aggregated by the join key).
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app_name: str = "strataflow", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session; wall-clock columns are zone-less, the zone is pinned for streams."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", **RUNTIME_SETTINGS, **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session built elsewhere, leaving submitted choices alone."""
    submitted = spark.sparkContext.getConf()
    for key, value in RUNTIME_SETTINGS.items():
        if not submitted.contains(key) and spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# How the tables of the warehouse are cut: shuffles begin with this many partitions, which adaptive execution merges up to SHARE, and a
# scan's task takes SPLIT of a file.  They bound what one task sorts or hashes, so that it stays in memory however large the tables are;
# narrow rows that compress well take some thirty times their shuffled size in a hash map.
INITIAL_PARTITIONS, SHARE, SPLIT = 400, "16m", "32m"
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SIZES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": SHARE, "spark.sql.files.maxPartitionBytes": SPLIT}


def finely(spark: SparkSession) -> SparkSession:
    """``tune``, with small shares of large tables for each task; submitted choices stay, and more shuffle partitions than these too."""
    tune(spark)
    submitted = spark.sparkContext.getConf()
    if not submitted.contains(_INITIAL):
        spark.conf.set(_INITIAL, max(INITIAL_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    for name, size in _SIZES.items():
        if not submitted.contains(name):
            spark.conf.set(name, size)
    return spark


def coarsely(spark: SparkSession) -> SparkSession:
    """Takes back what ``finely`` has set."""
    submitted = spark.sparkContext.getConf()
    for name in (_INITIAL, *_SIZES):
        if not submitted.contains(name):
            spark.conf.unset(name)
    return spark


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidily(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a statement go when it ends; else they stay until the driver happens to collect its garbage, and those
    of a build of many statements lie on the disks together.  A submitted choice stays.

    For code that runs each frame once: one that runs again computes its shuffles anew.
    """
    if spark.sparkContext.getConf().contains(_CLEANUP):
        yield
        return
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


# Removed when the process ends.
_LOCAL_SCRATCH: dict[str, tempfile.TemporaryDirectory] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master may
    fall back to a machine-local folder, because there all tasks share it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.TemporaryDirectory(prefix="strataflow-")
    return _LOCAL_SCRATCH[app].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch root; never reused, so a retry cannot see half a table."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back.

    Cuts the lineage at a point that survives lost executors, computes a frame
    that is used several times once, and fixes values that depend on partitioning.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
