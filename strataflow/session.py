"""Session factory and session-level settings shared by every job."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so parsed timestamps and day boundaries are
# stable, AQE for runtime re-planning (partition coalescing, skew-join splits),
# and dynamic partition overwrite so a write replaces only the partitions it holds.
#
# Broadcasts: the planner's size *estimates* are not a bound (they do not see
# explode fan-out or filter selectivity), so estimate-based broadcasting is off.
# A join side is broadcast only (a) by an explicit hint on a side whose size is
# bounded by construction (the calendar, fixed code tables), or (b) by AQE after
# the side's shuffle has run and its measured size is under the limit.
#
# Tables are stored with zstd: less is written and read back than with snappy.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}


def build_session(master: str | None = None, app: str = "strataflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster leave ``master`` unset so spark-submit decides; tests pass
    ``local[*]`` and a small ``shuffle_partitions``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(RUNTIME_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes and reads inside go when each of them ends.

    Otherwise they lie on disk until the driver's JVM next collects garbage, so the disk that a run of many
    writes needs is their sum. For data that is not read through the same plan again once it is written.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local session without that setting (tests) gets a private folder. On a
    cluster it must be set: executors there do not share local folders.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="strataflow-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the checkpoint root for one job run."""
    return f"{checkpoint_root(spark)}/strataflow/{name}/{uuid.uuid4().hex}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (only used by tests that inspect files)."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["build_session", "configure", "checkpoint_root", "scratch_path",
           "shuffles_dropped", "local_path", "RUNTIME_CONF"]
