"""Session factory and session-scoped helpers.

The factory mirrors what a job needs at scale: UTC session time (naive trip
timestamps must not shift with DST), AQE on (coalescing, skew-join split,
runtime broadcast), an event log when asked for, and a shared checkpoint
directory for lineage cuts.  Everything else is left to Spark's defaults so a
cluster's own configuration wins.
"""

from __future__ import annotations

import contextlib
import tempfile
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings every job of the library relies on; callers may override any of them.
BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # coalesce shuffle partitions to the advisory size rather than into many tiny tasks
    # (Spark's recommendation for busy clusters; on a single 8-core machine parallelism
    # wins instead, so the benchmark session keeps Spark's default)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MB = 1 << 20


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * MB) -> dict[str, str]:
    """Shuffle and scan sizing for an input of ``input_bytes`` on ``total_cores`` cores.

    Splits are ``target_partition_bytes`` (256 MB: comfortably inside a few GB
    of execution memory per core, and few enough tasks for the scheduler).  The
    first shuffle of every stage starts with one partition per target size of
    input (at least 2 per core) and AQE coalesces what turns
    out small; skewed partitions above 4× the advisory size are split by AQE's
    skew join.  At 100 TB: about 400,000 initial partitions of at most
    ~256 MB, fewer after coalescing.
    """
    initial = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def get_spark(
    app_name: str,
    master: str | None = None,
    event_log_dir: str | None = None,
    input_bytes: int | None = None,
    total_cores: int | None = None,
    **extra_conf: str,
) -> SparkSession:
    """Build (or reuse) a session with the library's base settings.

    ``event_log_dir`` switches on the event log written there; it is the
    input of the run-metrics operators.  ``input_bytes`` and ``total_cores``
    size shuffles and scan splits (:func:`scale_conf`).  Keyword arguments
    are passed as Spark settings, so per-job overrides stay declarative.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if input_bytes:
        conf.update(scale_conf(input_bytes, total_cores or 8))
    if event_log_dir:
        conf["spark.eventLog.enabled"] = "true"
        conf["spark.eventLog.dir"] = event_log_dir
    conf.update(extra_conf)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, setting one only in local mode.

    On a cluster the directory must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local folder would lose the
    checkpoint with the executor, so that case raises instead of guessing.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="fleetlens-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "before running operators that cut lineage"
        )
    return sc.getCheckpointDir()


@contextlib.contextmanager
def job_label(spark: SparkSession, text: str) -> Iterator[None]:
    """Label the jobs started inside the block (shown in the run log), then reset."""
    sc = spark.sparkContext
    previous = sc.getLocalProperty("spark.job.description")
    sc.setJobDescription(text)
    try:
        yield
    finally:
        sc.setJobDescription(previous)


@contextlib.contextmanager
def cached(df, storage_level=None):
    """Persist ``df`` for the queries in the block and always release it."""
    if storage_level is None:
        df.persist()
    else:
        df.persist(storage_level)
    try:
        yield df
    finally:
        df.unpersist()
