"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE sizes shuffles and splits skewed join partitions at run time, so no width is fixed here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed partition even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Lets AQE replace a sort-merge join by a hash join once every partition is known to be small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.parquet.filterPushdown": "true",
    # A union of joins keeps no partitioning: adaptive execution may give its sides different widths.
    "spark.sql.unionOutputPartitioning": "false",
}


def prepare(spark: SparkSession) -> None:
    """Set what the merge plans need in a session that was made elsewhere."""
    name = "spark.sql.unionOutputPartitioning"
    spark.conf.set(name, SETTINGS[name])


# Shuffled bytes one task should get.
_TASK_BYTES = 512 * 1024**2


def shuffle_width(input_bytes: int) -> int:
    """Shuffle partitions to start from for a job over that much data.

    AQE merges small partitions but never adds any, so the start has to be wide enough.
    """
    return max(200, -(-input_bytes // _TASK_BYTES))


# Shuffled bytes of a task that sorts both sides of several joins, and stored bytes for each partition to start from.
_JOIN_BYTES = 16 * 1024**2
_STORED_BYTES = 2 * 1024**2


@contextmanager
def small_tasks(spark: SparkSession, stored_bytes: int) -> Iterator[None]:
    """Inside, shuffles start wide enough for tables of that size and AQE merges less of them into a task.

    For chains of joins by one key: a task of theirs holds a sort for each side of each join, and shuffled rows take many
    times their compressed bytes in memory. The settings are put back at the end.
    """
    start = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    present = spark.conf.get(start, None) or spark.conf.get("spark.sql.shuffle.partitions")
    wanted = {
        start: str(max(int(present), -(-stored_bytes // _STORED_BYTES))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_JOIN_BYTES),
    }
    with _settings(spark, wanted):
        yield


# Bytes of a change log that one task parses, at a few megabytes a second.
_LOG_BYTES = 16 * 1024**2


@contextmanager
def log_tasks(spark: SparkSession) -> Iterator[None]:
    """Batches of a file log that are planned inside are read by tasks small enough to keep all cores busy to the end.

    A scan of a log costs far more for what is parsed than for a file opened, so Spark's own size is too large for it.
    """
    with _settings(spark, {"spark.sql.files.maxPartitionBytes": str(_LOG_BYTES)}):
        yield


@contextmanager
def coalesced_cache(spark: SparkSession) -> Iterator[None]:
    """Rows persisted and first read inside get as many partitions as AQE finds right, not one per shuffle partition."""
    with _settings(spark, {"spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true"}):
        yield


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def build_session(
    app_name: str = "cdcmart",
    master: str | None = None,
    input_bytes: int | None = None,
    **extra: str,
) -> SparkSession:
    """Session with the settings the mart expects; a running session is reused."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, **extra}
    if input_bytes:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_width(input_bytes))
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for written intermediates, under ``spark.checkpoint.dir``.

    Without that setting they go below the session's warehouse folder, which all executors share too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
