"""Session settings, shared scratch space and sizing helpers."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tierline import files

#: Target bytes per shuffle partition.
SHUFFLE_PARTITION_BYTES = 256 << 20
_SHUFFLES = "spark.sql.shuffle.partitions"


def build_session(app_name: str = "tierline", master: str | None = None,
                  **settings: str) -> SparkSession:
    """A session with the settings the jobs rely on.

    Surrogate keys hold epoch seconds of a date, so the time zone is pinned.
    ANSI mode is off, as mapping expressions expect; in another session the
    transform step resolves them that way, and all casts here are ``try_`` forms.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    pinned = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        # Folders of many slices are listed by some dozens of tasks, not by a task each.
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
        # A task that writes few partitions need not sort its rows first.
        "spark.sql.maxConcurrentOutputFileWriters": "4",
        "spark.scheduler.mode": "FAIR",
    }
    for key, value in {**pinned, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def wanted_shuffles(spark: SparkSession, *paths: str) -> int:
    """Shuffle partitions to suit the bytes below ``paths``, at least as many as the session has.

    Parquet is about three times smaller than the rows that are shuffled;
    adaptive execution joins partitions that stay small.
    """
    stored = sum(files.bytes_below(spark, p) for p in paths)
    return max(math.ceil(3 * stored / SHUFFLE_PARTITION_BYTES), int(spark.conf.get(_SHUFFLES)))


@contextmanager
def sized_shuffles(spark: SparkSession, *paths: str) -> Iterator[int]:
    """Within, shuffles have partitions to suit ``paths``; the session's own number comes back after."""
    before, wanted = spark.conf.get(_SHUFFLES), wanted_shuffles(spark, *paths)
    spark.conf.set(_SHUFFLES, str(wanted))
    try:
        yield wanted
    finally:
        spark.conf.set(_SHUFFLES, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``."""
    configured = (spark.conf.get("spark.checkpoint.dir", None)
                  or spark.sparkContext.getCheckpointDir())
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
    own = tempfile.mkdtemp(prefix="tierline-")
    spark.sparkContext.setCheckpointDir(own)
    files.make_until_exit(spark, own)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the application's own folder in the shared one.

    That folder is removed when the application ends.
    """
    own = f"{shared_dir(spark)}/tierline/{spark.sparkContext.applicationId}"
    files.make_until_exit(spark, own)
    return f"{own}/{purpose}-{uuid.uuid4().hex}"
