"""Session helpers with the settings that the operators assume."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def session(master: str | None = None, **settings: str) -> SparkSession:
    """A session in UTC with adaptive execution; shuffle partitions follow the cluster unless they are given."""
    builder = SparkSession.builder.appName("paperloom").config("spark.sql.session.timeZone", "UTC")
    builder = builder.config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return (builder.master(master) if master else builder).getOrCreate()


#: Of what a task reads of files or of a shuffle: hash maps and sorts of keys take ten to twenty times that of its memory.
TASK_BYTES = 16 << 20
TASK = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def tasks(spark: SparkSession) -> None:
    """Cut the session's tasks at TASK_BYTES, unless they are already cut at less; more tasks then, none larger."""
    for name in TASK:
        if not 0 < _bytes(spark, spark.conf.get(name)) <= TASK_BYTES:
            spark.conf.set(name, f"{TASK_BYTES}b")


def _bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


#: Of Python workers: Arrow and numpy take memory from one allocator, which can give it back.
WORKERS = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_TRIM_THRESHOLD_": "1048576", "MALLOC_MMAP_THRESHOLD_": "1048576"}
#: Of an Arrow batch, which may exceed it by one row: the JVM and the worker hold several for each task.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def workers(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver found it, and bound what they keep.

    The session's Arrow batches are cut at BATCH_BYTES, unless they are already cut at less.
    """
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
    for key, value in WORKERS.items():
        env.setdefault(key, value)
    if not 0 < _bytes(spark, spark.conf.get(BATCH)) <= BATCH_BYTES:
        spark.conf.set(BATCH, f"{BATCH_BYTES}b")
