"""Tables that end a plan's lineage, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application below the one in spark.checkpoint.dir; it goes when the application ends.

    Only a local session, whose executor is the driver, gets a temporary folder where that setting is missing.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not named:
        if not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='paperloom-')}"
        context.setCheckpointDir(named)
    folder = f"{named.rstrip('/')}/{context.applicationId}"
    files, path = hadoop_path(spark, folder)
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return folder


def hadoop_path(spark: SparkSession, name: str) -> tuple[Any, Any]:
    """A path in any store that Spark can read, and the file system that it lies in."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path


#: Paths of the tables that were staged in the innermost scope; none outside of one.
_SCOPE: ContextVar[list[str] | None] = ContextVar("paperloom-scope", default=None)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables that are staged inside are deleted at the end; what is made of them has to be written by then.

    Outside of a scope they stay until the application ends.
    """
    made: list[str] = []
    token = _SCOPE.set(made)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for name in made:
            files, path = hadoop_path(spark, name)
            files.delete(path, True)


#: Of a session: whether the files of a job's shuffles go when it ends, else they stay until the driver drops its plan.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """df, written and read back: lineage ends there, and lost executors lose nothing. Nothing reads the job's shuffles
    again, so their files go with it."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if (made := _SCOPE.get()) is not None:
        made.append(path)
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Files for each core of the cluster that dealt() makes at least, and the most rows of one.
TASKS = 4
ROWS = 50_000


def dealt(df: DataFrame) -> DataFrame:
    """df with its rows dealt evenly to files that all cores read: for a file of few bytes, which one task would read, with
    much to do for each of its rows. It is written, since Spark moves filters, and all that they need, to before a shuffle."""
    return staged(df.repartition(max(TASKS * df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS))), "dealt")


def numbered(df: DataFrame, *order: str | Column) -> DataFrame:
    """df with idx, the row's place from 0 in the order of columns; rows are dealt out by ranges, never to one task."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The low bits of these ids count the rows of a partition, the high ones are its number.
    rows = staged(ranged.withColumn("__n", F.monotonically_increasing_id()), "numbered")
    part, place = F.shiftright("__n", 33), F.col("__n").bitwiseAND(F.lit((1 << 33) - 1))
    counts = rows.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("n"))
    # One row for each partition of the rows above.
    before = F.coalesce(F.sum("n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__p", before.alias("__before"))
    return rows.join(F.broadcast(offsets), part == F.col("__p")).withColumn("idx", F.col("__before") + place).drop("__n", "__p", "__before")
