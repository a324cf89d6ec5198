"""Structured Streaming variants: windowed activity and incremental ingestion."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder as a stream with the schema of what is there."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def activity(log: DataFrame, window: str = "5 minutes", slide: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """start, operation, n over sliding windows, for a stream or a table; the watermark drops state of closed windows."""
    timed = log.withColumn("at", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("at", late) if log.isStreaming else timed
    counted = timed.groupBy(F.window("at", window, slide).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.unix_micros("w.start").alias("start_us"), "event_type", "n")


def ingest(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Run step(batch, batch id) for each micro-batch: all there is, once, or every interval."""
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def batch_path(root: str, batch: int) -> str:
    """Where a batch's rows go: the same place if the batch is repeated, so that a repeat overwrites itself."""
    return f"{root}/batch={batch}"


def once(log: DataFrame, keys: list[str], late: str) -> DataFrame:
    """Rows of a stream without repeats of a key that come within the watermark's time of each other."""
    return log.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late).dropDuplicatesWithinWatermark(keys)


def closed_windows(log: DataFrame, window: str, late: str) -> DataFrame:
    """start_us, event_type, n of windows that the watermark has closed; rows of a closed window are dropped.

    The stream is in append mode: a window is given once, when nothing can change it any more.
    """
    timed = log if "at" in log.columns else log.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    counted = timed.groupBy(F.window("at", window).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.unix_micros("w.start").alias("start_us"), "event_type", "n")


def sessions(log: DataFrame, gap: str, late: str) -> DataFrame:
    """user_id, start_us, end_us, n of runs of a user's events with less than a gap between them, once they are over."""
    timed = log.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    counted = timed.groupBy("user_id", F.session_window("at", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("user_id", F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "n")


#: Partitions of state for each core. Each opens and commits a store in every batch, which costs more than few rows do.
STORES = 2


@contextmanager
def stores(spark: SparkSession) -> Iterator[None]:
    """Streams that are first started inside deal their state to STORES partitions a core, or to the session's, if fewer."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), STORES * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append_runs(slices: list[DataFrame], build: Callable[[DataFrame], DataFrame], folder: str, *, die_in: int | None = None) -> str:
    """Let a stream over a folder see slices one after the other, each in a run of its own that starts from the checkpoint
    of the one before; returns where its rows are. die_in: a run that dies after it wrote its rows, and is started again.
    """
    spark = slices[0].sparkSession
    out = f"{folder}/out"
    for k, part in enumerate(slices):
        part.write.mode("append").parquet(f"{folder}/in")

        def step(batch: DataFrame, n: int) -> None:
            batch.write.mode("overwrite").parquet(batch_path(out, n))
            if dies and not batch.isEmpty():
                raise RuntimeError("killed")

        for dies in ([True, False] if k == die_in else [False]):
            stream = spark.readStream.schema(part.schema).parquet(f"{folder}/in")
            with stores(spark):
                query = build(stream).writeStream.outputMode("append").foreachBatch(step).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
            try:
                query.awaitTermination()
            except StreamingQueryException:
                if not dies:
                    raise
    return out
