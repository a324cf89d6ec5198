"""A table in buckets by the hash of its key, of which a change rewrites only the buckets that it touches.

A version is a list of buckets and where each lies; a bucket that a change leaves alone lies where it lay. Files are never
overwritten, so readers keep the version that they began with, and a writer that dies leaves nothing but files that no
version names. Versions are claimed one by one: of two writers that began with the same version one is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.staging import hadoop_path

BUCKETS = 64
_VERSION = "bucket int, path string, buckets int, key string, schema string"


class Conflict(RuntimeError):
    """Another writer made the version that this one wanted to make."""


@dataclass(frozen=True)
class Version:
    """A version's number and, by bucket, where its rows lie; buckets without rows have no place."""

    root: str
    number: int
    paths: dict[int, str]
    buckets: int
    key: str
    schema: str

    def read(self, spark: SparkSession, only: list[int] | None = None) -> DataFrame:
        """The rows, of some buckets only if they are named."""
        named = [p for b, p in sorted(self.paths.items()) if only is None or b in only]
        kind = spark.createDataFrame([], self.schema).schema
        return spark.read.schema(kind).parquet(*named) if named else spark.createDataFrame([], kind)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def latest(spark: SparkSession, root: str) -> Version:
    """The newest whole version."""
    files, folder = hadoop_path(spark, f"{root}/versions")
    numbers = [int(s.getPath().getName().removeprefix("v=")) for s in files.listStatus(folder)] if files.exists(folder) else []
    for n in sorted(numbers, reverse=True):
        files, done = hadoop_path(spark, f"{root}/versions/v={n}/_SUCCESS")
        if files.exists(done):
            # A row for each bucket.
            rows = spark.read.schema(_VERSION).json(f"{root}/versions/v={n}").collect()
            return Version(root, n, {r.bucket: r.path for r in rows if r.path}, rows[0].buckets, rows[0].key, rows[0].schema)
    raise FileNotFoundError(f"no version at {root}")


def _commit(spark: SparkSession, version: Version) -> Version:
    """Claim the version's number, which fails if it is taken, then write what it names."""
    files, claim = hadoop_path(spark, f"{version.root}/claims/{version.number}")
    if not files.createNewFile(claim):
        raise Conflict(f"version {version.number} of {version.root} is taken")
    rows = [(b, version.paths.get(b), version.buckets, version.key, version.schema) for b in range(version.buckets)]
    spark.createDataFrame(rows, _VERSION).coalesce(1).write.mode("error").json(f"{version.root}/versions/v={version.number}")
    return version


def _write(df: DataFrame, root: str, key: str, buckets: int) -> dict[int, str]:
    """Rows written by bucket, to a new place; the buckets that got some."""
    place = f"{root}/data/{uuid.uuid4().hex}"
    dealt = df.withColumn("__bucket", bucket_of(F.col(key), buckets)).repartition("__bucket")
    dealt.write.partitionBy("__bucket").parquet(place)
    files, folder = hadoop_path(df.sparkSession, place)
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return {int(n.removeprefix("__bucket=")): f"{place}/{n}" for n in names if n.startswith("__bucket=")}


def create(df: DataFrame, root: str, key: str, buckets: int = BUCKETS) -> Version:
    """Version 0 of a new table."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return _commit(df.sparkSession, Version(root, 0, _write(df, root, key, buckets), buckets, key, schema))


def change(spark: SparkSession, base: Version, keys: DataFrame, how: Callable[[DataFrame], DataFrame]) -> tuple[Version, int]:
    """(the next version, buckets rewritten): how() of the rows in the buckets of keys (one column), all others as they are.

    how() gives all rows that these buckets have from now on. If another version followed base meanwhile, Conflict is
    raised and nothing changes; the caller may begin again with latest().
    """
    one = keys.toDF("__key").select(bucket_of(F.col("__key"), base.buckets).alias("b")).distinct()
    touched = sorted(r.b for r in one.collect())  # at most as many as there are buckets
    if not touched:
        return base, 0
    made = how(base.read(spark, touched))
    written = _write(made, base.root, base.key, base.buckets)
    if stray := set(written) - set(touched):
        raise ValueError(f"rows of buckets that were not touched: {sorted(stray)}")
    kept = {b: p for b, p in base.paths.items() if b not in touched}
    return _commit(spark, Version(base.root, base.number + 1, kept | written, base.buckets, base.key, base.schema)), len(touched)
