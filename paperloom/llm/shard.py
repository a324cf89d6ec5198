"""Sharding by a two-pass external shuffle.

Pass one gives every record its shard by rendezvous hashing (the shard with the largest seeded hash of id and
shard), so one more shard takes rows only into itself, and scatters a shard's records uniformly over buckets by
another seeded hash; buckets are as many as keep each within a memory size. Pass two orders each bucket and
shuffles it by Fisher and Yates with a seed of its own; a record's slot is its place there after the rows of
the shard's earlier buckets.

Rows that are equal in all columns are counted before they are scattered, and each copy has a number that goes
into its bucket's hash; rows that share id and text alone are told apart by a hash of all their columns. So no
bucket grows with the copies of one row.

Defined cases: a null text has size 1 and the checksum of no bytes, 0. Null ids hash as the empty string.
Repeated rows get slots of their own; equal rows are alike, so either order of them is the same result. Texts of
any length stay whole; one that is longer than a bucket makes its bucket longer. Other columns are carried by
write_shards, and only told apart by assign. An input column called shard keeps its name, and the folders are then
called shard_ (with as many underscores as it takes). Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.llm.common import free_name, ready, stage_table

SHARDS = 16
#: Bytes of a bucket, what pass two holds in memory at once: those of the texts and ROW_BYTES for each row.
BUCKET_BYTES = 16 << 20
ROW_BYTES = 64
COPIES = 50_000  # of one row, made by a task


def rendezvous(key: Column, shards: int, seed: int) -> Column:
    """The shard whose seeded hash with the key is largest."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    best = F.greatest(*[F.struct(F.xxhash64(text, F.lit(seed), F.lit(j)).alias("h"), F.lit(j).alias("shard")) for j in range(shards)])
    return best["shard"]


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


KEYS = ["__id", "__size", "__crc", "__row"]


def _keys(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """Id, size and checksum of the text, and a hash of all columns (maps, which have no order, as their JSON)."""
    crc = F.crc32(F.coalesce(F.col(text_col), F.lit("")))
    plain = [F.to_json(F.struct(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema]
    return [F.col(id_col).alias("__id"), text_size(F.col(text_col)).alias("__size"), crc.alias("__crc"), F.xxhash64(*plain).alias("__row")]


def _numbered(counted: DataFrame) -> DataFrame:
    """Each row as often as its column n says, with its copy's number. Many copies are made by many tasks."""
    block = F.lit(COPIES).cast("long")
    parts = counted.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, block)))
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = parts.filter(F.col("n") <= block).unionByName(parts.filter(F.col("n") > block).repartition(tasks, "__row", "__from"))
    last = F.least(F.col("__from") + block, F.col("n")) - 1
    return parts.withColumn("__copy", F.explode(F.sequence("__from", last))).drop("n", "__from")


def _scatter(rows: DataFrame, total: int, shards: int, seed: int, bucket_bytes: int) -> DataFrame:
    """Pass one: rows (KEYS, __copy and any others) with __shard, __grown and __bucket. total: bytes of all rows."""
    buckets = max(1, -(-total // (bucket_bytes * shards)))
    return rows.select(
        "*", rendezvous(F.col("__id"), shards, seed).alias("__shard"), rendezvous(F.col("__id"), shards + 1, seed).alias("__grown"),
        F.pmod(F.xxhash64("__crc", "__row", "__copy", F.lit(seed + 1)), F.lit(buckets)).cast("long").alias("__bucket"),
    )


def _total(counted: DataFrame) -> int:
    return int(counted.agg(F.sum(F.col("n") * (F.col("__size") + ROW_BYTES))).first()[0] or 0)


def _shuffle(scattered: DataFrame, seed: int) -> DataFrame:
    """Pass two: __place, the row's place in its bucket after a Fisher-Yates shuffle. One bucket is held at a time."""

    def fisher_yates(key: tuple, bucket: pa.Table) -> pa.Table:
        start = pc.sort_indices(bucket, sort_keys=[(c, "ascending") for c in [*KEYS, "__copy"]]).to_numpy()
        n = len(start)
        order = np.arange(n)
        pick = np.random.default_rng([seed, *[k.as_py() for k in key]])
        draws = pick.integers(0, np.arange(n, 0, -1)) if n else order
        for i, d in enumerate(draws.tolist()):  # swap each place with one not yet dealt
            j = i + d
            order[i], order[j] = order[j], order[i]
        place = np.empty(n, np.int64)
        place[start[order]] = np.arange(n)
        return bucket.append_column("__place", pa.array(place))

    kinds = T.StructType([*scattered.schema, T.StructField("__place", T.LongType())])
    return scattered.groupBy("__shard", "__bucket").applyInArrow(fisher_yates, kinds)


def assign(
    docs: DataFrame, *, shards: int = SHARDS, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """id, size, text_crc32, shard, slot, grown_shard (the shard, were there one more) of every row."""
    ready(docs.sparkSession)
    counted = stage_table(docs.select(*_keys(docs, id_col, text_col)).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")), "sizes")
    scattered = _scatter(_numbered(counted), _total(counted), shards, seed, bucket_bytes)
    counts = scattered.groupBy("__shard", "__bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("__shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__shard", "__bucket", before.alias("before"))
    return _shuffle(scattered, seed).join(offsets, ["__shard", "__bucket"]).select(
        F.col("__id").alias(id_col), F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.col("__shard").alias("shard"),
        (F.col("before") + F.col("__place")).alias("slot"), F.col("__grown").alias("grown_shard"),
    )


def write_shards(
    docs: DataFrame, path: str, *, shards: int = SHARDS, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES,
) -> None:
    """Write the rows themselves as Parquet under shard=N, each file in the order of assign's slots.

    A bucket lies in one file, shuffled as in assign. Of rows that are equal in all columns one is shuffled and its
    copies are made again.
    """
    ready(docs.sparkSession)
    folder = free_name("shard", docs.columns)
    carried = [f"`{c}`" for c in docs.columns]
    rows = docs.select(*carried, *_keys(docs, id_col, text_col))
    counted = stage_table(docs.select(*_keys(docs, id_col, text_col)).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")), "sizes")
    again = stage_table(counted.filter("n > 1"), "copies")
    same = [rows[k].eqNullSafe(again[k]) for k in KEYS]
    single = rows.join(again, same, "left_anti").withColumn("__copy", F.lit(0).cast("long"))
    whole = rows.join(again, same, "left_semi").groupBy(*KEYS).agg(F.first(F.struct(*carried)).alias("__r"))
    whole = whole.join(again.withColumnsRenamed({k: f"{k}_" for k in KEYS}), [whole[k].eqNullSafe(F.col(f"{k}_")) for k in KEYS])
    copies = _numbered(whole.select("__r.*", *KEYS, "n"))
    dealt = _shuffle(_scatter(single.unionByName(copies), _total(counted), shards, seed, bucket_bytes), seed)
    out = dealt.sortWithinPartitions("__shard", "__bucket", "__place").select(F.col("__shard").alias(folder), *carried)
    out.write.partitionBy(folder).mode("error").parquet(path)
