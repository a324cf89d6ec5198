"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.staging import shared_folder as shared_dir
from paperloom.operators.staging import staged as stage_table
from paperloom.session import workers as ready

__all__ = ["free_name", "ready", "release", "shared_dir", "stage_table", "table", "without_ids", "words"]

#: A-Z become a-z; every other byte under 0x80 that is no digit or letter ends a word. Bytes of
#: UTF-8 sequences stay, so this is the class [^\x00-\x2F\x3A-\x60\x7B-\x7F] over code points.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Lower-cased words of a text as UTF-8; none for null."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def release() -> None:
    """Give back what a task has freed: Spark reuses a Python worker for the next stage's tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def free_name(name: str, taken: list[str]) -> str:
    """name, with underscores after it while a column of that name is there (in any case, as Spark compares them)."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Of ids that leave a table: up to here they go to the rows, else the rows are dealt out by id.
BROADCAST_BYTES = 32 << 20


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """docs whose id is not in the one column of ids; a null id is no member.

    The ids are written to the shared folder and measured before they are broadcast.
    """
    gone = stage_table(ids.toDF("__gone").dropna().distinct(), "gone")
    few = gone.count() * 32 <= BROADCAST_BYTES
    return docs.join(F.broadcast(gone) if few else gone, docs[id_col] == gone["__gone"], "left_anti")
