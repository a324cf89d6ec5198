"""Queries by name, each with the SQL that has to give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.session import tasks, workers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its own name."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            workers(spark)
            tasks(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def title() -> Column:
    """A document's title stands in its first line."""
    return F.get(F.split("text", "\n"), F.lit(0))


TITLE = "string_split(text, chr(10))[1]"
#: A tag list from a part: brand, type and name, with stale members, in SQL and as a column.
PART_TAGS = (
    "['type:journalarticle', 'pipeline:queued', 'kw:' || lower(p_brand), 'field:' || lower(p_type), 'note:' || p_size::VARCHAR, 'type:journal-article', 'pmid:' || p_partkey::VARCHAR]"
)


def part_tags() -> Column:
    lit = F.lit
    return F.array(
        lit("type:journalarticle"), lit("pipeline:queued"), F.concat(lit("kw:"), F.lower("p_brand")), F.concat(lit("field:"), F.lower("p_type")),
        F.concat(lit("note:"), F.col("p_size").cast("string")), lit("type:journal-article"), F.concat(lit("pmid:"), F.col("p_partkey").cast("string")),
    )
