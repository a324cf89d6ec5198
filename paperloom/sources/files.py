"""Other sources and sinks: identifier lists, graph lines, snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.identifiers import bare_id, strip

KINDS = ("node", "edge", "annotation")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Identifiers of a list with one on a line; # lines and blanks are passed over."""
    line = strip(F.col("value"))
    return spark.read.text(path).filter((line != "") & ~line.startswith("#")).select(bare_id(line).alias("doi"))


def read_id_batch(spark: SparkSession, path: str) -> DataFrame:
    """Identifiers of a JSON list of strings; anything else is an error."""
    parsed = F.from_json("value", "array<string>")
    checked = F.when(parsed.isNotNull(), parsed).otherwise(F.raise_error(F.lit("a batch has to be a JSON list of strings")))
    return spark.read.text(path, wholetext=True).select(F.explode(checked).alias("doi")).select(bare_id(F.col("doi")).alias("doi"))


def line_verdict(kind: Column, record_type: Column, operation: Column) -> Column:
    """keep, drop or fatal for a line of a graph export."""
    return F.when(kind.isin(*KINDS), "keep").when(kind.isNull() & (record_type.isNotNull() | operation.isNotNull()), "drop").otherwise("fatal")


def slim(lines: DataFrame) -> DataFrame:
    """Lines of nodes, edges and annotations; log lines go, and a line of any other kind ends the job."""
    j = F.try_parse_json("value")
    get = lambda name: F.try_variant_get(j, f"$.{name}", "string")
    verdict = line_verdict(get("kind"), get("record_type"), get("operation"))
    checked = F.when(verdict == "fatal", F.raise_error(F.concat(F.lit("not a graph line: "), F.col("value")))).otherwise(verdict)
    return lines.select("value", checked.alias("v")).filter("v = 'keep'").select("value")


def write_snapshot(df: DataFrame, root: str) -> str:
    """A new version beside the old ones; readers are pointed to it only once it is whole."""
    path = f"{root}/v={uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def chunked(idx: Column, size: int) -> Column:
    if size <= 0:
        raise ValueError("chunk size must be positive")
    return F.floor(idx / size)


#: Fixed value: how the file begins that stands for a large one which was not fetched.
POINTER = "version https://git-lfs"


def read_graph(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Nodes, edges and annotations of a graph export (JSON lines), by kind; a file that only points to one is refused."""
    lines = spark.read.text(path)
    held = F.when(F.col("value").startswith(POINTER), F.raise_error(F.lit("the export was not fetched, only its pointer"))).otherwise(F.col("value"))
    kept = slim(lines.select(held.alias("value")))
    kind = F.get_json_object("value", "$.kind")
    return {k: kept.filter(kind == k).select(F.try_parse_json("value").alias("v"), "value") for k in KINDS}


def graph_edges(lines: DataFrame) -> DataFrame:
    """id, source_id, target_id, relationship of edge lines."""
    return lines.select(*[F.try_variant_get("v", f"$.{c}", "string").alias(c) for c in ("id", "source_id", "target_id", "relationship")])


def append_rows(df: DataFrame, path: str) -> None:
    """Rows that are only ever added: annotations, log lines."""
    df.write.mode("append").json(path)


def workspace(spark: SparkSession, default: str, config: str | None = None) -> str:
    """The store's folder: the session's setting, else the line `workspace: folder` of a configuration file, else the default."""
    if named := spark.conf.get("spark.paperloom.workspace", None):
        return named
    if config:
        found = F.regexp_extract("value", r"""^\s*workspace\s*:\s*["']?([^"'#]*[^"'#\s])["']?\s*(#.*)?$""", 1)
        if line := spark.read.text(config).select(found.alias("w")).filter("w <> ''").first():
            return line[0]
    return default


def publish(df: DataFrame, root: str) -> str:
    """Write a snapshot, then mark it whole; latest() gives the last one marked, so a writer that died is not read."""
    path = write_snapshot(df, root)
    df.sparkSession.createDataFrame([(path,)], "path string").withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").json(f"{root}/_whole")
    return path


def latest(spark: SparkSession, root: str) -> DataFrame:
    marks = spark.read.schema("path string, at timestamp").json(f"{root}/_whole")
    return spark.read.parquet(marks.agg(F.max_by("path", "at")).first()[0])
