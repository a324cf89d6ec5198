"""Read analytics over nodes and their change log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StructType, VariantType

from paperloom.functions.identifiers import uuid_hex

#: Rows of a log page by default and at most.
PAGE, LONGEST_PAGE = 50, 1000


def alive(status: Column) -> Column:
    return F.coalesce(status, F.lit("")) != "deleted"


def status_counts(nodes: DataFrame, tags: str = "tags") -> DataFrame:
    """status, n of alive nodes by pipeline status, the most frequent first."""
    tag = nodes.select(F.explode(tags).alias("tag")).filter(F.col("tag").startswith("pipeline:"))
    return tag.groupBy(F.expr("substring(tag, 10)").alias("status")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "status")


def log_filter(log: DataFrame, *, since: str | None = None, now: Column | None = None, **equal: str | int | None) -> DataFrame:
    """Rows that meet all given equalities and the bound: digits are seconds back (strict), else a first moment."""
    for column, value in equal.items():
        if value not in (None, ""):
            log = log.filter(F.col(column) == value)
    if since:
        if since.isdigit():
            log = log.filter(F.col("ts") > now - F.make_dt_interval(secs=F.lit(int(since))))
        else:
            log = log.filter(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    return log


def page(log: DataFrame, limit: int = PAGE) -> DataFrame:
    """The latest rows; a page holds LONGEST_PAGE at most, and a negative limit is refused."""
    if limit < 0:
        raise ValueError("limit must not be negative")
    return log.orderBy(F.desc("ts"), F.desc("event_id")).limit(min(limit, LONGEST_PAGE))


def find_nodes(nodes: DataFrame, *, text: str | None = None, tag: str | None = None, columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Nodes whose columns (title and abstract, if none are named) hold a text in any case, and that carry a tag."""
    if text:
        hit = F.lit(False)
        for c in columns or ["title", "abstract"]:
            hit = hit | F.coalesce(F.contains(F.lower(c), F.lit(text.lower())), F.lit(False))
        nodes = nodes.filter(hit)
    if tag:
        nodes = nodes.filter(F.array_contains("tags", tag))
    return nodes if limit is None else nodes.limit(limit)


def _holds(c: Column, kind: DataType, test: Callable[[Column], Column]) -> Column:
    """Whether a test finds something in a value or in any value inside it; names of fields and keys are no values."""
    if isinstance(kind, StructType):
        hit = F.lit(False)
        for f in kind:
            hit = hit | _holds(c.getField(f.name), f.dataType, test)
        return hit
    if isinstance(kind, MapType):
        return _holds(F.map_values(c), ArrayType(kind.valueType), test)
    if isinstance(kind, ArrayType):
        return F.coalesce(F.exists(c, lambda x: _holds(x, kind.elementType, test)), F.lit(False))
    if isinstance(kind, VariantType):
        # Scalars as JSON writes them, one after the other, without the names before them.
        inside = F.regexp_extract_all(F.to_json(c), F.lit(r'"(?:[^"\\]|\\.)*+"\s*:|("(?:[^"\\]|\\.)*+"|[-+.0-9a-zA-Z]++)'), 1)
        text = F.transform(F.filter(inside, lambda x: x != ""), lambda x: F.when(x.startswith('"'), F.from_json(F.concat(F.lit('{"x":'), x, F.lit("}")), "x string")["x"]).otherwise(x))
        return F.coalesce(F.exists(F.filter(text, lambda x: x.isNotNull()), test), F.lit(False))
    if isinstance(kind, BinaryType):
        return F.lit(False)
    return F.coalesce(test(c.cast("string")), F.lit(False))


def grep(rows: DataFrame, needle: str, *, regex: bool = False, ignore_case: bool = False) -> DataFrame:
    """Rows with a value, at any depth of any column, that holds a text or matches a regular expression.

    Values are searched as they are, not as JSON writes them: quotes and line feeds are found, names are not.
    """
    if regex:
        test = lambda c: c.rlike(f"(?i){needle}" if ignore_case else needle)
    elif ignore_case:
        test = lambda c: F.contains(F.lower(c), F.lit(needle.lower()))
    else:
        test = lambda c: F.contains(c, F.lit(needle))
    hit = F.lit(False)
    for f in rows.schema:
        hit = hit | _holds(F.col(f"`{f.name}`"), f.dataType, test)
    return rows.filter(hit)


def get_node(nodes: DataFrame, name: str) -> DataFrame:
    """The node of a slug, or of a uuid with or without dashes."""
    by_uuid = uuid_hex(F.col("uuid")) == name.replace("-", "").lower()
    return nodes.filter((F.col("slug") == name) | by_uuid)


def by_title(nodes: DataFrame) -> DataFrame:
    return nodes.orderBy("title", "id")


def scalar_counts(nodes: DataFrame, edges: DataFrame, log: DataFrame) -> DataFrame:
    """alive, deleted, edges, refs, mutations: one row, of one pass over each table."""
    kept = alive(F.col("status"))
    n = nodes.agg(F.count_if(kept).alias("alive"), F.count_if(~kept).alias("deleted"))
    e = edges.agg(F.count(F.lit(1)).alias("edges"), F.count_if(F.col("relationship") == "references").alias("refs"))
    return n.join(e, F.lit(True)).join(log.agg(F.count(F.lit(1)).alias("mutations")), F.lit(True))


def recent(log: DataFrame, spans: dict[str, int], now: Column | None = None) -> DataFrame:
    """One row: for each name, the mutations of its last seconds before now, or before the log's last moment."""
    clock = log.agg((F.max("ts") if now is None else F.max(now)).alias("__t"))
    ago = lambda s: F.count_if(F.col("ts") > F.col("__t") - F.make_dt_interval(secs=F.lit(s)))
    return log.select("ts").join(F.broadcast(clock), F.lit(True)).agg(*[ago(s).alias(name) for name, s in spans.items()])


def last_mutation(log: DataFrame) -> DataFrame:
    """The latest row; of several, the one with the largest id."""
    return log.agg(F.max_by(F.struct("*"), F.struct("ts", "event_id")).alias("b")).select("b.*")


def lenient_json(text: Column) -> Column:
    """The JSON's canonical text where it parses, else the text as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(text)), text)
