"""Line dedup by site-relative frequency.

For each host, a line's frequency is the share of the host's pages that contain it. Lines over the boilerplate
ratio, on enough pages, are dropped from all pages of that host. Lines are compared without the white space
around them, by a 128-bit hash.

Defined cases: a null text stays null; a null host is a host of its own. Blank lines are never counted or
dropped. A page on which every line goes becomes empty, unless whole copies are to be spared for a near-duplicate
operator that follows (spare_copies). Repeated rows are pages each. Lines are read whole, however long and many. All
other columns are kept, and a count whose name an input column has gets underscores after it. Empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import free_name, stage_table

RATIO = 0.07  # of a host's pages: lines above it are boilerplate
BROADCAST_BYTES = 32 << 20  # of the lines to drop, 56 bytes each
PAGES = 3  # a line on fewer pages is no boilerplate, however small the host


SPACE = " \t\n\x0b\f\r"  # trimmed from lines; a line of nothing else is blank


def _trim(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE))


def _key(trimmed: Column) -> Column:
    return F.md5(trimmed)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(docs: DataFrame, *, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, pages: int = PAGES) -> DataFrame:
    """host, line (hash), n_pages, ratio of the lines to drop. A page's line counts once and is summed before the shuffle."""
    host = F.coalesce(F.concat(F.lit("="), F.col(host_col)), F.lit("null")).alias("host")
    kept = F.filter(F.transform(_lines(F.col(text_col)), _trim), lambda x: x != "")
    seen = docs.select(host, F.explode(F.array_distinct(F.transform(kept, _key))).alias("line"))
    counted = seen.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_pages")).filter(F.col("n_pages") >= pages)
    totals = docs.select(host).groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    share = F.col("n_pages") / F.col("total")
    return counted.join(totals, "host").select("host", "line", "n_pages", share.alias("ratio")).filter(F.col("ratio") > ratio)


def strip_lines(
    docs: DataFrame, *, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, pages: int = PAGES, spare_copies: bool = False,
) -> DataFrame:
    """docs with the boilerplate lines out of their texts, and n_lines, n_dropped (long).

    A host drops at most (lines of a page / ratio) lines, so its set is one array. The arrays are written to the
    shared folder and measured: up to BROADCAST_BYTES they go to the pages, which then are not shuffled; beyond
    that both are dealt out by host, as plain exchanges of which Spark splits the hot host's.
    """
    drop = boilerplate(docs, host_col=host_col, text_col=text_col, ratio=ratio, pages=pages)
    # Names of its own, which no column of the input has.
    of, drop_of, lines_of, keys_of, gone_of, kept_of = (free_name(c, docs.columns) for c in ("host__", "drop__", "lines__", "keys__", "gone__", "kept__"))
    sets = drop.groupBy("host").agg(F.collect_list("line").alias(drop_of)).withColumnRenamed("host", of)
    host = F.coalesce(F.concat(F.lit("="), F.col(host_col)), F.lit("null"))
    sets = stage_table(sets, "boilerplate")
    few = (sets.agg(F.sum(F.size(drop_of))).first()[0] or 0) * 56 <= BROADCAST_BYTES
    rows = docs.withColumn(of, host).join(F.broadcast(sets) if few else sets, of, "left")
    lines = F.col(lines_of)
    rows = rows.withColumn(lines_of, _lines(F.col(text_col)))
    # Hosts without boilerplate, most texts of a clean corpus, skip the hashing of their lines. The page's own lines
    # that go are found by one hashed intersection; each line is then held against those alone.
    rows = rows.withColumn(keys_of, F.when(F.col(drop_of).isNotNull(), F.transform(lines, lambda x: _key(_trim(x)))))
    rows = rows.withColumn(gone_of, F.array_intersect(keys_of, drop_of))
    kept = F.when(F.size(gone_of) > 0, F.filter(lines, lambda x, i: ~F.array_contains(gone_of, F.get(keys_of, i)))).otherwise(lines)
    rows = rows.withColumn(kept_of, kept)
    if spare_copies:
        rows = rows.withColumn(kept_of, F.when(F.exists(kept_of, lambda x: _trim(x) != ""), F.col(kept_of)).otherwise(lines))
    known = F.col(text_col).isNotNull()
    n_lines, n_kept = (F.when(known, F.size(c)).otherwise(0).cast("long") for c in (lines_of, kept_of))
    out = [F.array_join(kept_of, "\n").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return rows.select(*out, n_lines.alias(free_name("n_lines", docs.columns)), (n_lines - n_kept).alias(free_name("n_dropped", docs.columns)))
