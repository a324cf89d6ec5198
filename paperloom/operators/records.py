"""Parsing, enrichment, upsert and state of bibliographic records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from paperloom.functions import tags as T
from paperloom.functions.identifiers import bare_id, blank_to_null, coerce_year, strip
from paperloom.functions.text import citation_string
from paperloom.operators.identity import in_order
from paperloom.operators.staging import numbered
from paperloom.schemas import RAW_ITEM

LEAST_TITLE = 10
NO_KEY = "provide a doi, a pmid or a title of ten characters"


def parse(items: DataFrame) -> DataFrame:
    """Raw items with blank fields null, identifiers bare, and errors for those with nothing to be found by."""
    text = {c: blank_to_null(F.col(c)) for c in ("title", "pmid", "abstract", "year", "venue") if c in items.columns}
    rows = items.withColumns(text | {"doi": bare_id(F.col("doi"))})
    found = F.col("doi").isNotNull() | F.col("pmid").isNotNull() | (F.length("title") >= LEAST_TITLE)
    error = F.when(~F.coalesce(found, F.lit(False)), F.array(F.lit(NO_KEY))).otherwise(F.array().cast("array<string>"))
    return rows.withColumn("errors", error)


def is_array(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, ArrayType)


def bulk_lookup(items: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """Left join of items to a catalog by key, each distinct key looked up once; of repeated entries the last stands.

    The catalog brings (key, idx, entry struct); the result is items with `entry`, null where nothing was found.
    """
    last = catalog.filter(F.col("entry").isNotNull()).groupBy(key).agg(F.max_by("entry", "idx").alias("entry"))
    return items.join(last, key, "left")


def waterfall(base: DataFrame, sources: list[tuple[str, DataFrame]], key: str, columns: list[str], *, order: str | None = None) -> DataFrame:
    """base with columns filled from each source in turn where still missing, and the origin of the first that helped.

    Missing is null, the empty string or the empty list; what a source lacks fills nothing. Of several rows of a source for
    a key the one with the largest `order` stands, or the largest by its columns; none multiplies rows of base.
    """
    lists = {c: is_array(base, c) for c in columns}
    out = base.withColumn("origin", F.lit("input-only"))
    for name, source in sources:
        values = F.struct(*columns)
        one = source.groupBy(key).agg((F.max_by(values, order) if order else F.max(values)).alias("__v"))
        out = out.join(one.select(key, *[F.col(f"__v.{c}").alias(f"__{c}") for c in columns]), key, "left")
        helped = F.lit(False)
        for c in columns:
            helped = helped | (T.is_missing(F.col(c), array=lists[c]) & ~T.is_missing(F.col(f"__{c}"), array=lists[c]))
        out = out.withColumn("origin", F.when(helped & (F.col("origin") == "input-only"), name).otherwise(F.col("origin")))
        filled = {c: T.merge_missing(F.col(c), F.col(f"__{c}"), array=lists[c]) for c in columns}
        out = out.withColumns(filled).drop(*[f"__{c}" for c in columns])
    return out


def needs_enrichment(prefetched: Column, title: Column, s2_id: Column, authors: Column, year: Column, venue: Column, abstract: Column) -> Column:
    gaps = T.is_missing(s2_id) | T.is_missing(authors, array=True) | T.is_missing(year) | T.is_missing(venue) | T.is_missing(abstract)
    return ~prefetched | T.is_missing(title) | gaps


def keyword_floor(found: Column, own: Column) -> Column:
    """The record's own keywords only where enrichment found none."""
    none = F.array().cast("array<string>")
    return F.when(F.size(F.coalesce(found, none)) == 0, F.coalesce(own, none)).otherwise(found)


def citation_items(raw: Column) -> Column:
    """Items of a cited list that have an identifier or a title: identifiers bare, ids trimmed, years of digits only."""
    made = F.transform(
        F.filter(raw, lambda x: x.isNotNull()),
        lambda x: F.struct(
            F.nullif(F.lower(strip(x["doi"])), F.lit("")).alias("doi"), blank_to_null(x["pmid"]).alias("pmid"), F.lit(None).cast("string").alias("s2_id"),
            blank_to_null(x["title"]).alias("title"), coerce_year(x["year"]).alias("year"),
        ),
    )
    return F.filter(made, lambda x: x["doi"].isNotNull() | x["title"].isNotNull())


def kept_citations(stored: Column, incoming: Column) -> tuple[Column, Column]:
    """(items, side): an empty list never replaces one with items; otherwise incoming replaces stored."""
    none = lambda c: c.isNull() | (F.size(c) == 0)
    holds = none(incoming) & ~none(stored)
    return F.when(holds, stored).otherwise(incoming), F.when(holds, "stored").otherwise("incoming")


#: Columns of an incoming record that its tags are made of, beside s2_id, pmid and year.
TOPICS = ("fields", "types", "mesh", "keywords", "mesh_major", "mesh_qualifiers")


def one_per_key(incoming: DataFrame, key: str, first: list[str], last: list[str], order: str) -> DataFrame:
    """One row per key as if the rows were merged in order: of `first` columns the first value stands, of `last` the last."""
    here = lambda c: F.when(~T.is_missing(F.col(c), array=is_array(incoming, c)), F.col(order))
    columns = [*[F.min_by(c, here(c)).alias(c) for c in first], *[F.max_by(c, here(c)).alias(c) for c in last]]
    return incoming.groupBy(key).agg(*columns)


def upsert(
    nodes: DataFrame, incoming: DataFrame, key: str, fill: list[str], replace: list[str], *, order: str | None = None, tags: str | None = None,
) -> DataFrame:
    """The next snapshot: a full outer join by key; `fill` columns keep what is stored, `replace` columns take the new.

    Rows of one key are merged first, in the order of a column (any order, if none is named). With `tags`, the tags of a
    key that came in are derived anew from the incoming topics (columns TOPICS, s2_id, pmid, year; those that are there)
    and, where it brings no identifier, from the node's own. Column `created` tells new rows. Writing the snapshot is the
    caller's, to a new version, never over the old one.
    """
    made = [c for c in (*TOPICS, "s2_id", "pmid", "year") if c in incoming.columns and c not in (*fill, *replace)] if tags else []
    rows = incoming if order else incoming.withColumn("__at", F.lit(0))
    new = one_per_key(rows, key, [*fill, *made], replace, order or "__at")
    old = nodes.select(key, *[F.col(c).alias(f"__o_{c}") for c in [*fill, *replace, *([tags] if tags else [])]], F.lit(True).alias("__old"))
    new = new.select(key, *[F.col(c).alias(f"__n_{c}") for c in [*fill, *made, *replace]], F.lit(True).alias("__new"))
    both = old.join(new, key, "full_outer")
    lists = {c: is_array(nodes, c) for c in [*fill, *replace]}
    filled = {c: T.merge_missing(F.col(f"__o_{c}"), F.col(f"__n_{c}"), array=lists[c]) for c in fill}
    # An incoming row without a value for a column says nothing about it.
    taken = {c: F.when(~T.is_missing(F.col(f"__n_{c}"), array=lists[c]), F.col(f"__n_{c}")).otherwise(F.col(f"__o_{c}")) for c in replace}
    out = [key, *[v.alias(k) for k, v in (filled | taken).items()]]
    if tags:
        seen = lambda c: F.col(f"__n_{c}") if c in [*fill, *made, *replace] else F.lit(None).cast("string")
        own = lambda c: filled[c] if c in fill else F.lit(None).cast("string")
        topics = T.Topics(*[F.col(f"__n_{c}") if c in made else F.array().cast("array<string>") for c in TOPICS])
        fresh = T.derive_tags(F.col(f"__o_{tags}"), seen("s2_id"), seen("pmid"), seen("year"), topics, own_s2_id=own("s2_id"), own_pmid=own("pmid"))
        out.append(F.when(F.col("__new"), fresh).otherwise(F.col(f"__o_{tags}")).alias(tags))
    return both.select(*out, F.col("__old").isNull().alias("created"))


def annotations(nodes: DataFrame, key: str, note: Column, day: Column) -> DataFrame:
    """Dated notes, one for each row; they are appended, never replaced."""
    return nodes.select(F.col(key).alias("node_id"), F.concat(F.lit("["), day, F.lit("] "), note).alias("content"))


def normalized_items(items: DataFrame, item: str = "item") -> DataFrame:
    """Batch items as JSON, each a string (an identifier) or an object (a record), as raw items; others have an error.

    All else that items holds is kept.
    """
    v = F.try_parse_json(item)
    kind = F.schema_of_variant(v)
    text = lambda name: F.try_variant_get(v, f"$.{name}", "string")
    doi = F.when(kind == "STRING", F.try_variant_get(v, "$", "string")).otherwise(text("doi"))
    strings = lambda name: F.try_variant_get(v, f"$.{name}", "array<string>")
    wrong = F.concat(F.lit("a batch item has to be a string or an object, not "), F.coalesce(kind, F.lit("broken JSON")))
    ok = F.coalesce((kind == "STRING") | kind.startswith("OBJECT"), F.lit(False))
    columns = {"doi": doi} | {c: text(c) for c in ("pmid", "title", "abstract", "year", "venue")} | {c: strings(c) for c in ("authors", "keywords")}
    return items.withColumns(columns | {"item_error": F.when(~ok, wrong)})


def single_item(spark: SparkSession, *, doi: str | None = None, pmid: str | None = None, title: str | None = None) -> DataFrame:
    """A batch of one raw item."""
    return spark.createDataFrame([(0, title, doi, pmid, None, None, None, None, None)], RAW_ITEM)


def candidates(parts: list[DataFrame], names: list[str]) -> DataFrame:
    """Rows of several scans in their order, without those that carry a name (id, uuid, slug) of one kept before.

    Column `place` tells the scan. A row that is left out keeps nobody else out; one without names always stays.
    """
    rows = parts[0].withColumn("place", F.lit(0))
    for k, part in enumerate(parts[1:], 1):
        rows = rows.unionByName(part.withColumn("place", F.lit(k)))
    rows = numbered(rows, "place", *names).withColumnRenamed("idx", "__at")
    kept = in_order(rows, "__at", [("name", blank_to_null(F.col(c).cast("string"))) for c in names])
    return rows.join(kept.filter("created").select("__at"), "__at", "left_semi").drop("__at")


def backfill(
    nodes: DataFrame, statuses: list[str], chunk_size: int, ingest: Callable[[DataFrame], DataFrame], *, limit: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(summary, outcomes) of nodes (id, uuid, slug, tags and the rest) with one of the statuses, ingested in chunks.

    Rows whose identifier can't be found are skipped and counted. A chunk size of 0 or less is refused where there is
    something to do. ingest takes raw items with a column `chunk` and gives outcomes.
    """
    found = candidates([nodes.filter(T.has_status(F.col("tags"), s)) for s in statuses], ["id", "uuid", "slug"])
    found = found if limit is None else found.orderBy("place", "id").limit(limit)
    reference = F.col("metadata.reference")
    found = found.withColumn("doi", doi_precedence(F.col("uri"), reference["doi"], F.col("tags")))
    todo = found.filter(F.col("doi").isNotNull() | reference["pmid"].isNotNull() | (F.length("title") >= LEAST_TITLE))
    skipped = found.count() - todo.count()
    if chunk_size <= 0 and todo.limit(1).count():
        raise ValueError("chunk size must be positive")
    items = numbered(todo, "place", "id").withColumn("chunk", F.floor(F.col("idx") / max(1, chunk_size)))
    outcomes = ingest(items)
    return backfill_summary(outcomes).withColumn("skipped", F.lit(skipped).cast("long")), outcomes


def verify(outcomes: DataFrame, nodes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """key, node_exists, has_citations, status, n_edges of every outcome."""
    n = edges.groupBy(key).agg(F.count(F.lit(1)).alias("n_edges"))
    found = nodes.select(key, F.lit(True).alias("there"), "has_citations", "status")
    out = outcomes.select(key).join(found, key, "left").join(n, key, "left")
    return out.select(
        key, F.coalesce("there", F.lit(False)).alias("node_exists"), F.coalesce("has_citations", F.lit(False)).alias("has_citations"),
        "status", F.coalesce("n_edges", F.lit(0)).cast("long").alias("n_edges"),
    )


def raw_from_node() -> list[Column]:
    """A node as a raw item again."""
    m = F.col("metadata.reference")
    return [
        F.col("title"), F.coalesce(blank_to_null(F.col("uri")), m["doi"]).alias("doi"), m["pmid"].alias("pmid"), F.col("abstract"),
        m["authors"].alias("authors"), m["year"].alias("year"), m["venue"].alias("venue"),
    ]


def doi_precedence(uri: Column, doi: Column, tags: Column) -> Column:
    """Identifier of a node: its address, else its record's, else its first valid tag."""
    from_tag = F.get(F.filter(F.transform(tags, lambda t: F.when(t.startswith("doi:"), bare_id(t))), lambda d: d.isNotNull() & d.startswith("10.")), F.lit(0))
    valid = lambda c: F.when(bare_id(c).startswith("10."), bare_id(c))
    return F.coalesce(valid(uri), valid(doi), from_tag)


def cross_citations(items: DataFrame, batch: DataFrame) -> DataFrame:
    """source_id, n: different cited identifiers (source_id, own, doi) that are in the batch (doi) and not the source's own."""
    hits = items.filter(~F.col("doi").eqNullSafe(F.col("own"))).select("source_id", "doi").distinct()
    return hits.join(batch.select("doi").distinct(), "doi", "left_semi").groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))


def phase_metrics(phases: DataFrame, phase: str, seconds: str) -> DataFrame:
    """phase, wall, items, per_item (0 without items) of a log with a row per item and phase."""
    wall, items = F.sum(seconds), F.count(seconds)
    return phases.groupBy(phase).agg(F.round(wall, 4).alias("wall"), items.alias("items"), F.round(F.coalesce(F.try_divide(wall, items), F.lit(0.0)), 4).alias("per_item"))


def bench_rollup(outcomes: DataFrame, by: str) -> DataFrame:
    """Sums of what was stored, linked and skipped, and links per paper to two places."""
    n = F.count(F.lit(1))
    sums = [F.sum(c).cast("long").alias(c) for c in ("stored", "linked", "skipped")]
    return outcomes.groupBy(by).agg(*sums, F.round(F.sum("linked") / n, 2).alias("per_paper"))


def write_outcomes(outcomes: DataFrame, path: str) -> None:
    """Outcomes as JSON lines beside their summary, which is written last and so tells a whole run."""
    outcomes.write.mode("error").json(f"{path}/outcomes")
    outcome_summary(outcomes).coalesce(1).write.mode("error").json(f"{path}/summary")


def append_log(rows: DataFrame, path: str) -> None:
    """Rows of a bench log, appended as JSON lines."""
    rows.write.mode("append").json(path)


def outcome_summary(outcomes: DataFrame) -> DataFrame:
    ok = F.size("errors") == 0
    return outcomes.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"),
        F.count_if("created").alias("created"), F.count_if(~F.col("created")).alias("updated"),
    )


def import_summary(outcomes: DataFrame) -> DataFrame:
    ok = F.size("errors") == 0
    return outcomes.agg(
        F.count_if(ok & F.col("created")).alias("created"), F.count_if(ok & ~F.col("created")).alias("updated"), F.count_if(~ok).alias("failed"),
        F.coalesce(F.sum("linked"), F.lit(0)).cast("long").alias("linked"),
    )


def backfill_summary(outcomes: DataFrame) -> DataFrame:
    """Counters of a backfill; an outcome with errors adds nothing to what was linked and stored."""
    ok = F.size("errors") == 0
    status = T.final_status(F.col("errors"))
    return outcomes.agg(
        F.count(F.lit(1)).alias("processed"), F.coalesce(F.sum(F.when(ok, F.col("linked"))), F.lit(0)).cast("long").alias("edges_linked"),
        F.coalesce(F.sum(F.when(ok, F.col("stored"))), F.lit(0)).cast("long").alias("citations_stored"),
        F.count_if(status == "failed").alias("failed"), F.count_if(status == "needs-review").alias("needs_review"),
        F.coalesce(F.sum(F.size("errors")), F.lit(0)).cast("long").alias("errors"),
    )


def with_citation() -> Column:
    m = F.col("metadata.reference")
    return citation_string(m["authors"], m["year"], F.col("title"), m["venue"])
