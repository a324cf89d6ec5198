"""Enrichment of records from several catalogs: each is asked only for the rows that still need it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import tags as T
from paperloom.functions.identifiers import bare_id, blank_to_null
from paperloom.functions.text import MATCHED, norm_title, token_sort_ratio
from paperloom.operators.records import keyword_floor
from paperloom.operators.staging import staged

#: What a record has one of, and what it has lists of.
SCALARS = ("title", "doi", "pmid", "s2_id", "abstract", "year", "venue")
LISTS = ("authors", "alt_dois", "fields", "types", "mesh", "keywords", "mesh_major", "mesh_qualifiers")
#: What an article adds to, where a record may come from, and the error of one without a title.
ARTICLE_LISTS = ("mesh", "keywords", "mesh_major", "mesh_qualifiers", "types")
INPUT, BULK, ARTICLE, PAPER, WORK = "input-only", "s2-batch", "pubmed", "semantic-scholar", "crossref"
NO_TITLE = "Could not resolve a title for the reference"

_LIST = "array<string>"


@dataclass(frozen=True)
class Catalogs:
    """Tables of answers. bulk, papers and works: doi, at, record; articles: pmid, at, record; hits: term, rank, pmid.

    Of several records for a key the one with the largest `at` stands. A record holds those of SCALARS and LISTS that the
    catalog has; bulk may hold `citations` too.
    """

    bulk: DataFrame
    hits: DataFrame
    articles: DataFrame
    papers: DataFrame
    works: DataFrame


def ask(rows: DataFrame, name: str, table: DataFrame, key: Column) -> DataFrame:
    """rows with `answer`, the table's record (key, at, record) for the key that a row asks with; null asks nothing.

    Only records that are asked for are read on, each key's once, so a key that repeats in the table multiplies no rows.
    Rows that ask nothing get keys of their own, which match nothing and lie anywhere. The result is written: asking twice
    of one plan would run all steps before it twice. `asked` lists whom a row asked.
    """
    rows = rows.withColumn("__ask", key)
    wanted = rows.filter("__ask is not null").select(F.col("__ask").alias("__key")).distinct()
    found = table.toDF("__key", "__at", "answer").join(wanted, "__key", "left_semi").groupBy("__key").agg(F.max_by("answer", "__at").alias("answer"))
    dealt = rows.withColumn("__key", F.coalesce("__ask", F.concat(F.lit("\u0000"), F.monotonically_increasing_id().cast("string"))))
    out = dealt.join(found, "__key", "left").drop("__key")
    asked = F.when(F.col("__ask").isNotNull(), F.array_append("asked", F.lit(name))).otherwise(F.col("asked"))
    return staged(out.withColumn("asked", asked).withColumnRenamed("__ask", "ask"), "asked")


def _has(table: DataFrame) -> set[str]:
    return set(table.schema["record"].dataType.names)


def _fill(rows: DataFrame, has: set[str], columns: tuple[str, ...], use: Column, **instead: Column) -> DataFrame:
    """rows with columns filled from the answer where they are missing, in rows that may use it."""
    values = {c: instead.get(c, F.col(f"answer.{c}")) for c in columns if c in has or c in instead}
    return rows.withColumns({c: F.when(use, T.merge_missing(F.col(c), v, array=c in LISTS)).otherwise(F.col(c)) for c, v in values.items()})


def _extend(rows: DataFrame, has: set[str], columns: tuple[str, ...], use: Column) -> DataFrame:
    none = F.array().cast(_LIST)
    return rows.withColumns({c: F.when(use, T.ordered_union(F.col(c), F.coalesce(F.col(f"answer.{c}"), none))).otherwise(F.col(c)) for c in columns if c in has})


def _promote(rows: DataFrame, has: set[str], use: Column) -> DataFrame:
    """The catalog's own identifier is the record's from now on; the old one stays as an alternative."""
    if "doi" not in has:
        return rows
    doi, alternatives = T.canonical_promote(F.col("doi"), F.col("alt_dois"), F.col("answer.doi"))
    return rows.withColumns({"doi": F.when(use, doi).otherwise(F.col("doi")), "alt_dois": F.when(use, alternatives).otherwise(F.col("alt_dois"))})


def _origin(rows: DataFrame, name: str, use: Column, *, always: bool = False) -> DataFrame:
    fresh = use if always else use & (F.col("source") == INPUT)
    return rows.withColumn("source", F.when(fresh, name).otherwise(F.col("source")))


def same_title(known: Column, found: Column) -> Column:
    """Whether two titles are near enough to be one work's; a title that is missing on either side objects to nothing."""
    a, b = F.nullif(norm_title(known), F.lit("")), norm_title(found)
    ratio = token_sort_ratio(F.when(T.is_missing(found), F.lit(None).cast("string")).otherwise(a), b)
    return T.is_missing(found) | a.isNull() | (ratio >= MATCHED)


def resolve(items: DataFrame, catalogs: Catalogs) -> DataFrame:
    """items (parsed: any of SCALARS, authors, keywords, and other columns, which stay) as resolved records.

    Asked in turn: the bulk answers, by identifier; the articles of what they found; then, only for rows that the bulk
    didn't know or that lack a title, id, authors, year, venue or abstract: the search and its article, whose title has to
    match where it was searched; the paper; and the work, where the item named no identifier or there still is no title.
    New columns: source, asked, cited (the bulk's citations), errors (null where there is a title).
    """
    out = items.withColumns({c: F.lit(None).cast("string") for c in SCALARS if c not in items.columns} | {c: F.lit(None).cast(_LIST) for c in LISTS if c not in items.columns})
    out = out.withColumns({f"__{c}": F.col(c) for c in ("doi", "pmid", "title", "keywords")})
    none = F.array().cast(_LIST)
    out = out.withColumns({c: none if c == "keywords" else F.coalesce(F.col(c), none) for c in LISTS} | {"source": F.lit(INPUT), "asked": none, "__row": F.monotonically_increasing_id()})

    out = ask(out, "bulk", catalogs.bulk.select("doi", "at", "record"), bare_id(F.col("__doi")))
    has, use = _has(catalogs.bulk), F.col("answer").isNotNull()
    out = out.withColumn("__bulk", use)
    # Lists of citations are long: they wait where they were written, and no later answer's table holds them again.
    cited = out.filter("answer.citations is not null").select("__row", F.col("answer.citations").alias("cited")) if "citations" in has else None
    out = _fill(out, has, (*SCALARS, "authors"), use)
    out = _extend(_promote(out, has, use), has, ("fields", "types"), use)
    told = F.coalesce(*[blank_to_null(F.col(f"answer.{c}")) for c in ("title", "doi", "pmid", "s2_id", "abstract") if c in has], F.lit(None).cast("string"))
    out = _origin(out, BULK, told.isNotNull())
    own = F.coalesce(blank_to_null(F.col("answer.pmid")), F.col("pmid")) if "pmid" in has else F.col("pmid")
    out = out.withColumn("__pmid_of", F.when(F.col("__bulk"), blank_to_null(own))).drop("answer", "ask")

    articles, has = catalogs.articles.select("pmid", "at", "record"), _has(catalogs.articles)
    out = ask(out, "bulk-article", articles, F.col("__pmid_of"))
    use = F.col("answer").isNotNull()
    own = F.coalesce(F.col("answer.pmid"), F.col("ask")) if "pmid" in has else F.col("ask")
    out = _extend(_fill(out, has, ("abstract", "pmid"), use, pmid=own), has, ARTICLE_LISTS, use).drop("answer", "ask")

    gaps = T.is_missing(F.col("authors"), array=True) | T.is_missing(F.col("year"))
    for c in ("title", "s2_id", "venue", "abstract"):
        gaps = gaps | blank_to_null(F.col(c)).isNull()
    out = out.withColumn("__open", ~F.col("__bulk") | gaps)
    term = F.coalesce(bare_id(F.col("__doi")), F.lower(blank_to_null(F.col("__title"))))
    out = ask(out, "search", catalogs.hits.select("term", (-F.col("rank")).alias("at"), "pmid"), F.when(F.col("__open") & F.col("__pmid").isNull(), term))
    out = out.withColumn("__found", F.col("answer")).drop("answer", "ask")

    out = ask(out, "article", articles, F.when(F.col("__open"), F.coalesce("__pmid", "__found")))
    searched, fetched = F.col("__pmid").isNull() & F.col("answer").isNotNull(), F.col("answer.title") if "title" in has else F.lit(None).cast("string")
    known = F.coalesce(blank_to_null(F.col("title")), F.col("__title"))
    # Only titles that have to be compared go to the workers.
    fits = same_title(F.when(searched, known), F.when(searched, fetched))
    out = out.withColumn("__fits", fits)
    use = F.col("answer").isNotNull() & F.col("__fits")
    own = F.coalesce(F.col("answer.pmid"), F.col("ask")) if "pmid" in has else F.col("ask")
    out = _fill(out, has, ("title", "doi", "pmid", "abstract", "authors", "year", "venue"), use, pmid=own)
    out = _origin(_extend(out, has, ARTICLE_LISTS, use), ARTICLE, use, always=True).drop("answer", "ask", "__fits")

    out = ask(out, "paper", catalogs.papers.select("doi", "at", "record"), F.when(F.col("__open"), bare_id(F.col("doi"))))
    has, use = _has(catalogs.papers), F.col("answer").isNotNull()
    out = _fill(out, has, (*SCALARS, "authors"), use)
    out = _origin(_extend(_promote(out, has, use), has, ("fields", "types"), use), PAPER, use).drop("answer", "ask")

    late = F.col("__doi").isNull() | blank_to_null(F.col("title")).isNull()
    out = ask(out, "work", catalogs.works.select("doi", "at", "record"), F.when(F.col("__open") & late, bare_id(F.col("doi"))))
    has, use = _has(catalogs.works), F.col("answer").isNotNull()
    out = _fill(out, has, ("title", "doi", "authors", "year", "venue", "abstract"), use)
    out = _origin(_extend(out, has, ("keywords",), use), WORK, use).drop("answer", "ask")

    clean = {c: blank_to_null(F.col(c)) for c in ("title", "pmid", "s2_id", "abstract", "venue")} | {"doi": bare_id(F.col("doi"))}
    out = out.withColumns(clean | {"keywords": keyword_floor(F.col("keywords"), F.col("__keywords"))})
    out = out.withColumn("resolve_error", F.when(F.col("title").isNull(), F.lit(NO_TITLE)))
    out = out.withColumn("cited", F.lit(None)) if cited is None else out.join(cited, "__row", "left")
    return out.select(*[c for c in out.columns if not c.startswith("__")])


def asked_rows(resolved: DataFrame) -> DataFrame:
    """source, n: how many rows asked each catalog."""
    return resolved.select(F.explode("asked").alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
