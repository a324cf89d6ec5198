"""Catalog answers: entries, references, article records, and their bulk lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import text as X
from paperloom.functions.identifiers import bare_id, blank_to_null, year_waterfall
from paperloom.functions.tags import ordered_union
from paperloom.operators.staging import numbered
from paperloom.schemas import CATALOG_ENTRY, CATALOG_REFERENCE, CATALOG_WORK

#: The most identifiers of one request, and what a failed answer is called.
CHUNK = 500
BATCH, SINGLE, FAILED = "s2-batch", "semantic-scholar", "semantic-scholar-failed"


def _no_list_of_objects(entry: Column, name: str) -> Column:
    """Whether a field of a JSON object is there, and is no list of objects. An empty list, or none, is one."""
    kind = F.schema_of_variant(F.try_variant_get(entry, f"$.{name}", "variant"))
    return kind.isNotNull() & (kind != "VOID") & ~kind.startswith("ARRAY<OBJECT") & (kind != "ARRAY<VOID>")


def malformed(raw: Column) -> Column:
    """Whether an entry as JSON is no object, or its authors or references are no lists of objects."""
    entry = F.try_parse_json(raw)
    is_object = F.coalesce(F.schema_of_variant(entry).startswith("OBJECT"), F.lit(False))
    return ~is_object | _no_list_of_objects(entry, "authors") | _no_list_of_objects(entry, "references")


def _cited(ref: Column) -> Column:
    """One reference as a citation item."""
    return F.struct(
        F.nullif(F.lower(F.trim(ref["externalIds"]["DOI"])), F.lit("")).alias("doi"), blank_to_null(ref["externalIds"]["PubMed"]).alias("pmid"),
        ref["paperId"].alias("s2_id"), blank_to_null(ref["title"]).alias("title"), ref["year"].try_cast("int").alias("year"),
    )


def _named(items: Column) -> Column:
    return F.filter(items, lambda x: x["doi"].isNotNull() | x["title"].isNotNull())


def entry_record(raw: Column) -> Column:
    """A catalog entry (JSON) as a record: fields of both lists once each, authors with a name, a year unless it is 0."""
    return X.let(F.from_json(raw, CATALOG_ENTRY), _entry)


def _entry(e: Column) -> Column:
    none = F.array().cast("array<string>")
    fields = ordered_union(none, F.concat(F.coalesce(e["fieldsOfStudy"], none), F.coalesce(F.transform(e["s2FieldsOfStudy"], lambda x: x["category"]), none)))
    authors = F.filter(F.transform(e["authors"], lambda a: a["name"]), lambda n: n.isNotNull() & (n != ""))
    refs = F.filter(F.coalesce(e["references"], F.array().cast(f"array<{CATALOG_REFERENCE}>")), lambda r: r.isNotNull())
    return F.struct(
        F.nullif(F.lower(F.trim(e["externalIds"]["DOI"])), F.lit("")).alias("doi"), e["paperId"].alias("s2_id"), e["title"].alias("title"),
        e["abstract"].alias("abstract"), F.trim(e["externalIds"]["PubMed"]).alias("pmid"), F.when(~e["year"].isin("", "0"), e["year"]).alias("year"),
        e["venue"].alias("venue"), F.coalesce(authors, none).alias("authors"), fields.alias("fields"),
        ordered_union(none, F.coalesce(e["publicationTypes"], none)).alias("types"), _named(F.transform(refs, _cited)).alias("citations"),
    )


def work_record(raw: Column) -> Column:
    """A publisher's answer about a work (JSON, in `message` or by itself) as a record: the first title and venue, names
    given and family, the first date with a year of four digits, subjects as keywords."""
    message = X.let(F.try_parse_json(raw), lambda v: F.to_json(F.coalesce(F.try_variant_get(v, "$.message", "variant"), v)))
    return X.let(F.from_json(message, CATALOG_WORK), _work)


def _work(m: Column) -> Column:
    name = lambda a: F.concat_ws(" ", blank_to_null(a["given"]), blank_to_null(a["family"]))
    authors = F.transform(F.filter(m["author"], lambda a: blank_to_null(a["family"]).isNotNull()), name)
    first = lambda c: F.nullif(F.get(c, F.lit(0)), F.lit(""))
    none = F.array().cast("array<string>")
    dates = [F.get(F.get(m[d]["date-parts"], F.lit(0)), F.lit(0)) for d in ("published", "published-print", "published-online")]
    return F.struct(
        first(m["title"]).alias("title"), bare_id(m["DOI"]).alias("doi"), F.nullif(m["abstract"], F.lit("")).alias("abstract"), year_waterfall(dates).alias("year"),
        first(m["container-title"]).alias("venue"), F.coalesce(authors, none).alias("authors"), ordered_union(none, F.coalesce(m["subject"], none)).alias("keywords"),
    )


def outbound(raw: Column, doi: Column) -> Column:
    """The references that a catalog's answer (JSON) lists for a paper: source and items, all of them.

    Without an identifier there was no request and there are no items; an answer of another shape is a failed one.
    """
    answer = F.try_parse_json(raw)
    data = F.schema_of_variant(F.try_variant_get(answer, "$.data", "variant"))
    good = F.coalesce(F.schema_of_variant(answer).startswith("OBJECT"), F.lit(False)) & F.coalesce((data == "VOID") | data.startswith("ARRAY"), F.lit(True))
    # Members that are no objects are passed over, so each is read by itself.
    members = F.coalesce(F.try_variant_get(answer, "$.data", "array<variant>"), F.array().cast("array<variant>"))
    cited = F.transform(members, lambda m: F.from_json(F.to_json(F.try_variant_get(m, "$.citedPaper", "variant")), CATALOG_REFERENCE))
    items = _named(F.transform(F.filter(cited, lambda c: c.isNotNull()), _cited))
    none = F.filter(items, lambda x: F.lit(False))
    asked = F.coalesce(doi, F.lit("")) != ""
    source = F.when(~asked | good, SINGLE).otherwise(FAILED)
    return F.struct(source.alias("source"), F.when(asked & good, items).otherwise(none).alias("items"))


def chosen_citations(prefetched: Column, fetched: Column) -> Column:
    """The prefetched items if there are any, else what was fetched (source, items)."""
    return F.when(F.size(F.coalesce(prefetched, F.array())) > 0, F.struct(F.lit(BATCH).alias("source"), prefetched.alias("items"))).otherwise(fetched)


def chunk_size(size: int | None) -> int:
    return min(max(int(size or CHUNK), 1), CHUNK)


def requests(ids: DataFrame, size: int | None = CHUNK, *, order: str = "idx", doi: str = "doi") -> DataFrame:
    """key, pos, chunk, place of every identifier that is one, in order: what a bulk lookup asks for."""
    size = chunk_size(size)
    keys = ids.select(F.col(order).alias("__order"), bare_id(F.col(doi)).alias("key")).filter("key is not null")
    rows = numbered(keys, "__order").withColumnRenamed("idx", "pos")
    return rows.select("key", "pos", F.floor(F.col("pos") / size).alias("chunk"), (F.col("pos") % size).alias("place"))


def bulk_resolve(asked: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, record of every identifier found, by what was asked and by the catalog's own identifier; the summary).

    asked is of requests(); answers hold chunk and payload, a JSON list aligned with the chunk's places, or an object
    with such a list as `data`. A chunk without an answer, or with another one, is a failed chunk; the rest stand. Empty
    and malformed entries are passed over. Of several records for a key the last stands.
    """
    v = F.try_parse_json("payload")
    data = lambda at: F.try_variant_get(v, at, "array<variant>")
    shape = F.schema_of_variant(v)
    entries = F.when(shape.startswith("ARRAY"), data("$")).when(shape.startswith("OBJECT"), data("$.data"))
    lists = answers.select("chunk", entries.alias("entries"))
    one = lists.select("chunk", F.posexplode("entries").alias("place", "e")).select("chunk", "place", F.to_json("e").alias("raw"))
    hits = asked.join(one, ["chunk", "place"]).filter(F.col("raw").isNotNull() & ~malformed(F.col("raw"))).select("key", "pos", entry_record(F.col("raw")).alias("record"))
    both = hits.select("key", (F.col("pos") * 2).alias("at"), "record").unionByName(
        hits.select(F.col("record.doi").alias("key"), (F.col("pos") * 2 + 1).alias("at"), "record").filter("key is not null")
    )
    result = both.groupBy("key").agg(F.max_by("record", "at").alias("record"))
    found = asked.join(result.select("key"), "key", "left_semi").agg(F.count_distinct("key").alias("resolved"))
    tried = asked.select("chunk").distinct().join(lists, "chunk", "left")
    chunks = tried.agg(F.count(F.lit(1)).alias("chunks_attempted"), F.count_if(F.col("entries").isNull()).alias("chunks_failed"))
    # Two tables of one row each.
    summary = asked.agg(F.count(F.lit(1)).alias("input_ids")).join(found, F.lit(True)).join(chunks, F.lit(True))
    return result, summary


def search_article(items: DataFrame, index: DataFrame) -> DataFrame:
    """items with pmid_found: the best hit of index (term, rank, pmid) for the identifier, else the pmid, else the title."""
    term = F.coalesce(bare_id(F.col("doi")), blank_to_null(F.col("pmid")), F.lower(blank_to_null(F.col("title"))))
    best = index.groupBy("term").agg(F.min_by("pmid", "rank").alias("pmid_found"))
    return items.withColumn("term", term).join(best, "term", "left").drop("term")


def article_record(xml: Column) -> Column:
    """An article's record from its markup, by functions of Spark alone; null where that is no XML.

    Of a set of articles in one text the first of everything is taken, as if it were one: read_articles() tells them apart.
    """
    return F.when(X.xml_is_whole(xml), X.let(X.xml_bare(xml), _article))


#: Elements of an article that are looked up by themselves, each once.
_ELEMENTS = (
    "ArticleTitle", "AbstractText", "Author", "PubDate", "Journal", "ISOAbbreviation", "ArticleId", "PMID", "MeshHeading", "KeywordList", "PublicationType",
)


def _article(bare: Column) -> Column:
    return X.let(F.struct(*[X.xml_elements(bare, n).alias(n) for n in _ELEMENTS]), _article_fields)


def _article_fields(every: Column) -> Column:
    texts = lambda elements: F.filter(F.transform(elements, X.xml_content), lambda t: t.isNotNull())
    first = lambda elements: X.xml_content(F.get(elements, F.lit(0)))
    inside = lambda outer, name: F.flatten(F.transform(every[outer], lambda e: X.xml_elements(e, name)))
    once = lambda elements: F.array_distinct(texts(elements))

    def name(author: Column) -> Column:
        last = first(X.xml_elements(author, "LastName"))
        given = F.coalesce(first(X.xml_elements(author, "ForeName")), first(X.xml_elements(author, "Initials")))
        return X.let(last, lambda n: F.when(n.isNotNull(), F.concat_ws(" ", n, given)))

    def major(heading: Column) -> Column:
        descriptor = F.slice(X.xml_elements(heading, "DescriptorName"), 1, 1)
        marked = F.exists(F.concat(descriptor, X.xml_elements(heading, "QualifierName")), lambda e: X.xml_marked(e, "MajorTopicYN", "Y"))
        return F.when(marked, first(descriptor))

    date = F.coalesce(first(inside("PubDate", "Year")), F.substring(first(inside("PubDate", "MedlineDate")), 1, 4))
    ids = F.filter(every["ArticleId"], lambda e: X.xml_marked(e, "IdType", "doi"))
    one = F.filter(every["PMID"], lambda e: X.xml_marked(e, "Version", "1"))
    own = F.coalesce(F.get(texts(one), F.lit(0)), first(every["PMID"]))
    known = lambda c: F.filter(c, lambda x: x.isNotNull())
    fields = {
        "title": first(every["ArticleTitle"]), "abstract": F.nullif(F.array_join(texts(every["AbstractText"]), " "), F.lit("")), "authors": known(F.transform(every["Author"], name)),
        "year": X.let(date, lambda d: F.when(d.rlike("^[0-9]{4}$"), d)), "venue": F.coalesce(first(inside("Journal", "Title")), first(every["ISOAbbreviation"])), "doi_raw": first(ids), "pmid": own,
        "mesh": texts(inside("MeshHeading", "DescriptorName")), "keywords": texts(inside("KeywordList", "Keyword")), "mesh_major": F.array_distinct(known(F.transform(every["MeshHeading"], major))),
        "mesh_qualifiers": once(inside("MeshHeading", "QualifierName")), "types": once(every["PublicationType"]),
    }
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def read_articles(spark: SparkSession, path: str, tag: str = "PubmedArticle") -> DataFrame:
    """file, xml of every article in files that hold sets of them; files are split between tasks, and none is held whole."""
    found = spark.read.option("recursiveFileLookup", "true").option("lineSep", f"</{tag}>").text(path)
    start = F.regexp_extract("value", rf"(?s)(<{tag}(?:\s[^>]*)?>.*)$", 1)
    rows = found.select(F.col("_metadata.file_path").alias("file"), start.alias("xml")).filter("xml <> ''")
    return rows.withColumn("xml", F.concat("xml", F.lit(f"</{tag}>")))


def article_records(rows: DataFrame, xml: str = "xml", pmid: str | None = None) -> DataFrame:
    """rows with an article's fields from its markup; a record without an own pmid keeps the one it was asked by."""
    out = rows.withColumn("__a", article_record(F.col(xml)))
    own = F.col("__a.pmid") if pmid is None else F.coalesce(F.col("__a.pmid"), F.col(pmid))
    fields = [c for c in out.schema["__a"].dataType.names if c not in ("doi_raw", "pmid")]
    return out.select(*[c for c in rows.columns if c not in (*fields, "pmid", "doi")], *[f"__a.{c}" for c in fields], bare_id(F.col("__a.doi_raw")).alias("doi"), own.alias("pmid"))


def fallback(sources: list[tuple[str, Column]], last: str) -> Column:
    """The name of the first source whose column has a value, else the last resort."""
    return F.coalesce(*[F.when(blank_to_null(c.cast("string")).isNotNull(), F.lit(name)) for name, c in sources], F.lit(last))


def resolve_once(rows: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """rows with what is known of their key; each different key is asked for once."""
    return rows.join(rows.select(key).distinct().join(known, key), key)
