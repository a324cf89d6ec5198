"""Queries over batches: gated enrichment from several catalogs, ingestion and backfill of a store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.operators import batch as B
from paperloom.operators import catalog as K
from paperloom.operators import enrich as N
from paperloom.operators.staging import dealt
from paperloom.plans.library import works
from paperloom.plans.registry import query, table
from paperloom.schemas import EDGE

_SLOW = """i AS (SELECT p_partkey AS k, p_name, p_brand, p_type, p_size, p_retailprice AS price, CASE WHEN p_size > 10 THEN '10.1/p' || p_partkey END AS doi0, CASE WHEN p_type = 'SMALL' THEN 'm' || p_partkey END AS pmid0,
      CASE WHEN p_size > 5 THEN p_name || ' by ' || p_brand || ' ' || p_partkey END AS title0 FROM part),
    r AS (SELECT l_partkey AS k, max(year(l_shipdate)) AS y FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45 GROUP BY l_partkey),
    b AS (SELECT i.*, y, doi0 IS NOT NULL AND y IS NOT NULL AS ub FROM i LEFT JOIN r ON i.k = r.k),
    b1 AS (SELECT *, CASE WHEN ub AND p_type = 'PROMO' THEN '10.1/c' || k ELSE doi0 END AS doi1, CASE WHEN ub THEN 's' || k END AS s1, CASE WHEN ub AND price > 950 THEN 'Bulk abstract' END AS ab1, CASE WHEN ub THEN y::VARCHAR END AS y1, CASE WHEN ub AND p_size > 25 THEN 'Bulk venue' END AS v1, ub AND pmid0 IS NOT NULL AS ask1 FROM b),
    b2 AS (SELECT *, CASE WHEN ask1 AND p_brand < 'Brand#15' THEN coalesce(ab1, 'From the article') ELSE ab1 END AS ab2, ask1 AND p_brand < 'Brand#15' AS a1 FROM b1),
    b3 AS (SELECT *, NOT ub OR v1 IS NULL OR ab2 IS NULL AS op FROM b2),
    b4 AS (SELECT *, op AND pmid0 IS NULL AND (doi0 IS NOT NULL OR title0 IS NOT NULL) AS ask_s FROM b3),
    b5 AS (SELECT *, op AND (pmid0 IS NOT NULL OR ask_s AND p_brand < 'Brand#20') AS ask_a FROM b4),
    b6 AS (SELECT *, ask_a AND p_brand < 'Brand#15' AND NOT (ask_s AND p_type = 'STANDARD') AS a2 FROM b5),
    b7 AS (SELECT *, CASE WHEN a2 THEN coalesce(title0, p_name || ' by ' || p_brand || ' ' || k) ELSE title0 END AS t2, CASE WHEN a2 THEN coalesce(doi1, '10.1/p' || k) ELSE doi1 END AS doi2, CASE WHEN a2 THEN 'm' || k ELSE pmid0 END AS pm2,
      CASE WHEN a2 THEN coalesce(ab2, 'From the article') ELSE ab2 END AS ab3, CASE WHEN a2 THEN coalesce(y1, '1999') ELSE y1 END AS y2, CASE WHEN a2 THEN coalesce(v1, CASE WHEN p_size < 40 THEN 'Journal of ' || p_name END) ELSE v1 END AS v2 FROM b6),
    b8 AS (SELECT *, op AND doi2 IS NOT NULL AS ask_p FROM b7), b9 AS (SELECT *, ask_p AND doi2 = '10.1/p' || k AND price < 950 AS p1 FROM b8),
    b10 AS (SELECT *, op AND doi2 IS NOT NULL AND (doi0 IS NULL OR t2 IS NULL) AS ask_w FROM b9)"""


def _parsed(spark, d) -> DataFrame:
    k = F.col("p_partkey").cast("string")
    return dealt(table(spark, d, "part")).select(
        F.col("p_partkey").alias("k"), F.when(F.col("p_size") > 10, F.concat(F.lit("doi:10.1/P"), k)).alias("doi"), F.when(F.col("p_type") == "SMALL", F.concat(F.lit("m"), k)).alias("pmid"),
        F.when(F.col("p_size") > 5, F.concat("p_name", F.lit(" by "), "p_brand", F.lit(" "), k)).alias("title"), F.array("p_brand").alias("keywords"),
    )


def catalogs(spark, d) -> N.Catalogs:
    """Answers about parts: the bulk's from line items, several for a part; publishers' as JSON."""
    part, k = dealt(table(spark, d, "part")), F.col("p_partkey").cast("string")
    line = table(spark, d, "lineitem").filter("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"), F.year("l_shipdate").alias("at"))
    doi = F.concat(F.lit("10.1/p"), k)
    entry = F.to_json(F.struct(
        F.concat(F.lit("s"), k).alias("paperId"), F.concat(F.lit("Bulk "), k).alias("title"), F.col("at").alias("year"), F.when(F.col("p_retailprice") > 950, "Bulk abstract").alias("abstract"),
        F.when(F.col("p_size") > 25, "Bulk venue").alias("venue"), F.struct(F.when(F.col("p_type") == "PROMO", F.concat(F.lit("10.1/C"), k)).otherwise(doi).alias("DOI")).alias("externalIds"),
        F.array(F.struct(F.col("p_brand").alias("name"))).alias("authors"), F.array("p_type").alias("fieldsOfStudy"),
    ))
    bulk = line.join(part, "p_partkey").select(doi.alias("doi"), "at", K.entry_record(entry).alias("record"))
    pmid = F.concat(F.lit("m"), k)
    named = part.filter("p_brand < 'Brand#20'")
    terms = F.explode(F.array(doi, F.lower(F.concat("p_name", F.lit(" by "), "p_brand", F.lit(" "), k))))
    hits = named.select(terms.alias("term"), F.lit(1).alias("rank"), pmid.alias("pmid")).unionByName(named.select(doi.alias("term"), F.lit(2).alias("rank"), F.lit("m0").alias("pmid")))
    title = F.when(F.col("p_type") == "STANDARD", "Nothing alike whatsoever").otherwise(F.concat(F.lit("By "), "p_brand", F.lit(" "), k, F.lit(" "), "p_name", F.lit(".")))
    article = F.struct(
        F.when(F.col("p_size") <= 5, F.concat("p_name", F.lit(" by "), "p_brand", F.lit(" "), k)).otherwise(title).alias("title"), doi.alias("doi"), F.lit("From the article").alias("abstract"), F.array("p_name").alias("authors"),
        F.lit("1999").alias("year"), F.when(F.col("p_size") < 40, F.concat(F.lit("Journal of "), "p_name")).alias("venue"), F.array("p_name").alias("mesh"),
    )
    articles = part.filter("p_brand < 'Brand#15'").select(pmid.alias("pmid"), F.lit(0).alias("at"), article.alias("record"))
    paper = F.to_json(F.struct(F.concat(F.lit("s"), k).alias("paperId"), F.lit("Paper venue").alias("venue"), F.array(F.lit("JournalArticle")).alias("publicationTypes")))
    papers = part.filter("p_retailprice < 950").select(doi.alias("doi"), F.lit(0).alias("at"), K.entry_record(paper).alias("record"))
    work = F.concat(F.lit('{"message": {"title": ["Work '), k, F.lit('"], "container-title": ["Work venue"], "published": {"date-parts": [[2005, 1]]}, "subject": ["'), F.col("p_name"), F.lit('"], "author": [{"given": "A", "family": "B"}, {"given": "C"}]}}'))
    works = part.select(doi.alias("doi"), F.lit(0).alias("at"), K.work_record(work).alias("record"))
    return N.Catalogs(bulk, hits, articles, papers, works)


def _text(c: Column | str) -> Column:
    return F.array_join(c, ",")


@query(f"""WITH {_SLOW} SELECT k, t2 AS title, doi2 AS doi, pm2 AS pmid, CASE WHEN p1 THEN coalesce(s1, 's' || k) ELSE s1 END AS s2_id, ab3 AS abstract, CASE WHEN ask_w THEN coalesce(y2, '2005') ELSE y2 END AS year,
    CASE WHEN ask_w THEN coalesce(CASE WHEN p1 THEN coalesce(v2, 'Paper venue') ELSE v2 END, 'Work venue') WHEN p1 THEN coalesce(v2, 'Paper venue') ELSE v2 END AS venue,
    CASE WHEN ub THEN p_brand WHEN a2 THEN p_name WHEN ask_w THEN 'A B' ELSE '' END AS authors, CASE WHEN ub AND p_type = 'PROMO' THEN '10.1/p' || k ELSE '' END AS alt_dois, CASE WHEN ub THEN p_type ELSE '' END AS fields, CASE WHEN p1 THEN 'JournalArticle' ELSE '' END AS types,
    CASE WHEN a1 OR a2 THEN p_name ELSE '' END AS mesh, CASE WHEN ask_w THEN p_name ELSE p_brand END AS keywords, CASE WHEN a2 THEN 'pubmed' WHEN ub THEN 's2-batch' WHEN p1 THEN 'semantic-scholar' WHEN ask_w THEN 'crossref' ELSE 'input-only' END AS source, t2 IS NULL AS failed FROM b10""")
def enrich_gated(spark, d):
    """Records from five catalogs, each asked only for what is still missing; canonical identifiers, topics of all."""
    out = N.resolve(_parsed(spark, d), catalogs(spark, d))
    lists = [_text(c).alias(c) for c in ("authors", "alt_dois", "fields", "types", "mesh", "keywords")]
    return out.select("k", "title", "doi", "pmid", "s2_id", "abstract", "year", "venue", *lists, "source", F.col("resolve_error").isNotNull().alias("failed"))


@query(f"""WITH {_SLOW}, n AS (SELECT unnest([('bulk', count(*) FILTER (doi0 IS NOT NULL)), ('bulk-article', count(*) FILTER (ask1)), ('search', count(*) FILTER (ask_s)), ('article', count(*) FILTER (ask_a)), ('paper', count(*) FILTER (ask_p)), ('work', count(*) FILTER (ask_w))]) AS x FROM b10)
    SELECT x[1] AS source, x[2]::BIGINT AS n FROM n WHERE x[2] > 0""")
def enrich_asked(spark, d):
    """How many records asked each catalog: fewer from one to the next."""
    return N.asked_rows(N.resolve(_parsed(spark, d), catalogs(spark, d)))


_BATCH = """p AS (SELECT p_partkey AS k, p_name, p_brand, p_type, p_size <= 30 AS held, p_retailprice < 980 AS known, CASE WHEN p_brand < 'Brand#12' THEN 'doi' WHEN p_type = 'ECONOMY' THEN 'number' WHEN p_type = 'LARGE' THEN 'short' WHEN p_type = 'PROMO' THEN 'title' ELSE 'both' END AS kind FROM part),
    i AS (SELECT *, k AS idx, false AS again FROM p UNION ALL SELECT *, k + 10000000, true FROM p WHERE p_type = 'MEDIUM'),
    j AS (SELECT *, kind IN ('doi', 'both') AND known AS bulk, kind IN ('title', 'both') OR kind = 'doi' AND known AS ok FROM i),
    here AS (SELECT k FROM p WHERE held UNION SELECT k FROM j WHERE ok AND kind <> 'title'),
    c AS (SELECT DISTINCT l_partkey AS k, l_suppkey AS s FROM lineitem WHERE l_returnflag = 'R'),
    n AS (SELECT c.k, count(*) AS listed, count(*) FILTER (s <> c.k AND h.k IS NOT NULL) AS linked FROM c LEFT JOIN here h ON c.s = h.k GROUP BY c.k),
    o AS (SELECT j.*, ok AND NOT held AND NOT again AS made, CASE WHEN bulk AND ok THEN coalesce(listed, 0) ELSE 0 END AS listed, CASE WHEN bulk AND ok THEN coalesce(linked, 0) ELSE 0 END AS linked FROM j LEFT JOIN n ON j.k = n.k)"""
_STATUS = "CASE WHEN ok THEN 'digested' WHEN kind = 'number' THEN 'failed' ELSE 'needs-review' END"


def _batch(spark, d):
    """(items, catalogs, references, store): parts as items of several shapes, some twice; about half of them are stored."""
    k = F.col("p_partkey").cast("string")
    doi = F.concat(F.lit("10.1/q"), k)
    title = F.concat("p_name", F.lit(" of "), "p_brand", F.lit(", no. "), k, F.lit("."))
    item = (
        F.when(F.col("p_brand") < "Brand#12", F.concat(F.lit('"https://doi.org/'), doi, F.lit('"'))).when(F.col("p_type") == "ECONOMY", k).when(F.col("p_type") == "LARGE", '{"title": "short"}')
        .when(F.col("p_type") == "PROMO", F.to_json(F.struct(title.alias("title")))).otherwise(F.to_json(F.struct(doi.alias("doi"), title.alias("title"))))
    )
    part = dealt(table(spark, d, "part"))
    items = part.select(F.col("p_partkey").alias("idx"), item.alias("item"))
    items = items.unionByName(part.filter("p_type = 'MEDIUM'").select((F.col("p_partkey") + 10000000).alias("idx"), item.alias("item")))
    cited = table(spark, d, "lineitem").filter("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.collect_set("l_suppkey").alias("s"))
    refs = F.transform(F.coalesce("s", F.array().cast("array<long>")), lambda x: F.struct(F.struct(F.concat(F.lit("10.1/Q"), x.cast("string")).alias("DOI")).alias("externalIds")))
    entry = F.to_json(F.struct(F.concat(F.lit("Bulk "), k).alias("title"), refs.alias("references")))
    bulk = part.filter("p_retailprice < 980").join(cited, "p_partkey", "left").select(doi.alias("doi"), F.lit(0).alias("at"), K.entry_record(entry).alias("record"))
    some = catalogs(spark, d)
    nothing = N.Catalogs(bulk, some.hits.limit(0), some.articles.limit(0), some.papers.limit(0), some.works.limit(0))
    references = spark.createDataFrame([], "doi string, at int, payload string")
    held = works(spark, d).drop("scan")
    held = held.join(part.filter("p_size <= 30").select(F.concat(F.lit("p"), k).alias("id")), "id", "left_semi")
    return items, nothing, references, B.Store(held, spark.createDataFrame([], EDGE))


def _done(spark, d) -> B.Result:
    return B.ingest(*_batch(spark, d), batch="query", day="2024-01-01")


@query(f"""WITH {_BATCH} SELECT idx, CASE WHEN ok THEN made END AS created, CASE WHEN NOT ok OR made THEN NULL WHEN kind = 'title' THEN 'title' ELSE 'doi' END AS reason, {_STATUS} AS status, linked::BIGINT AS linked, (listed - linked)::BIGINT AS skipped,
    listed::BIGINT AS stored, CASE WHEN ok THEN '' WHEN kind = 'number' THEN 'item' WHEN kind = 'short' THEN 'key' ELSE 'title' END AS error FROM o""")
def ingest_batch(spark, d):
    """A batch with items of several shapes: what fails keeps its error and leaves, the others go through all phases."""
    out = _done(spark, d).outcomes
    first = F.get("errors", F.lit(0))
    error = F.when(first.isNull(), "").when(first.startswith("a batch item"), "item").when(first.startswith("provide"), "key").when(first.startswith("Could not"), "title").otherwise(first)
    return out.select("idx", "created", "reason", "status", "linked", "skipped", "stored", error.alias("error"))


@query(f"""WITH {_BATCH}, u AS (SELECT k, bool_or(made) AS made, max(listed) AS listed FROM o WHERE ok GROUP BY k), f AS (SELECT k, kind, known, p_name, p_brand FROM p)
    SELECT CASE WHEN p.held OR kind = 'both' OR kind = 'title' THEN p_name || ' of ' || p_brand || ', no. ' || p.k || '.' ELSE 'Bulk ' || p.k END AS title, CASE WHEN p.held OR kind <> 'title' THEN '10.1/q' || p.k END AS doi,
    CASE WHEN u.k IS NOT NULL THEN 'pipeline:digested' END AS status, coalesce(u.listed, 0)::BIGINT AS n_items, NOT p.held AS made FROM p LEFT JOIN u ON p.k = u.k WHERE p.held OR u.k IS NOT NULL""")
def ingest_nodes(spark, d):
    """The store's nodes after a batch: stored ones keep what they have, created ones are what their first item says."""
    r = F.col("metadata.reference")
    doi = F.regexp_replace(F.lower(r["doi"]), "^doi:", "")
    status = F.get(F.filter("tags", lambda t: t.startswith("pipeline:")), F.lit(0))
    return _done(spark, d).store.nodes.select("title", doi.alias("doi"), status.alias("status"), F.coalesce(F.size(r["outbound_citations"]["items"]), F.lit(0)).cast("long").alias("n_items"), F.col("slug").isNull().alias("made"))


@query(f"""WITH {_BATCH} SELECT DISTINCT o.k AS source, s AS target FROM o JOIN c ON o.k = c.k JOIN here ON c.s = here.k WHERE ok AND bulk AND s <> o.k""")
def ingest_edges(spark, d):
    """New edges of a batch, by the parts that their nodes stand for."""
    done = _done(spark, d)
    r = F.col("metadata.reference")
    part = F.coalesce(F.regexp_extract(r["doi"], "(?i)10.1/q([0-9]+)", 1), F.regexp_extract("title", r"no\. ([0-9]+)", 1))
    named = done.store.nodes.select("id", part.cast("long").alias("k"))
    source, target = named.toDF("source_id", "source"), named.toDF("target_id", "target")
    return done.edges.join(source, "source_id").join(target, "target_id").select("source", "target")


@query("""WITH w AS (SELECT p_partkey AS k, p_type, p_size, p_retailprice < 980 AS known, p_type = 'SMALL' AS tagged, p_size <= 12 AS anon, p_type IN ('SMALL', 'PROMO', 'MEDIUM') AS open FROM part WHERE p_size <= 30), q AS (SELECT * FROM w WHERE open),
    g AS (SELECT * FROM q WHERE NOT tagged), c AS (SELECT DISTINCT l_partkey AS k, l_suppkey AS s FROM lineitem WHERE l_returnflag = 'R'), x AS (SELECT g.k, count(*) AS listed, count(*) FILTER (s <> g.k AND t.k IS NOT NULL) AS linked FROM g JOIN c ON g.k = c.k LEFT JOIN w t ON c.s = t.k AND NOT t.anon WHERE g.known AND NOT g.anon GROUP BY g.k)
    SELECT (SELECT count(*) FROM q)::BIGINT AS candidates, (SELECT count(*) FROM q WHERE tagged)::BIGINT AS skipped_already_tagged, 0::BIGINT AS skipped_no_doi, (SELECT count(*) FROM g)::BIGINT AS resolvable, (SELECT count(*) FROM g WHERE anon OR known)::BIGINT AS processed,
    (SELECT coalesce(sum(linked), 0) FROM x)::BIGINT AS edges_linked, (SELECT coalesce(sum(listed), 0) FROM x)::BIGINT AS citations_stored, 0::BIGINT AS failed, (SELECT count(*) FROM g WHERE NOT anon AND NOT known)::BIGINT AS needs_review, (SELECT count(*) FROM g WHERE NOT anon AND NOT known)::BIGINT AS errors""")
def backfill_store(spark, d):
    """Stored nodes by status through the batch again: identifiers as they are, others as records; tagged ones are passed over."""
    _, some, references, store = _batch(spark, d)
    part = table(spark, d, "part").filter("p_size <= 30").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"), "p_type", "p_size")
    n = store.nodes.join(part, "id")
    kind = F.col("p_type")
    status = F.when(kind == "SMALL", "queued").when(kind == "PROMO", "scaffolded").when(kind == "MEDIUM", "failed").otherwise("digested")
    tags = F.concat(F.filter("tags", lambda t: t.startswith("kw:")), F.array(F.concat(F.lit("pipeline:"), status)), F.when(kind == "SMALL", F.array(F.lit("mesh:x"))).otherwise(F.array().cast("array<string>")))
    r = F.col("metadata.reference")
    anon = F.col("p_size") <= 12
    bare = r.withField("doi", F.when(anon, F.lit(None).cast("string")).otherwise(r["doi"])).withField("alt_dois", F.lit(None).cast("array<string>"))
    nodes = n.withColumns({"tags": tags, "uri": F.lit(None).cast("string"), "metadata": F.struct(bare.alias("reference"))}).select(*store.nodes.columns)
    counts, _ = B.backfill(B.Store(nodes, store.edges), some, references, batch="backfill", day="2024-01-01", only_missing=True)
    return counts
