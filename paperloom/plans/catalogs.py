"""Queries over catalog answers, upserts, links and orders, on data with real gaps."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from paperloom.functions import tags as G
from paperloom.operators import catalog as K
from paperloom.operators import graph as E
from paperloom.operators import identity as D
from paperloom.operators import monitor as M
from paperloom.operators import records as R
from paperloom.operators import staging as S
from paperloom.operators import store as W
from paperloom.plans.registry import TITLE, query, table, title

_GAP = "CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN '' ELSE c_mktsegment || '!' END"


@query(f"""WITH s AS (SELECT o_custkey AS k, CASE WHEN max(o_totalprice) > 300000 THEN '' ELSE min('v' || o_orderkey) END AS venue, list_sort(list(DISTINCT o_orderpriority)) AS kw FROM orders GROUP BY o_custkey),
    b AS (SELECT c_custkey AS k, {_GAP} AS venue, CASE WHEN c_custkey % 3 = 0 THEN [] WHEN c_custkey % 3 = 1 THEN [c_mktsegment] END::VARCHAR[] AS kw FROM customer)
    SELECT b.k, CASE WHEN coalesce(b.venue, '') = '' AND coalesce(s.venue, '') <> '' THEN s.venue ELSE b.venue END AS venue, array_to_string(CASE WHEN len(coalesce(b.kw, [])) = 0 AND s.kw IS NOT NULL THEN s.kw ELSE b.kw END, ',') AS kw,
    CASE WHEN coalesce(b.venue, '') = '' AND coalesce(s.venue, '') <> '' OR len(coalesce(b.kw, [])) = 0 AND s.kw IS NOT NULL THEN 'orders' ELSE 'input-only' END AS origin FROM b LEFT JOIN s ON b.k = s.k""")
def enrich_gaps(spark, d):
    """Nulls, empty strings and empty lists are all gaps; what the source lacks fills none."""
    n, c = F.col("c_custkey"), table(spark, d, "customer")
    venue = F.when(n % 5 == 0, F.lit(None)).when(n % 5 == 1, "").otherwise(F.concat("c_mktsegment", F.lit("!")))
    kw = F.when(n % 3 == 0, F.array().cast("array<string>")).when(n % 3 == 1, F.array("c_mktsegment"))
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        F.when(F.max("o_totalprice") > 300000, "").otherwise(F.min(F.concat(F.lit("v"), F.col("o_orderkey").cast("string")))).alias("venue"), F.array_sort(F.collect_set("o_orderpriority")).alias("kw")
    )
    out = R.waterfall(c.select(n.alias("k"), venue.alias("venue"), kw.alias("kw")), [("orders", o)], "k", ["venue", "kw"])
    return out.select("k", "venue", F.array_join("kw", ",").alias("kw"), "origin")


@query("""WITH n AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN c_name || '!' ELSE '' END AS venue, CASE WHEN c_custkey % 4 = 0 THEN [c_mktsegment] ELSE [] END::VARCHAR[] AS authors, c_name AS cite,
      CASE WHEN c_custkey % 3 <> 0 THEN 'p' || c_custkey END AS pmid, ['type:journalarticle', 'kw:old', 'pmid:0', 'note:' || c_nationkey] AS tags FROM customer WHERE c_custkey % 7 <> 0),
    i AS (SELECT o_custkey AS k, arg_max(o_orderpriority, o_orderkey) AS cite, arg_min(lower(replace(o_orderpriority, '-', ' ')), o_orderkey) AS kw FROM orders GROUP BY o_custkey),
    f AS (SELECT o_custkey AS k, arg_min('v' || o_orderkey, o_orderkey) AS venue, [arg_min(o_orderstatus, o_orderkey)] AS authors FROM orders GROUP BY o_custkey)
    SELECT coalesce(n.k, i.k) AS k, CASE WHEN coalesce(n.venue, '') <> '' THEN n.venue WHEN f.venue IS NOT NULL THEN f.venue ELSE n.venue END AS venue,
      array_to_string(CASE WHEN len(n.authors) > 0 THEN n.authors WHEN f.authors IS NOT NULL THEN f.authors ELSE n.authors END, ',') AS authors, coalesce(i.cite, n.cite) AS cite, n.pmid,
      array_to_string(CASE WHEN i.k IS NULL THEN n.tags ELSE list_concat(CASE WHEN n.k IS NULL THEN [] ELSE ['note:' || substr(n.tags[4], 6)] END, ['pipeline:scaffolded'], CASE WHEN n.pmid IS NULL THEN [] ELSE ['pmid:' || n.pmid] END,
        ['kw:' || trim(regexp_replace(i.kw, '[^0-9a-z]+', '-', 'g'), '-')]) END, ',') AS tags, n.k IS NULL AS created
    FROM n FULL JOIN i ON n.k = i.k LEFT JOIN f ON coalesce(n.k, i.k) = f.k""")
def upsert_tagged(spark, d):
    """Several incoming rows of a key, lists, gaps of both kinds, and tags that fall back to the node's own identifier."""
    n, none = F.col("c_custkey"), F.array().cast("array<string>")
    old = table(spark, d, "customer").filter("c_custkey % 7 <> 0").select(
        n.alias("k"), F.when(n % 2 == 0, F.concat("c_name", F.lit("!"))).otherwise("").alias("venue"), F.when(n % 4 == 0, F.array("c_mktsegment")).otherwise(none).alias("authors"),
        F.col("c_name").alias("cite"), F.when(n % 3 != 0, F.concat(F.lit("p"), n.cast("string"))).alias("pmid"),
        F.array(F.lit("type:journalarticle"), F.lit("kw:old"), F.lit("pmid:0"), F.concat(F.lit("note:"), F.col("c_nationkey").cast("string"))).alias("tags"),
    )
    new = table(spark, d, "orders").select(
        F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("at"), F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("venue"), F.array("o_orderstatus").alias("authors"),
        F.col("o_orderpriority").alias("cite"), F.lit(None).cast("string").alias("pmid"), F.array(F.replace("o_orderpriority", F.lit("-"), F.lit(" "))).alias("keywords"),
    )
    out = R.upsert(old, new, "k", ["venue", "authors", "pmid"], ["cite"], order="at", tags="tags")
    return out.select("k", "venue", F.array_join("authors", ",").alias("authors"), "cite", "pmid", F.array_join("tags", ",").alias("tags"), "created")


_ASKED = "SELECT c_custkey AS idx, (row_number() OVER (ORDER BY c_custkey) - 1) AS pos, '10.1/c' || c_custkey AS key FROM customer WHERE c_custkey % 6 <> 0"

def _catalog_answers(spark, d):
    """Requests, and answers made from them: chunk 1 has none, chunk 2 none that can be used, others wrap their list."""
    i = F.col("c_custkey")
    ids = table(spark, d, "customer").select(i.alias("idx"), F.when(i % 6 != 0, F.concat(F.lit("doi:10.1/C"), i.cast("string"))).otherwise(" ").alias("doi"))
    asked = S.staged(K.requests(ids, 40), "asked")
    n, pos = F.regexp_extract("key", "c([0-9]+)", 1).cast("long"), F.col("pos")
    entry = F.concat(
        F.lit('{"paperId":"s'), n.cast("string"), F.lit('","title":"t'), (n % 10).cast("string"), F.lit('","year":'), F.when(n % 2 == 0, "0").otherwise("2001"),
        F.lit(',"externalIds":{"DOI":"10.2/N'), (n % 40).cast("string"), F.lit('"},"authors":[{"name":"a"},{"name":""}],"fieldsOfStudy":["f","g"],"s2FieldsOfStudy":[{"category":"g"},{"category":"h'),
        (n % 3).cast("string"), F.lit('"}]}'),
    )
    raw = F.when(pos % 9 == 0, "null").when(pos % 9 == 1, "[1]").when(pos % 9 == 2, '{"authors":["x"]}').otherwise(entry)
    lists = asked.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("place", raw.alias("raw")))).alias("l"))
    body = F.concat(F.lit("["), F.array_join(F.transform("l", lambda x: x["raw"]), ","), F.lit("]"))
    wrapped = F.when(F.col("chunk") % 2 == 0, F.concat(F.lit('{"data":'), body, F.lit("}"))).otherwise(body)
    return asked, lists.filter("chunk <> 1").select("chunk", F.when(F.col("chunk") == 2, '{"error":"busy"}').otherwise(wrapped).alias("payload"))


_HITS = f"""a AS ({_ASKED}), h AS (SELECT * FROM a WHERE pos % 9 > 2 AND pos // 40 NOT IN (1, 2)),
    r AS (SELECT key, pos * 2 AS turn, idx FROM h UNION ALL SELECT '10.2/n' || (idx % 40), pos * 2 + 1, idx FROM h), w AS (SELECT key, arg_max(idx, turn) AS idx FROM r GROUP BY key)"""


@query(f"WITH {_HITS} SELECT key, 's' || idx AS s2_id, 't' || (idx % 10) AS title, CASE WHEN idx % 2 = 1 THEN '2001' END AS year, 'f,g,h' || (idx % 3) AS fields, 1 AS n_authors FROM w")
def catalog_bulk(spark, d):
    asked, answers = _catalog_answers(spark, d)
    r = K.bulk_resolve(asked, answers)[0]
    return r.select("key", "record.s2_id", "record.title", "record.year", F.array_join("record.fields", ",").alias("fields"), F.size("record.authors").alias("n_authors"))


@query(f"WITH {_HITS} SELECT (SELECT count(*) FROM a)::BIGINT AS input_ids, (SELECT count(*) FROM h)::BIGINT AS resolved, (SELECT count(DISTINCT pos // 40) FROM a)::BIGINT AS chunks_attempted, (SELECT count(DISTINCT pos // 40) FROM a WHERE pos // 40 IN (1, 2))::BIGINT AS chunks_failed")
def catalog_bulk_summary(spark, d):
    return K.bulk_resolve(*_catalog_answers(spark, d))[1]


@query("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 1 THEN 'semantic-scholar-failed' WHEN 2 THEN 's2-batch' ELSE 'semantic-scholar' END AS source, CASE o_orderkey % 5 WHEN 2 THEN 2 WHEN 3 THEN 2 WHEN 4 THEN 0 ELSE 0 END AS n_items, CASE o_orderkey % 5 WHEN 3 THEN '10.5/x' || o_custkey WHEN 2 THEN '10.9/p' END AS first_doi FROM orders")
def citation_sources(spark, d):
    """No identifier, a failed answer, a prefetched list, an answer with items of every kind, and one without a list."""
    k = F.col("o_orderkey") % 5
    data = F.concat(F.lit('{"data":[{"citedPaper":{"paperId":"s","title":" ","externalIds":{"DOI":" 10.5/X'), F.col("o_custkey").cast("string"), F.lit('"},"year":2001}},7,{"citedPaper":{"title":"named"}},{"citedPaper":{"title":""}},{"citedPaper":null}]}'))
    raw = F.when(k == 1, "[2]").when(k == 4, '{"data":null}').otherwise(data)
    fetched = K.outbound(raw, F.when(k != 0, "10.1/a"))
    item = F.struct(F.lit("10.9/p").alias("doi"), *[F.lit(None).cast("string").alias(c) for c in ("pmid", "s2_id", "title")], F.lit(None).cast("int").alias("year"))
    prefetched = F.when(k == 2, F.array(item, item)).otherwise(F.slice(F.array(item), 1, 0))
    c = K.chosen_citations(prefetched, fetched)
    return table(spark, d, "orders").select("o_orderkey", c["source"].alias("source"), F.size(c["items"]).alias("n_items"), F.get(c["items"], F.lit(0))["doi"].alias("first_doi"))


def _article_rows(spark, d):
    i = F.col("c_custkey").cast("string")
    even, part = F.col("c_custkey") % 2 == 0, F.col("c_custkey") % 3
    date = F.when(part == 0, "<Year>1999</Year>").when(part == 1, "<MedlineDate>2004 Jan-Feb</MedlineDate>").otherwise("<Year>in press</Year>")
    flag = lambda on: F.when(on, "Y").otherwise("N")
    xml = F.concat(
        F.lit("<Set><PubmedArticle>"), F.when(even, F.concat(F.lit('<PMID Version="2">no</PMID><PMID Version="1">p'), i, F.lit("</PMID>"))).otherwise(""),
        F.lit("<ArticleTitle>"), F.col("c_name"), F.lit(" <i>and</i>\n "), F.col("n_name"), F.lit("</ArticleTitle><Abstract><AbstractText>one <b>"), F.col("c_mktsegment"),
        F.lit("</b></AbstractText><AbstractText> two </AbstractText></Abstract><Author><LastName>Last</LastName><Initials>"), F.col("c_mktsegment"),
        F.lit("</Initials></Author><Author><LastName>Only</LastName></Author><Author><ForeName>No</ForeName></Author><PubDate>"), date,
        F.lit('</PubDate><ArticleId IdType="pii">x</ArticleId><ArticleId IdType="DOI">https://doi.org/10.1/C'), i,
        F.lit('</ArticleId><MeshHeading><DescriptorName MajorTopicYN="'), flag(~even), F.lit('">A</DescriptorName><QualifierName MajorTopicYN="N">q</QualifierName></MeshHeading>'),
        F.lit('<MeshHeading><DescriptorName>B</DescriptorName><QualifierName MajorTopicYN="'), flag(even), F.lit('">q</QualifierName></MeshHeading><PublicationType>T</PublicationType><PublicationType>T</PublicationType></PubmedArticle></Set>'),
    )
    rows = S.dealt(table(spark, d, "customer")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("c_custkey", xml.alias("xml"), F.concat(F.lit("asked"), i).alias("asked"))


def _article_fields():
    lists = {"authors": "authors", "mesh": "mesh", "mesh_major": "major", "mesh_qualifiers": "qualifiers", "types": "types"}
    return ["title", "abstract", "year", "doi", "pmid", *[F.array_join(c, ",").alias(n) for c, n in lists.items()]]


_ARTICLES = """SELECT c_custkey, c_name || ' and ' || n_name AS title, 'one ' || c_mktsegment || ' two' AS abstract, 'Last ' || c_mktsegment || ',Only' AS authors, CASE WHEN c_custkey % 3 = 0 THEN '1999' WHEN c_custkey % 3 = 1 THEN '2004' END AS year,
    '10.1/c' || c_custkey AS doi, CASE WHEN c_custkey % 2 = 0 THEN 'p' || c_custkey ELSE 'asked' || c_custkey END AS pmid, 'A,B' AS mesh, CASE WHEN c_custkey % 2 = 0 THEN 'B' ELSE 'A' END AS major, 'q' AS qualifiers, 'T' AS types FROM customer JOIN nation ON c_nationkey = n_nationkey"""


@query(_ARTICLES)
def article_records(spark, d):
    """Article records from markup, by Spark's own functions: no Python worker reads a row."""
    return K.article_records(_article_rows(spark, d), pmid="asked").select("c_custkey", *_article_fields())


@query(f"WITH a AS ({_ARTICLES}) SELECT * EXCLUDE (c_custkey) REPLACE (CASE WHEN pmid NOT LIKE 'asked%' THEN pmid END AS pmid) FROM a")
def article_sets(spark, d):
    """The same from files that hold sets of many articles, which are read article by article."""
    where = f"{S.shared_folder(spark)}/articles-{uuid.uuid4().hex}"
    _article_rows(spark, d).select(F.regexp_replace("xml", "</?Set>", "").alias("value")).write.text(where)
    return K.article_records(K.read_articles(spark, where)).select(*_article_fields())



@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'd' || c_custkey WHEN c_custkey % 3 = 1 THEN 'p' || c_custkey WHEN c_custkey % 2 = 0 THEN 't' || c_custkey END AS pmid_found FROM customer")
def article_search(spark, d):
    i = F.col("c_custkey")
    s = i.cast("string")
    items = table(spark, d, "customer").select("c_custkey", F.when(i % 3 == 0, F.concat(F.lit("doi:10.1/C"), s)).alias("doi"), F.when(i % 3 < 2, s).otherwise(" ").alias("pmid"), F.col("c_name").alias("title"))
    one = lambda term, tag: F.struct(term.alias("term"), F.concat(F.lit(tag), s).alias("pmid"))
    hits = F.array(one(F.concat(F.lit("10.1/c"), s), "d"), one(s, "p"), one(F.when(i % 2 == 0, F.lower("c_name")), "t"))
    index = table(spark, d, "customer").select(F.explode(hits).alias("h")).select("h.term", F.lit(0).alias("rank"), "h.pmid")
    worse = index.select("term", F.lit(1).alias("rank"), F.lit("worse").alias("pmid"))
    return K.search_article(items, index.unionByName(worse).filter("term is not null")).select("c_custkey", "pmid_found")


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN '10.1/' || event_id WHEN 1 THEN 'd' || event_id END AS doi, CASE WHEN event_id % 3 = 1 THEN event_type END AS title, event_id % 3 = 2 AS wrong FROM events")
def batch_items(spark, d):
    i = F.col("event_id").cast("string")
    item = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('"10.1/'), i, F.lit('"'))).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"doi":"d'), i, F.lit('","title":"'), F.col("event_type"), F.lit('"}'))).otherwise("[3]")
    return R.normalized_items(table(spark, d, "events").select("event_id", item.alias("item"))).select("event_id", "doi", "title", F.col("item_error").isNotNull().alias("wrong"))


def _works(spark, d):
    """Parts as known works with keys of every kind; line items cite them by one kind each."""
    i, s = F.col("p_partkey"), F.col("p_partkey").cast("string")
    return table(spark, d, "part").filter("p_partkey % 5 <> 0").select(
        s.alias("id"), F.when(i % 2 == 0, F.concat(F.lit("s"), s)).alias("s2_id"), F.concat(F.lit("10.1/P"), s).alias("doi"), F.concat(F.lit("m"), s).alias("pmid"),
        F.concat(F.lit("The work called "), s, F.lit(".")).alias("title"),
    )


_FORWARD = """c AS (SELECT DISTINCT l_orderkey AS o, l_linenumber AS n, l_partkey AS p, l_linenumber % 4 AS kind FROM lineitem), m AS (SELECT o, n, p, (p % 5 <> 0 AND (kind <> 0 OR p % 2 = 0)) AS known FROM c)"""


def _cited_items(spark, d):
    s, kind = F.col("l_partkey").cast("string"), F.col("l_linenumber") % 4
    return table(spark, d, "lineitem").select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("source_id"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("pos"), F.when(kind == 0, F.concat(F.lit("s"), s)).alias("s2_id"),
        F.when(kind == 1, F.concat(F.lit("https://doi.org/10.1/p"), s)).alias("doi"), F.when(kind == 2, F.concat(F.lit("m"), s)).alias("pmid"),
        F.when(kind == 3, F.concat(F.lit("the Work called "), s)).alias("title"),
    )


def _linked(spark, d):
    works = _works(spark, d)
    there = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("source_id"), F.col("l_partkey").cast("string").alias("target_id"), F.lit("references").alias("relationship"))
    return E.forward_links(_cited_items(spark, d), D.key_index(works, "id", D.node_keys()), there)


@query(f"WITH {_FORWARD} SELECT DISTINCT 'o' || o AS source_id, p::VARCHAR AS target_id FROM m WHERE known AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o AND l.l_partkey = p AND l_returnflag = 'R')")
def forward_edges(spark, d):
    return _linked(spark, d)[0].select("source_id", "target_id")


@query(f"WITH {_FORWARD} SELECT 'o' || o AS source_id, count(*) FILTER (known)::BIGINT AS linked, count(*) FILTER (NOT known)::BIGINT AS skipped FROM m GROUP BY o")
def forward_counts(spark, d):
    return _linked(spark, d)[1]


@query("SELECT DISTINCT 'o' || l_orderkey AS source_id, l_partkey::VARCHAR AS target_id FROM lineitem WHERE l_partkey % 3 = 0 AND 'o' || l_orderkey <> l_partkey::VARCHAR")
def reverse_edges(spark, d):
    part = F.col("l_partkey").cast("string")
    pending = table(spark, d, "lineitem").select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("source_id"), F.concat(F.lit("doi:10.1/P"), part).alias("doi"))
    made = table(spark, d, "part").filter("p_partkey % 3 = 0").select(F.col("p_partkey").cast("string").alias("node_id"), F.concat(F.lit("10.1/p"), F.col("p_partkey").cast("string")).alias("doi"))
    none = spark.createDataFrame([], "source_id string, target_id string, relationship string")
    return E.reverse_links(pending, made, none)[0].select("source_id", "target_id")


@query("SELECT l_orderkey AS source_id, l_partkey AS target_id, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY 1, 2")
def first_edges(spark, d):
    e = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("source_id"), F.col("l_partkey").alias("target_id"), F.lit("references").alias("relationship"), "l_linenumber")
    return E.first_edges(e, "l_linenumber").select("source_id", "target_id", "l_linenumber")


@query("SELECT l_partkey AS target_id, count(*)::BIGINT AS n FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_linenumber > 5) GROUP BY 1 ORDER BY n DESC, target_id LIMIT 20")
def phantom_top(spark, d):
    e = table(spark, d, "lineitem").filter("l_linenumber > 5").select(F.col("l_orderkey").alias("source_id"), F.col("l_partkey").alias("target_id"))
    return E.phantom_counts(E.phantom_edges(e, [e.limit(0)])).limit(20)


@query("SELECT p_partkey AS id, p_name AS title FROM part ORDER BY p_name, p_partkey LIMIT 30")
def nodes_by_title(spark, d):
    return M.by_title(table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))).limit(30)


@query("SELECT l_orderkey AS source_id, l_partkey AS target_id FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) ORDER BY 1, 2 LIMIT 40")
def edges_by_key(spark, d):
    e = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("source_id"), F.col("l_partkey").alias("target_id"), F.lit("references").alias("relationship")).distinct()
    return E.by_key(e).select("source_id", "target_id").limit(40)


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS idx FROM orders")
def positions(spark, d):
    return S.numbered(table(spark, d, "orders").select("o_totalprice", "o_orderkey"), "o_totalprice", "o_orderkey").select("o_orderkey", "idx")


@query("SELECT s_suppkey FROM supplier WHERE s_name = 'Supplier#000000003' OR s_suppkey = 7")
def point_lookup(spark, d):
    uuid = F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(F.col("s_suppkey").cast("string"), 12, "0"))
    nodes = table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("slug"), uuid.alias("uuid"))
    return M.get_node(nodes, "Supplier#000000003").unionByName(M.get_node(nodes, "0" * 31 + "7")).select("s_suppkey")


@query("""WITH RECURSIVE h(node, hop) AS (SELECT 'r0', 0 UNION ALL SELECT CASE WHEN hop = 0 THEN 'n' || n_nationkey ELSE 'c' || c_custkey END, hop + 1 FROM h, (SELECT n_nationkey, n_regionkey, c_custkey FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey) t
    WHERE hop = 0 AND n_regionkey = 0 OR hop = 1 AND node = 'n' || n_nationkey AND c_custkey IS NOT NULL) SELECT DISTINCT node, hop FROM h""")
def hierarchy(spark, d):
    """What a region holds, through parent edges alone; other edges are not walked."""
    edge = lambda df, a, b, kind: df.select(a.alias("source_id"), b.alias("target_id"), F.lit(kind).alias("relationship"))
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    nation, customer = table(spark, d, "nation"), table(spark, d, "customer")
    edges = edge(nation, name("n", "n_nationkey"), name("r", "n_regionkey"), "parent").unionByName(edge(customer, name("c", "c_custkey"), name("n", "c_nationkey"), "parent"))
    edges = edges.unionByName(edge(nation, name("n", "n_nationkey"), F.lit("r0"), "references"))
    return E.k_hop(edges, "r0", 5, "in", mode="hierarchy").withColumn("hop", F.col("hop").cast("int"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT 'o:' || l_orderkey AS s, 'p:' || l_partkey AS t FROM lineitem WHERE l_returnflag = 'N'), b AS (SELECT s, t FROM e UNION ALL SELECT t, s FROM e),
    w(n, h) AS (SELECT 'p:1', 0 UNION SELECT b.t, h + 1 FROM w JOIN b ON b.s = w.n WHERE h < 6) SELECT min(h)::BIGINT AS hops, true AS whole FROM w WHERE n = 'p:2' HAVING count(*) > 0""")
def path_by_relationship(spark, d):
    """The path's edges are all of the one relationship."""
    o, p = F.concat(F.lit("o:"), F.col("l_orderkey").cast("string")), F.concat(F.lit("p:"), F.col("l_partkey").cast("string"))
    e = table(spark, d, "lineitem").select(o.alias("source_id"), p.alias("target_id"), F.col("l_returnflag").alias("relationship"))
    found = E.shortest_path(e, "p:1", "p:2", 6, relationship="N")
    pairs = found.select("hops", F.explode(F.transform(F.sequence(F.lit(1), F.col("hops")), lambda i: F.array_sort(F.array(F.element_at("path", i.cast("int")), F.element_at("path", i.cast("int") + 1))))).alias("x"))
    real = e.filter("relationship = 'N'").select(F.array(F.col("source_id"), F.col("target_id")).alias("x")).distinct()
    return pairs.join(real, "x").groupBy("hops").agg((F.count(F.lit(1)) == F.max("hops")).alias("whole"))


@query("""WITH t AS (SELECT o_orderkey, ['kw:' || lower(o_orderstatus), 'type:' || lower(o_orderpriority), 'pipeline:queued'] AS a, ['kw:' || lower(chr((97 + o_custkey % 26)::INTEGER)), 'type:' || lower(o_orderpriority), CASE WHEN o_orderkey % 2 = 0 THEN 'kw:f' ELSE 'kw:o' END] AS b FROM orders)
    SELECT o_orderkey, array_to_string([x for x in a if NOT list_contains(b, x)], ',') AS removed, array_to_string([b[i] for i in range(1, 4) if NOT list_contains(a, b[i]) AND list_position(b, b[i]) = i], ',') AS added FROM t""")
def tag_changes(spark, d):
    o = table(spark, d, "orders")
    kind = F.concat(F.lit("type:"), F.lower("o_orderpriority"))
    a = F.array(F.concat(F.lit("kw:"), F.lower("o_orderstatus")), kind, F.lit("pipeline:queued"))
    b = F.array(F.concat(F.lit("kw:"), F.char(F.lit(97) + F.col("o_custkey") % 26)), kind, F.when(F.col("o_orderkey") % 2 == 0, "kw:f").otherwise("kw:o"))
    removed, added = G.tag_changes(a, b)
    return o.select("o_orderkey", F.array_join(removed, ",").alias("removed"), F.array_join(added, ",").alias("added"))


@query("""WITH t AS (SELECT event_id, '[' || strftime(ts, '%Y-%m-%d') || '] ' || event_type AS content FROM events) SELECT event_id::VARCHAR AS node_id, content FROM t""")
def annotations(spark, d):
    e = table(spark, d, "events").withColumn("id", F.col("event_id").cast("string"))
    return R.annotations(e, "id", F.col("event_type"), F.date_format("ts", "yyyy-MM-dd"))


@query(f"""WITH RECURSIVE k AS (SELECT doc_id, text AS a, CASE WHEN length({TITLE}) >= 10 THEN lower({TITLE}) END AS b, row_number() OVER (ORDER BY doc_id) AS n FROM documents),
    s(n, doc_id, rep, ma, mb) AS (SELECT 0::BIGINT, NULL::BIGINT, NULL::BIGINT, MAP {{}}::MAP(VARCHAR, BIGINT), MAP {{}}::MAP(VARCHAR, BIGINT) UNION ALL
      SELECT k.n, k.doc_id, coalesce(ma[md5(a)], mb[b]), CASE WHEN coalesce(ma[md5(a)], mb[b]) IS NULL THEN map_concat(ma, MAP {{md5(a): k.doc_id}}) ELSE ma END, CASE WHEN coalesce(ma[md5(a)], mb[b]) IS NULL AND b IS NOT NULL THEN map_concat(mb, MAP {{b: k.doc_id}}) ELSE mb END
      FROM s JOIN k ON k.n = s.n + 1)
    SELECT doc_id, coalesce(rep, doc_id) AS rep_id, rep IS NULL AS created FROM s WHERE n > 0""")
def intra_batch_dedup(spark, d):
    """Two keys, so a fold in order, which the SQL walks row by row."""
    t = F.lower(title())
    return D.in_order(table(spark, d, "documents"), "doc_id", [("text", F.md5("text")), ("title", F.when(F.length(t) >= 10, t))])


@query("""WITH n AS (SELECT o_custkey AS k, max(o_totalprice) AS top FROM orders WHERE o_totalprice > 490000 GROUP BY o_custkey)
    SELECT coalesce(c_custkey, n.k) AS k, c_name AS name, CASE WHEN n.k IS NOT NULL THEN top ELSE c_acctbal END AS value, true AS few FROM customer FULL JOIN n ON c_custkey = n.k""")
def store_upsert(spark, d):
    """A table in buckets after an upsert: only the buckets of the keys that came in were written again."""
    root = f"{S.shared_folder(spark)}/store-{uuid.uuid4().hex}"
    first = W.create(table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("value")), root, "k", 256)
    new = table(spark, d, "orders").filter("o_totalprice > 490000").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("top"))

    def merge(held):
        both = held.join(new, "k", "full_outer")
        return both.select("k", "name", F.coalesce("top", "value").alias("value"))

    after, rewritten = W.change(spark, first, new.select("k"), merge)
    untouched = sum(after.paths.get(b) == p for b, p in first.paths.items())
    few = rewritten <= new.count() and untouched >= len(first.paths) - rewritten
    return after.read(spark).withColumn("few", F.lit(few))


@query("SELECT DISTINCT 's' || l_suppkey AS source_id, 's' || l_linenumber AS target_id FROM lineitem WHERE l_suppkey <> l_linenumber")
def self_edges(spark, d):
    """Ends that name a node by its uuid, slug or id are one node's, so an edge to itself is found whatever it is called."""
    key = F.col("s_suppkey").cast("string")
    uuid_of = lambda c: F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(c, 12, "0"))
    nodes = table(spark, d, "supplier").select(F.concat(F.lit("s"), key).alias("id"), uuid_of(key).alias("uuid"), F.col("s_name").alias("slug"))
    source, flag = F.col("l_suppkey").cast("string"), F.col("l_returnflag")
    name = F.when(flag == "R", F.upper(uuid_of(source))).when(flag == "A", F.concat(F.lit("Supplier#"), F.lpad(source, 9, "0"))).otherwise(F.concat(F.lit("s"), source))
    target = F.col("l_linenumber").cast("string")
    other = F.when(F.col("l_linestatus") == "O", F.replace(uuid_of(target), F.lit("-"), F.lit(""))).otherwise(F.concat(F.lit("s"), target))
    edges = table(spark, d, "lineitem").select(name.alias("source_id"), other.alias("target_id"), F.lit("references").alias("relationship"))
    return E.new_edges(E.by_node(edges, nodes), edges.limit(0)).select("source_id", "target_id")
