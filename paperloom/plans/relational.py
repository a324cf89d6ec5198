"""Queries over sources, joins, graphs, state, logs and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from paperloom.functions.identifiers import first_nonblank as first_of
from paperloom.operators import catalog as K
from paperloom.operators import graph as E
from paperloom.operators import identity as D
from paperloom.operators import monitor as M
from paperloom.operators import records as R
from paperloom.operators import repair as P
from paperloom.operators.staging import shared_folder
from paperloom.plans.registry import TITLE, query, table, title
from paperloom.sources import files as S
from paperloom.sources import ris
from paperloom.streaming import activity as A

_RIS_TEXT = "'TI  - ' || replace(text, chr(10), chr(10) || '  ') || chr(10) || 'AU  - ' || role || chr(10) || 'PY  - ' || (2000 + turn) || '/01' || chr(10) || 'DO  - doi:10.1/C' || conv_id || '.' || chr(10) || 'ER  - '"
_ONE_LINE = r"regexp_replace(regexp_replace(replace(text, chr(10), ' '), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')"


def _ris_rows(spark, d):
    text = F.concat(
        F.lit("TI  - "), F.regexp_replace("text", "\n", "\n  "), F.lit("\nAU  - "), F.col("role"), F.lit("\nPY  - "), (F.col("turn") + 2000).cast("string"),
        F.lit("/01\nDO  - doi:10.1/C"), F.col("conv_id").cast("string"), F.lit(".\nER  - "),
    )
    t = table(spark, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("k"), text.alias("text"))
    return ris.records(ris.record_texts(t, "k"), ["k", "rec"])


@query(f"SELECT conv_id || '-' || turn AS k, {_ONE_LINE} AS title, '10.1/c' || conv_id AS doi, (2000 + turn)::VARCHAR AS year, role AS authors FROM conversations WHERE {_ONE_LINE} <> ''")
def ris_parse(spark, d):
    clean = F.regexp_replace("title", r"\s+", " ")
    return _ris_rows(spark, d).select("k", clean.alias("title"), "doi", "year", F.array_join("authors", ";").alias("authors"))


@query(f"SELECT conv_id || '-' || turn AS k, {_ONE_LINE} AS title, '10.1/c' || conv_id AS doi, NULL::VARCHAR AS venue, true AS no_keywords FROM conversations WHERE {_ONE_LINE} <> ''")
def ris_project(spark, d):
    p = ris.project(_ris_rows(spark, d))
    return p.select("k", F.regexp_replace("title", r"\s+", " ").alias("title"), "doi", "venue", F.col("keywords").isNull().alias("no_keywords"))


@query(r"SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN role ELSE regexp_replace(text, '^\s+|\s+$', '', 'g') END AS value FROM conversations")
def first_nonblank(spark, d):
    a = F.when(F.col("turn") % 2 == 0, F.col("role")).otherwise(F.lit(" \t"))
    return table(spark, d, "conversations").select("conv_id", "turn", first_of([a, F.col("text")]).alias("value"))


@query("WITH t AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY CASE WHEN conv_id % 2 = 0 THEN '10.1/c' || conv_id ELSE lower(role) END ORDER BY conv_id * 1000 + turn) AS n FROM conversations) SELECT conv_id, turn FROM t WHERE n = 1")
def ris_dedup_first(spark, d):
    doi = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("10.1/c"), F.col("conv_id").cast("string"))).otherwise("")
    rows = table(spark, d, "conversations").select("conv_id", "turn", doi.alias("doi"), F.upper("role").alias("title"), (F.col("conv_id") * 1000 + F.col("turn")).alias("idx"))
    return ris.keep_first(rows, "idx").select("conv_id", "turn")


@query("SELECT p_partkey, 'TY  - JOUR' || chr(10) || 'TI  - ' || p_name || chr(10) || 'AU  - ' || p_brand || chr(10) || 'AU  - ' || p_type || CASE WHEN p_size % 2 = 0 THEN chr(10) || 'PY  - ' || p_size ELSE '' END || chr(10) || 'ER  - ' AS text FROM part")
def ris_export(spark, d):
    year = F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string"))
    return table(spark, d, "part").select("p_partkey", ris.export(F.col("p_name"), F.array("p_brand", "p_type"), year, F.lit(None).cast("string")).alias("text"))


@query("SELECT CASE event_id % 3 WHEN 0 THEN 'node' ELSE 'edge' END AS kind, count(*)::BIGINT AS n FROM events WHERE event_id % 3 <> 2 GROUP BY 1")
def export_slim(spark, d):
    n, i = F.col("event_id") % 3, F.col("event_id").cast("string")
    line = F.when(n == 2, F.concat(F.lit('{"operation":"'), F.col("event_type"), F.lit('"}'))).otherwise(F.concat(F.lit('{"kind":"'), F.when(n == 0, "node").otherwise("edge"), F.lit('","id":'), i, F.lit("}")))
    kept = S.slim(table(spark, d, "events").select(line.alias("value")))
    return kept.groupBy(F.get_json_object("value", "$.kind").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, event_type AS name FROM events WHERE event_id % 4 > 1")
def malformed_filter(spark, d):
    n = F.col("event_id") % 4
    raw = F.when(n == 0, "[1]").when(n == 1, '{"authors":"x"}').otherwise(F.concat(F.lit('{"authors":[{"name":"'), F.col("event_type"), F.lit('"}]}')))
    rows = table(spark, d, "events").select("event_id", raw.alias("raw")).filter(~K.malformed(F.col("raw")))
    return rows.select("event_id", F.get(K.entry_record(F.col("raw"))["authors"], F.lit(0)).alias("name"))


@query("""WITH t AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, year(l_shipdate) AS y FROM lineitem), i AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 <> 1 THEN '10.1/p' || l_partkey END AS doi, CASE WHEN l_linenumber % 2 = 0 THEN 't' || l_suppkey END AS title, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE y END AS year FROM t)
    SELECT l_orderkey, count(*)::BIGINT AS n_items, count(doi)::BIGINT AS n_dois, coalesce(sum(year), 0)::BIGINT AS years FROM i WHERE doi IS NOT NULL OR title IS NOT NULL GROUP BY l_orderkey""")
def citation_items(spark, d):
    n = F.col("l_linenumber")
    item = F.struct(
        F.when(n % 3 != 1, F.concat(F.lit(" 10.1/P"), F.col("l_partkey").cast("string"))).otherwise("").alias("doi"), F.col("l_suppkey").cast("string").alias("pmid"),
        F.when(n % 2 == 0, F.concat(F.lit("t"), F.col("l_suppkey").cast("string"))).otherwise(" ").alias("title"),
        F.when(n % 3 == 0, F.lit("n.d.")).otherwise(F.date_format("l_shipdate", "yyyy")).alias("year"),
    )
    lists = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(item).alias("raw"))
    kept = lists.select("l_orderkey", R.citation_items(F.col("raw")).alias("i")).filter(F.size("i") > 0)
    years = F.aggregate(F.filter(F.transform("i", lambda x: x["year"]), lambda y: y.isNotNull()), F.lit(0).cast("long"), lambda s, y: s + y)
    return kept.select("l_orderkey", F.size("i").cast("long").alias("n_items"), F.size(F.filter("i", lambda x: x["doi"].isNotNull())).cast("long").alias("n_dois"), years.alias("years"))


@query("SELECT floor(p_partkey / 500)::BIGINT AS chunk, count(*)::BIGINT AS n FROM part GROUP BY 1")
def chunking(spark, d):
    return table(spark, d, "part").groupBy(S.chunked(F.col("p_partkey"), 500).alias("chunk")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT d.doc_id, CASE WHEN quality = 1 THEN 'labelled' WHEN regexp_matches(text, 'https?://\\S') THEN 'linked' WHEN n_chars > 2000 THEN 'long' ELSE 'abstract' END AS origin
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def fallback_chain(spark, d):
    """The first source that has something for a document: a good label, an address in it, a long text."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    address = F.regexp_extract("text", r"(https?://\S)", 1)
    sources = [("labelled", F.when(F.col("quality") == 1, F.col("quality"))), ("linked", address), ("long", F.when(F.col("n_chars") > 2000, F.col("n_chars")))]
    return docs.select("doc_id", K.fallback(sources, "abstract").alias("origin"))


@query("SELECT doc_id FROM documents WHERE contains(text, 'the') AND contains(lower(source), 'src1')")
def find_text(spark, d):
    return M.find_nodes(table(spark, d, "documents").filter(F.contains("text", F.lit("the"))), text="SRC1", columns=["source"]).select("doc_id")


@query("SELECT p_partkey FROM part WHERE lower(p_brand) = 'brand#11'")
def find_tag(spark, d):
    tagged = table(spark, d, "part").withColumn("tags", F.array(F.concat(F.lit("kw:"), F.lower("p_brand"))))
    return M.find_nodes(tagged, tag="kw:brand#11").select("p_partkey")


@query("SELECT p_partkey FROM part WHERE contains(p_name, 'red') OR contains(p_brand, 'red') OR contains(p_type, 'red')")
def grep_all_fields(spark, d):
    return M.grep(table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type"), "red").select("p_partkey")


@query(rf"""WITH t AS (SELECT doc_id, regexp_replace({TITLE}, '^\s+|\s+$', '', 'g') AS t FROM documents) SELECT doc_id, length(t) >= 10 OR doc_id % 4 = 0 AS valid FROM t""")
def parse_validate(spark, d):
    none = F.lit(None).cast("string")
    rows = table(spark, d, "documents").select("doc_id", title().alias("title"), F.when(F.col("doc_id") % 4 == 0, F.lit("doi:10.1/x")).alias("doi"), none.alias("pmid"))
    return R.parse(rows).select("doc_id", (F.size("errors") == 0).alias("valid"))


@query("SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def enrich_bulk_lookup(spark, d):
    catalog = table(spark, d, "labels").select("doc_id", F.col("doc_id").alias("idx"), F.struct("quality", "toxic").alias("entry"))
    return R.bulk_lookup(table(spark, d, "documents").select("doc_id"), catalog, "doc_id").select("doc_id", F.col("entry.quality").alias("quality"))


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def cached_lookup(spark, d):
    """Each distinct key is resolved once, then joined back."""
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("k"))
    known = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    return K.resolve_once(c, "k", known).select("c_custkey", "n_name")


@query("""WITH m AS (SELECT source, CASE WHEN avg(quality) >= 0.5 THEN 1 ELSE 0 END AS major FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY source)
    SELECT d.doc_id, coalesce(quality, major)::INTEGER AS quality, CASE WHEN quality IS NOT NULL THEN 'labels' WHEN major IS NOT NULL THEN 'source' ELSE 'input-only' END AS origin
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN m ON d.source = m.source""")
def enrich_waterfall(spark, d):
    docs, labels = table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels").select("doc_id", "quality")
    major = docs.join(labels, "doc_id").groupBy("source").agg(F.when(F.avg("quality") >= 0.5, 1).otherwise(0).alias("quality"))
    base = docs.withColumn("quality", F.lit(None).cast("int"))
    first = R.waterfall(base, [("labels", labels)], "doc_id", ["quality"]).withColumnRenamed("origin", "o1")
    second = R.waterfall(first, [("source", major)], "source", ["quality"])
    return second.select("doc_id", "quality", F.when(F.col("o1") != "input-only", F.col("o1")).otherwise(F.col("origin")).alias("origin"))


@query("SELECT c_custkey, c_custkey % 6 <> 5 OR c_acctbal < 0 AS needed FROM customer")
def needs_enrichment(spark, d):
    k = F.col("c_custkey") % 6
    full = lambda n: F.when(k == n, F.lit("")).otherwise("x")
    venue = F.when(F.col("c_acctbal") >= 0, full(4))
    authors = F.when(k == 2, F.array().cast("array<string>")).otherwise(F.array(F.lit("a")))
    needed = R.needs_enrichment(k != 0, full(1), F.lit("s"), authors, full(3), venue, F.lit("t"))
    return table(spark, d, "customer").select("c_custkey", needed.alias("needed"))


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def last_wins_map(spark, d):
    e = table(spark, d, "events")
    catalog = e.select("user_id", F.col("event_id").alias("idx"), F.struct("event_type").alias("entry"))
    return R.bulk_lookup(e.select("user_id").distinct(), catalog, "user_id").select("user_id", "entry.event_type")


def _doc_keys():
    t = F.lower(title())
    return [("text", F.md5("text")), ("shape", F.concat_ws("|", "source", "n_chars")), ("title", F.when(F.length(t) >= 10, t))]


_DOC_KEYS = f"""k AS (SELECT doc_id, 'text' AS kind, 0 AS prio, md5(text) AS key FROM documents UNION ALL SELECT doc_id, 'shape', 1, source || '|' || n_chars FROM documents
    UNION ALL SELECT doc_id, 'title', 2, lower({TITLE}) FROM documents WHERE length({TITLE}) >= 10)"""


@query(f"WITH {_DOC_KEYS} SELECT kind, key, min(doc_id) AS node_id FROM k GROUP BY kind, key")
def node_key_index(spark, d):
    return D.key_index(table(spark, d, "documents"), "doc_id", _doc_keys()).select("kind", "key", "node_id")


@query(f"""WITH {_DOC_KEYS}, i AS (SELECT kind, key, min(doc_id) AS node FROM k WHERE doc_id % 2 = 0 GROUP BY kind, key),
    h AS (SELECT k.doc_id, i.node, k.kind, row_number() OVER (PARTITION BY k.doc_id ORDER BY prio) AS n FROM k JOIN i ON k.kind = i.kind AND k.key = i.key WHERE k.doc_id % 2 = 1)
    SELECT doc_id, node AS match_id, kind AS reason FROM h WHERE n = 1""")
def dedup_priority_match(spark, d):
    docs = table(spark, d, "documents")
    index = D.key_index(docs.filter("doc_id % 2 = 0"), "doc_id", _doc_keys())
    return D.priority_match(docs.filter("doc_id % 2 = 1"), index, "doc_id", _doc_keys())


@query("SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS rep_id, doc_id = min(doc_id) OVER (PARTITION BY text) AS created FROM documents")
def intra_batch_dedup_single(spark, d):
    return D.in_order(table(spark, d, "documents"), "doc_id", [_doc_keys()[0]])


@query("SELECT o_orderkey, min(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END)::INTEGER AS place FROM orders WHERE o_orderstatus IN ('P', 'F') OR o_orderpriority = '1-URGENT' GROUP BY o_orderkey")
def backfill_candidates(spark, d):
    o = table(spark, d, "orders")
    scans = [o.filter(c).select("o_orderkey", F.lit(None).cast("string").alias("uuid")) for c in ("o_orderstatus = 'P'", "o_orderstatus = 'F'", "o_orderpriority = '1-URGENT'")]
    return R.candidates(scans, ["o_orderkey", "uuid"]).select("o_orderkey", F.least("place", F.lit(1)).alias("place"))


def _edges(spark, d):
    o, p = F.concat(F.lit("o:"), F.col("l_orderkey").cast("string")), F.concat(F.lit("p:"), F.col("l_partkey").cast("string"))
    return table(spark, d, "lineitem").select(o.alias("source_id"), p.alias("target_id"), F.lit("references").alias("relationship"), "l_linenumber")


@query("SELECT 'o:' || l_orderkey AS source_id, count(*) FILTER (l_partkey % 3 <> 0)::BIGINT AS linked, count(*) FILTER (l_partkey % 3 = 0)::BIGINT AS skipped FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) GROUP BY 1")
def link_forward(spark, d):
    items = _edges(spark, d).select("source_id", F.col("target_id").alias("key")).distinct()
    known = table(spark, d, "part").filter("p_partkey % 3 <> 0").select(F.concat(F.lit("p:"), F.col("p_partkey").cast("string")).alias("key"))
    return E.link_counts(items, known.withColumn("target_id", F.col("key")))


@query("SELECT 'p:' || l_partkey AS target_id, count(DISTINCT l_orderkey)::BIGINT AS n_sources FROM lineitem WHERE l_partkey % 3 = 0 GROUP BY 1")
def link_reverse(spark, d):
    made = table(spark, d, "part").filter("p_partkey % 3 = 0").select(F.concat(F.lit("p:"), F.col("p_partkey").cast("string")).alias("key"))
    return E.link_reverse(_edges(spark, d).select("source_id", F.col("target_id").alias("key")), made.withColumn("target_id", F.col("key")))


@query("SELECT DISTINCT 'o:' || l_orderkey AS source_id, 'p:' || l_partkey AS target_id FROM lineitem a WHERE EXISTS (SELECT 1 FROM lineitem b WHERE a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey AND b.l_linenumber = 1)")
def edge_exists_semi(spark, d):
    e = _edges(spark, d)
    return E.existing_edges(e, e.filter("l_linenumber = 1")).select("source_id", "target_id")


@query("SELECT DISTINCT 'o:' || l_orderkey AS source_id, 'p:' || l_partkey AS target_id FROM lineitem a WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey AND b.l_linenumber = 1)")
def edge_insert_anti(spark, d):
    e = _edges(spark, d)
    return E.new_edges(e, e.filter("l_linenumber = 1")).select("source_id", "target_id")


@query("WITH e AS (SELECT DISTINCT l_orderkey AS s, l_partkey AS t FROM lineitem), i AS (SELECT s AS n FROM e UNION ALL SELECT t FROM e WHERE s <> t) SELECT n AS node, count(*)::BIGINT AS n_edges FROM i GROUP BY n")
def incident_edges(spark, d):
    e = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("source_id"), F.col("l_partkey").alias("target_id")).distinct()
    return E.incident(e).groupBy("node").agg(F.count(F.lit(1)).alias("n_edges"))


@query("WITH e AS (SELECT DISTINCT 'o:' || l_orderkey AS s, 'p:' || l_partkey AS t FROM lineitem) SELECT s AS node, count(*)::BIGINT AS n_out, 0::BIGINT AS n_in FROM e GROUP BY s UNION ALL SELECT t, 0, count(*) FROM e GROUP BY t")
def degree_counts(spark, d):
    return E.degrees(_edges(spark, d))


@query("SELECT count(*)::BIGINT AS n_ids, count(DISTINCT l_orderkey || '-' || l_partkey)::BIGINT AS n_keys FROM lineitem")
def edge_counts(spark, d):
    return E.edge_counts(_edges(spark, d).withColumn("id", F.monotonically_increasing_id()), "id")


@query("WITH b AS (SELECT p_partkey FROM part WHERE p_size % 2 = 0) SELECT l_orderkey, count(DISTINCT l_partkey)::BIGINT AS n FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM b) AND l_partkey <> l_orderkey GROUP BY l_orderkey")
def cross_citations(spark, d):
    batch = table(spark, d, "part").filter("p_size % 2 = 0").select(F.col("p_partkey").alias("doi"))
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("source_id"), F.col("l_orderkey").alias("own"), F.col("l_partkey").alias("doi"))
    return R.cross_citations(items, batch).withColumnRenamed("source_id", "l_orderkey")


@query("""WITH e AS (SELECT DISTINCT 'o:' || l_orderkey AS s, 'p:' || l_partkey AS t FROM lineitem), h1 AS (SELECT DISTINCT s AS n FROM e WHERE t = 'p:1'), h2 AS (SELECT DISTINCT t AS n FROM e WHERE s IN (SELECT n FROM h1) AND t <> 'p:1'),
    h3 AS (SELECT DISTINCT s AS n FROM e WHERE t IN (SELECT n FROM h2) AND s NOT IN (SELECT n FROM h1)) SELECT 'p:1' AS node, 0 AS hop UNION ALL SELECT n, 1 FROM h1 UNION ALL SELECT n, 2 FROM h2 UNION ALL SELECT n, 3 FROM h3""")
def subgraph_k_hop(spark, d):
    return E.k_hop(_edges(spark, d), "p:1", 3)


@query("""WITH RECURSIVE e AS (SELECT DISTINCT 'o:' || l_orderkey AS s, 'p:' || l_partkey AS t FROM lineitem), b AS (SELECT s, t FROM e UNION ALL SELECT t, s FROM e),
    w(n, h) AS (SELECT 'p:1', 0 UNION SELECT b.t, h + 1 FROM w JOIN b ON b.s = w.n WHERE h < 6) SELECT 'p:1' AS start, 'p:2' AS goal, min(h)::BIGINT AS hops FROM w WHERE n = 'p:2' HAVING count(*) > 0""")
def shortest_path(spark, d):
    return E.shortest_path(_edges(spark, d), "p:1", "p:2", 6).drop("path")


@query("""WITH c AS (SELECT DISTINCT l_orderkey AS s, l_partkey + CASE WHEN l_linenumber = 2 THEN 1 ELSE 0 END AS t FROM lineitem), g AS (SELECT DISTINCT l_orderkey AS s, l_partkey AS t FROM lineitem),
    n AS (SELECT DISTINCT l_orderkey AS s, p_name FROM lineitem JOIN part ON l_partkey = p_partkey) SELECT s AS source_id, t AS target_id FROM c WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.s = c.s AND g.t = c.t)
    AND NOT EXISTS (SELECT 1 FROM n JOIN part ON n.p_name = part.p_name WHERE n.s = c.s AND part.p_partkey = c.t)""")
def phantom_edges(spark, d):
    line = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("source_id"), "l_partkey", "l_linenumber")
    part = table(spark, d, "part").select("p_partkey", "p_name")
    claimed = line.select("source_id", (F.col("l_partkey") + F.when(F.col("l_linenumber") == 2, 1).otherwise(0)).alias("target_id"))
    same = line.select("source_id", F.col("l_partkey").alias("target_id"))
    # By name: the claim's part and the order's parts meet on the name, so this stays an equi-join on (order, name).
    cited = line.join(part, F.col("l_partkey") == F.col("p_partkey")).select("source_id", "p_name").distinct()
    named = claimed.distinct().join(part, F.col("target_id") == F.col("p_partkey")).join(cited, ["source_id", "p_name"]).select("source_id", "target_id")
    return E.phantom_edges(claimed, [same, named])


@query("SELECT count(*)::BIGINT AS n_edges, (SELECT count(*) FROM part WHERE p_size % 10 = 0)::BIGINT AS n_deleted FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size % 10 = 0)")
def repair_apply(spark, d):
    part = table(spark, d, "part").select(F.concat(F.lit("p:"), F.col("p_partkey").cast("string")).alias("id"), "p_size", F.lit("open").alias("status"))
    edges, nodes = P.apply_plan(_edges(spark, d), part.drop("p_size"), part.filter("p_size % 10 = 0").select("id"))
    deleted = nodes.agg(F.count_if(F.col("status") == "deleted").alias("n_deleted"))
    return edges.agg(F.count(F.lit(1)).alias("n_edges")).join(deleted, F.lit(True))


@query("""WITH o AS (SELECT o_custkey AS k, max(o_orderpriority) AS venue, max(o_orderstatus) AS cite FROM orders GROUP BY o_custkey), c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS venue, c_name AS cite FROM customer WHERE c_custkey % 3 <> 0)
    SELECT coalesce(o.k, c.k) AS k, coalesce(c.venue, o.venue) AS venue, coalesce(o.cite, c.cite) AS cite, c.k IS NULL AS created FROM c FULL JOIN o ON c.k = o.k""")
def upsert_nodes(spark, d):
    old = table(spark, d, "customer").filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("venue"), F.col("c_name").alias("cite"))
    new = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderpriority").alias("venue"), F.max("o_orderstatus").alias("cite"))
    return R.upsert(old, new, "k", ["venue"], ["cite"])


@query("""SELECT l_orderkey, CASE WHEN count(*) FILTER (l_returnflag = 'R') = 0 THEN count(*) ELSE count(*) FILTER (l_returnflag = 'R') END::BIGINT AS kept, CASE WHEN count(*) FILTER (l_returnflag = 'R') = 0 THEN 'stored' ELSE 'incoming' END AS side FROM lineitem GROUP BY l_orderkey""")
def citations_no_downgrade(spark, d):
    part = F.col("l_partkey").cast("string")
    lists = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(part).alias("stored"), F.collect_list(F.when(F.col("l_returnflag") == "R", part)).alias("incoming"))
    items, side = R.kept_citations(F.col("stored"), F.col("incoming"))
    return lists.select("l_orderkey", F.size(items).cast("long").alias("kept"), side.alias("side"))


@query("SELECT o.o_orderkey, o.o_orderkey % 5 <> 0 AS node_exists, o.o_orderkey % 5 <> 0 AND o_orderstatus = 'F' AS has_citations, CASE WHEN o.o_orderkey % 5 <> 0 THEN o_orderstatus END AS status, coalesce(n, 0)::BIGINT AS n_edges FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON o.o_orderkey = l.l_orderkey")
def verify_outcomes(spark, d):
    o = table(spark, d, "orders")
    nodes = o.filter("o_orderkey % 5 <> 0").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("has_citations"), F.col("o_orderstatus").alias("status"))
    return R.verify(o, nodes, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query("SELECT CASE o_orderstatus WHEN 'P' THEN 'digesting' WHEN 'F' THEN 'digested' ELSE 'queued' END AS status, count(*)::BIGINT AS n FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1")
def stats_pipeline(spark, d):
    status = F.when(F.col("o_orderpriority") == "5-LOW", "deleted")
    s = F.when(F.col("o_orderstatus") == "P", "digesting").when(F.col("o_orderstatus") == "F", "digested").otherwise("queued")
    nodes = table(spark, d, "orders").filter(M.alive(status)).select(F.array(F.lit("kw:x"), F.concat(F.lit("pipeline:"), s)).alias("tags"))
    return M.status_counts(nodes)


@query("SELECT (SELECT count(*) FROM orders WHERE o_orderpriority <> '5-LOW')::BIGINT AS alive, (SELECT count(*) FROM orders WHERE o_orderpriority = '5-LOW')::BIGINT AS deleted, (SELECT count(*) FROM lineitem)::BIGINT AS edges, (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R')::BIGINT AS refs, (SELECT count(*) FROM events)::BIGINT AS mutations")
def stats_scalars(spark, d):
    nodes = table(spark, d, "orders").select(F.when(F.col("o_orderpriority") == "5-LOW", "deleted").alias("status"))
    edges = table(spark, d, "lineitem").select(F.when(F.col("l_returnflag") == "R", "references").otherwise("parent").alias("relationship"))
    return M.scalar_counts(nodes, edges, table(spark, d, "events"))


@query("WITH m AS (SELECT max(ts) AS t FROM events) SELECT count(*) FILTER (ts > t - INTERVAL 1 DAY)::BIGINT AS last_day, count(*) FILTER (ts > t - INTERVAL 7 DAY)::BIGINT AS last_week FROM events, m")
def recent_activity(spark, d):
    return M.recent(table(spark, d, "events"), {"last_day": 86_400, "last_week": 604_800})


@query("SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def last_mutation(spark, d):
    return M.last_mutation(table(spark, d, "events")).select("event_id", "event_type")


@query("WITH m AS (SELECT max(ts) AS t, min(user_id) AS u, min(event_type) AS e FROM events) SELECT event_id FROM events, m WHERE event_type = e AND ts > t - INTERVAL 604800 SECOND")
def mutations_filter(spark, d):
    e = table(spark, d, "events")
    first = e.agg(F.max("ts"), F.min("event_type")).first()
    return M.log_filter(e, since="604800", now=F.lit(first[0]).cast("timestamp_ntz"), event_type=first[1], user_id=None).select("event_id")


@query("SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 50")
def mutations_topk(spark, d):
    return M.page(table(spark, d, "events")).select("event_id", "user_id", "event_type")


def _outcomes(spark, d):
    k, none = F.col("o_orderkey"), F.array().cast("array<string>")
    errors = F.when(k % 7 == 0, F.array(F.lit("HTTP 404"))).when(k % 7 == 1, F.array(F.lit("busy"), F.lit("locked"))).otherwise(none)
    return table(spark, d, "orders").select("o_orderkey", "o_orderstatus", errors.alias("errors"), (k % 2 == 0).alias("created"), (k % 5).cast("int").alias("linked"), (k % 3).cast("int").alias("stored"), (F.col("o_custkey") % 4).cast("int").alias("skipped"))


@query("""SELECT count(*)::BIGINT AS processed, sum(CASE WHEN o_orderkey % 7 > 1 THEN o_orderkey % 5 ELSE 0 END)::BIGINT AS edges_linked, sum(CASE WHEN o_orderkey % 7 > 1 THEN o_orderkey % 3 ELSE 0 END)::BIGINT AS citations_stored,
    count(*) FILTER (o_orderkey % 7 = 1)::BIGINT AS failed, count(*) FILTER (o_orderkey % 7 = 0)::BIGINT AS needs_review, sum(CASE o_orderkey % 7 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END)::BIGINT AS errors FROM orders""")
def backfill_summary(spark, d):
    return R.backfill_summary(_outcomes(spark, d))


@query("SELECT count(*)::BIGINT AS total, count(*) FILTER (o_orderkey % 7 > 1)::BIGINT AS succeeded, count(*) FILTER (o_orderkey % 7 <= 1)::BIGINT AS failed, count(*) FILTER (o_orderkey % 2 = 0)::BIGINT AS created, count(*) FILTER (o_orderkey % 2 = 1)::BIGINT AS updated FROM orders")
def outcome_summary(spark, d):
    return R.outcome_summary(_outcomes(spark, d))


@query("SELECT count(*) FILTER (o_orderkey % 7 > 1 AND o_orderkey % 2 = 0)::BIGINT AS created, count(*) FILTER (o_orderkey % 7 > 1 AND o_orderkey % 2 = 1)::BIGINT AS updated, count(*) FILTER (o_orderkey % 7 <= 1)::BIGINT AS failed, sum(o_orderkey % 5)::BIGINT AS linked FROM orders")
def import_summary(spark, d):
    return R.import_summary(_outcomes(spark, d))


@query("SELECT event_type, round(sum(value), 4) AS wall, count(*)::BIGINT AS items, round(coalesce(sum(value) / nullif(count(*), 0), 0), 4) AS per_item FROM events GROUP BY event_type")
def phase_metrics(spark, d):
    return R.phase_metrics(table(spark, d, "events"), "event_type", "value")


@query("SELECT o_orderstatus, sum(o_orderkey % 3)::BIGINT AS stored, sum(o_orderkey % 5)::BIGINT AS linked, sum(o_custkey % 4)::BIGINT AS skipped, round(sum(o_orderkey % 5) / count(*), 2) AS per_paper FROM orders GROUP BY o_orderstatus")
def bench_rollup(spark, d):
    return R.bench_rollup(_outcomes(spark, d), "o_orderstatus")


@query("""WITH w AS (SELECT event_type, unnest([0, 1, 2, 3, 4]) AS k, epoch_us(ts) AS t FROM events) SELECT (t // 60000000 - k)::BIGINT * 60000000 AS start_us, event_type, count(*)::BIGINT AS n FROM w GROUP BY 1, 2""")
def stream_activity_window(spark, d):
    """The stream of the log, run over all there is into a table; late rows count, as the watermark spans the log."""
    where = f"{shared_folder(spark)}/activity-{uuid.uuid4().hex}"
    counted = A.activity(_log(spark, d), late="3650 days")
    sink = counted.writeStream.outputMode("complete").foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{where}/out"))
    sink.option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{where}/out")


def _log(spark, d):
    """The log as a stream. A stream takes folders, globs among them, so a table in one file is named by a glob."""
    return spark.readStream.schema(spark.read.parquet(f"{d}/events.parquet").schema).parquet(f"{d}/events.parque[t]")


@query("SELECT user_id, count(*)::BIGINT AS n, max(event_id) AS last_id FROM events GROUP BY user_id")
def stream_ingest(spark, d):
    """Batches of the log into the store; a repeated batch overwrites its own folder, so each row counts once."""
    where = f"{shared_folder(spark)}/ingest-{uuid.uuid4().hex}"
    A.ingest(_log(spark, d), lambda b, n: b.write.mode("overwrite").parquet(A.batch_path(f"{where}/store", n)), f"{where}/state").awaitTermination()
    return spark.read.parquet(f"{where}/store").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"))
