"""Queries over whole stored nodes: works made of parts, and orders that cite them in nested lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.operators import evidence as V
from paperloom.operators import identity as D
from paperloom.operators import monitor as M
from paperloom.operators.staging import dealt, staged
from paperloom.plans.registry import query, table
from paperloom.schemas import EDGE, NODE

#: Parts of one name and brand are siblings; the first of them leads, and the others carry its identity tag too.
_WORKS = """g AS (SELECT *, p_partkey AS k, min(p_partkey) OVER (PARTITION BY p_name, p_brand) AS lead FROM part),
    w AS (SELECT k, lead, p_name, p_type, -p_retailprice AS scan, p_size = 50 AS deleted, p_name || ' of ' || p_brand || ', no. ' || k AS title, CASE WHEN p_size <= 35 THEN 's' || k END AS s2, CASE WHEN p_size >= 10 THEN (100000 + k)::VARCHAR END AS pmid FROM g)"""


def works(spark, d) -> DataFrame:
    """Parts as stored nodes, with a column `scan` for their order."""
    p = dealt(table(spark, d, "part"))
    lead = p.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("lead"))
    k = F.col("p_partkey").cast("string")
    p = p.join(lead, ["p_name", "p_brand"])
    s2, pmid = F.when(F.col("p_size") <= 35, F.concat(F.lit("s"), k)), F.when(F.col("p_size") >= 10, (F.col("p_partkey") + 100000).cast("string"))
    uri = F.when(F.col("p_type") != "ECONOMY", F.concat(F.lit("https://doi.org/10.1/P"), k))
    none = lambda kind: F.lit(None).cast(kind)
    tags = F.filter(
        F.array(F.concat(F.lit("s2id:s"), k), F.when(F.col("lead") != F.col("p_partkey"), F.concat(F.lit("s2id:s"), F.col("lead").cast("string"))), F.concat(F.lit("pmid:"), pmid), F.concat(F.lit("kw:"), F.lower("p_type"))),
        lambda t: t.isNotNull(),
    )
    alternative = F.array(F.concat(F.lit("10.1/line-"), F.replace("p_name", F.lit(" "), F.lit("-"))), none("string"))
    reference = F.struct(
        F.lit("reference-v1").alias("schema"), none("string").alias("uri"), F.concat(F.lit("doi:10.1/Q"), k).alias("doi"), pmid.alias("pmid"), s2.alias("s2_id"), none("string").alias("year"),
        F.lit("").alias("venue"), none("array<string>").alias("authors"), alternative.alias("alt_dois"), none("string").alias("citation"),
        none("struct<source:string,retrieved_at:string,items:array<struct<doi:string,pmid:string,s2_id:string,title:string,year:int>>>").alias("outbound_citations"),
    )
    return p.select(
        F.concat(F.lit("p"), k).alias("id"), none("string").alias("uuid"), F.concat(F.lit("part-"), k).alias("slug"),
        F.concat("p_name", F.lit(" of "), "p_brand", F.lit(", no. "), k, F.lit(".")).alias("title"), uri.alias("uri"), none("string").alias("abstract"), none("string").alias("citation"),
        F.when(F.col("p_size") == 50, "deleted").alias("status"), F.lit("reference").alias("type"), tags.alias("tags"), F.struct(reference.alias("reference")).alias("metadata"), (-F.col("p_retailprice")).alias("scan"),
    ).to(_with_scan(spark))


def _with_scan(spark):
    return spark.createDataFrame([], f"{NODE}, scan double").schema


def _cited(spark, d) -> DataFrame:
    """l_orderkey, lines (part, flags, and the part's name and brand where a line cites by them): what an order's list is
    made of. Only lines that cite by name go to the parts."""
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    line = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus")
    flag, shipped = F.col("l_returnflag"), F.coalesce(F.col("l_linestatus") == "O", F.lit(False))
    by_name = F.coalesce((flag == "A") & ~shipped | (flag == "N") & shipped, F.lit(False))
    none = F.lit(None).cast("string")
    lines = line.filter(by_name).join(part, "l_partkey").unionByName(line.filter(~by_name).withColumns({"p_name": none, "p_brand": none}))
    return lines.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_partkey", "l_returnflag", "l_linestatus", "p_name", "p_brand")).alias("lines"))


def _orders(cited: DataFrame) -> DataFrame:
    """Orders as stored nodes, of what their lists are made of."""

    def item(x: Column) -> Column:
        part, k, flag, status, name = x["l_partkey"], x["l_partkey"].cast("string"), x["l_returnflag"], x["l_linestatus"], x["p_name"]
        return F.struct(
            F.when((flag == "A") & (status == "O"), F.concat(F.lit("https://doi.org/10.1/p"), k)).when(flag == "A", F.concat(F.lit("10.1/LINE-"), F.replace(name, F.lit(" "), F.lit("-")))).alias("doi"),
            F.when((flag == "N") & (status == "F"), (part + 100000).cast("string")).alias("pmid"), F.when(flag == "R", F.concat(F.lit("s"), k)).alias("s2_id"),
            F.when((flag == "N") & (status == "O"), F.upper(F.concat(name, F.lit(" of  "), x["p_brand"], F.lit(", no. "), k))).alias("title"), F.lit(None).cast("int").alias("year"),
        )

    outbound = F.struct(F.lit("s2-batch").alias("source"), F.lit("2024-01-01").alias("retrieved_at"), F.transform("lines", item).alias("items"))
    return cited.select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("id"), F.lit("open").alias("status"), F.lit("an order").alias("title"), F.struct(F.struct(outbound.alias("outbound_citations")).alias("reference")).alias("metadata"))


def citing(spark, d) -> DataFrame:
    """Orders as stored nodes; each line item cites its part by one kind of key, as its flags say."""
    return _orders(_cited(spark, d))


def library(spark, d) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): works and orders, and the edges that their lists and the works' identity tags led to. What lists
    and edges are made of is written, as numbers, so that no plan gathers it again; their texts are made where they are read."""
    schema = spark.createDataFrame([], NODE).schema
    held = staged(works(spark, d).drop("scan"), "works")
    orders = _orders(staged(_cited(spark, d), "lists"))
    blank = F.lit(None).cast(schema["metadata"].dataType)["reference"]
    filled = F.struct(F.struct(*[F.col("metadata.reference.outbound_citations").alias(f.name) if f.name == "outbound_citations" else blank[f.name].alias(f.name) for f in schema["metadata"].dataType["reference"].dataType]).alias("reference")).alias("metadata")
    orders = orders.select(*[filled if c == "metadata" else F.col(c) if c in ("id", "status", "title") else F.lit(None).cast(schema[c].dataType).alias(c) for c in schema.names])
    line = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    lead = table(spark, d, "part").groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("lead"))
    siblings = table(spark, d, "part").join(lead, ["p_name", "p_brand"]).filter("lead <> p_partkey").select(F.col("lead").alias("l_partkey"), "p_partkey")
    misled = line.filter("l_returnflag = 'R'").join(siblings, "l_partkey").select("l_orderkey", F.col("p_partkey").alias("l_partkey"))
    edges = staged(line.select("l_orderkey", "l_partkey").unionByName(misled).distinct(), "edges")
    edges = edges.withColumn("source_id", F.concat(F.lit("o"), F.col("l_orderkey").cast("string")))
    edges = edges.select(F.concat_ws("-", "source_id", "l_partkey").alias("id"), "source_id", F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("target_id"), F.lit("references").alias("relationship"))
    return held.unionByName(orders), edges.to(spark.createDataFrame([], EDGE).schema)


@query(f"""WITH {_WORKS}, k AS (SELECT 's2_id' AS kind, 's' || k AS key, k, scan FROM w UNION ALL SELECT 's2_id', 's' || lead, k, scan FROM w UNION ALL SELECT 'doi', '10.1/p' || k, k, scan FROM w WHERE p_type <> 'ECONOMY'
    UNION ALL SELECT 'doi', '10.1/q' || k, k, scan FROM w UNION ALL SELECT 'doi', '10.1/line-' || replace(p_name, ' ', '-'), k, scan FROM w UNION ALL SELECT 'pmid', pmid, k, scan FROM w WHERE pmid IS NOT NULL UNION ALL SELECT 'title', lower(title), k, scan FROM w)
    SELECT kind, key, arg_min('p' || k, (scan, 'p' || k)) AS node_id FROM k GROUP BY kind, key""")
def node_index_many(spark, d):
    """Several identifiers a node, and nodes that share one: the first in the order of the scan has it."""
    return D.node_index(works(spark, d), order="scan").select("kind", "key", "node_id")


_EVIDENCE = f"""{_WORKS}, bad AS (SELECT * FROM w WHERE lead <> k AND s2 IS NOT NULL AND NOT deleted), l AS (SELECT l_orderkey AS o, l_partkey AS p, l_returnflag AS f, l_linestatus AS s, p_name FROM lineitem JOIN w ON l_partkey = k),
    e AS (SELECT DISTINCT o, p AS t FROM l UNION SELECT o, k FROM l JOIN w ON p = lead AND lead <> k WHERE f = 'R'), i AS (SELECT e.o, bad.k AS t, bad.p_type, bad.pmid, bad.p_name FROM e JOIN bad ON e.t = bad.k),
    h AS (SELECT i.o, t, max(CASE WHEN f = 'R' AND p = t THEN 1 ELSE 0 END) AS a, max(CASE WHEN f = 'A' AND (s = 'O' AND p = t AND p_type <> 'ECONOMY' OR s = 'F' AND l.p_name = i.p_name) THEN 1 ELSE 0 END) AS b,
          max(CASE WHEN f = 'N' AND s = 'F' AND p = t AND pmid IS NOT NULL THEN 1 ELSE 0 END) AS c, max(CASE WHEN f = 'N' AND s = 'O' AND p = t THEN 1 ELSE 0 END) AS d FROM i JOIN l ON i.o = l.o GROUP BY i.o, t)"""


@query(f"WITH {_EVIDENCE} SELECT 'o' || o AS source_id, 'p' || t AS target_id, concat_ws(',', CASE a WHEN 1 THEN 's2_id' END, CASE b WHEN 1 THEN 'doi' END, CASE c WHEN 1 THEN 'pmid' END, CASE d WHEN 1 THEN 'title' END) AS kinds FROM h")
def edge_evidence(spark, d):
    """Citations of nodes with a foreign identity tag, and which kinds of keys of the citing list name them."""
    nodes, edges = library(spark, d)
    return V.plan(nodes, edges).evidence.withColumn("kinds", F.array_join("kinds", ","))


@query(f"""WITH {_WORKS} SELECT 'p' || k AS id, CASE WHEN s2 IS NOT NULL THEN 's2id:s' || lead ELSE '' END AS "foreign", CASE WHEN s2 IS NULL THEN array_to_string(list_sort(['s2id:s' || k, 's2id:s' || lead]), ',') ELSE '' END AS ambiguous FROM w WHERE lead <> k""")
def own_identity(spark, d):
    """Identity tags that are not a node's own, and those of which nothing tells whose they are."""
    return V.identity_tags(works(spark, d)).select("id", F.array_join("foreign", ",").alias("foreign"), F.array_join("ambiguous", ",").alias("ambiguous"))


@query(f"""WITH {_EVIDENCE} SELECT (SELECT count(*) FROM e)::BIGINT - count(*) FILTER (a + b + c + d = 0)::BIGINT AS edges, (SELECT count(*) FROM bad)::BIGINT AS mended, 0::BIGINT AS contaminated_after, 0::BIGINT AS phantom_after FROM h""")
def decontaminated(spark, d):
    """The store after a plan was applied; a second plan finds nothing."""
    nodes, edges = library(spark, d)
    made = V.plan(nodes, edges)
    mended, kept = V.apply(nodes, edges, made)
    again = V.plan(mended, kept).counts().select(F.col("contaminated").alias("contaminated_after"), F.col("phantom").alias("phantom_after"))
    n = staged(kept.agg(F.count(F.lit(1)).alias("edges")).join(made.contaminated.agg(F.count(F.lit(1)).alias("mended")), F.lit(True)), "counts")
    return n.join(again, F.lit(True))


@query("""WITH t AS (SELECT l_orderkey AS o, l_partkey AS p, l_returnflag AS f, l_linestatus AS s FROM lineitem), i AS (SELECT o, CASE f WHEN 'R' THEN 's' || p WHEN 'A' THEN CASE s WHEN 'O' THEN 'https://doi.org/10.1/p' || p END END AS v FROM t)
    SELECT DISTINCT 'o' || o AS id FROM i WHERE regexp_matches(v, '(?i)(^S|/P)[0-9]*7$')""")
def grep_nested(spark, d):
    """A regular expression over all values of stored nodes, those of nested lists too; no name of a field counts."""
    nodes = citing(spark, d)
    return M.grep(nodes, "(^S|/P)[0-9]*7$", regex=True, ignore_case=True).select("id")


@query("""SELECT conv_id, turn FROM conversations WHERE contains(text, chr(10)) OR contains(role, chr(10))""")
def grep_line_feeds(spark, d):
    """A line feed is found in values, and is none of what JSON would write for it."""
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.struct(F.array(F.struct("role", "text"))).alias("nested"))
    return M.grep(rows, "\n").select("conv_id", "turn")
