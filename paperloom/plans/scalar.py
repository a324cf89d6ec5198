"""Queries over identifiers, years, texts, tags and state."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.functions import identifiers as I
from paperloom.functions import tags as G
from paperloom.functions import text as X
from paperloom.operators import monitor as M
from paperloom.operators import records as R
from paperloom.operators import repair as P
from paperloom.plans.registry import PART_TAGS, TITLE, part_tags, query, table, title

_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_PRE = r"'(?i)^(doi:|https://doi\.org/|http://dx\.doi\.org/)'"
_RAW = "CASE page_id % 5 WHEN 0 THEN 'doi:10.1/AB' || page_id WHEN 1 THEN ' https://doi.org/10.2/X' || page_id || chr(9) WHEN 2 THEN 'http://dx.doi.org/10.3/Y' || page_id WHEN 3 THEN chr(10) || ' ' ELSE url END"


def _raw():
    i, lit = F.col("page_id").cast("string"), F.lit
    n = F.col("page_id") % 5
    return (
        F.when(n == 0, F.concat(lit("doi:10.1/AB"), i)).when(n == 1, F.concat(lit(" https://doi.org/10.2/X"), i, lit("\t")))
        .when(n == 2, F.concat(lit("http://dx.doi.org/10.3/Y"), i)).when(n == 3, lit("\n ")).otherwise(F.col("url"))
    )


@query(f"SELECT page_id, nullif({_STRIP.format(f'lower(regexp_replace({_STRIP.format(_RAW)}, {_PRE}, {chr(39)*2}))')}, '') AS bare FROM pages")
def norm_bare_id(spark, d):
    return table(spark, d, "pages").select("page_id", I.bare_id(_raw()).alias("bare"))


@query(f"SELECT page_id, CASE WHEN {_STRIP.format(_RAW)} = '' THEN '' ELSE 'https://doi.org/' || {_STRIP.format(f'regexp_replace({_STRIP.format(_RAW)}, {_PRE}, {chr(39)*2})')} END AS uri FROM pages")
def norm_uri(spark, d):
    return table(spark, d, "pages").select("page_id", I.id_uri(_raw()).alias("uri"))


_RIS = r"lower(regexp_replace(regexp_replace(regexp_replace({}, '(?i)^doi:\s*', ''), '(?i)^https?://(dx\.)?doi\.org/', ''), '[\s.;,]+$', ''))"


@query(f"SELECT page_id, {_RIS.format(_STRIP.format(_RAW + ' || ' + chr(39) + ' .;,' + chr(39)))} AS ris FROM pages")
def norm_ris_id(spark, d):
    return table(spark, d, "pages").select("page_id", I.ris_id(F.concat(_raw(), F.lit(" .;,"))).alias("ris"))


@query(
    rf"""WITH t AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'doi: 10.5/K' || page_id || '.' END AS a, url || CASE WHEN page_id % 2 = 0 THEN ' see 10.7/Q' || page_id || ';' ELSE '' END AS b FROM pages),
    n AS (SELECT page_id, a, b, {_RIS.format(_STRIP.format("coalesce(a, '')"))} AS na, {_RIS.format(_STRIP.format("coalesce(b, '')"))} AS nb, nullif(regexp_extract(coalesce(a, ''), '(10\.\S+)', 1), '') AS ia, nullif(regexp_extract(coalesce(b, ''), '(10\.\S+)', 1), '') AS ib FROM t)
    SELECT page_id, coalesce(CASE WHEN starts_with(na, '10.') THEN na ELSE {_RIS.format("ia")} END, CASE WHEN starts_with(nb, '10.') THEN nb ELSE {_RIS.format("ib")} END, '') AS found FROM n"""
)
def extract_id(spark, d):
    i = F.col("page_id").cast("string")
    a = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("doi: 10.5/K"), i, F.lit(".")))
    b = F.concat(F.col("url"), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit(" see 10.7/Q"), i, F.lit(";"))).otherwise(""))
    return table(spark, d, "pages").select("page_id", a.alias("a"), b.alias("b")).select("page_id", I.extract_id([F.col("a"), F.col("b")]).alias("found"))


@query("SELECT o_orderkey, coalesce(nullif(regexp_extract(coalesce(CASE WHEN o_orderkey % 3 = 0 THEN 'n.d.' END, ''), '((?:19|20)[0-9]{2})', 1), ''), nullif(regexp_extract(strftime(o_orderdate, '%Y-%m-%d'), '((?:19|20)[0-9]{2})', 1), '')) AS year FROM orders")
def extract_year(spark, d):
    a = F.when(F.col("o_orderkey") % 3 == 0, F.lit("n.d."))
    return table(spark, d, "orders").select("o_orderkey", I.extract_year([a, F.date_format("o_orderdate", "yyyy-MM-dd")]).alias("year"))


@query("WITH t AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN '20a4' END AS y FROM orders) SELECT o_orderkey, CASE WHEN regexp_matches(y, '^[0-9]+$') THEN y::INTEGER END AS year FROM t")
def coerce_year(spark, d):
    n = F.col("o_orderkey") % 3
    y = F.when(n == 0, F.date_format("o_orderdate", "yyyy")).when(n == 1, F.lit("20a4"))
    return table(spark, d, "orders").select("o_orderkey", I.coerce_year(y).alias("year"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN '1987' WHEN 2 THEN '2023' END AS year FROM orders")
def year_waterfall(spark, d):
    n = F.col("o_orderkey") % 4
    parts = [F.when(n == 0, F.date_format("o_orderdate", "yyyy")).when(n == 2, F.lit("24")), F.when(n == 1, F.lit("1987")), F.when(n == 2, F.lit("2023")).when(n == 3, F.lit("999"))]
    return table(spark, d, "orders").select("o_orderkey", I.year_waterfall(parts).alias("year"))


@query(r"SELECT doc_id, nullif(regexp_replace(CASE WHEN doc_id % 4 = 0 THEN chr(9) || ' ' || chr(10) ELSE ' ' || source || chr(10) END, '^\s+|\s+$', '', 'g'), '') AS value FROM documents")
def blank_to_null(spark, d):
    c = F.when(F.col("doc_id") % 4 == 0, F.lit("\t \n")).otherwise(F.concat(F.lit(" "), F.col("source"), F.lit("\n")))
    return table(spark, d, "documents").select("doc_id", I.blank_to_null(c).alias("value"))


@query("WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'id' || o_orderkey END AS i, CASE WHEN o_orderkey % 3 = 0 THEN 'uu' || o_orderkey END AS u, 'slug' || o_orderkey AS s FROM orders) SELECT o_orderkey, coalesce(i, u, s) AS key, coalesce(s, i, u) AS shown FROM t")
def id_precedence(spark, d):
    k = F.col("o_orderkey")
    named = lambda p, when: F.when(when, F.concat(F.lit(p), k.cast("string")))
    t = table(spark, d, "orders").select(k, named("id", k % 2 == 0).alias("i"), named("uu", k % 3 == 0).alias("u"), named("slug", k > -1).alias("s"))
    return t.select("o_orderkey", I.node_key(F.col("i"), F.col("u"), F.col("s")).alias("key"), I.node_slug(F.col("s"), F.col("i"), F.col("u")).alias("shown"))


@query(
    r"""WITH t AS (SELECT doc_id, md5(text) AS h FROM documents), u AS (SELECT doc_id, h, h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] AS dashed FROM t)
    SELECT doc_id, dashed, lower(replace(upper(dashed), '-', '')) AS hex, CASE WHEN doc_id % 2 = 0 THEN true ELSE false END AS is_uuid FROM u"""
)
def uuid_forms(spark, d):
    dashed = I.uuid_dashed(F.md5("text"))
    shown = F.when(F.col("doc_id") % 2 == 0, F.upper(dashed)).otherwise(F.md5("text"))
    return table(spark, d, "documents").select("doc_id", dashed.alias("dashed"), I.uuid_hex(F.upper(dashed)).alias("hex"), I.is_uuid(shown).alias("is_uuid"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'not json' ELSE NULL END AS kept_text, event_id % 5 <> 0 AS parsed FROM events")
def json_lenient(spark, d):
    raw = F.when(F.col("event_id") % 5 == 0, F.lit("not json")).otherwise(F.col("props"))
    parsed = F.try_parse_json(raw).isNotNull()
    return table(spark, d, "events").select("event_id", F.when(~parsed, M.lenient_json(raw)).alias("kept_text"), parsed.alias("parsed"))


@query(rf"""SELECT doc_id, {_STRIP.format(r"regexp_replace(regexp_replace(regexp_replace(strip_accents(lower(" + _STRIP.format(TITLE) + r")), '[^\x00-\x7F]', '', 'g'), '\.+$', ''), '\s+', ' ', 'g')")} AS title FROM documents""")
def norm_title(spark, d):
    distinct = table(spark, d, "documents").select("doc_id", title().alias("t"))
    return distinct.select("doc_id", X.norm_title("t").alias("title"))


@query(rf"SELECT doc_id, nullif(regexp_replace(regexp_replace(lower({_STRIP.format(TITLE)}), '[^0-9a-z]+', '-', 'g'), '^-+|-+$', '', 'g'), '') AS slug FROM documents")
def slugify(spark, d):
    return table(spark, d, "documents").select("doc_id", X.slugify(title()).alias("slug"))


@query(r"""WITH t AS (SELECT p_partkey, array_to_string([upper(x[1]) || lower(x[2:]) for x in string_split(p_name, ' ')], '') AS camel FROM part)
    SELECT p_partkey, camel, regexp_replace(regexp_replace(lower(regexp_replace(camel, '([a-z0-9])([A-Z])', '\1 \2', 'g')), '[^0-9a-z]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM t""")
def pub_type_slug(spark, d):
    camel = F.replace(F.initcap("p_name"), F.lit(" "), F.lit(""))
    return table(spark, d, "part").select("p_partkey", camel.alias("camel"), X.pub_type_slug(camel).alias("slug"))


_CANON = "CASE x " + " ".join(f"WHEN 'type:{a}' THEN 'type:{b}'" for a, b in G.CANONICAL.items()) + " ELSE x END"


@query(f"""WITH t AS (SELECT p_partkey, {PART_TAGS} AS tags FROM part), c AS (SELECT p_partkey, [{_CANON} for x in tags] AS c FROM t)
    SELECT p_partkey, array_to_string(c[1:5] || c[7:7], ',') AS tags, true AS stale FROM c""")
def canonical_tag(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(G.canonicalize(part_tags()), ",").alias("tags"), G.has_stale_type(part_tags()).alias("stale"))


_STOP = ", ".join(f"'{w}'" for w in X.STOPWORDS)
_TOKENS = rf"[x for x in string_split_regex(lower({{}}), '[^\p{{{{L}}}}\p{{{{N}}}}]+') if length(x) >= 3 and x not in ({_STOP})]"


@query(f"SELECT doc_id, array_to_string({_TOKENS.format(TITLE)}, ' ') AS tokens FROM documents".replace("{{", "{").replace("}}", "}"))
def sig_tokens(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(X.sig_tokens(title()), " ").alias("tokens"))


_PAIR = f"WITH t AS (SELECT doc_id, {_TOKENS.format(TITLE)} AS a, {_TOKENS.format('text')} AS w FROM documents), p AS (SELECT x.doc_id, x.a, y.w AS b, y.a AS c FROM t x JOIN t y ON y.doc_id = x.doc_id + 1) ".replace("{{", "{").replace("}}", "}")


def _next_pairs(spark, d):
    """Each document's title tokens with the next document's text tokens (b) and title tokens (c)."""
    t = table(spark, d, "documents").select("doc_id", X.sig_tokens(title(), entities=False).alias("a"), X.sig_tokens(F.col("text"), entities=False).alias("w"))
    after = t.select((F.col("doc_id") - 1).alias("doc_id"), F.col("w").alias("b"), F.col("a").alias("c"))
    return t.select("doc_id", "a").join(after, "doc_id")


@query(_PAIR + "SELECT doc_id, CASE WHEN len(a) >= 5 AND len(b) > 0 THEN round(len([x for x in a if list_contains(b, x)]) / len(a), 6) END AS overlap FROM p")
def token_overlap(spark, d):
    return _next_pairs(spark, d).select("doc_id", F.round(X.token_overlap(F.col("a"), F.col("b")), 6).alias("overlap"))


@query(_PAIR + "SELECT doc_id, CASE WHEN len(a) > 0 AND len(c) > 0 THEN round(greatest(len(list_intersect(a, c)) / len(list_distinct(a)), len(list_intersect(a, c)) / len(list_distinct(c))), 6) END AS similarity FROM p")
def bidir_similarity(spark, d):
    return _next_pairs(spark, d).select("doc_id", F.round(X.bidir_similarity(F.col("a"), F.col("c")), 6).alias("similarity"))


@query(_PAIR + """, o AS (SELECT CASE WHEN len(a) >= 5 AND len(b) > 0 THEN len([x for x in a if list_contains(b, x)]) / len(a) END AS v, doc_id FROM p)
    SELECT doc_id FROM o WHERE v < 0.40""")
def crosswire_candidates(spark, d):
    return _next_pairs(spark, d).filter(P.is_candidate(F.col("a"), F.col("b"))).select("doc_id")


@query(_PAIR + """, o AS (SELECT a, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE c END AS c FROM p), s AS (SELECT CASE WHEN c IS NULL THEN 'MANUAL' WHEN len(a) > 0 AND len(c) > 0 AND
    greatest(len(list_intersect(a, c)) / len(list_distinct(a)), len(list_intersect(a, c)) / len(list_distinct(c))) < 0.45 THEN 'REMOVE' ELSE 'KEEP' END AS decision FROM o) SELECT decision, count(*)::BIGINT AS n FROM s GROUP BY decision""")
def repair_decisions(spark, d):
    resolved = F.when(F.col("doc_id") % 7 != 0, F.col("c"))
    return _next_pairs(spark, d).groupBy(P.decision(F.col("a"), resolved).alias("decision")).agg(F.count(F.lit(1)).alias("n"))


@query()
def title_fuzzy_guard(spark, d):
    """Titles of next documents, and whether their sorted-token similarity is 85 or more."""
    t = table(spark, d, "documents").select("doc_id", F.lower(title()).alias("t"))
    pairs = t.join(t.select((F.col("doc_id") - 1).alias("doc_id"), F.col("t").alias("u")), "doc_id")
    ratio = X.token_sort_ratio("t", "u")
    return pairs.select("doc_id", F.round(ratio, 4).alias("ratio")).withColumn("accepted", F.col("ratio") >= X.MATCHED)


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 AND p_size % 3 <> 0 THEN p_brand || '; ' || p_type || ' (' || p_size || '). ' WHEN p_size % 3 <> 0 THEN '(' || p_size || '). ' WHEN p_size % 2 = 0 THEN p_brand || '; ' || p_type || '. ' ELSE '' END
    || p_name || CASE WHEN p_size % 5 = 0 THEN '' ELSE ' ' || p_brand END AS citation FROM part""")
def citation_string(spark, d):
    s = F.col("p_size")
    authors = F.when(s % 2 == 0, F.array("p_brand", "p_type"))
    c = X.citation_string(authors, F.when(s % 3 != 0, s.cast("string")), F.col("p_name"), F.when(s % 5 != 0, F.col("p_brand")))
    return table(spark, d, "part").select("p_partkey", c.alias("citation"))


@query(r"SELECT p_partkey, array_to_string([x for x in [regexp_replace(y, '^\s+|\s+$', '', 'g') for y in string_split(p_brand || ' ; ;' || p_type || ';' || chr(9), ';')] if x <> ''], '|') AS authors FROM part")
def split_authors(spark, d):
    c = F.concat("p_brand", F.lit(" ; ;"), "p_type", F.lit(";\t"))
    return table(spark, d, "part").select("p_partkey", F.array_join(X.split_list(c), "|").alias("authors"))


@query(rf"""SELECT page_id, nullif({_STRIP.format(r"regexp_replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')")}, '') AS body FROM pages""")
def xml_extract(spark, d):
    body = F.regexp_extract("html", "(?s)<article>(.*?)</article>", 1)
    return table(spark, d, "pages").select("page_id", X.markup_text(body).alias("body"))


@query(f"""WITH t AS (SELECT p_partkey, p_size, p_name, p_brand, {PART_TAGS} AS tags FROM part), k AS (SELECT p_partkey, p_size, p_name, p_brand, CASE WHEN p_size % 2 = 0 THEN tags[5:5] ELSE ['type:journal-article', tags[3], tags[4], tags[5]] END AS kept FROM t)
    SELECT p_partkey, array_to_string(kept || ['pipeline:scaffolded', 's2id:s' || p_partkey, 'year:' || p_size] || CASE WHEN p_size % 2 = 0 THEN ['kw:' || regexp_replace(regexp_replace(lower(p_name), '[^0-9a-z]+', '-', 'g'), '^-+|-+$', '', 'g')] ELSE []::VARCHAR[] END, ',') AS tags FROM k""")
def derive_tags(spark, d):
    none = F.array().cast("array<string>")
    words = F.when(F.col("p_size") % 2 == 0, F.array("p_name")).otherwise(none)
    topics = G.Topics(none, none, none, words, none, none)
    made = G.derive_tags(part_tags(), F.concat(F.lit("s"), F.col("p_partkey").cast("string")), F.lit(None).cast("string"), F.col("p_size").cast("string"), topics)
    return table(spark, d, "part").select("p_partkey", F.array_join(made, ",").alias("tags"))


@query(f"WITH t AS (SELECT p_partkey, {PART_TAGS} AS tags FROM part) SELECT p_partkey, array_to_string(tags || ['new:' || p_partkey], ',') AS tags FROM t")
def array_ordered_union(spark, d):
    i = F.concat(F.lit(" new:"), F.col("p_partkey").cast("string"), F.lit("\t"))
    added = F.array(F.lit(None).cast("string"), F.lit(""), i, F.concat(F.lit("kw:"), F.lower("p_brand")), i)
    return table(spark, d, "part").select("p_partkey", F.array_join(G.ordered_union(part_tags(), added), ",").alias("tags"))


@query("SELECT p_partkey, 'type:journalarticle' AS removed, '' AS added FROM part")
def tag_diff(spark, d):
    new = G.canonicalize(part_tags())
    removed, added = G.tag_changes(part_tags(), new)
    return table(spark, d, "part").select("p_partkey", F.array_join(removed, ",").alias("removed"), F.array_join(added, ",").alias("added"))


_STATUS = "CASE o_orderstatus WHEN 'P' THEN 'digesting' WHEN 'F' THEN 'digested' ELSE 'queued' END"


def _status():
    s = F.col("o_orderstatus")
    return F.when(s == "P", "digesting").when(s == "F", "digested").otherwise("queued")


@query(f"SELECT o_orderkey, 'kw:' || lower(o_orderpriority) || ',pipeline:' || {_STATUS} AS tags FROM orders")
def set_status(spark, d):
    old = F.array(F.lit("pipeline:failed"), F.concat(F.lit("kw:"), F.lower("o_orderpriority")), F.lit("pipeline:queued"))
    return table(spark, d, "orders").select("o_orderkey", F.array_join(G.set_status(old, _status()), ",").alias("tags"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'digested' WHEN o_orderkey % 4 = 1 OR o_orderkey % 20 = 2 THEN 'needs-review' ELSE 'failed' END AS status FROM orders")
def final_status(spark, d):
    k, none = F.col("o_orderkey"), F.array().cast("array<string>")
    errors = F.when(k % 4 == 0, none).when(k % 4 == 1, F.array(F.lit("busy"), F.lit("HTTP 404"))).when(k % 20 == 2, F.array(F.lit("Malformed id"))).otherwise(F.array(F.lit("timed out")))
    return table(spark, d, "orders").select("o_orderkey", G.final_status(errors).alias("status"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'needs-review' ELSE 'failed' END AS status FROM events")
def classify_failure(spark, d):
    e = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Not Found: "), F.col("event_type"))).otherwise(F.concat(F.lit("locked "), F.col("event_type")))
    return table(spark, d, "events").select("event_id", G.classify_failure(F.array(e)).alias("status"))


@query(f"SELECT o_orderkey, 'pipeline:failed' AS tag FROM orders WHERE {_STATUS} = 'digesting'")
def stale_recovery(spark, d):
    tags = F.array(F.concat(F.lit("pipeline:"), _status()))
    rows = table(spark, d, "orders").filter(G.has_status(tags, "digesting"))
    return rows.select("o_orderkey", F.get(G.set_status(tags, "failed"), F.lit(0)).alias("tag"))


@query("SELECT p_partkey FROM part WHERE p_size % 3 <> 0")
def only_missing_filter(spark, d):
    tags = F.when(F.col("p_size") % 3 == 0, F.array(F.lit("kw:a"), F.lit("field:b"))).otherwise(F.array(F.lit("kw:a")))
    return table(spark, d, "part").filter(~G.is_topical(tags)).select("p_partkey")


@query("SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'verified' WHEN toxic = 1 THEN 'drop' ELSE 'needs-review' END AS routed FROM labels")
def verdict_routing(spark, d):
    verdict = F.when(F.col("toxic") == 1, "rejected").when(F.col("quality") == 1, "confirmed").otherwise("uncertain")
    routed = F.lit(None).cast("string")
    for name, to in G.VERDICTS.items():
        routed = F.when(verdict == name, to).otherwise(routed)
    return table(spark, d, "labels").select("doc_id", routed.alias("routed"))


@query(f"WITH t AS (SELECT o_orderkey, 'x, pipeline:' || {_STATUS} AS tags FROM orders) SELECT o_orderkey FROM t WHERE list_contains(string_split(tags, ', '), 'pipeline:queued')")
def has_status(spark, d):
    joined = F.concat(F.lit("x, pipeline:"), _status())
    return table(spark, d, "orders").filter(G.has_status(G.tag_list(joined), "queued")).select("o_orderkey")


@query(f"SELECT o_orderkey, 'pipeline:' || {_STATUS} AS tag FROM orders")
def first_status(spark, d):
    tags = F.array(F.lit("kw:a"), F.concat(F.lit("pipeline:"), _status()), F.lit("pipeline:failed"))
    return table(spark, d, "orders").select("o_orderkey", G.first_status(tags).alias("tag"))


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW'")
def alive_filter(spark, d):
    status = F.when(F.col("o_orderpriority") == "5-LOW", "deleted").when(F.col("o_orderkey") % 2 == 0, "open")
    return table(spark, d, "orders").filter(M.alive(status)).select("o_orderkey")


@query(f"SELECT o_orderkey FROM orders WHERE {_STATUS} = 'digested'")
def status_scan(spark, d):
    return table(spark, d, "orders").filter(G.has_status(F.array(F.concat(F.lit("pipeline:"), _status())), "digested")).select("o_orderkey")


@query(f"WITH t AS (SELECT p_partkey, p_size, {PART_TAGS} || CASE WHEN p_size % 2 = 0 THEN ['kw:okr', 'mesh-q:physiology', 'pmid:38621210'] ELSE []::VARCHAR[] END AS tags FROM part) SELECT p_partkey, array_to_string(tags[1:7], ',') AS tags FROM t WHERE p_size % 2 = 0")
def strip_foreign_tags(spark, d):
    extra = F.array(F.lit("kw:okr"), F.lit("mesh-q:physiology"), F.lit("pmid:38621210"))
    tags = F.when(F.col("p_size") % 2 == 0, F.concat(part_tags(), extra)).otherwise(part_tags())
    marked = table(spark, d, "part").filter(F.array_contains(tags, "pmid:38621210"))
    return marked.select("p_partkey", F.array_join(G.strip_foreign(tags), ",").alias("tags"))


@query("SELECT p_partkey, 'pmid:' || p_partkey AS foreign_tags FROM part WHERE p_size % 4 = 0")
def contaminated_tags(spark, d):
    own = F.when(F.col("p_size") % 4 == 0, F.lit("own")).when(F.col("p_size") % 4 == 1, F.col("p_partkey").cast("string"))
    rows = table(spark, d, "part").select("p_partkey", P.foreign_tags(part_tags(), "pmid:", own).alias("f"))
    return rows.filter(F.size("f") > 0).select("p_partkey", F.array_join("f", ",").alias("foreign_tags"))


@query("SELECT p_partkey FROM part WHERE p_size % 4 = 2")
def ambiguous_tags(spark, d):
    own = F.when(F.col("p_size") % 2 == 1, F.lit("own"))
    tags = F.when(F.col("p_size") % 4 == 2, F.concat(part_tags(), F.array(F.lit("pmid:0")))).otherwise(F.concat(part_tags(), F.array(F.concat(F.lit("pmid:"), F.col("p_partkey").cast("string")))))
    return table(spark, d, "part").filter(P.is_ambiguous(tags, "pmid:", own)).select("p_partkey")


@query("SELECT page_id, CASE page_id % 3 WHEN 0 THEN '10.1/u' || page_id WHEN 1 THEN '10.2/m' || page_id ELSE '10.3/t' || page_id END AS doi FROM pages")
def doi_precedence(spark, d):
    n, i = F.col("page_id") % 3, F.col("page_id").cast("string")
    uri = F.when(n == 0, F.concat(F.lit("https://doi.org/10.1/U"), i)).otherwise(F.col("url"))
    meta = F.when(n == 1, F.concat(F.lit("10.2/M"), i))
    tags = F.array(F.lit("doi:none"), F.concat(F.lit("doi:10.3/T"), i))
    return table(spark, d, "pages").select("page_id", R.doi_precedence(uri, meta, tags).alias("doi"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment WHEN c_custkey % 3 = 1 THEN ' ' ELSE c_name END AS value, CASE WHEN c_custkey % 2 = 0 THEN 'b' ELSE 'a' END AS members FROM customer""")
def merge_missing(spark, d):
    n = F.col("c_custkey") % 3
    old = F.when(n == 0, F.lit("")).when(n == 1, F.lit(" ")).otherwise(F.col("c_name"))
    none = F.array().cast("array<string>")
    lists = F.when(F.col("c_custkey") % 2 == 0, none).otherwise(F.array(F.lit("a")))
    merged = G.merge_missing(old, F.col("c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", merged.alias("value"), F.array_join(G.merge_missing(lists, F.array(F.lit("b")), array=True), ",").alias("members"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '10.9/new' ELSE '10.1/old' END AS doi, CASE WHEN page_id % 3 = 0 THEN '10.1/alt,10.1/old' ELSE '10.1/alt' END AS alternatives FROM pages")
def canonical_promote(spark, d):
    n = F.col("page_id") % 3
    candidate = F.when(n == 0, F.lit("https://doi.org/10.9/NEW")).when(n == 1, F.lit("DOI:10.1/OLD"))
    doi, alternatives = G.canonical_promote(F.lit("10.1/old"), F.array(F.lit("10.1/alt")), candidate)
    return table(spark, d, "pages").select("page_id", doi.alias("doi"), F.array_join(alternatives, ",").alias("alternatives"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_type END AS keywords FROM part")
def keyword_floor(spark, d):
    found = F.when(F.col("p_size") % 2 == 0, F.array("p_brand"))
    return table(spark, d, "part").select("p_partkey", F.array_join(R.keyword_floor(found, F.array("p_type")), ",").alias("keywords"))
