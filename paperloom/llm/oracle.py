"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from paperloom.llm import line_dedup, secret_scan, url_filter

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []::VARCHAR[]) AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
b2 AS (SELECT item, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, k, list_aggregate(list_slice(w, i, i + k - 1), 'string_agg', ' ') AS gram FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM b2)),
ks AS (SELECT DISTINCT k FROM b2),
dw AS (SELECT doc_id, k, i, list_aggregate(list_slice(w, i, i + k - 1), 'string_agg', ' ') AS gram FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
m AS (SELECT doc_id, i, dw.k AS k, item FROM dw JOIN bw ON dw.gram = bw.gram AND dw.k = bw.k),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM m)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""

OP2 = """
WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE) for x in embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def _op5() -> str:
    parts = []
    for i, r in enumerate(secret_scan.BASE + secret_scan.MORE):
        pattern = r.pattern.replace("'", "''")
        judged = f"regexp_extract_all(t, '{pattern}', {r.group})" if r.group else f"regexp_extract_all(t, '{pattern}')"
        parts.append(
            f"SELECT doc_id, {i} AS rule, '{r.kind}' AS kind, {r.least} AS least, string_split_regex(t, '{pattern.replace('(', '(?:').replace('(?:?', '(?')}') AS g, "
            f"regexp_extract_all(t, '{pattern}') AS m, {judged} AS j FROM d WHERE regexp_matches(t, '{pattern}')"
        )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
a AS ({" UNION ALL ".join(parts)}),
k AS (SELECT doc_id, rule, kind, least, g, m, j, unnest(range(1, len(m) + 1)) AS i FROM a),
s AS (SELECT doc_id, rule, kind, list_sum([len(x) for x in g[1:i]]) + coalesce(list_sum([len(x) for x in m[1:i - 1]]), 0) AS s, len(m[i]) AS n FROM k WHERE len(j[i]) >= least),
f AS (SELECT doc_id, rule, kind, s::BIGINT AS s, kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT AS span FROM s),
p AS (SELECT doc_id, count(*) FILTER (rule = 0) AS a, count(*) FILTER (rule = 1) AS c, count(*) FILTER (rule = 2) AS h,
             string_agg(span, ',' ORDER BY s, rule) FILTER (rule < 3) AS base, string_agg(span, ',' ORDER BY s, rule) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(c, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN p ON d.doc_id = p.doc_id
"""


OP7 = rf"""
WITH d AS (SELECT doc_id, source, text, coalesce('=' || source, 'null') AS host, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT host, unnest(list_distinct([regexp_replace(x, '^\s+|\s+$', '', 'g') for x in lines if regexp_matches(x, '\S')])) AS line FROM d),
c AS (SELECT host, line, count(*) AS n FROM l GROUP BY host, line HAVING count(*) >= {line_dedup.PAGES}),
t AS (SELECT host, count(*) AS total FROM d GROUP BY host),
b AS (SELECT c.host, list(line) AS gone FROM c JOIN t ON c.host = t.host WHERE n / total > {line_dedup.RATIO} GROUP BY c.host),
k AS (SELECT doc_id, source, text, lines, [x for x in lines if NOT list_contains(coalesce(gone, []::VARCHAR[]), regexp_replace(x, '^\s+|\s+$', '', 'g'))] AS kept FROM d LEFT JOIN b ON d.host = b.host)
SELECT doc_id, source, CASE WHEN text IS NULL THEN NULL ELSE array_to_string(kept, chr(10)) END AS text,
       coalesce(len(lines), 0)::BIGINT AS n_lines, (coalesce(len(lines), 0) - coalesce(len(kept), 0))::BIGINT AS n_dropped FROM k
"""


def _op10() -> str:
    u = url_filter
    name = verdict = "NULL"
    for r in sorted(u.RULES, key=lambda r: (len(r.name), r.name)):
        fits = f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        name, verdict = f"CASE WHEN {fits} THEN '{r.name}' ELSE {name} END", f"CASE WHEN {fits} THEN '{r.verdict}' ELSE {verdict} END"
    kind = "CASE WHEN regexp_matches(s, '^[0-9]+$') THEN '{n}' WHEN regexp_matches(s, '^[0-9a-fA-F-]{8,}$') AND regexp_matches(s, '[0-9]') THEN '{id}' WHEN regexp_matches(s, '[0-9]') THEN regexp_replace(s, '[0-9]+', '{n}', 'g') ELSE s END"

    def differ(b1: str, n1: str, b2: str, n2: str) -> str:
        pool = f"(({b1} + {b2})::DOUBLE / nullif({n1} + {n2}, 0))"
        error = f"sqrt({pool} * (1 - {pool}) * (1.0 / nullif({n1}, 0)::DOUBLE + 1.0 / nullif({n2}, 0)::DOUBLE))"
        return f"coalesce(abs({b1}::DOUBLE / nullif({n1}, 0) - {b2}::DOUBLE / nullif({n2}, 0)) > {u.ALIKE} * {error}, false)"

    return f"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UP}', '{_LOW}') AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
u AS (SELECT page_id, host, path, {name} AS rule, {verdict} AS decided, [{kind} for s in string_split(path, '/') if s <> ''] AS shape FROM p),
c AS (SELECT host, shape, count(*) AS n, count(*) FILTER (decided = 'allow') AS good, count(*) FILTER (decided = 'block') AS bad FROM u WHERE host <> '' GROUP BY host, shape),
e AS (SELECT host, shape, i, array_to_string(shape[1:i - 1], '/') AS node, shape[i] AS segment, good, bad FROM (SELECT *, unnest(range(1, len(shape) + 1)) AS i FROM c)),
b AS (SELECT host, node, segment, sum(bad) AS b, sum(good + bad) AS n FROM e GROUP BY ALL),
w AS (SELECT host, node, count(*) AS kids, sum(n) AS na, sum(b) AS ba FROM b GROUP BY ALL),
k AS (SELECT * FROM b JOIN w USING (host, node)),
m AS (SELECT *, lag(b) OVER o AS pb, lag(n) OVER o AS pn FROM k WHERE kids <= {u.FANOUT} AND n > 0 WINDOW o AS (PARTITION BY host, node ORDER BY b::DOUBLE / n, segment)),
g AS (SELECT host, node, segment, sum(CASE WHEN {differ('b', 'n', 'pb', 'pn')} THEN 1 ELSE 0 END) OVER (PARTITION BY host, node ORDER BY b::DOUBLE / n, segment) AS part FROM m),
gn AS (SELECT host, node, part, CASE WHEN count(*) > 1 THEN '{{' || string_agg(segment, '|' ORDER BY segment) || '}}' ELSE any_value(segment) END AS t FROM g GROUP BY ALL),
r AS (SELECT host, node, segment, t FROM g JOIN gn USING (host, node, part)
      UNION ALL SELECT host, node, segment, CASE WHEN {differ('b', 'n', '(ba - b)', '(na - n)')} THEN segment ELSE '{{*}}' END FROM k WHERE kids > {u.FANOUT}),
s AS (SELECT e.host, shape, string_agg(coalesce(t, e.segment), '/' ORDER BY i) AS template FROM e LEFT JOIN r ON e.host = r.host AND e.node = r.node AND e.segment = r.segment GROUP BY e.host, shape),
l AS (SELECT c.*, coalesce(template, '') AS template FROM c LEFT JOIN s ON c.host = s.host AND c.shape = s.shape),
base AS (SELECT coalesce(sum(bad)::DOUBLE / nullif(sum(good) + sum(bad), 0), 0) AS base FROM l),
v AS (SELECT shape, count(*) AS hosts, sum(bad::DOUBLE / (good + bad)) AS votes FROM l WHERE good + bad > 0 GROUP BY shape),
x AS (SELECT host, template, sum(good) AS good, sum(bad) AS bad, max(coalesce(hosts, 0)) AS hosts,
             sum(n * ((coalesce(votes, 0.0) + {u.PRIOR} * base) / (coalesce(hosts, 0) + {u.PRIOR}))) / sum(n) AS prior FROM l CROSS JOIN base LEFT JOIN v ON l.shape = v.shape GROUP BY host, template),
y AS (SELECT l.host, shape, (x.bad + {u.PRIOR} * prior) / (x.good + x.bad + {u.PRIOR}) >= {u.PURITY} AND (x.good + x.bad >= {u.LEAST} OR hosts >= {u.LEAST}) AS rejected FROM l JOIN x ON l.host = x.host AND l.template = x.template)
SELECT page_id, u.host, path, rule, coalesce(decided, CASE WHEN rejected THEN 'block' ELSE 'allow' END) AS verdict FROM u LEFT JOIN y ON u.host = y.host AND u.shape = y.shape
"""


_FIELD = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _crc32(value: str) -> str:
    """Unsigned crc32 of a short ASCII text, a bit at a time."""
    bit = "CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END"
    byte = f"list_reduce(range(8), lambda a, z: {bit}, xor(s, y))"
    return f"xor(list_reduce([ascii(x)::BIGINT for x in string_split({value}, '')], lambda s, y: {byte}, 4294967295::BIGINT), 4294967295)"


OP11 = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, lang, n_chars, text, {_leaf('text')} AS leaf, CASE WHEN {_crc32('doc_id::VARCHAR')} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS bad FROM documents),
g AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM documents)),
l AS (SELECT row_number() OVER () AS r, doc_id, leaf, coalesce(bad, leaf) AS bad, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
t(lvl, tree, pos, n, h) AS (SELECT 0, tree, pos, n, leaf FROM l UNION ALL SELECT lvl + 1, tree, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY ALL),
u(lvl, pos, n, h) AS (SELECT 0, tree, count(*) OVER (), h FROM t WHERE n = 1 UNION ALL SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY ALL),
b AS (SELECT lvl, tree, pos, coalesce(string_agg(h, '') OVER (PARTITION BY lvl, tree, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
             coalesce(string_agg(h, '') OVER (PARTITION BY lvl, tree, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS z FROM t WHERE n > 1),
c AS (SELECT lvl, pos, coalesce(string_agg(h, '') OVER (PARTITION BY lvl, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
             coalesce(string_agg(h, '') OVER (PARTITION BY lvl, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS z FROM u WHERE n > 1),
f(r, lvl, tree, pos, n, p, h) AS (SELECT r, 0, tree, pos, n, '', bad FROM l UNION ALL SELECT r, f.lvl + 1, f.tree, f.pos // 3, (n + 2) // 3, p || a || z, sha256(a || h || z) FROM f JOIN b ON f.lvl = b.lvl AND f.tree = b.tree AND f.pos = b.pos WHERE n > 1),
e(r, lvl, pos, n, p, h) AS (SELECT r, 0, tree, (SELECT count(*) FROM g), p, h FROM f WHERE n = 1 UNION ALL SELECT r, e.lvl + 1, e.pos // 3, (n + 2) // 3, p || a || z, sha256(a || h || z) FROM e JOIN c ON e.lvl = c.lvl AND e.pos = c.pos WHERE n > 1)
SELECT doc_id, leaf, s.h AS subroot, o.h AS root, sha256(e.p) AS proof_sha256, e.h AS folded_root, e.h = o.h AS verified
FROM l JOIN t s ON s.tree = l.tree AND s.n = 1 JOIN e ON e.r = l.r AND e.n = 1, (SELECT h FROM u WHERE n = 1) o
"""

_TOKEN = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
_H = "('0x' || substr(h, {}, 8))::UBIGINT"

OP13 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{_TOKEN}') AS w, {_H.format(1)} AS h1, {_H.format(9)} AS h2, {_H.format(17)} AS h3, {_H.format(25)} AS h4 FROM d),
c AS (SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1))::BIGINT AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1))::BIGINT AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM w),
p AS (SELECT doc_id, t, n, form, array_to_string(w[1:a], '') AS x, array_to_string(w[a + 1:b], '') AS y, array_to_string(w[b + 1:n], '') AS z FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(x) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(y) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": OP1, "op2_top_k": OP2, "op5_secrets": _op5(), "op7_line_dedup": OP7, "op10_url_filter": _op10(),
            "op11_merkle_manifest": OP11, "op13_fill_in_middle": OP13}
