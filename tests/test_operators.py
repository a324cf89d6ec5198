"""Operators on small tables, and queries against their SQL."""

import decimal
import os
import random
import re
import xml.etree.ElementTree as ET

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from paperloom.operators import catalog, graph, identity, monitor, records, repair, staging, store
from paperloom.plans import scalar
from paperloom.plans.registry import ORACLES, QUERIES
from paperloom.sources import files

DATA = "/root/testdata/sf0.001"


def test_in_order_is_a_fold_and_not_a_component(spark):
    rows = spark.createDataFrame([(1, "d1", "p2"), (2, "d1", "p3"), (3, None, "p3")], "id long, doi string, pmid string")
    got = {r.id: (r.rep_id, r.created) for r in identity.in_order(rows, "id", [("doi", F.col("doi")), ("pmid", F.col("pmid"))]).collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (3, True)}


def test_in_order_against_a_loop(spark):
    rng = random.Random(3)
    data = [(i, rng.choice([None, *"abcde"]), rng.choice([None, *"vwxyz"])) for i in range(60)]
    held, want = {}, {}
    for i, a, b in data:
        rep = next((held[k] for k in (("a", a), ("b", b)) if k[1] and k in held), None)
        want[i] = i if rep is None else rep
        if rep is None:
            held |= {k: i for k in (("a", a), ("b", b)) if k[1] and k not in held}
    rows = spark.createDataFrame(data, "id long, a string, b string").repartition(3)
    got = {r.id: r.rep_id for r in identity.in_order(rows, "id", [("a", F.col("a")), ("b", F.col("b"))]).collect()}
    assert got == want


def test_in_order_settles_long_chains_in_few_rounds(spark, monkeypatch):
    data = [(i, f"k{i}", f"k{i + 1}") for i in range(120)]
    rows = spark.createDataFrame(data, "id long, a string, b string")
    rounds, write = [], identity.staged
    monkeypatch.setattr(identity, "staged", lambda df: (rounds.append(1), write(df))[1])
    got = {r.id: r.created for r in identity.in_order(rows, "id", [("k", F.col("a")), ("k", F.col("b"))]).collect()}
    assert got == {i: i % 2 == 0 for i in range(120)} and len(rounds) < 6


def test_priority(spark):
    keys = identity.node_keys()
    nodes = spark.createDataFrame([(1, "s1", "10.1/a", None, "x"), (2, None, "10.1/b", "7", "A title that is long.")], "id long, s2_id string, doi string, pmid string, title string")
    asks = spark.createDataFrame([(11, "s1", "10.1/b", "7", None), (12, None, "doi:10.1/B", None, None), (13, None, None, None, "a TITLE that is long"), (14, None, None, None, "x")], nodes.schema)
    got = {r.id: (r.match_id, r.reason) for r in identity.priority_match(asks, identity.key_index(nodes, "id", keys), "id", keys).collect()}
    assert got == {11: (1, "s2_id"), 12: (2, "doi"), 13: (2, "title")}


def test_title_guard_against_a_table_of_subsequences(spark):
    """The query's ratios against 200 * common subsequence / lengths, a row of the plain table at a time."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", F.lower(scalar.title()).alias("t")).collect()
    titles = {r.doc_id: " ".join(sorted((r.t or "").split())) for r in docs if r.t is not None}
    want = {}
    for i, x in titles.items():
        if (y := titles.get(i + 1)) is None:
            continue
        row, other = np.zeros(len(y) + 1, int), np.array([ord(c) for c in y], int)
        for c in x:
            row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (other == ord(c))))
        want[i] = 200 * row[-1] / (len(x) + len(y)) if x or y else 100
    got = {r.doc_id: r for r in QUERIES["title_fuzzy_guard"](spark, DATA).collect() if r.ratio is not None}
    assert got.keys() == want.keys() and len(want) > 100
    assert all(abs(r.ratio - want[i]) < 1e-3 and r.accepted == (round(want[i], 4) >= 85) for i, r in got.items())


def test_edges_are_idempotent(spark):
    e = spark.createDataFrame([("a", "b", "r"), ("a", "b", "r"), ("a", "a", "r"), ("b", "c", "r")], "source_id string, target_id string, relationship string")
    fresh = graph.new_edges(e, e.filter("source_id = 'b'"))
    assert [tuple(r) for r in fresh.collect()] == [("a", "b", "r")]
    assert graph.new_edges(e, e.filter("source_id <> target_id")).count() == 0


def test_paths(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "x"), ("x", "c"), ("c", "d")], "source_id string, target_id string")
    assert graph.shortest_path(e, "a", "d", 5).first().path == ["a", "b", "c", "d"]
    assert graph.shortest_path(e, "a", "d", 2).count() == 0
    assert graph.shortest_path(e, "a", "zz", 9).count() == 0 and graph.shortest_path(e, "d", "a", 9, direction="out").count() == 0
    assert graph.k_hop(e, "nowhere", 99).count() == 1
    with pytest.raises(ValueError, match="mode"):
        graph.k_hop(e, "a", 1, mode="other")
    assert {r.node: r.hop for r in graph.k_hop(e, "c", 1, "in").collect()} == {"c": 0, "b": 1, "x": 1}


def test_bulk_lookup_keeps_the_last(spark):
    catalog = spark.createDataFrame([("a", 1, ("x",)), ("a", 2, ("y",)), ("b", 3, None)], "k string, idx int, entry struct<v:string>")
    got = {r.k: r.entry and r.entry.v for r in records.bulk_lookup(spark.createDataFrame([("a",), ("b",)], "k string"), catalog, "k").collect()}
    assert got == {"a": "y", "b": None}


def test_waterfall_fills_blanks_and_empty_lists(spark):
    kind = "k string, v string, l array<string>"
    base = spark.createDataFrame([("a", "", []), ("b", None, None), ("c", "own", ["x"]), ("d", "", [])], kind)
    one = spark.createDataFrame([("a", "1", []), ("b", "", ["1"]), ("c", "1", ["1"])], kind)
    two = spark.createDataFrame([("a", "2", ["2"]), ("b", "2", ["2"]), ("d", "", [])], kind)
    got = {r.k: (r.v, r.l, r.origin) for r in records.waterfall(base, [("one", one), ("two", two)], "k", ["v", "l"]).collect()}
    assert got == {"a": ("1", ["2"], "one"), "b": ("2", ["1"], "one"), "c": ("own", ["x"], "input-only"), "d": ("", [], "input-only")}


def test_upsert_merges_rows_of_a_key_and_keeps_own_identity(spark):
    old = spark.createDataFrame([("a", "", [], "s9", ["kw:old", "s2id:wrong", "note:x"]), ("b", "kept", ["k"], None, ["kw:b"])], "k string, t string, l array<string>, s2_id string, tags array<string>")
    new = spark.createDataFrame([("a", 2, "late", ["y"], None, ["Topic Two"]), ("a", 1, "", ["x"], None, []), ("c", 3, "new", [], "s3", None)], "k string, at int, t string, l array<string>, s2_id string, keywords array<string>")
    got = {r.k: r for r in records.upsert(old, new, "k", ["t", "l", "s2_id"], [], order="at", tags="tags").collect()}
    assert len(got) == 3 and (got["a"].t, got["a"].l, got["a"].created) == ("late", ["x"], False)
    assert got["a"].tags == ["note:x", "pipeline:scaffolded", "s2id:s9", "kw:topic-two"]
    assert got["b"].tags == ["kw:b"] and (got["c"].created, got["c"].tags) == (True, ["pipeline:scaffolded", "s2id:s3"])


def test_candidates_are_taken_in_order(spark):
    kind = "id string, uuid string, slug string"
    first = spark.createDataFrame([("1", "u1", None), ("2", None, "s2"), (None, None, None)], kind)
    second = spark.createDataFrame([("9", "u1", "s9"), ("8", None, "s9"), ("s2", None, None)], kind)
    got = records.candidates([first, second], ["id", "uuid", "slug"]).collect()
    # The row of u1 is left out, and so doesn't keep out the one that shares its slug alone.
    assert sorted((r.id or "", r.place) for r in got) == [("", 0), ("1", 0), ("2", 0), ("8", 1)]


def test_numbered_rows(spark):
    rows = spark.range(0, 1000, 1, 7).select((F.col("id") * 37 % 1000).alias("v"))
    assert all(r.v == r.idx for r in staging.numbered(rows, "v").collect())


def test_backfill_runs_what_can_be_found(spark):
    node = "id string, uuid string, slug string, title string, uri string, tags array<string>, metadata struct<reference:struct<doi:string,pmid:string>>"
    rows = [("1", None, None, "t", "https://doi.org/10.1/a", ["pipeline:queued"], (("", None),)), ("2", None, None, "t", None, ["pipeline:queued"], ((None, None),)), ("3", None, None, "A title long enough", None, ["pipeline:failed"], ((None, None),)), ("4", None, None, "t", None, ["kw:x"], (("10.1/z", None),))]
    nodes, seen = spark.createDataFrame(rows, node), []

    def ingest(items):
        seen.extend((r.id, r.chunk) for r in items.collect())
        return items.select(F.array().cast("array<string>").alias("errors"), F.lit(1).alias("linked"), F.lit(2).alias("stored"))

    summary = records.backfill(nodes, ["queued", "failed"], 1, ingest)[0].first()
    assert (summary.processed, summary.edges_linked, summary.skipped) == (2, 2, 1) and sorted(seen) == [("1", 0), ("3", 1)]
    with pytest.raises(ValueError, match="positive"):
        records.backfill(nodes, ["queued"], 0, ingest)
    assert records.backfill(nodes, ["digested"], 0, ingest)[0].first().processed == 0


def test_items(spark):
    rows = spark.createDataFrame([(1, '"10.1/a"'), (2, '{"title":"T","authors":["x"]}'), (3, "[1]"), (4, "nope"), (5, None)], "n int, item string")
    got = {r.n: r for r in records.normalized_items(rows).collect()}
    assert (got[1].doi, got[2].title, got[2].authors) == ("10.1/a", "T", ["x"]) and [got[n].item_error is None for n in range(1, 6)] == [True, True, False, False, False]
    assert records.parse(records.single_item(spark, pmid=" 7 ")).first().errors == []


def test_links_by_any_key(spark):
    works = spark.createDataFrame([("a", "s1", None, None, "x"), ("b", None, "10.1/b", "7", "A title that is long.")], "id string, s2_id string, doi string, pmid string, title string")
    cited = spark.createDataFrame([("a", 0, None, "10.1/B", None, None), ("a", 1, None, None, None, "a title that is LONG"), ("b", 0, None, None, "7", None), ("b", 1, "s1", None, None, None), ("c", 0, None, None, None, "short")], "source_id string, pos int, s2_id string, doi string, pmid string, title string")
    there = spark.createDataFrame([("b", "a", "references")], "source_id string, target_id string, relationship string")
    edges, counts = graph.forward_links(cited, identity.key_index(works, "id", identity.node_keys()), there)
    assert [tuple(r) for r in edges.collect()] == [("a", "b", "references")]
    assert {r.source_id: (r.linked, r.skipped) for r in counts.collect()} == {"a": (2, 0), "b": (1, 1), "c": (0, 1)}
    pending = spark.createDataFrame([("p", "doi:10.1/N"), ("p", "10.1/n"), ("n", "10.1/n")], "source_id string, doi string")
    edges, counts = graph.reverse_links(pending, spark.createDataFrame([("n", "10.1/N")], "node_id string, doi string"), there)
    assert [tuple(r) for r in edges.collect()] == [("p", "n", "references")] and [tuple(r) for r in counts.collect()] == [("n", 2)]


def test_article_of_broken_markup_and_chunks(spark):
    rows = spark.createDataFrame([("<x><ArticleTitle>T</ArticleTitle></x>", "5"), ("broken", "6"), (None, None)], "xml string, asked string")
    assert sorted((r.title or "", r.pmid or "") for r in catalog.article_records(rows, pmid="asked").collect()) == [("", ""), ("", "6"), ("T", "5")]
    assert [catalog.chunk_size(n) for n in (None, 0, -3, 7, 9999)] == [500, 500, 1, 7, 500]


def test_files_and_marks(spark, tmp_path):
    (tmp_path / "seeds.txt").write_text("# head\n\n doi:10.1/A \n10.1/b\n")
    assert [r.doi for r in files.read_ids(spark, str(tmp_path / "seeds.txt")).collect()] == ["10.1/a", "10.1/b"]
    (tmp_path / "batch.json").write_text('["10.1/A",\n "10.1/b"]')
    assert [r.doi for r in files.read_id_batch(spark, str(tmp_path / "batch.json")).collect()] == ["10.1/a", "10.1/b"]
    (tmp_path / "bad.json").write_text('{"a": 1}')
    with pytest.raises(Exception, match="JSON list"):
        files.read_id_batch(spark, str(tmp_path / "bad.json")).collect()
    (tmp_path / "graph.jsonl").write_text('{"kind":"node","id":"1"}\n{"kind":"edge","id":"e","source_id":"1","target_id":"2","relationship":"references"}\n{"operation":"x"}\n')
    graph_ = files.read_graph(spark, str(tmp_path / "graph.jsonl"))
    assert {k: v.count() for k, v in graph_.items()} == {"node": 1, "edge": 1, "annotation": 0}
    assert tuple(files.graph_edges(graph_["edge"]).first()) == ("e", "1", "2", "references")
    (tmp_path / "pointer.jsonl").write_text("version https://git-lfs.github.com/spec/v1\noid x\n")
    with pytest.raises(Exception, match="pointer"):
        files.read_graph(spark, str(tmp_path / "pointer.jsonl"))["node"].collect()
    root = str(tmp_path / "store")
    files.publish(spark.range(3), root)
    files.write_snapshot(spark.range(99), root)  # a writer that died before its mark
    assert files.latest(spark, root).count() == 3
    files.append_rows(spark.range(2), f"{root}/notes")
    files.append_rows(spark.range(2), f"{root}/notes")
    assert spark.read.json(f"{root}/notes").count() == 4
    outcomes = spark.createDataFrame([([], True), (["x"], False)], "errors array<string>, created boolean")
    records.write_outcomes(outcomes, f"{root}/run")
    assert spark.read.json(f"{root}/run/summary").first().failed == 1


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(Conf)
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="shared|share"):
        staging.shared_folder(Session())


def test_repair_plan(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "source_id string, target_id string")
    n = spark.createDataFrame([("a", None), ("b", "open")], "id string, status string")
    edges, nodes = repair.apply_plan(e, n, spark.createDataFrame([("b",)], "id string"))
    assert [tuple(r) for r in edges.collect()] == [("c", "d")]
    assert {r.id: r.status for r in nodes.collect()} == {"a": None, "b": "deleted"}
    assert nodes.filter(monitor.alive(F.col("status"))).count() == 1


def test_slim_refuses_other_lines(spark):
    good = spark.createDataFrame([('{"kind":"node"}',), ('{"operation":"x"}',)], "value string")
    assert files.slim(good).count() == 1
    with pytest.raises(Exception, match="not a graph line"):
        files.slim(spark.createDataFrame([("nonsense",)], "value string")).collect()


def test_page_limits(spark):
    log = spark.sql("SELECT id AS event_id, timestamp_ntz'2020-01-01' AS ts FROM range(2000)")
    assert monitor.page(log, 5000).count() == 1000
    with pytest.raises(ValueError, match="negative"):
        monitor.page(log, -1)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _plain(v):
    return round(float(v), 6) if isinstance(v, (float, decimal.Decimal)) else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{DATA}/{f}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cur = duck.execute(ORACLES[name])
    names = [x[0] for x in cur.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    key = lambda r: [(x is None, str(type(x)), x) for x in r]
    got = sorted(([_plain(r[c]) for c in order] for r in df.collect()), key=key)
    want = sorted(([_plain(r[names.index(c)]) for c in order] for r in cur.fetchall()), key=key)
    assert got == want


def test_grep_finds_values_and_no_names(spark):
    rows = spark.createDataFrame(
        [(1, "say \"x\"", {"k": ["line one\nline two"]}, [("deep", 5)]), (2, "p_name is a name", {"p_name": [None]}, []), (3, None, None, None)], "id int, p_name string, m map<string,array<string>>, a array<struct<p_name:string,n:int>>"
    ).withColumn("v", F.parse_json(F.when(F.col("id") == 3, F.lit('{"p_name": {"q": ["tab\\there", "a\\"b", 17.5, true]}}'))))
    hits = lambda needle, **how: sorted(r.id for r in monitor.grep(rows, needle, **how).collect())
    assert hits("p_name") == [2] and hits('"x"') == [1] and hits("one\nline") == [1] and hits("deep") == [1] and hits("5") == [1, 3]
    assert hits("tab\there") == [3] and hits('a"b') == [3] and hits("17.5") == [3] and hits("q") == []
    assert hits("LINE", ignore_case=True) == [1] and hits("^say", regex=True) == [1] and hits("^NAME|DEEP$", regex=True, ignore_case=True) == [1] and hits("zzz") == []


def test_citation_lists_of_records_are_kept(spark):
    kind = "array<struct<doi:string>>"
    rows = spark.createDataFrame([(1, [("a",)], []), (2, [("a",)], None), (3, [], [("b",)]), (4, None, None), (5, [("a",)], [("b",)])], f"id int, stored {kind}, incoming {kind}")
    items, side = records.kept_citations(F.col("stored"), F.col("incoming"))
    got = {r.id: (r.side, [x.doi for x in r.items_ or []]) for r in rows.select("id", items.alias("items_"), side.alias("side")).collect()}
    assert got == {1: ("stored", ["a"]), 2: ("stored", ["a"]), 3: ("incoming", ["b"]), 4: ("incoming", []), 5: ("incoming", ["b"])}


def test_repeated_keys_of_a_source_multiply_nothing(spark):
    base = spark.createDataFrame([(1, None, [])], "k int, v string, l array<string>")
    source = spark.createDataFrame([(1, "late", ["x"], 2), (1, "early", ["y"], 1)], "k int, v string, l array<string>, at int")
    assert [(r.v, r.l) for r in records.waterfall(base, [("s", source)], "k", ["v", "l"], order="at").collect()] == [("late", ["x"])]
    assert records.waterfall(base, [("s", source)], "k", ["v", "l"]).count() == 1


def plain_article(xml):
    """An article's record by a tree of its elements."""
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return None
    text = lambda e: None if e is None else " ".join("".join(e.itertext()).split()) or None
    every = lambda path: [t for t in map(text, root.iterfind(path)) if t]
    first = lambda path: text(root.find(path))
    names = [(text(a.find("LastName")), text(a.find("ForeName")) or text(a.find("Initials"))) for a in root.iterfind(".//Author")]
    major = [text(h.find("DescriptorName")) for h in root.iterfind(".//MeshHeading") if any(e.get("MajorTopicYN") == "Y" for e in [*h.findall("DescriptorName")[:1], *h.findall("QualifierName")])]
    date = first(".//PubDate/Year") or (first(".//PubDate/MedlineDate") or "")[:4]
    return {
        "title": first(".//ArticleTitle"), "abstract": " ".join(every(".//AbstractText")) or None, "authors": [f"{n} {g}" if g else n for n, g in names if n], "year": date if re.fullmatch("[0-9]{4}", date) else None,
        "venue": first(".//Journal/Title") or first(".//ISOAbbreviation"), "doi_raw": next((text(e) for e in root.iterfind(".//ArticleId") if (e.get("IdType") or "").lower() == "doi"), None),
        "pmid": next((t for t in map(text, root.iterfind(".//PMID[@Version='1']")) if t), None) or first(".//PMID"), "mesh": every(".//MeshHeading/DescriptorName"), "keywords": every(".//KeywordList/Keyword"),
        "mesh_major": list(dict.fromkeys(m for m in major if m)), "mesh_qualifiers": list(dict.fromkeys(every(".//MeshHeading/QualifierName"))), "types": list(dict.fromkeys(every(".//PublicationType"))),
    }


def test_articles_against_a_tree(spark):
    pick = random.Random(9)
    words = ["one", "<i>two</i>", "&lt;3 &amp; 4", "&#233;t&#xE9;", " <b><sup>x</sup></b>\n y ", "", "<!-- <LastName>no</LastName> -->", "a > b", "\u00a0"]
    text = lambda: " ".join(pick.choice(words) for _ in range(pick.randint(0, 3)))
    yn = lambda: pick.choice(['', ' MajorTopicYN="Y"', " MajorTopicYN='N'", ' UI="D>1" MajorTopicYN="Y"'])

    def article():
        heading = lambda: f"<MeshHeading><DescriptorName{yn()}>{text()}</DescriptorName>" + "".join(f"<QualifierName{yn()}>{text()}</QualifierName>" for _ in range(pick.randint(0, 2))) + "</MeshHeading>"
        author = lambda: f"<Author ValidYN='Y'><LastName>{text()}</LastName>{pick.choice(['', f'<ForeName>{text()}</ForeName>'])}<Initials>{text()}</Initials></Author>"
        date = pick.choice(["<Year>1999</Year>", "<MedlineDate>2001 Jan</MedlineDate>", "<Year>soon</Year>", "", "<Year/>"])
        body = [
            f'<PMID Version="{pick.choice("12")}">{text()}</PMID>', '<PMID Version="1">77</PMID>', f"<Journal><JournalIssue><PubDate>{date}</PubDate></JournalIssue><Title>{text()}</Title></Journal>", f"<ISOAbbreviation>{text()}</ISOAbbreviation>",
            f"<ArticleTitle>{text()}</ArticleTitle>", f'<AbstractText Label="A">{text()}</AbstractText>', f"<AbstractText>{text()}</AbstractText>", "<AbstractText/>", author(), author(), heading(), heading(),
            f"<KeywordList><Keyword{yn()}>{text()}</Keyword><Keyword>k</Keyword></KeywordList>", f"<PublicationType>{text()}</PublicationType>", f"<ArticleId IdType='{pick.choice(['doi', 'DOI', 'pii'])}'>10.1/{text()}</ArticleId>",
        ]
        pick.shuffle(body)
        broken = pick.choice(["", "", "", "", "&nbsp;", "<open>"])
        return f"<PubmedArticle>{''.join(body[: pick.randint(1, len(body))])}{broken}</PubmedArticle>"

    xmls = [article() for _ in range(150)] + [None, "", "text", "<a/>", "<a>", "<a><![CDATA[ x ]]><ArticleTitle>t</ArticleTitle></a>", "<?xml version='1.0'?><s><ArticleTitle>r</ArticleTitle></s>"]
    got = {r.i: r.a for r in spark.createDataFrame(list(enumerate(xmls)), "i int, xml string").select("i", catalog.article_record(F.col("xml")).alias("a")).collect()}
    for i, x in enumerate(xmls):
        assert (None if got[i] is None else got[i].asDict()) == plain_article(x), x


def test_a_change_rewrites_touched_buckets_only(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    first = store.create(spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v")), root, "k", 64)
    keys = spark.createDataFrame([(5,), (5,), (2000,)], "k long")

    def put(held):
        return held.join(keys.distinct().withColumn("n", F.lit("new")), "k", "full_outer").select("k", F.coalesce("n", "v").alias("v"))

    second, n = store.change(spark, first, keys, put)
    assert n <= 2 and second.number == 1 and sum(first.paths.get(b) != p for b, p in second.paths.items()) <= 2
    got = {r.k: r.v for r in store.latest(spark, root).read(spark).collect()}
    assert len(got) == 1001 and got[5] == got[2000] == "new" and got[6] == "old"
    assert first.read(spark).filter("v = 'new'").count() == 0  # who reads the old version goes on with it
    with pytest.raises(store.Conflict):
        store.change(spark, first, keys, put)
    assert store.latest(spark, root).number == 1 and store.latest(spark, root).read(spark).count() == 1001
    # Rows that go away, a change of nothing, and one that would write elsewhere.
    third, _ = store.change(spark, second, keys, lambda held: held.filter("v <> 'new'"))
    assert third.read(spark).count() == 999 and store.change(spark, third, keys.limit(0), put) == (third, 0)
    with pytest.raises(ValueError, match="not touched"):
        store.change(spark, third, keys, lambda held: spark.range(64).select(F.col("id").alias("k"), F.lit("x").alias("v")))
    empty = store.create(spark.range(0).select(F.col("id").alias("k")), f"{root}2", "k", 4)
    assert empty.read(spark).count() == 0
    with pytest.raises(store.Conflict):
        store.create(spark.range(3).select(F.col("id").alias("k")), root, "k", 4)
    with pytest.raises(FileNotFoundError):
        store.latest(spark, f"{root}3")


def test_a_scope_leaves_no_staged_tables(spark, tmp_path):
    folder = staging.shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    with staging.scope(spark):
        rows = spark.createDataFrame([(0, "a", "x"), (1, "a", "y"), (2, "b", "y")], "id long, a string, b string")
        identity.in_order(rows, "id", [("a", F.col("a")), ("b", F.col("b"))]).write.parquet(f"file://{tmp_path}/out")
        assert set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before and spark.read.parquet(f"file://{tmp_path}/out").count() == 3


def test_workspace_of_a_configuration_file(spark, tmp_path):
    (tmp_path / "c.yml").write_text("# workspace: no\nother: x\nworkspace: '/data/my store'  # here\n")
    assert files.workspace(spark, "d", str(tmp_path / "c.yml")) == "/data/my store" and files.workspace(spark, "d") == "d"
    (tmp_path / "e.yml").write_text("other: x\n")
    assert files.workspace(spark, "d", str(tmp_path / "e.yml")) == "d"


def test_incident_edges_take_one_pass(spark):
    """The edges, with all that leads to them, were worked out twice; ends that are missing stay as they were."""
    e = spark.createDataFrame([(1, 2), (3, 3), (None, 4), (5, None)], "source_id long, target_id long")
    out = graph.incident(e)
    assert sorted(out.collect(), key=str) == sorted([(1, 1, 2), (2, 1, 2), (3, 3, 3), (None, None, 4), (5, 5, None)], key=str)
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_tasks_are_cut(spark):
    """A task read up to 128 MB of a file and 64 MB of a shuffle; a smaller setting is left alone."""
    from paperloom import session

    files, shuffle = session.TASK
    before = {name: spark.conf.get(name) for name in session.TASK}
    try:
        spark.conf.set(files, "128m")
        spark.conf.set(shuffle, "1m")
        session.tasks(spark)
        assert spark.conf.get(files) == f"{session.TASK_BYTES}b" and spark.conf.get(shuffle) == "1m"
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_every_asked_row_comes_back_in_turn(spark):
    """Rows that no key finds came back by a join with all rows; a title is asked only where no identifier was found."""
    index = spark.createDataFrame([("doi", "10.1/a", "n"), ("title", "a title that is long", "m")], "kind string, key string, node_id string")
    row = [(1, None, "10.1/A", None, "A title that is long"), (2, None, "10.1/x", None, "A Title that is long."), (3, None, None, None, None), (4, None, None, None, "x"), (4, None, None, None, "a title that is long"), (4, None, None, None, None)]
    rows = spark.createDataFrame(row, "i long, s2_id string, doi string, pmid string, title string")
    got = identity.matches_in_turn(rows, index, "i", identity.node_keys()).collect()
    assert sorted(tuple(r) for r in got) == [(1, "n", "doi"), (2, "m", "title"), (3, None, None), (4, "m", "title")]
