"""Batches, enrichment, evidence and many-valued keys on cases that the tables don't have."""

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paperloom.operators import batch as B
from paperloom.operators import catalog as K
from paperloom.operators import enrich as N
from paperloom.operators import evidence as V
from paperloom.operators import identity as D
from paperloom.operators.staging import staged
from paperloom.schemas import EDGE, NODE

RECORD = "struct<title:string,doi:string,pmid:string,s2_id:string,abstract:string,year:string,venue:string,authors:array<string>,fields:array<string>,types:array<string>,citations:array<struct<doi:string,pmid:string,s2_id:string,title:string,year:int>>>"
ARTICLE = "struct<title:string,doi:string,pmid:string,abstract:string,authors:array<string>,year:string,venue:string,mesh:array<string>,keywords:array<string>>"


def node(id_, title="", doi=None, pmid=None, s2=None, uri=None, alt=None, tags=(), cites=None, status=None):
    items = None if cites is None else {"source": "s", "retrieved_at": "d", "items": [{"doi": None, "pmid": None, "s2_id": None, "title": None, "year": None} | c for c in cites]}
    ref = {"schema": None, "uri": None, "doi": doi, "pmid": pmid, "s2_id": s2, "year": None, "venue": None, "authors": None, "alt_dois": alt, "citation": None, "outbound_citations": items}
    return {"id": id_, "uuid": None, "slug": None, "title": title, "uri": uri, "abstract": None, "citation": None, "status": status, "type": None, "tags": list(tags), "metadata": {"reference": ref}}


def store(spark, nodes, edges=()):
    return B.Store(spark.createDataFrame([tuple(n[c] for c in ("id", "uuid", "slug", "title", "uri", "abstract", "citation", "status", "type", "tags", "metadata")) for n in nodes], NODE), spark.createDataFrame([(f"e{i}", s, t, "references") for i, (s, t) in enumerate(edges)], EDGE))


def record(**known):
    return {c: known.get(c) for c in ("title", "doi", "pmid", "s2_id", "abstract", "year", "venue", "authors", "fields", "types", "citations")}


def catalogs(spark, bulk=(), hits=(), articles=(), papers=(), works=()):
    art = lambda a: {c: a.get(c) for c in ("title", "doi", "pmid", "abstract", "authors", "year", "venue", "mesh", "keywords")}
    return N.Catalogs(
        spark.createDataFrame([(d, n, record(**r)) for n, (d, r) in enumerate(bulk)], f"doi string, at int, record {RECORD}"), spark.createDataFrame(list(hits), "term string, rank int, pmid string"),
        spark.createDataFrame([(p, n, art(a)) for n, (p, a) in enumerate(articles)], f"pmid string, at int, record {ARTICLE}"),
        spark.createDataFrame([(d, n, record(**r)) for n, (d, r) in enumerate(papers)], f"doi string, at int, record {RECORD}"),
        spark.createDataFrame([(d, n, record(**r)) for n, (d, r) in enumerate(works)], f"doi string, at int, record {RECORD}"),
    )


def items(spark, *raw):
    return spark.createDataFrame([(i, x if isinstance(x, str) and x.startswith("!") else json.dumps(x)) for i, x in enumerate(raw)], "idx long, item string")


def ingest(spark, raw, held=(), edges=(), cat=None, refs=(), **more):
    return B.ingest(items(spark, *raw), cat or catalogs(spark), spark.createDataFrame(list(refs), "doi string, at int, payload string"), store(spark, held, edges), batch="b", day="2024-05-01", **more)


def outcomes(result):
    return {r.idx: r for r in result.outcomes.collect()}


def cite(**known):
    return {c: known.get(c) for c in ("doi", "pmid", "s2_id", "title", "year")}


@pytest.fixture(scope="module")
def world(spark):
    """One batch with all sorts of items: (result, outcomes by idx)."""
    held = [
        node("n1", "Known work number one", doi="10.1/k"), node("n2", "Waits", doi="10.1/w", cites=[{"doi": "10.1/NEW"}, {"doi": "10.1/w"}]), node("n3", "Old", doi="10.1/new3", alt=["10.1/OLD"]),
        node("n4", "Merged into, a long title", doi="10.1/m", tags=["pipeline:queued", "mesh:old", "note:mine", "s2id:s0"], s2="s0"), node("n5", "Keeps its citations", doi="10.1/keep", cites=[{"doi": "10.1/z"}]),
    ]
    listed = [cite(doi="10.1/k"), cite(title="known WORK number  one."), cite(doi="10.1/new"), cite(doi="10.1/none")]
    bulk = [("10.1/new", {"title": "A new work", "citations": listed}), ("10.1/x", {"title": "The promoted work", "doi": "10.1/y"}), ("10.1/p", {"title": "t", "doi": "10.1/c"}), ("10.1/q", {"title": "u", "doi": "10.1/p"})]
    payload = json.dumps({"data": [{"citedPaper": {"paperId": "s9", "title": "T", "externalIds": {"DOI": "10.1/Q9"}}}]})
    raw = [
        {"doi": "10.1/a", "title": "a title that is long enough"}, 7, {"title": "short"}, "10.1/unknown", "!broken", {"title": "another title, long too"}, {"pmid": "5", "title": "the second long title"},
        "10.1/x", {"doi": "https://doi.org/10.1/old", "title": "whatever it is called"}, {"doi": "10.1/X", "title": "by its old name again"}, {"doi": "10.1/p", "title": "first long title"}, {"doi": "10.1/q", "title": "other long title"},
        "10.1/new", {"doi": "10.1/m", "title": "x", "year": "1990", "venue": ""}, {"doi": "10.1/m", "title": "y", "year": "1991", "venue": "V"}, {"doi": "10.1/keep", "title": "keeps"}, {"doi": "10.1/k", "title": "k"},
    ]
    i = F.col("idx")
    faults = {"store": F.when(i == 5, "disk is full"), "link": F.when(i == 0, "HTTP 404").when(i == 6, "locator missing")}
    done = ingest(spark, raw, held=held, edges=[("n2", "n1")], cat=catalogs(spark, bulk=bulk), refs=[("10.1/k", 0, payload), ("10.1/k", -1, "{}")], faults=faults)
    return done, outcomes(done)


def test_items_fail_by_themselves(world):
    _, got = world
    assert [got[i].status for i in range(7)] == ["needs-review", "failed", "needs-review", "needs-review", "failed", "failed", "needs-review"]
    assert all(got[i].status == "digested" for i in range(7, 17))
    assert got[0].created and got[5].created and got[0].node_id and not got[3].node_id
    assert got[0].errors == ["HTTP 404"] and got[5].errors == ["disk is full"] and N.NO_TITLE in got[3].errors


def test_final_status_and_notes_of_failing_items(world):
    done, got = world
    tags = {r.id: r.tags for r in done.store.nodes.collect()}
    assert "pipeline:needs-review" in tags[got[6].node_id] and "pipeline:failed" in tags[got[5].node_id] and "pipeline:digested" in tags[got[7].node_id]
    notes = {}
    for r in done.notes.collect():
        notes.setdefault(r.node_id, []).append(r.content)
    assert sorted(notes[got[6].node_id]) == ["[2024-05-01] Created via ingestion pipeline; source: input-only", "[2024-05-01] backfill needs-review: locator missing"]
    assert notes["n3"] == ["[2024-05-01] Dedup match on doi; merged metadata; source: input-only"]


def test_alternative_identifiers_find_stored_nodes_and_each_other(world):
    _, got = world
    assert got[7].created and got[8].node_id == "n3" and got[8].reason == "doi" and not got[8].created and got[9].node_id == got[7].node_id
    # A node is known by the identifier that it was promoted from, too.
    assert got[10].created and not got[11].created and got[11].node_id == got[10].node_id


def test_links_forward_and_reverse(world):
    done, got = world
    one = got[12]
    assert (one.linked, one.skipped, one.reverse, one.stored) == (2, 2, 1, 4)
    assert {(r.source_id, r.target_id) for r in done.edges.collect()} == {(one.node_id, "n1"), ("n2", one.node_id)}
    assert done.store.edges.count() == 3


def test_an_empty_answer_keeps_stored_citations(world):
    done, got = world
    listed = {r.id: r.metadata.reference.outbound_citations for r in done.store.nodes.collect()}
    assert got[15].stored == 1 and [i.doi for i in listed["n5"]["items"]] == ["10.1/z"]
    assert [i.doi for i in listed["n1"]["items"]] == ["10.1/q9"] and listed["n1"].source == "semantic-scholar" and listed["n1"].retrieved_at == "2024-05-01"


def test_merged_items_fill_in_order_and_replace_tags(world):
    row = world[0].store.nodes.filter("id = 'n4'").first()
    assert row.title == "Merged into, a long title" and row.metadata.reference.year == "1990" and row.metadata.reference.venue == "V"
    assert sorted(row.tags) == ["mesh:old", "note:mine", "pipeline:digested", "s2id:s0", "year:1991"]
    assert row.citation == "(1991). y V"


def test_a_run_goes_on_where_it_ended(spark, tmp_path):
    raw = [{"doi": "10.1/a", "title": "a title that is long enough"}, {"title": "a second title, long too"}]
    root = f"file://{tmp_path}/run"
    first = ingest(spark, raw, root=root)
    want = sorted(map(str, first.outcomes.collect()))
    written = sorted(p.name for p in tmp_path.glob("run/*/*"))
    # Another state of the sources would give another result; what is written stands.
    again = ingest(spark, [1, 2], root=root)
    assert sorted(map(str, again.outcomes.collect())) == want and sorted(p.name for p in tmp_path.glob("run/*/*")) == written
    # A phase that was not marked whole is made again, with the ones before it read.
    import shutil

    for late in ("final", "outcomes"):
        shutil.rmtree(tmp_path / "run" / late / "_whole")
    third = ingest(spark, [1, 2], root=root)
    assert sorted(map(str, third.outcomes.collect())) == want


def test_a_batch_of_nothing(spark):
    none = B.ingest(items(spark, 1).limit(0), catalogs(spark), spark.createDataFrame([], "doi string, at int, payload string"), store(spark, []), batch="b", day="d")
    assert none.outcomes.collect() == [] and none.store.nodes.collect() == []


def test_backfill_in_chunks(spark):
    held = [
        node("a", "a title that is long enough", doi="10.1/a", tags=["pipeline:queued"]), node("b", "another long title here", tags=["pipeline:failed"]), node("c", "short", tags=["pipeline:queued"]),
        node("d", "digested already, a long one", doi="10.1/d", tags=["pipeline:digested"]), node("e", "tagged and long enough", tags=["pipeline:scaffolded", "mesh:x"]), node("f", "deleted but long enough", tags=["pipeline:queued"], status="deleted"),
    ]
    cat = catalogs(spark, bulk=[("10.1/a", {"title": "T", "citations": [{"doi": "10.1/d", "pmid": None, "s2_id": None, "title": None, "year": None}]})])
    refs = spark.createDataFrame([], "doi string, at int, payload string")
    for size in (1,):
        counts, after = B.backfill(store(spark, held), cat, refs, batch="f", day="2024-05-01", only_missing=True, chunk_size=size)
        assert counts.first().asDict() == {"candidates": 4, "resolvable": 2, "skipped_no_doi": 1, "skipped_already_tagged": 1, "processed": 2, "edges_linked": 1, "citations_stored": 1, "failed": 0, "needs_review": 0, "errors": 0}
        assert after.nodes.count() == 6 and after.edges.count() == 1
    with pytest.raises(ValueError):
        B.backfill(store(spark, held), cat, refs, batch="f", day="d", chunk_size=0)
    nothing, _ = B.backfill(store(spark, held[3:4]), cat, refs, batch="f", day="d", chunk_size=0)
    assert nothing.first().candidates == 0


def test_chunks_share_catalogs_and_keys(spark, monkeypatch):
    calls, keyed = [], []
    monkeypatch.setattr(B, "resolve", lambda df, cat: calls.append(df.count()) or N.resolve(df, cat))
    monkeypatch.setattr(B, "node_key_rows", lambda nodes: keyed.append(sorted(r.id for r in nodes.collect())) or D.node_key_rows(nodes), raising=False)
    held = [node("a", "another long title here", tags=["pipeline:queued"]), node("b", "a title that is long enough", doi="10.1/b", tags=["pipeline:failed"]), node("c", "nobody asks for this one", doi="10.1/c"), node("d", "deleted", doi="10.1/new", status="deleted")]
    cat = catalogs(spark, bulk=[("10.1/b", {"title": "T", "citations": [cite(doi="10.1/new"), cite(doi="10.1/c"), cite(doi="10.1/none")]})], hits=[("another long title here", 1, "p9")], articles=[("p9", {"title": "Another long title here", "doi": "10.1/new"})])
    counts, after = B.backfill(store(spark, held), cat, spark.createDataFrame([], "doi string, at int, payload string"), batch="f", day="2024-05-01", chunk_size=1)
    # The identifier that the first chunk gave to a is what the second one's list names it by.
    assert {(r.source_id, r.target_id) for r in after.edges.collect()} == {("b", "a"), ("b", "c")} and counts.first().processed == 2
    status = {r.id: [t for t in r.tags if t.startswith("pipeline:")] for r in after.nodes.collect()}
    assert status == {"a": ["pipeline:digested"], "b": ["pipeline:digested"], "c": [], "d": []}
    assert calls == [2] and keyed == [["a", "b", "c"], ["a"], ["b"]]


# ---------------------------------------------------------------------------------------------------------------


def test_searched_articles_need_the_title(spark):
    raw = spark.createDataFrame([(1, "Deep learning for plants", "10.1/a", None), (2, "Deep learning for plants", "10.1/b", "p1"), (3, None, "10.1/c", None)], "idx long, title string, doi string, pmid string")
    cat = catalogs(spark, hits=[("10.1/a", 1, "p1"), ("10.1/c", 1, "p1")], articles=[("p1", {"title": "Unrelated pig feed trial", "venue": "Pigs"}), ("p1", {"title": "Unrelated pig feed trial", "venue": "Swine", "mesh": ["m"]})])
    got = {r.idx: r for r in N.resolve(raw, cat).collect()}
    assert (got[1].venue, got[1].source, got[1].mesh, got[1].pmid) == (None, "input-only", [], None)
    # A given id is believed, and so is a search without a title to compare; of two records the last stands.
    assert (got[2].venue, got[2].source, got[2].mesh) == ("Swine", "pubmed", ["m"])
    assert (got[3].title, got[3].pmid, got[3].resolve_error) == ("Unrelated pig feed trial", "p1", None)
    assert len(got) == 3


def test_complete_records_ask_nobody_else(spark):
    whole = {"title": "T", "doi": "10.1/A", "s2_id": "s", "abstract": "a", "year": "2000", "venue": "v", "authors": ["x"]}
    raw = spark.createDataFrame([(1, "10.1/a", ["own"]), (2, "10.1/b", ["own"])], "idx long, doi string, keywords array<string>")
    cat = catalogs(spark, bulk=[("10.1/a", whole)], papers=[("10.1/a", {"venue": "no"}), ("10.1/b", {"title": "paper", "doi": "10.1/B2", "fields": ["f"]})], works=[("10.1/b2", {"title": "no"})])
    got = {r.idx: r for r in N.resolve(raw, cat).collect()}
    assert got[1].asked == ["bulk"] and got[1].venue == "v" and got[1].source == "s2-batch" and got[1].keywords == ["own"]
    assert got[2].asked == ["bulk", "search", "paper"] and got[2].doi == "10.1/b2" and got[2].alt_dois == ["10.1/b"] and got[2].source == "semantic-scholar"


def test_publishers_records(spark):
    raw = [
        '{"message": {"title": ["A", "B"], "container-title": [], "author": [{"given": " X ", "family": "Y"}, {"family": "Z"}, {"given": "only"}], "published": {"date-parts": [[]]}, "published-print": {"date-parts": [["1999"]]}, "subject": ["s", "s"], "DOI": "https://doi.org/10.1/Q", "abstract": ""}}',
        '{"title": [], "published": {"date-parts": [[20205]]}, "published-online": {"date-parts": [[2001, 2]]}}', "not json", "[]",
    ]
    got = [r.r for r in spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, raw string").orderBy("i").select(K.work_record(F.col("raw")).alias("r")).collect()]
    assert got[0].asDict() == {"title": "A", "doi": "10.1/q", "abstract": None, "year": "1999", "venue": None, "authors": ["X Y", "Z"], "keywords": ["s"]}
    assert got[1].year == "2001" and got[1].title is None and got[2].title is None and got[3].authors == []


@pytest.mark.parametrize(("item", "kind"), [({"s2_id": "s1"}, "s2_id"), ({"pmid": "7"}, "pmid"), ({"doi": "doi:10.1/A"}, "doi"), ({"doi": "10.1/alt"}, "doi"), ({"doi": "https://doi.org/10.1/uri"}, "doi"), ({"title": "Thé  Own Title."}, "title"), ({"title": "Short"}, None), ({"s2_id": "s9"}, None), ({}, None)])
def test_each_kind_of_evidence_saves_an_edge(spark, item, kind):
    t = node("t", "The own title", doi="10.1/a", pmid="7", s2="s1", uri="https://doi.org/10.1/URI", alt=["10.1/ALT"], tags=["s2id:s1", "s2id:s9", "kw:x"])
    s = store(spark, [t, node("o", "citer", cites=[{"doi": "10.9/else"}, item]), node("u", "short")], [("o", "t"), ("gone", "t"), ("o", "u")])
    made = V.plan(s.nodes, s.edges)
    got = {r.source_id: r.kinds for r in made.evidence.collect()}
    assert got == {"o": [kind] if kind else [], "gone": []}
    nodes, edges = V.apply(s.nodes, s.edges, made)
    assert nodes.filter("id = 't'").first().tags == ["s2id:s1", "kw:x"]
    assert {(r.source_id, r.target_id) for r in edges.collect()} == ({("o", "t")} if kind else set()) | {("o", "u")}
    assert V.plan(nodes, edges).counts().first().asDict() == {"contaminated": 0, "ambiguous": 0, "phantom": 0, "genuine": 0}


def test_edges_carry_only_keys_of_several_targets(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(V, "staged", lambda df, name="staged": kept.setdefault(name, staged(df, name)))
    a = node("a", "The own title of a", doi="10.1/a", s2="sa", alt=["10.1/BOTH"], tags=["s2id:x"])
    b = node("b", "The own title of b", pmid="7", s2="sb", alt=["10.1/both"], tags=["s2id:x"])
    c = node("c", "short", s2="sc", tags=["s2id:x"])
    lists = {"o": [{"doi": "10.1/both"}, {"s2_id": "sc"}, {"s2_id": "sc"}], "p": [{"s2_id": "sa"}, {"title": "the own title of A"}], "q": [{"pmid": "7"}, {"doi": "10.1/Both"}], "r": []}
    edges = [(s, t) for s in lists for t in "abc"] + [("o", "a")]
    s = store(spark, [a, b, c] + [node(k, "citer", cites=v) for k, v in lists.items()], edges)
    found = V.edge_evidence(s.nodes, s.edges, s.nodes.filter("id in ('a', 'b', 'c')")).collect()
    want = {("o", "a"): ["doi"], ("o", "b"): ["doi"], ("o", "c"): ["s2_id"], ("p", "a"): ["s2_id", "title"], ("q", "a"): ["doi"], ("q", "b"): ["doi", "pmid"]}
    assert len(found) == 12 and {(r.source_id, r.target_id): r.kinds for r in found if r.kinds} == want
    assert {(r.target_id, *[k.key for k in r.also or []]) for r in kept["inbound"].collect()} == {("a", "10.1/both"), ("b", "10.1/both"), ("c",)}


def test_shuffles_of_what_is_written_go_with_the_job(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {f.name for d in manager.localDirs() for f in Path(d.getPath()).rglob("shuffle_*.data")}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = held(), spark.conf.get(name)
    rows = staged(spark.range(20_000).repartition(3, "id").groupBy((F.col("id") % 7_001).alias("k")).count())
    end = time.monotonic() + 20
    while held() - before and time.monotonic() < end:  # files go a moment after the job
        time.sleep(0.1)
    assert not held() - before and rows.count() == 7_001 and spark.conf.get(name) == was


def test_ambiguous_tags_stay(spark):
    s = store(spark, [node("t", "x", pmid="7", tags=["s2id:a", "s2id:b", "pmid:7", "s2id:a"]), node("d", "x", s2="q", tags=["s2id:z"], status="deleted")])
    made = V.plan(s.nodes, s.edges)
    assert [(r.id, r.tags) for r in made.ambiguous.collect()] == [("t", ["s2id:a", "s2id:b"])] and made.contaminated.collect() == []


def test_creators_register_alternatives_but_do_not_ask_by_them(spark):
    rows = spark.createDataFrame([(0, "a", ["b", "c"]), (1, "b", []), (2, "d", ["c"]), (3, "c", []), (4, "e", ["d"])], "id long, doi string, alt array<string>")
    got = {r.id: (r.rep_id, r.created) for r in D.in_order(rows, "id", [("doi", F.col("doi"))], also=[("doi", F.col("alt"))]).collect()}
    assert got == {0: (0, True), 1: (0, False), 2: (2, True), 3: (0, False), 4: (4, True)}


@pytest.mark.parametrize("last", [0, 200_000])
def test_placed_against_a_loop(spark, monkeypatch, last):
    import random

    monkeypatch.setattr(D, "LAST", last)
    pick = random.Random(2)
    rows = [(i, f"s{pick.randrange(40)}" if i % 3 else None, f"d{pick.randrange(60)}" if i % 2 else None, [f"d{pick.randrange(60)}"] if i % 5 == 0 else []) for i in range(120)]
    stored = {("s", f"s{k}"): f"n{k}" for k in range(0, 10)} | {("d", f"d{k}"): f"m{k}" for k in range(0, 12)}
    want, live = {}, dict(stored)
    for i, s, d, alt in rows:
        hit = next(((k, live[(k, v)]) for k, v in (("s", s), ("d", d)) if v and (k, v) in live), None)
        if hit:
            want[i] = (hit[1], False, hit[0])
        else:
            want[i] = (i, True, None)
            for key in [("s", s), ("d", d), *[("d", a) for a in alt]]:
                if key[1]:
                    live.setdefault(key, i)
    index = spark.createDataFrame([(k, v, n) for (k, v), n in stored.items()], "kind string, key string, node_id string")
    df = spark.createDataFrame(rows, "id long, s string, d string, alt array<string>")
    got = {r.id: (r.node_id if r.node_id is not None else r.rep_id, r.created, r.reason) for r in D.placed(df, "id", [("s", F.col("s")), ("d", F.col("d"))], index, also=[("d", F.col("alt"))]).collect()}
    assert got == want


@pytest.mark.parametrize(
    ("make", "once"), [(lambda df: K.article_records(df), "<!--"), (lambda df: df.select(K.entry_record(F.col("xml")).alias("r")), "from_json("), (lambda df: df.select(K.work_record(F.col("xml")).alias("r")), "from_json(")]
)
def test_an_answer_is_parsed_once_a_row(spark, make, once):
    plan = make(spark.createDataFrame([("x",)], "xml string").repartition(2))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(once) == 1


def test_lists_of_citations_are_written_with_one_answer_only(spark, monkeypatch):
    wrote, plain = [], N.staged
    monkeypatch.setattr(N, "staged", lambda df, name: wrote.append(df.columns) or plain(df, name))
    raw = spark.createDataFrame([(1, "10.1/a"), (2, "10.1/b")], "idx long, doi string")
    got = {r.idx: r.cited for r in N.resolve(raw, catalogs(spark, bulk=[("10.1/a", {"title": "T", "citations": [cite(doi="10.1/z")]})])).collect()}
    assert [c.doi for c in got[1]] == ["10.1/z"] and got[2] is None
    assert len(wrote) == 6 and not any("cited" in c for c in wrote)


def test_an_index_that_is_asked_twice_is_written_once(spark, monkeypatch):
    wrote, plain = [], D.staged
    monkeypatch.setattr(D, "staged", lambda df, name="x": wrote.append(name) or plain(df, name))
    index = spark.createDataFrame([("doi", "10.1/a", "n")], "kind string, key string, node_id string")
    rows = spark.createDataFrame([(1, None, "10.1/A", None, "t")], "i long, s2_id string, doi string, pmid string, title string")
    assert [tuple(r) for r in D.match_in_turn(rows, index, "i", D.node_keys()).collect()] == [(1, "n", "doi")]
    assert wrote.count("index") == 1


def test_a_small_table_is_read_by_all_cores(spark, tmp_path):
    from paperloom.operators import staging as S

    spark.range(1000).coalesce(1).write.parquet(f"file://{tmp_path}/one")
    out = S.dealt(spark.read.parquet(f"file://{tmp_path}/one"))
    sizes = [len(p) for p in out.filter("id >= 0").rdd.glom().collect()]
    assert sum(sizes) == 1000 and len(sizes) >= 4 and max(sizes) < 500


def test_looks_at_a_library_gather_no_lists_again(spark):
    from paperloom.plans.library import library

    nodes, edges = library(spark, "/root/testdata/sf0.001")
    for df in (nodes, edges):
        assert "Aggregate" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_files_dealt_grow_with_rows(spark, monkeypatch):
    """Their number was fixed by cores, so that a task's rows grew with the table."""
    from paperloom.operators import staging as S

    monkeypatch.setattr(S, "ROWS", 10)
    out = S.dealt(spark.range(1000))
    assert len(out.inputFiles()) == 100 and out.count() == 1000
