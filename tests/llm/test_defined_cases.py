"""Defined cases of earlier operators that no other test covers."""

from paperloom.llm import ngram_join, secret_scan, topk


def test_top_k_without_queries(spark):
    rows = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(1, 19)] + [(None, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert topk.top_k(rows).collect() == []
    one = topk.top_k(rows.unionByName(spark.createDataFrame([(20, [1.0, 0.0])], rows.schema))).collect()
    assert {r.query_id for r in one} == {20} and [r.vec_id for r in sorted(one, key=lambda r: r.rank)][:3] == [18, 17, 16]


def test_secrets_of_rows_without_ids(spark):
    secret = "token=abcdef123456"
    docs = spark.createDataFrame([(None, secret, "a"), (None, "none", "b"), (1, secret, "c"), (2, None, "d")], "doc_id long, text string, source string")
    found, _ = secret_scan.scan(docs)
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_assign) for r in secret_scan.digest(found).collect())
    assert got == [((False, 1), 1), ((False, 2), 0), ((True, 0), 0), ((True, 0), 1)]


def test_one_of_each_keeps_columns_with_names_of_its_own(spark):
    text = " ".join(f"word{i}" for i in range(40))
    names = ["__text", "__doc", "__hash", "__first", "m", "hash", "doc_"]
    rows = [(1, text, *range(7)), (2, text, *range(7)), (3, text, *range(7)), (3, text, *range(7)), (4, "another text", *range(7))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    got = sorted(ngram_join.one_of_each(docs).collect())
    assert [r.doc_id for r in got] == [1, 4] and all([r[n] for n in names] == list(range(7)) for r in got)
    same = docs.filter("doc_id = 3")
    assert [[r[n] for n in names] for r in ngram_join.one_of_each(same).collect()] == [list(range(7))]
