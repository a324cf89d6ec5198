"""Operators 11 to 13 against plain loops, exact round trips and held-out labels, and their defined cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import infill, line_dedup, manifest, quality
from paperloom.llm.common import table
from paperloom.llm.queries import queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_line_dedup_keeps_columns_with_names_of_its_own(spark):
    names = ["__host", "__drop", "__lines", "__keys", "__gone", "__kept", "host__", "drop__", "lines__", "keys__", "gone__", "kept__"]
    rows = [(i, f"own {i}\nlicence line", "s", *range(len(names))) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` int" for n in names))
    got = line_dedup.strip_lines(docs).collect()
    assert all([r[n] for n in names] == list(range(len(names))) and r.text == f"own {r.doc_id}" and r.n_dropped == 1 for r in got)


# 11 ------------------------------------------------------------------------------------------------------------


def plain_leaf(row):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """(root, [(left, right), ...] for each node), level by level."""
    proofs, at, row = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(row) > 1:
        for p, i in zip(proofs, at, strict=True):
            run = row[i // 3 * 3 : i // 3 * 3 + 3]
            p.append(("".join(run[: i % 3]), "".join(run[i % 3 + 1 :])))
        row = [sha("".join(row[i : i + 3])) for i in range(0, len(row), 3)]
        at = [i // 3 for i in at]
    return row[0], proofs


def plain_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [(sorted(groups[s]), *plain_tree([x[2] for x in sorted(groups[s])])) for s in order]
    root, tops = plain_tree([t[1] for t in trees])
    return sorted((x[2], t[1], root, tuple(p + top)) for t, top in zip(trees, tops, strict=True) for x, p in zip(t[0], t[2], strict=True))


def rows_of(sizes, seed=0):
    pick, out = random.Random(seed), []
    for source, n in sizes.items():
        for _ in range(n):
            i = pick.randrange(10 * n + 10)
            out.append({"doc_id": None if i % 31 == 7 else i, "text": [None, "", "a\nb", "é" * (i % 5)][i % 4], "lang": "en", "source": source, "n_chars": i if i % 3 else None})
    pick.shuffle(out)
    return out


@pytest.mark.parametrize("step", [1, 7])
@pytest.mark.parametrize("sizes", [{"s": 1}, {"s": 2}, {"a": 3, None: 4, "": 1}, {"hot": 700, "Z": 28, "é": 27, None: 9, "b": 10}, {f"s{i}": 1 + i % 4 for i in range(40)}])
def test_manifest_against_plain_trees(spark, monkeypatch, step, sizes):
    monkeypatch.setattr(manifest, "STEP", step)
    rows = rows_of(sizes)
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], DOCS).repartition(5)
    found = manifest.manifest(docs).withColumn("up", manifest.folded(F.col("leaf"), F.col("proof"))).collect()
    assert sorted((r.leaf, r.subroot, r.root, tuple((p.left, p.right) for p in r.proof)) for r in found) == plain_manifest(rows)
    assert all(r.up == r.root for r in found)


def test_manifest_with_groups_that_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(manifest, "BROADCAST_BYTES", 0)
    rows = rows_of({"hot": 300, "b": 5, None: 2})
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], DOCS)
    assert sorted((r.leaf, r.subroot, r.root, tuple((p.left, p.right) for p in r.proof)) for r in manifest.manifest(docs).collect()) == plain_manifest(rows)


def test_manifest_of_equal_rows_clashing_columns_and_none(spark):
    docs = spark.createDataFrame([(7, "x", "en", "s", 1)] * 50, DOCS)
    clash = docs.selectExpr("*", "1 as tree", "2 as at", "3 as digest", "4 as id", "5 as n", "6 as grp", "7 as kept", "8 as level")
    got = manifest.manifest(clash, keep={"n": F.col("n"), "tree": F.col("tree")}).collect()
    assert len(got) == 50 and len({r.root for r in got}) == 1 and {(r.n, r.tree) for r in got} == {(5, 1)}
    none = manifest.manifest(docs.limit(0))
    assert none.collect() == [] and none.columns == ["doc_id", "source", "leaf", "subroot", "root", "proof"]


def test_tampered_rows_are_told(spark, tmp_path):
    docs = spark.createDataFrame([(i, "line one\nline two" if i % 3 else "one line", "en", f"s{i % 4}", 5) for i in range(60)], DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries()["op11_merkle_manifest"](spark, str(tmp_path)).collect()}
    for i, r in got.items():
        broken = zlib.crc32(str(i).encode()) % 2 == 0 and i % 3 != 0
        assert r.verified == (not broken) and (r.folded_root == r.root) == (not broken)


# 12 ------------------------------------------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries()["op12_quality"](spark, d).collect()}
    labels = {r.doc_id: r.quality for r in table(spark, d, "labels").collect()}
    assert len(got) == table(spark, d, "documents").count()
    held = [(labels[i], r.score, r.predicted) for i, r in got.items() if r.held_out and i in labels]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert sum(p == y for y, _, p in held) >= 0.95 * len(held) and min(y for y, _, _ in held) == 0
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_quality_votes_against_a_plain_loop():
    pick = random.Random(4)
    word = lambda: "".join(pick.choice("abcde") for _ in range(pick.randint(1, 6)))
    texts = [" ".join(word() + ("!!" if i % 3 == 0 else "") for _ in range(30)) for i in range(90)]
    terms = quality.Terms()

    def dense(t):
        at, w = terms.of(t)
        out = np.zeros(quality.TERMS)
        out[at] = w
        return out

    rows = np.array([dense(t) for t in texts])
    axes = np.linalg.svd(rows[:60], full_matrices=False)[2][: quality.DIMS].T
    unit = lambda v: v / np.linalg.norm(v)
    vectors, y = np.array([unit(r @ axes) for r in rows[:60]]), np.array([i % 3 != 0 for i in range(60)], float)
    stands = np.where(y == 1, 2.0, 1.0)
    model = quality.Model(0.6, axes.astype(np.float32), vectors.astype(np.float32), y.astype(np.float32), stands.astype(np.float32))
    got = quality.Scorer(model).scores([*texts[60:], "", None])
    for r, score in zip(rows[60:], got, strict=False):
        near = sorted(((float(unit(r @ axes) @ v), j) for j, v in enumerate(vectors)), reverse=True)[: quality.NEIGHBOURS]
        votes = [(max(c, 0.0) ** quality.POWER * stands[j], y[j]) for c, j in near]
        want = (sum(v * l for v, l in votes) + quality.PRIOR * 0.6) / (sum(v for v, _ in votes) + quality.PRIOR)
        assert score == pytest.approx(want, abs=1e-4)
    assert list(got[-2:]) == [0.6, 0.6]


def test_the_space_is_that_of_the_first_singular_vectors(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows, _ = quality.sample(docs, table(spark, "/root/testdata/sf0.001", "labels"))
    model = quality.fit(rows, 0.5)
    dense = np.zeros((rows.count(), quality.TERMS))
    for r, row in zip(dense, sorted(rows.collect(), key=lambda r: r.id), strict=True):
        r[row.places] = row.weights
    best = np.linalg.svd(dense, full_matrices=False)[1][: quality.DIMS]
    assert np.linalg.norm(dense @ model.axes) >= 0.97 * np.linalg.norm(best)


def test_quality_of_edge_cases(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 1), (2, None), (None, 1)], "doc_id long, quality int")
    texts = [("plain words here and there " * 3) if i % 2 else ("NOISE!! MORE!! " * 5) for i in range(40)]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(None, "plain words", "en"), (41, None, "en"), (42, "", "en"), (43, "x" * 300_000, "en"), (7, texts[7], "de"), (44, " \n ", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = quality.fit(*quality.sample(docs, labels))
    got = quality.score_texts(docs, model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[41].score == by[42].score == by[44].score == pytest.approx(model.share)
    assert by[1].score > 0.9 > 0.1 > by[0].score and sum(r.doc_id == 7 for r in got) == 2
    nothing = quality.fit(*quality.sample(docs, labels.limit(0)))
    assert {r.score for r in quality.score_texts(docs, nothing).collect()} == {0.0}
    ones = quality.fit(*quality.sample(docs, labels.filter("quality = 1")))
    assert min(r.score for r in quality.score_texts(docs, ones).collect()) == pytest.approx(1.0)
    assert quality.score_texts(docs.limit(0), model).collect() == []
    assert quality.fit(*quality.sample(docs.limit(0), labels)).labels.size == 0


# 13 ------------------------------------------------------------------------------------------------------------

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_cut(key, text):
    t = text or ""
    tokens = TOKEN.findall(t)
    h = [int(sha(f"42:{key}")[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(tokens), "plain", None, None, t
    a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    x, y, z = ("".join(part) for part in (tokens[:a], tokens[a:b], tokens[b:]))
    if h[3] % 100 < 80:
        return len(tokens), "spm", len(x), len(y), f"<S>{z}<P>{x}<M>{y}"
    return len(tokens), "psm", len(x), len(y), f"<P>{x}<S>{z}<M>{y}"


def test_fill_in_middle_against_a_plain_loop(spark):
    pick = random.Random(3)
    texts = ["".join(pick.choice("ab é\n\t\x0b\x0c\r\x85 日 <PSM>") for _ in range(pick.randint(0, 400))) for _ in range(400)]
    texts += [None, "", " ", "\n\n", "x", " x", "x ", "a <M> b", "word " * 50_000, "x" * 200_000, " " * 5000]
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(None, "a b c d", 1), (3, texts[3], 9)]
    made = infill.transform(spark.createDataFrame(rows, "doc_id long, text string, form long"))
    assert made.columns == ["doc_id", "text", "form", "n_tokens", "form_", "prefix_chars", "middle_chars", "output"]
    got = made.withColumn("back", infill.restored(F.col("output"), F.col("form_"))).collect()
    assert len(got) == len(rows)
    forms = set()
    for r in got:
        key = "" if r.doc_id is None else r.doc_id
        assert (r.n_tokens, r.form_, r.prefix_chars, r.middle_chars, r.output) == plain_cut(key, r.text)
        assert r.back == (r.text or "")
        forms.add(r.form_)
    assert forms == {"plain", "psm", "spm"}
    assert infill.transform(made.select("doc_id", "text").limit(0)).collect() == []


def test_rank_and_select(spark):
    pick = random.Random(8)
    for size in (0, 1, 7, 8, 9, 511, 512, 513, 4096, 40_000):
        text = bytes(pick.choice(b"a  \nb") for _ in range(size))
        bounds = infill.Boundaries(text)
        starts = [m.start() for m in TOKEN.finditer(text.decode())]
        assert bounds.n == len(starts)
        assert [bounds.select(r) for r in range(len(starts) + 1)] == [*starts, size]
        assert all(bounds.rank(p) == r for r, p in enumerate(starts))


def test_bytes_that_are_no_text_stay(spark):
    raw = spark.createDataFrame([(i, bytearray(b"ab \xff\xfe cd \xe9 x")) for i in range(20)], "doc_id long, b binary").selectExpr("doc_id", "cast(b as string) as text")
    made = infill.transform(raw)
    back = made.select(F.hex(F.col("text").cast("binary")).alias("a"), F.hex(infill.restored(F.col("output"), F.col("form")).cast("binary")).alias("b"), "form").collect()
    assert {r.form for r in back} > {"plain"} and all(r.a == r.b for r in back)


def test_many_items_on_one_repeated_window():
    """The longest matches against a loop, and in time where thousands of items share a window that a text repeats."""
    import time

    import pandas as pd

    from paperloom.llm import decontaminate
    from paperloom.llm.common import words

    def plain(text, item, need):
        best = (0, 0, 0)
        for j in range(len(item)):
            for p in range(len(text)):
                n = 0
                while p + n < len(text) and j + n < len(item) and text[p + n] == item[j + n]:
                    n += 1
                if n >= need and (n, -p, -j) > (best[0], -best[1], -best[2]):
                    best = (n, p, j)
        return best

    pick = random.Random(11)
    for _ in range(40):
        items = [(str(i), [b"w%d" % pick.randrange(3) for _ in range(pick.choice([2, 4, 6, 12]))]) for i in range(8)]
        texts = [" ".join(f"w{pick.randrange(3)}" for _ in range(40)) for _ in range(3)]
        index = decontaminate.TestIndex(items, 4)
        for row, text in zip(pd.concat(decontaminate._judge(pd.DataFrame({"d": range(3), "t": texts}), "d", "t", index)).itertuples(), texts, strict=True):
            got = {m["item_id"]: (m["length"], m["doc_pos"], m["item_pos"]) for m in row.matches}
            assert got == {i: b for i, ws in items if (b := plain(words(text), ws, min(4, len(ws))))[0]}
    shared = " ".join(f"w{i}" for i in range(13))
    index = decontaminate.TestIndex([(str(i), words(f"a{i} {shared} b{i}")) for i in range(4000)], 13)
    start = time.monotonic()
    (out,) = decontaminate._judge(pd.DataFrame({"d": [1], "t": [(shared + " x ") * 800]}), "d", "t", index)
    assert len(out.matches[0]) == 4000 and time.monotonic() - start < 3
