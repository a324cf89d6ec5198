"""N-gram Jaccard join with a MinHash LSH forest.

A text's signature is TREES rows of DEPTH MinHash values. In each tree the texts' rows are sorted, so that texts
which share a prefix stand side by side: the sorted prefix trie of that tree. Texts are matched by their longest
prefixes first: neighbours in the order are joined where their signatures look alike. Then the matched prefix is
shortened, for each text until the chance to meet a similar text in some tree reaches the target recall; how far that
is follows from the text's number of n-grams, which says how similar another text can be if it is similar enough. At
that depth every text outside the node's largest group is compared with all that share its prefix. A node with very
many texts goes deeper instead, as dense places of a forest do: each of its branches is joined by itself, and their
leaders are then compared under the node's own prefix, with a wider margin.

Texts joined that way make candidate classes, by a spanning set of edges, one row a text and tree at most. Within a
class pairs are verified by their exact sets of n-grams. Of a large class, the texts near enough to its first one are
all similar to each other, by the triangle inequality of the Jaccard distance: those links are counted without a
comparison, so only the other texts are compared with all, in blocks of bounded bytes, and a large class makes rows in
proportion to its texts. Classes are the connected components of the verified links.

Equal texts are first collapsed to one, and come back at the end by a join on the text's hash.

Defined cases: words are those of `words` in common.py. A text of fewer than n words, but not none, is one
n-gram; a text without words, or null, is linked to no other text, and is one class with the texts equal to it.
Repeated rows are copies, and a row with a null id is a document like any other. The class id is the smallest id of
the class, null if all are null. Texts are read whole, however long. Other columns are ignored by classes() and kept
by one_of_each(), whose private columns start with two underscores. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import free_name, ready, release, stage_table, words

N = 5
SIMILARITY = 0.8
TREES = 24
DEPTH = 8  # values of a tree's row
RECALL = 0.9999  # the least chance that two texts at the threshold meet in a tree
HOT = 4000  # texts under one prefix from which on its branches are joined by themselves
BLOCK_TEXTS, BLOCK_GRAMS = 1000, 1_000_000  # of a class: what one side of a verifying task holds
CORE = 200  # texts of a class from which on links near its first text are counted, not compared
DENSE = 150  # an n-gram is dense if it is in more than one in so many pairs of texts
BROADCAST_BYTES = 32 << 20  # of the candidate classes' members; a larger table is joined by a shuffle
MARGIN = 0.2  # what a signature's estimate may fall short of the threshold: over five standard deviations
SEED = 5


def depth_for(similarity: float = SIMILARITY, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """Shorten the prefix from the full row until two texts at the threshold meet often enough."""
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


@lru_cache(maxsize=100_000)
def least_similarity(size: int, similarity: float) -> float:
    """The smallest Jaccard similarity at or above the threshold that a set of this size can have with another set."""
    if size > 100:
        return similarity
    found = 1.0
    for other in range(1, int(size / similarity + 1e-9) + 1):
        for both in range(min(size, other), 0, -1):
            j = both / (size + other - both)
            if j < similarity - 1e-9:
                break
            found = min(found, j)
    return found


class _Words(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 100_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASH = _Words()
#: An odd multiplier for each place in an n-gram, by the golden ratio's powers.
_PLACE = np.array([pow(0x9E3779B97F4A7C15, k + 1, 2**64) for k in range(64)], np.uint64)


def ngrams(text: str | None, n: int = N) -> np.ndarray:
    """Sorted 64-bit hashes of the text's different n-grams of words: multilinear in the words' hashes, then mixed."""
    ws = words(text)
    if not ws:
        return np.zeros(0, np.uint64)
    h = np.array([_HASH[w] for w in ws], np.uint64)
    size = min(n, len(h))
    with np.errstate(over="ignore"):
        g = np.full(len(h) - size + 1, size, np.uint64)
        for k in range(size):
            g += h[k : len(h) - size + 1 + k] * _PLACE[k]
        g ^= g >> np.uint64(31)
        g *= _PLACE[1]
        g ^= g >> np.uint64(29)
    return np.unique(g)


def _multipliers(rows: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 2**31, rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a[:, None], rng.integers(0, 2**32, rows, dtype=np.uint32)[:, None]


def signature(grams: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """MinHash values (32 bits) under permutations a * x + b of the n-grams' upper halves, which are hashes themselves."""
    least, half = np.full(len(a), 2**32 - 1, np.uint32), (grams >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(half), 4096):
            h = a * half[None, at : at + 4096]
            h += b
            np.minimum(least, h.min(axis=1), out=least)
    return least


def signatures(texts: DataFrame, similarity: float, recall: float, n: int) -> DataFrame:
    """id, size (n-grams), depth (of the prefix that the text may be matched by), nodes (one per tree: the hash of the
    prefix at the shortest depth), deep (two bytes of each value beyond it), sig (a byte of each value up to it)."""
    ready(texts.sparkSession)
    least = depth_for(similarity, recall)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = _multipliers(TREES * DEPTH)
        for pdf in batches:
            rows = []
            for i, t in zip(pdf["id"], pdf["text"], strict=True):
                grams = ngrams(t, n)
                if len(grams):
                    s = signature(grams, a, b).reshape(TREES, DEPTH)
                    nodes = [xxhash.xxh3_64_intdigest(row.tobytes(), tree) - 2**63 for tree, row in enumerate(s[:, :least])]
                    deep = s[:, least:].astype(">u2").tobytes()
                    depth = depth_for(least_similarity(len(grams), similarity), recall)
                    rows.append((i, len(grams), depth, nodes, deep, (s[:, :least] & np.uint32(255)).astype(np.uint8).tobytes()))
            if rows:
                yield pd.DataFrame(rows, columns=["id", "size", "depth", "nodes", "deep", "sig"])
        _HASH.clear()
        release()

    return texts.mapInPandas(run, "id long, size int, depth int, nodes array<long>, deep binary, sig binary")


def _blocks(rows: DataFrame, hot: int) -> DataFrame:
    """rows, of which column n holds their group's size, with (i, j) and own: a row of a hot group goes to each pair
    of blocks that its own block is in, the others to (0, 0)."""
    many = F.ceil(F.col("n") / F.lit(hot)).cast("int")
    own = F.pmod(F.xxhash64("id", F.lit(SEED)), many).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("many") - 1), lambda x: F.struct(F.least(x, F.col("own")).alias("i"), F.greatest(x, F.col("own")).alias("j")))
    dealt = rows.withColumns({"many": many, "own": own}).withColumn("p", F.explode(pairs))
    return dealt.select("*", "p.i", "p.j").drop("p", "many", "n")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows that share keys, from batches sorted by them."""
    held: list[pa.Table] = []
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if not len(t):
            continue
        codes = np.zeros(len(t), bool)
        for k in keys:
            v = t[k].to_numpy()
            codes[1:] |= v[1:] != v[:-1]
        same = held and all(held[-1][k][len(held[-1]) - 1] == t[k][0] for k in keys)
        cuts = [0, *np.flatnonzero(codes).tolist(), len(t)]
        if held and not same:
            yield pa.concat_tables(held)
            held = []
        for s, e in zip(cuts[:-2], cuts[1:-1], strict=True):
            part = t.slice(s, e - s)
            yield pa.concat_tables([*held, part]) if held else part
            held = []
        held.append(t.slice(cuts[-2]))
    if held:
        yield pa.concat_tables(held)


def _close(sig: np.ndarray, one: np.ndarray, least: float) -> np.ndarray:
    return (sig == one).mean(axis=1) >= least


class _Joined:
    """Disjoint sets over rows, and the edges that joined them."""

    def __init__(self, n: int):
        self.label = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        label = self.label
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    def join(self, a: int, b: int) -> None:
        p, q = self.root(a), self.root(b)
        if p != q:
            self.label[max(p, q)] = min(p, q)
            self.edges.append((a, b))

    def roots(self) -> np.ndarray:
        return np.array([self.root(x) for x in range(len(self.label))])


def spanning(sig: np.ndarray, deep: np.ndarray, depth: np.ndarray, least: float) -> _Joined:
    """Rows in the order of the trie, joined where signatures are close, by at most one edge a row for each set it meets.

    deep: values beyond the node's prefix; depth: how many of them have to match for a row to be compared. Neighbours,
    which share the longest prefixes, come first; then each row outside the largest set meets all under its prefix.
    """
    joined = _Joined(len(sig))
    for i in np.flatnonzero((sig[1:] == sig[:-1]).mean(axis=1) >= least).tolist():
        joined.join(i, i + 1)
    roots = joined.roots()
    sets, sizes = np.unique(roots, return_counts=True)
    if len(sets) == 1:
        return joined
    # Rows that share the first d values are a stretch of the order: it starts where one of those values changes.
    new = []
    for d in range(deep.shape[1] + 1):
        changed = np.zeros(len(sig), bool)
        changed[1:] = (deep[1:, :d] != deep[:-1, :d]).any(axis=1)
        changed[0] = True
        new.append(np.flatnonzero(changed))
    for r in np.flatnonzero(roots != sets[sizes.argmax()]).tolist():
        starts = new[int(depth[r])]
        k = int(np.searchsorted(starts, r, side="right")) - 1
        s, e = int(starts[k]), int(starts[k + 1]) if k + 1 < len(starts) else len(sig)
        for x in np.flatnonzero(_close(sig[s:e], sig[r], least)).tolist():
            joined.join(r, s + x)
    return joined


def _bytes(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def candidate_edges(sigs: DataFrame, similarity: float, recall: float) -> DataFrame:
    """src, dst of a spanning set over texts that meet in a tree and look similar enough."""
    short = depth_for(similarity, recall)
    size = 2 * (DEPTH - short)
    keys = sigs.select("id", "depth", "deep", F.posexplode("nodes").alias("tree", "key"))
    branch = F.expr(f"substring(deep, tree * {size} + 1, {size})")
    keys = keys.select("id", "depth", F.xxhash64("key", "tree").alias("node"), branch.alias("deep"))
    shared = stage_table(keys.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "nodes")
    rows = keys.join(shared, "node").join(sigs.select("id", "sig"), "id")
    # Texts of one branch to its end are dealt out by id, should they be very many.
    part = F.when(F.col("n") > HOT, F.xxhash64("deep", F.pmod(F.xxhash64("id", F.lit(SEED)), F.ceil(F.col("n") / HOT)))).otherwise(0)
    rows = rows.select("node", part.alias("part"), "deep", "id", "depth", "sig", (F.col("n") > HOT).alias("hot"))
    rows = rows.repartition("node", "part").sortWithinPartitions("node", "part", "deep", "id")
    least, kind = similarity - MARGIN, "src long, dst long, node long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, ["node", "part"]):
            ids, hot = t["id"].to_numpy(), t["hot"][0].as_py()
            edges, leaders = [], ids[:1].tolist() if hot else []
            if len(t) > 1:
                joined = spanning(_bytes(t["sig"], "u1"), _bytes(t["deep"], ">u2"), t["depth"].to_numpy() - short, least)
                edges = joined.edges
                leaders = ids[np.unique(joined.roots())].tolist() if hot else []
            if edges or leaders:
                src, dst = [*ids[[e[0] for e in edges]].tolist(), *leaders], [*ids[[e[1] for e in edges]].tolist(), *[None] * len(leaders)]
                node = [*[None] * len(edges), *[t["node"][0].as_py()] * len(leaders)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (src, dst, node)], names=["src", "dst", "node"])
        release()

    found = stage_table(rows.mapInArrow(run, kind), "matched")
    edges = found.filter("dst is not null").select("src", "dst")
    leaders = found.filter("node is not null").select("node", F.col("src").alias("id")).distinct()
    many = leaders.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = _blocks(leaders.join(many, "node").join(sigs.select("id", "sig"), "id"), HOT)
    met = met.select("node", "i", "j", "id", "sig").repartition("node", "i", "j").sortWithinPartitions("node", "i", "j", "id")
    # A text may be off its leader by as much as it is off a similar text, and so may that text of its own leader.
    wide = max(0.0, least - MARGIN)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, ["node", "i", "j"]):
            if len(t) > 1:
                ids, none = t["id"].to_numpy(), np.zeros((len(t), 0), np.uint8)
                if edges := spanning(_bytes(t["sig"], "u1"), none, np.zeros(len(t), int), wide).edges:
                    yield pa.RecordBatch.from_arrays([pa.array(ids[[e[k] for e in edges]], pa.int64()) for k in (0, 1)], names=["src", "dst"])
        release()

    return edges.unionByName(met.mapInArrow(meet, "src long, dst long")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """id, class (the smallest id that its edges reach) of every id on an edge.

    Each round takes the least label among the neighbours, then the label's own label, and is written to the
    shared folder. Labels fall along doubling paths, so rounds follow the logarithm of the longest path.
    """
    both = stage_table(edges.union(edges.select("dst", "src")).distinct(), "edges")
    labels = both.groupBy("src").agg(F.least(F.col("src"), F.min("dst")).alias("class")).withColumnRenamed("src", "id")
    labels = stage_table(labels, "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("id", "dst"), "dst").groupBy("src").agg(F.min("class").alias("near"))
        step = labels.join(seen.withColumnRenamed("src", "id"), "id").select("id", F.col("class").alias("old"), F.least("class", "near").alias("mid"))
        up = labels.select(F.col("id").alias("mid"), F.col("class").alias("above"))
        moved = stage_table(step.join(up, "mid").select("id", "old", F.least("mid", "above").alias("class")), "labels")
        labels = moved.select("id", "class")
        if not moved.filter("old <> class").limit(1).count():
            return labels


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common n-grams of the sets in left and right, a row for each of left.

    N-grams that many of the texts have are counted by a product of matrices, the others through lists of their texts.
    """
    out = np.zeros((len(left), len(right)), np.float32)
    codes, counts = [], []
    flat = [np.concatenate([sets[i] for i in side]) for side in (left, right)]
    owner = [np.repeat(np.arange(len(side)), [len(sets[i]) for i in side]) for side in (left, right)]
    vocab = np.intersect1d(flat[0], flat[1])
    if not len(vocab):
        return out
    for k in (0, 1):
        at = np.minimum(np.searchsorted(vocab, flat[k]), len(vocab) - 1)
        there = vocab[at] == flat[k]
        flat[k], owner[k] = at[there], owner[k][there]
        order = np.argsort(flat[k], kind="stable")
        flat[k], owner[k] = flat[k][order], owner[k][order]
        codes.append(np.searchsorted(flat[k], np.arange(len(vocab) + 1)))
        counts.append(np.diff(codes[k]))
    dense = np.flatnonzero(counts[0].astype(np.int64) * counts[1] * DENSE > len(left) * len(right)) if len(left) * len(right) > 64 else np.zeros(0, int)
    for at in range(0, len(dense), 1024):
        chosen = dense[at : at + 1024]
        column = np.full(len(vocab), -1)
        column[chosen] = np.arange(len(chosen))
        grids = []
        for k, side in enumerate((left, right)):
            grid = np.zeros((len(side), len(chosen)), np.float32)
            mine = column[flat[k]]
            grid[owner[k][mine >= 0], mine[mine >= 0]] = 1
            grids.append(grid)
        out += grids[0] @ grids[1].T
    thin = np.ones(len(vocab), bool)
    thin[dense] = False
    mine = thin[flat[0]]
    rows, grams = owner[0][mine], flat[0][mine]
    order = np.argsort(rows, kind="stable")
    rows, grams = rows[order], grams[order]
    ends = np.searchsorted(rows, np.arange(len(left) + 1))
    for i in np.unique(rows).tolist():
        own = grams[ends[i] : ends[i + 1]]
        many = counts[1][own]
        at = np.repeat(codes[1][own] - np.cumsum(many) + many, many) + np.arange(many.sum())
        out[i] += np.bincount(owner[1][at], minlength=len(right))
    return out


def _links(sets: list[np.ndarray], similarity: float, left: np.ndarray, right: np.ndarray, within: bool) -> np.ndarray:
    """Whether a row of left and one of right are linked; within: they are the same rows, and none is linked to itself."""
    size = np.array([len(s) for s in sets])
    both = _overlaps(sets, left, right)
    linked = both >= similarity * (size[left][:, None] + size[right][None, :] - both) - 1e-6
    if within:
        np.fill_diagonal(linked, False)
    return linked


def _near_first(members: DataFrame, similarity: float) -> DataFrame:
    """members (class, id, n, copies, grams) with core: whether the text of a large class is as near to its first text as
    any two such texts are similar, which the triangle inequality gives at half the distance."""
    first = members.filter((F.col("n") >= CORE) & (F.col("id") == F.col("class"))).select("class", F.col("grams").alias("first"))
    # Where the first texts are few, by bytes, they go to the members, which then don't gather by class.
    few = (first.agg(F.sum(F.size("first"))).first()[0] or 0) * 8 <= BROADCAST_BYTES
    both = F.size(F.array_intersect("grams", "first"))
    near = both >= (1 + similarity) / 2 * (F.size("grams") + F.size("first") - both) + 1e-9
    return members.join(F.broadcast(first) if few else first, "class", "left").withColumn("core", F.coalesce(near, F.lit(False))).drop("first")


def verified(texts: DataFrame, labels: DataFrame, similarity: float, n: int) -> DataFrame:
    """src, dst, links, linked_docs: for each text of a candidate class its links counted in a task; and a spanning set.

    A row with dst null carries counts for src; one with dst is a verified edge.
    """
    sized = labels.join(labels.groupBy("class").agg(F.count(F.lit(1)).alias("n")), "class")
    # Three numbers a row: where they are few they go to the texts, else the texts are dealt out by id.
    few = labels.count() * 32 <= BROADCAST_BYTES
    rows = texts.join(F.broadcast(sized) if few else sized, "id").select("class", "id", "n", "copies", "text")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [ngrams(t, n).view(np.int64) for t in part.column("text").to_pylist()]
                lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, found)], dtype=np.int32), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("class", "id", "n", "copies")], lists], names=["class", "id", "n", "copies", "grams"])
        _HASH.clear()
        release()

    members = rows.mapInArrow(grams, "class long, id long, n long, copies long, grams array<long>")
    members = stage_table(_near_first(stage_table(members, "members"), similarity), "members")
    per_class = members.groupBy("class").agg(
        F.count_if("core").alias("nc"), F.sum(F.when(F.col("core"), F.col("copies")).otherwise(0)).alias("cc"),
        F.count_if(~F.col("core")).alias("nr"), F.sum(F.when(F.col("core"), 0).otherwise(F.size("grams"))).alias("gr"),
        F.sum(F.when(F.col("core"), F.size("grams")).otherwise(0)).alias("gc"),
    )
    parts = lambda count, weight: F.ceil(F.greatest(F.col(count) / BLOCK_TEXTS, F.col(weight) / BLOCK_GRAMS)).cast("int")
    per_class = stage_table(per_class.select("class", "nc", "cc", parts("nr", "gr").alias("a"), parts("nc", "gc").alias("b")), "classes")
    per_class = F.broadcast(per_class) if per_class.count() * 64 <= BROADCAST_BYTES else per_class
    # Within the core all are linked, through the first text.
    core = members.filter("core").select("class", "id", "copies").join(per_class, "class")
    certain = core.select(F.col("id").alias("src"), F.lit(None).cast("long").alias("dst"), (F.col("nc") - 1).alias("links"), (F.col("cc") - F.col("copies")).alias("linked_docs"))
    tied = core.filter("id <> class").select(F.col("class").alias("src"), F.col("id").alias("dst"), F.lit(0).cast("long").alias("links"), F.lit(0).cast("long").alias("linked_docs"))
    # Blocks of other texts come first, then those of the core; a block of others meets itself and all after it.
    dealt = members.join(per_class, "class").filter("a > 0")
    own = F.when(F.col("core"), F.col("a") + F.pmod(F.xxhash64("id", F.lit(SEED)), F.col("b"))).otherwise(F.pmod(F.xxhash64("id", F.lit(SEED)), F.col("a"))).cast("int")
    other = F.sequence(F.lit(0), F.when(F.col("core"), F.col("a")).otherwise(F.col("a") + F.col("b")) - 1)
    dealt = dealt.withColumn("own", own).withColumn("o", F.explode(other))
    dealt = dealt.select("class", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "own", "id", "copies", "grams")
    dealt = dealt.repartition("class", "i", "j").sortWithinPartitions("class", "i", "j", "id")
    kind = "src long, dst long, links long, linked_docs long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, ["class", "i", "j"]):
            ids, own, copies = t["id"].to_numpy(), t["own"].to_numpy(), t["copies"].to_numpy()
            i, j = t["i"][0].as_py(), t["j"][0].as_py()
            left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
            if len(left) + len(right) < 2 or not len(left) or not len(right):
                continue
            column = t["grams"].combine_chunks()
            flat, ends = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
            linked = _links([flat[s:e] for s, e in zip(ends[:-1], ends[1:], strict=True)], similarity, left, right, i == j)
            counts, docs = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            counts[left], docs[left] = linked.sum(axis=1), linked @ copies[right]
            if i != j:
                counts[right], docs[right] = linked.sum(axis=0), copies[left] @ linked
            label, edges = np.arange(len(ids)), []
            for r, row in zip(left.tolist(), linked, strict=True):
                to = right[row]
                for other in np.unique(label[to]).tolist():
                    if other != label[r]:
                        edges.append((int(ids[r]), int(ids[to[label[to] == other][0]])))
                        label[label == other] = label[r]
            got = np.flatnonzero(counts)
            src = [*ids[got].tolist(), *[e[0] for e in edges]]
            dst = [*[None] * len(got), *[e[1] for e in edges]]
            rest = [0] * len(edges)
            if src:
                columns = (src, dst, [*counts[got].tolist(), *rest], [*docs[got].tolist(), *rest])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["src", "dst", "links", "linked_docs"])
        release()

    return certain.unionByName(tied).unionByName(dealt.mapInArrow(run, kind))


def _hash(text: Column) -> Column:
    """128 bits that stand for a text; a null text has one of its own."""
    return F.coalesce(F.unhex(F.md5(text)), F.lit(b""))


def _classes(docs: DataFrame, n: int, similarity: float, recall: float, id_col: str, text_col: str) -> DataFrame:
    """hash, class (a number), class_id, copies, links, linked_docs of every different text."""
    ready(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), _hash(F.col(text_col)).alias("hash"))
    texts = texts.groupBy("hash").agg(F.min("doc").alias("doc"), F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))
    texts = stage_table(texts.withColumn("id", F.monotonically_increasing_id()), "texts")
    sigs = stage_table(signatures(texts.select("id", "text"), similarity, recall, n), "signatures")
    candidates = components(candidate_edges(sigs, similarity, recall))
    checked = stage_table(verified(texts.select("id", "copies", "text"), candidates, similarity, n), "verified")
    found = components(checked.filter("dst is not null").select("src", "dst"))
    counts = checked.filter("dst is null").groupBy(F.col("src").alias("id")).agg(F.sum("links").alias("links"), F.sum("linked_docs").alias("linked_docs"))
    small = texts.select("hash", "id", "doc", "copies").join(found, "id", "left").join(counts, "id", "left")
    small = small.withColumn("class", F.coalesce("class", "id"))
    names = small.groupBy("class").agg(F.min("doc").alias("class_id"), F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "hash")).alias("first"))
    out = small.join(names, "class").select("hash", "class", "class_id", "doc", "first", "copies", "links", "linked_docs")
    return stage_table(out, "classes")


def classes(
    docs: DataFrame, *, n: int = N, similarity: float = SIMILARITY, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row: id, class_id, n_copies (rows of equal text), n_links (different texts it is similar to), n_linked_docs.

    n_linked_docs counts the other rows that a row is linked to: its copies, and the copies of the linked texts.
    """
    found = _classes(docs, n, similarity, recall, id_col, text_col)
    links, linked = F.coalesce("links", F.lit(0)), F.coalesce("linked_docs", F.lit(0)) + F.col("copies") - 1
    rows = docs.select(F.col(id_col).alias("__id"), _hash(F.col(text_col)).alias("hash"))
    return rows.join(found, "hash").select(
        F.col("__id").alias(id_col), "class_id", F.col("copies").alias("n_copies"), links.alias("n_links"), linked.alias("n_linked_docs")
    )


def one_of_each(
    docs: DataFrame, *, n: int = N, similarity: float = SIMILARITY, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """docs with one row of each class: the one with the smallest id, nulls last. Of rows alike in id and text one stays.

    What leaves is written as pairs of id and text hash and measured: few pairs go to the rows, which then are not
    shuffled; many are dealt out, as are the rows.
    """
    found = _classes(docs, n, similarity, recall, id_col, text_col)
    pair = docs.select(F.col(id_col).alias("doc_"), _hash(F.col(text_col)).alias("hash")).groupBy("doc_", "hash").agg(F.count(F.lit(1)).alias("m"))
    pair = pair.join(found.select("hash", "first"), "hash")
    first = F.col("doc_").eqNullSafe(F.col("first.doc")) & (F.col("hash") == F.col("first.hash"))
    pair = stage_table(pair.select(F.col("doc_").alias("__doc"), F.col("hash").alias("__hash"), first.alias("__first"), "m"), "pairs")
    gone, again = pair.filter("not __first or m > 1"), pair.filter("__first and m > 1")
    own = free_name("__text", docs.columns)
    keyed = docs.withColumn(own, _hash(F.col(text_col)))
    on = lambda other: [keyed[id_col].eqNullSafe(other["__doc"]), keyed[own] == other["__hash"]]
    few = gone.count() * 64 <= BROADCAST_BYTES
    kept = keyed.join(F.broadcast(gone) if few else gone, on(gone), "left_anti").select(*[f"`{c}`" for c in docs.columns])
    if not again.limit(1).count():
        return kept
    once = keyed.join(again, on(again), "left_semi").groupBy(id_col, own).agg(F.first(F.struct(*[f"`{c}`" for c in docs.columns])).alias("__r"))
    return kept.unionByName(once.select("__r.*"))


def brute_force(rows: list[tuple[int | None, str | None]], n: int = N, similarity: float = SIMILARITY) -> list[tuple]:
    """(id, class id, links to different texts) of every row, by comparing all pairs, for tests."""
    texts: dict[str | None, list[int | None]] = {}
    for i, t in rows:
        texts.setdefault(t, []).append(i)
    keys = list(texts)
    sets = [set(ngrams(t, n).tolist()) for t in keys]
    label, links = list(range(len(keys))), [0] * len(keys)

    def root(x: int) -> int:
        while label[x] != x:
            x = label[x]
        return x

    for a, x in enumerate(sets):
        for b in range(a):
            if x and sets[b] and len(x & sets[b]) >= similarity * len(x | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                label[max(root(a), root(b))] = min(root(a), root(b))
    ids: dict[int, list[int]] = {}
    for k, t in enumerate(keys):
        ids.setdefault(root(k), []).extend(i for i in texts[t] if i is not None)
    place = {t: k for k, t in enumerate(keys)}
    return [(i, min(ids[root(place[t])], default=None), links[place[t]]) for i, t in rows]
