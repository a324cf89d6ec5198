"""Benchmark decontamination with suffix arrays over shards of the training text.

Every Arrow batch of documents is cut into shards of bounded size. A shard's words become one array of
numbers, its suffixes are sorted by prefix doubling (to the length of the longest test item, which no match can
exceed), and every test suffix is binary-searched in it by its window: the run of suffixes that share the window
gives all its places. Runs of different windows of one length don't overlap, so places are at most as many as
words, however often a text repeats itself. From the places come the words hit, the items, and for each item the
longest verbatim match and where it stands.

Defined cases: a null or empty text has no words and no matches. A test row whose id or text is null, or
that has no words, takes no part. Repeated document rows, and rows whose id is null, are judged row by row in
any number of blocks; test rows that repeat an id are one item. Texts of any length are read whole: one that is
longer than a shard is a shard of its own. Columns of other names are ignored by find_matches, whose own columns
stand for the result, and kept by decontaminate. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import ready, release, stage_table, without_ids, words

MATCHES = (
    "{id} {kind}, n_words long, n_hit long, hits array<struct<start:int,end:int>>, item_ids array<string>, "
    "matches array<struct<item_id:string,doc_pos:int,item_pos:int,length:int>>"
)
#: Words of a shard, hence memory of a task: by estimate 100 bytes each, the words included.
SHARD_WORDS = 200_000
#: Words of test items that one pass holds on each executor. Larger test sets go in several passes.
BLOCK_WORDS = 500_000


class TestIndex:
    """The windows of a block of test items: each different one once, by length, and the items that it stands in."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.vocab: dict[bytes, int] = {}
        self.ids = [item for item, _ in items]
        arrays = [np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in ws], np.int32) for _, ws in items]
        self.longest = max(map(len, arrays), default=1)
        #: Of each item the numbers of its windows in order, and their length.
        self.windows: list[np.ndarray] = [np.zeros(0, np.int32)] * len(items)
        self.need = [min(len(a), window) for a in arrays]
        #: By length: the first window's number, and the different windows as rows.
        self.grids: list[tuple[int, np.ndarray]] = []
        total = 0
        for need in sorted(set(self.need)):
            rows = [i for i, n in enumerate(self.need) if n == need]
            grid = np.concatenate([np.lib.stride_tricks.sliding_window_view(arrays[i], need) for i in rows])
            grid, number = np.unique(grid, axis=0, return_inverse=True)
            number = number.reshape(-1).astype(np.int32) + total
            ends = np.cumsum([len(arrays[i]) - need + 1 for i in rows])
            for i, part in zip(rows, np.split(number, ends[:-1]), strict=True):
                self.windows[i] = part
            self.grids.append((total, grid))
            total += len(grid)
        self.shortest = min(self.need, default=1)
        pairs = [np.unique(w) for w in self.windows]
        number = np.concatenate(pairs) if pairs else np.zeros(0, np.int32)
        item = np.repeat(np.arange(len(items), dtype=np.int32), [len(p) for p in pairs])
        #: The items of window w: holders[first[w] : first[w + 1]].
        self.holders = item[np.argsort(number, kind="stable")]
        self.first = np.searchsorted(np.sort(number), np.arange(total + 1))


def suffix_array(a: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """starts, sorted by the words that follow in a, to the given depth at least."""
    # Ranks have to be below the array's length for a pair of them to be one number of its own.
    rank, h, n = np.unique(a, return_inverse=True)[1].reshape(-1).astype(np.int64), 1, len(a)
    while h < depth:
        key = rank * (n + 1)
        key[:-h] += rank[h:] + 1
        order = np.argsort(key, kind="stable")
        step = np.zeros(n, np.int64)
        np.cumsum(key[order][1:] != key[order][:-1], out=step[1:])
        rank = np.empty(n, np.int64)
        rank[order] = step
        h *= 2
        if step[-1] == n - 1:
            break
    return starts[np.argsort(rank[starts], kind="stable")]


def _bound(a: np.ndarray, sa: np.ndarray, grid: np.ndarray, upper: bool) -> np.ndarray:
    """For each window, the first suffix in sa that is not below it (upper: that is above all that start with it)."""
    lo, hi = np.zeros(len(grid), np.int64), np.full(len(grid), len(sa), np.int64)
    while len(open_ := np.flatnonzero(lo < hi)):
        mid = (lo[open_] + hi[open_]) // 2
        at, order, live = sa[mid], np.zeros(len(open_), np.int8), np.arange(len(open_))
        for h in range(grid.shape[1]):
            sign = np.sign(a[np.minimum(at[live] + h, len(a) - 1)] - grid[open_[live], h])
            order[live] = sign
            live = live[sign == 0]
            if not len(live):
                break
        right = order <= 0 if upper else order < 0
        lo[open_[right]] = mid[right] + 1
        hi[open_[~right]] = mid[~right]
    return lo


def search(docs: list[list[bytes]], index: TestIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, place, window) of every occurrence of every window, by document and place."""
    none = np.zeros(0, np.int64)
    get, lengths = index.vocab.get, np.array([len(ws) + 1 for ws in docs], np.int64)
    base = np.cumsum(lengths) - lengths
    a = np.zeros(int(lengths.sum()), np.int32)  # 0: a word of no item, or the end of a document, which no match runs over
    for at, ws in zip(base.tolist(), docs, strict=True):
        a[at : at + len(ws)] = [get(w, 0) for w in ws]
    # A match of the shortest window needs so many known words in a row; other suffixes can't hold one.
    gaps = np.flatnonzero(a == 0)
    run = gaps[np.searchsorted(gaps, np.arange(len(a)))] - np.arange(len(a)) if len(a) else none
    starts = np.flatnonzero(run >= index.shortest)
    if not len(starts) or not index.grids:
        return none, none, none
    # Runs too short for any window fall away; each kept run keeps the gap that ends it.
    near = np.zeros(len(a) + 1, np.int64)
    np.add.at(near, starts, 1)
    np.add.at(near, starts + run[starts] + 1, -1)
    place = np.flatnonzero(np.cumsum(near)[:-1] > 0)
    small = a[place]
    sa = suffix_array(small, np.flatnonzero(run[place] >= index.shortest), index.longest)
    known = np.zeros(len(index.vocab) + 1, bool)
    known[small] = True
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for number, grid in index.grids:
        there = np.flatnonzero(known[grid].all(axis=1))  # a window with a word that the shard lacks isn't in it
        grid = grid[there]
        lo, hi = _bound(small, sa, grid, False), _bound(small, sa, grid, True)
        many = hi - lo
        at = np.repeat(lo - np.cumsum(many) + many, many) + np.arange(many.sum())
        found.append((place[sa[at]], np.repeat(there + number, many)))
    where, window = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((window, where))
    where, window = where[order], window[order]
    doc = np.searchsorted(base, where, side="right") - 1
    return doc, where - base[doc], window


class Found:
    """The windows that stand in one text, in order, as a suffix array of their own: how long an item's windows go on in
    the text is found by binary search, whatever the number of places."""

    def __init__(self, places: np.ndarray, found: np.ndarray, depth: int):
        # Windows that don't follow each other place by place have a gap between them, which no item has.
        new = np.flatnonzero(np.diff(places) != 1) + 1
        order = np.insert(found.astype(np.int64) + 1, new, 0)
        self.place = np.insert(places, new, -1)
        self.row = order.astype(">u4").tobytes()
        self.sa = suffix_array(order, np.arange(len(order)), depth).tolist()
        self.here = np.unique(found)

    def _run(self, pattern: bytes) -> tuple[int, int]:
        """Suffixes that start with a pattern."""
        key = lambda i: self.row[4 * self.sa[i] : 4 * self.sa[i] + len(pattern)]
        lo = bisect_left(range(len(self.sa)), pattern, key=key)
        if lo == len(self.sa) or key(lo) != pattern:
            return lo, lo
        return lo, bisect_right(range(len(self.sa)), pattern, lo=lo, key=key)

    def longest(self, windows: np.ndarray) -> tuple[int, int, int]:
        """(windows in a row, place in the text, place in the item) of the first longest match of an item's windows."""
        row = (windows.astype(np.int64) + 1).astype(">u4").tobytes()
        starts = np.flatnonzero(np.isin(windows, self.here)).tolist()
        best = 0
        there = lambda j, n: j + n <= len(windows) and self._has(row[4 * j : 4 * (j + n)])
        for j in starts:
            while there(j, best + 1):
                best += 1
        first = (1 << 62, 0)  # beyond any text
        for j in starts:
            if j + best <= len(windows):
                lo, hi = self._run(row[4 * j : 4 * (j + best)])
                if lo < hi:
                    first = min(first, (int(self.place[self.sa[lo:hi]].min()), j))
        return best, *first

    def _has(self, pattern: bytes) -> bool:
        key = lambda i: self.row[4 * self.sa[i] : 4 * self.sa[i] + len(pattern)]
        lo = bisect_left(range(len(self.sa)), pattern, key=key)
        return lo < len(self.sa) and key(lo) == pattern


def _of_document(index: TestIndex, need: np.ndarray, n: int, places: np.ndarray, found: np.ndarray, matches: bool) -> tuple[int, list, list, list]:
    """Words hit, spans, items and, if they are asked for, longest matches of one document of n words."""
    hit = np.zeros(n + 1, np.int64)
    np.add.at(hit, places, 1)
    np.add.at(hit, places + need[found], -1)
    covered = np.cumsum(hit)[:-1] > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    spans = [{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2], strict=True)]
    held = [index.holders[index.first[w] : index.first[w + 1]] for w in np.unique(found).tolist()]
    items = np.unique(np.concatenate(held)).tolist() if held else []
    out = []
    if matches and items:
        # Places where windows of several lengths start are told apart by their lengths, of which an item has one.
        texts = {k: Found(places[need[found] == k], found[need[found] == k], index.longest) for k in {index.need[i] for i in items}}
        for i in items:
            many, at, pos = texts[index.need[i]].longest(index.windows[i])
            out.append({"item_id": index.ids[i], "doc_pos": at, "item_pos": pos, "length": many - 1 + index.need[i]})
    return int(covered.sum()), spans, sorted({index.ids[i] for i in items}), out


def _judge(pdf: pd.DataFrame, id_col: str, text_col: str, index: TestIndex, matches: bool = True) -> Iterator[pd.DataFrame]:
    need = np.concatenate([np.full(len(g), g.shape[1]) for _, g in index.grids]) if index.grids else np.zeros(0, np.int64)
    shard: list[list[bytes]] = []
    ids: list = []

    def flush() -> pd.DataFrame:
        doc, place, window = search(shard, index)
        ends = np.searchsorted(doc, np.arange(len(shard) + 1))
        out = []
        for d, (doc_id, ws) in enumerate(zip(ids, shard, strict=True)):
            s, e = int(ends[d]), int(ends[d + 1])
            got = _of_document(index, need, len(ws), place[s:e], window[s:e], matches) if s < e else (0, [], [], [])
            out.append((doc_id, len(ws), *got))
        shard.clear()
        ids.clear()
        return pd.DataFrame(out, columns=[id_col, "n_words", "n_hit", "hits", "item_ids", "matches"])

    total = 0
    for doc_id, text in zip(pdf[id_col], pdf[text_col], strict=True):
        ws = words(text if isinstance(text, str) else None)
        ids.append(doc_id)
        shard.append(ws)
        if (total := total + len(ws)) >= SHARD_WORDS:
            yield flush()
            total = 0
    if ids:
        yield flush()


def _blocks(items: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Test items in blocks of bounded size; the driver holds one block at a time."""
    block: list[tuple[str, list[bytes]]] = []
    n = 0
    for r in items.select(F.col(item_id).cast("string"), text).dropna().toLocalIterator():
        if ws := words(r[1]):
            block.append((r[0], ws))
            if (n := n + len(ws)) >= block_words:
                yield block
                block, n = [], 0
    if block:
        yield block


def find_matches(
    docs: DataFrame, items: DataFrame, *, window: int = 13, doc_id: str = "doc_id", doc_text: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS, matches: bool = True,
) -> DataFrame:
    """One row for each document row: its words, those inside a window's occurrence, spans, items, longest matches (which
    are left empty if nobody reads them).

    The documents are read once for each block of test items and never shuffled while one block holds the
    test set; with more blocks each row is first written to the shared folder with a key of its own, and what
    the blocks found for a row is merged by that key, never by id. A block's index is made once, on the driver, and
    broadcast: its size follows block_words, not the data.
    """
    ready(docs.sparkSession)
    docs = docs.select(doc_id, doc_text)
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = MATCHES.format(id=f"`{doc_id}`", kind=kind)

    def judged(docs: DataFrame, schema: str, doc_id: str, block: list) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(TestIndex(block, window))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield from _judge(pdf, doc_id, doc_text, shared.value, matches)
            release()

        return docs.mapInPandas(run, schema)

    blocks = _blocks(items, item_id, item_text, block_words)
    first = next(blocks, [])
    second = next(blocks, None)
    if second is None:
        return judged(docs, schema, doc_id, first)
    rows = stage_table(docs.withColumn("__key", F.monotonically_increasing_id()), "rows")
    keyed = MATCHES.format(id="`__key`", kind="long")
    parts = [judged(rows, keyed, "__key", b) for b in chain([first, second], blocks)]
    both = reduce(DataFrame.unionByName, parts).groupBy("__key").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
        F.flatten(F.collect_list("matches")).alias("matches"),
    )
    merged = F.aggregate(
        F.array_sort("hits"),
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    both = both.withColumn("hits", merged)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    both = both.join(rows.select("__key", doc_id), "__key")
    return both.select(doc_id, "n_words", n_hit.alias("n_hit"), "hits", "item_ids", "matches")


def verdicts(matches: DataFrame, doc_id: str = "doc_id", share: int = 20) -> DataFrame:
    """The digest of find_matches: contaminated where a hit word is at least one in `share`."""
    return matches.select(
        doc_id, "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, *, window: int = 13, doc_text: str = "text", item_id: str = "item_id", item_text: str = "text",
    share: int = 20, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """docs without the contaminated rows; each is judged by its own text, whatever its id.

    While one block holds the test set, rows are dropped as they are read. With more blocks they are first written to
    the shared folder with a key of their own, and leave by that key.
    """
    ready(docs.sparkSession)
    blocks = _blocks(items, item_id, item_text, block_words)
    first, second = next(blocks, []), next(blocks, None)
    if second is not None:
        rows = stage_table(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
        found = find_matches(rows, items, window=window, doc_id="__row", doc_text=doc_text, item_id=item_id, item_text=item_text, block_words=block_words, matches=False)
        return without_ids(rows, verdicts(found, "__row", share).filter("contaminated").select("__row"), "__row").drop("__row")
    shared, at = docs.sparkSession.sparkContext.broadcast(TestIndex(first, window)), docs.columns.index(doc_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pdf = pd.DataFrame({"row": np.arange(batch.num_rows), "text": pd.Series(batch.column(at).to_pylist(), dtype=object)})
            clean = [(part["n_hit"] == 0) | (share * part["n_hit"] < part["n_words"]) for part in _judge(pdf, "row", "text", shared.value, False)]
            yield batch.filter(pa.array(np.concatenate(clean) if clean else [], pa.bool_()))
        release()

    return docs.mapInArrow(run, docs.schema)
