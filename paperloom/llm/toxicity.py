"""Toxicity by compression distance with zstandard dictionaries.

One dictionary is made of ordinary text, one of toxic text. A toxic text is ordinary text with something in it, so a
dictionary of whole toxic rows would mostly be one of ordinary text again. So both are made by contrast: stretches of
a few characters that stand much more often in toxic rows than in ordinary ones are marked; the toxic dictionary is
made of the passages and words of toxic rows that hold them, and the ordinary one is trained on ordinary rows without
such words. The toxic dictionary is then put before the ordinary one's content: both compress an ordinary window
alike, and the difference of a window's compressed lengths is what the toxic part saves. A window is a run of words.

The thresholds on the differences, and the logistic curve over a text's counts of windows beyond each threshold, are
calibrated on labelled rows that the dictionaries were not made of.

Defined cases: a null text is scored like an empty one, by the curve at no windows. Every window of a text is
compared, however long it is; letters are lower-cased first. Rows that repeat get equal scores, and rows with a null
id are scored like others. A label that is null, or whose row has no text, teaches nothing; of several labels of an id
the largest counts, of several texts the smallest. With no toxic or no ordinary label the score is the toxic share of
the labels (0 without labels). Other columns are ignored by score_texts and kept by without_toxic. Empty tables give
empty results.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import ready, release

#: The bounded sample of labelled rows that the model is fitted on: whole rows of each class.
SAMPLE_ROWS = 3000
WINDOW = 16  # words; chosen on labelled rows outside the held-out fold, as are the next five
GRAM = 5  # characters of a stretch
ODDS = 4.0  # how many times as often a marked stretch stands in toxic rows
SURE = 8.0  # standard deviations by which it has to be more often
ROWS = 0.02  # share of the toxic rows, and three at least, that hold it
RIDGE = 1.0  # of the curve's weights
THRESHOLDS = (1, 2, 3, 4, 6)  # bytes saved; the curve weighs them
PER_ROW = 3  # of a stretch, counted in one row
DICT_BYTES = 48 << 10  # of the ordinary dictionary
TOXIC_BYTES = 16 << 10  # of what the toxic one adds
LEAD = 48  # bytes before each window
SEED = 11


def fold(doc_id: Column, folds: int = 3) -> Column:
    """crc32 of the id's decimal text, mod folds."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds))


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    ws = text.lower().split()
    return [" ".join(["", *ws[i : i + size], ""]).encode("utf-8", "surrogatepass") for i in range(0, len(ws), size)]


@dataclass
class Model:
    """Dictionaries' contents, the curve's weights and the share of toxic labels."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    share: float


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        if model.weights:
            # Matches from four bytes on, searched with care: windows are short and lengths are compared to the byte.
            how = zstandard.ZstdCompressionParameters(
                window_log=17, hash_log=15, chain_log=16, search_log=5, min_match=4, target_length=64,
                strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False,
            )

            def make(content: bytes):
                known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                known.precompute_compress(compression_params=how)
                return zstandard.ZstdCompressor(dict_data=known, compression_params=how).compress

            # The toxic part stands first: what both hold is equally far away in both, so ordinary windows tie.
            self.by_ordinary, self.by_toxic = make(model.ordinary), make(model.toxic + model.ordinary)
            # Both dictionaries' last stretch goes before a window, so that neither falls back to storing it.
            self.lead = model.ordinary[-LEAD:]

    def differences(self, text: str | None) -> list[int]:
        """Bytes that the toxic dictionary saves over the ordinary one, window by window."""
        a, b, lead = self.by_ordinary, self.by_toxic, self.lead
        return [len(a(lead + w)) - len(b(lead + w)) for w in windows(text or "")]

    def features(self, text: str | None) -> np.ndarray:
        d = np.array(self.differences(text), float)
        n, saved = len(d), np.maximum(d, 0)
        reach = [int((d >= t).sum()) for t in THRESHOLDS]
        shares = [k / max(1, n) for k in (reach[0], reach[1], reach[3])]
        most, mean = min(float(d.max(initial=0)), 12.0) / 8, float(saved.sum()) / max(1, n)
        return np.array([1.0, *map(math.log1p, reach), *shares, most, mean, math.log1p(saved.sum()), math.log(max(n, 4)) / 4])

    def score(self, text: str | None) -> float:
        if not self.model.weights:
            return self.model.share
        z = float(self.features(text) @ np.array(self.model.weights))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _spaced(text: str) -> str:
    return " " + " ".join(text.lower().split()) + " "


def _stretches(t: str) -> Iterator[str]:
    return (t[i : i + GRAM] for i in range(len(t) - GRAM + 1))


def marked_stretches(rows: list[tuple[str, int]]) -> set[str]:
    """The stretches that stand ODDS times as often in toxic rows as in ordinary ones, and surely so."""
    count, holders, total, toxic = [Counter(), Counter()], Counter(), [0, 0], 0
    for text, y in rows:
        found = Counter(_stretches(_spaced(text)))
        for g, n in found.items():
            count[y][g] += min(n, PER_ROW)
        total[y] += sum(min(n, PER_ROW) for n in found.values())
        if y:
            toxic += 1
            holders.update(found.keys())
    out = set()
    for g, n in count[1].items():
        expected = (count[0][g] + 0.5) * total[1] / max(1, total[0])
        if holders[g] >= max(3, ROWS * toxic) and n > ODDS * expected and n - expected > SURE * math.sqrt(expected + 0.5):
            out.add(g)
    return out


def _passages(text: str, marked: set[str]) -> list[str]:
    """The stretches of a toxic text that marked ones cover, and the words that hold one."""
    t = _spaced(text)
    out, start, end = [], 0, 0
    for i, g in enumerate(_stretches(t)):
        if g in marked:
            if i > end:
                out.append(t[start:end])
                start = i
            end = i + GRAM
    out.append(t[start:end])
    return [*[x for x in out if x], *[f" {w} " for w in t.split() if _holds(w, marked)]]


def _holds(word: str, marked: set[str]) -> bool:
    return any(g in marked for g in _stretches(f" {word} "))


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """What zstandard's training keeps of the samples; their own end where they are too few to train on."""
    total = sum(map(len, samples))
    try:
        if total < 8 * size:
            raise zstandard.ZstdError("too little to train on")
        return zstandard.train_dictionary(size, samples, k=64, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def fit(rows: list[tuple]) -> Model:
    """rows: (text, label 0 or 1), a bounded sample; a third value says how many labels of its class a row stands for."""
    stands = [[1.0], [1.0]]
    for _, y, *n in rows:
        stands[y].extend(n)
    per_row = [max(n) for n in stands]
    all_of = [per_row[k] * sum(r[1] == k for r in rows) for k in (0, 1)]
    share = all_of[1] / sum(all_of) if rows else 0.0
    rows = _different([r[:2] for r in rows])
    train = [(t, y) for k, (t, y) in enumerate(rows) if k % 3]
    held = [r for k, r in enumerate(rows) if k % 3 == 0]
    if min(sum(r[1] == y for r in part) for part in (train, held) for y in (0, 1)) < 3:
        return Model(b"", b"", (), share)
    marked = marked_stretches(train)
    # What stands twice or more; the commonest last, nearest to the window.
    found = Counter(w for t, y in train if y for w in _passages(t, marked))
    toxic = b"".join(w.encode("utf-8", "surrogatepass") for w, n in reversed(found.most_common()) if n > 1)[-TOXIC_BYTES:]
    plain = (" ".join(w for w in t.lower().split() if not _holds(w, marked)) for t, y in train if not y)
    model = Model(_dictionary([w for t in plain for w in windows(t)], DICT_BYTES), toxic, (0.0,), share)
    scorer = Scorer(model)
    # The sample's odds are not the labels' once a class is cut: its intercept is put right by the sampling rates.
    intercept, *slopes = _logistic(np.array([scorer.features(t) for t, _ in held]), np.array([y for _, y in held], float))
    model.weights = (float(intercept) + math.log(per_row[1] / per_row[0]), *map(float, slopes))
    return model


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _different(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Rows without near copies of earlier ones, whose chance words would look like a class's own."""
    seen: set[tuple[int, int]] = set()
    out = []
    for t, y in rows:
        ws = t.lower().split()
        grams = {" ".join(ws[i : i + 5]).encode("utf-8", "surrogatepass") for i in range(max(1, len(ws) - 4))}
        least = [min(zlib.crc32(g, k) for g in grams) for k in range(4)]
        keys = {(i, j, least[i], least[j]) for i in range(4) for j in range(i)}
        if seen.isdisjoint(keys):
            out.append((t, y))
        seen |= keys
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    w = np.zeros(x.shape[1])
    keep = ridge * np.eye(x.shape[1])
    keep[0, 0] = 1e-6
    for _ in range(50):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sample(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_fold: int = 1) -> list[tuple[str, int, float]]:
    """At most SAMPLE_ROWS labelled rows of each class outside the held-out fold, by a seeded hash of the id; and the
    labels of its class that each stands for."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(F.col(id_col)) != held_fold))
    known = known.groupBy(id_col).agg(F.max(label_col).alias("__y"))
    order = F.xxhash64(F.col(id_col).cast("string"), F.lit(SEED))
    n = {bool(r[0]): r[1] for r in known.groupBy(F.col("__y") > 0).count().collect()}
    stands = [max(1.0, n.get(bool(y), 0) / SAMPLE_ROWS) for y in (0, 1)]
    picked = None
    for y in (0, 1):
        part = known.filter((F.col("__y") > 0) == bool(y)).orderBy(order, id_col).limit(SAMPLE_ROWS)
        picked = part if picked is None else picked.unionByName(part)
    rows = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col), F.col(text_col).alias("__t")).join(F.broadcast(picked), id_col)
    rows = rows.groupBy(id_col).agg(F.min("__t").alias("__t"), F.first("__y").alias("__y"))
    got = [(r[1], int(r[2] > 0), zlib.crc32(str(r[0]).encode())) for r in rows.collect()]
    return [(t, y, stands[y]) for t, y, _ in sorted(got, key=lambda r: (r[2], r[0]))]


def score_texts(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """id, score, predicted of every row; nothing is shuffled."""
    ready(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            scores = [scorer.score(t.as_py()) for t in batch.column(1)]
            columns = [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "score", "predicted"])
        release()

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """docs without the rows whose text scores the threshold or more. Rows are judged one by one, and not shuffled."""
    ready(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t.as_py()) < threshold for t in batch.column(at)], pa.bool_()))
        release()

    return docs.mapInArrow(run, docs.schema)
