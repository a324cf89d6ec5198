"""Quality by votes of the nearest labelled neighbours among latent-semantic vectors.

A text's terms are its words and their forms (upper, lower, digit and mark runs, each shortened to one sign), with two
forms that count words repeated at once and words seen before. Words weigh by the logarithm of their count, forms by the
root of their share; each of the two parts has a length of its own. Terms are hashed to a fixed number of places.

The latent space is spanned by the first singular vectors of the labelled rows' terms, found by subspace iteration: every
task multiplies its own rows, and the partial sums, whose size is fixed, are added up block by block. The labelled rows'
vectors, at most 2 * SAMPLE_ROWS of DIMS numbers, go to all tasks. Every text of the table is then compared with all of
them by blocked products of unit vectors, exactly; its NEIGHBOURS nearest vote with their label, each weighted by a power
of its cosine and by the labels of its class that it stands for.

Defined cases: a null text is scored like an empty one, by the share of label 1. So is every text if no row, or no text,
is labelled; with labels of one class only the score is that class. Texts are read whole, however long. Rows that repeat
get equal scores, and rows with a null id are scored like others. A label that is null, or whose row has no text, teaches
nothing; of several labels of an id the largest counts, of several texts the smallest. Ties in similarity go to any of the
tied. Other columns are ignored. Empty tables give empty results.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import ready, release, stage_table

#: The bounded sample of labelled rows that the space and the votes are made of: so many of each class.
SAMPLE_ROWS = 3000
WORDS, FORMS = 1 << 13, 1 << 11  # places that terms are hashed to
WORD_PART = 0.5  # length of the words' part beside the forms', which is 1
DIMS, SPARE = 32, 8  # of the space, and more that the iteration carries along
STEPS = 3
NEIGHBOURS = 8
POWER = 16  # of the cosine
PRIOR = 0.01  # votes of the share of label 1, for texts that are like none
BLOCK = 256  # texts of one product
PARTS = 16  # tasks of the fit
MEMO = 100_000  # words that a worker remembers, of up to WORD_CHARS characters
WORD_CHARS = 64
SEED = 5

TERMS = WORDS + FORMS + 2
_AT_ONCE, _BEFORE = WORDS + FORMS, WORDS + FORMS + 1
_SIGN = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id's decimal text, mod folds."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds))


def places(word: str) -> tuple[int, int]:
    """Where a word and its form are counted."""
    form = _RUN.sub(rb"\1", word.encode("utf-8", "surrogatepass").translate(_SIGN))
    return zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % WORDS, WORDS + zlib.crc32(form) % FORMS


class Terms:
    """The weighted terms of texts; words seen before are remembered."""

    def __init__(self) -> None:
        self.memo: dict[str, tuple[int, int]] = {}

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(places, weights) of a text's terms; none for a text without words."""
        every = (text or "").split()
        if not every:
            return np.zeros(0, np.int32), np.zeros(0, np.float32)
        words: dict[int, int] = {}
        forms: dict[int, int] = {}
        counts, memo = Counter(every), self.memo
        for w, k in counts.items():
            at = memo.get(w)
            if at is None:
                at = places(w)
                if len(w) <= WORD_CHARS:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[w] = at
            words[at[0]] = words.get(at[0], 0) + k
            forms[at[1]] = forms.get(at[1], 0) + k
        forms[_AT_ONCE] = sum(map(str.__eq__, every, every[1:]))
        forms[_BEFORE] = len(every) - len(counts)
        a = 1 + np.log(np.fromiter(words.values(), np.float32, len(words)))
        b = np.sqrt(np.fromiter(forms.values(), np.float32, len(forms)) / len(every))
        weights = np.concatenate([WORD_PART * a / np.linalg.norm(a), b / np.linalg.norm(b)])
        return np.fromiter([*words, *forms], np.int32, len(weights)), weights.astype(np.float32)


@dataclass
class Model:
    """The space's axes (TERMS x DIMS), the labelled rows' unit vectors, labels and weights, and the share of label 1."""

    share: float
    axes: np.ndarray = field(default_factory=lambda: np.zeros((TERMS, 0), np.float32))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    stands: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.terms = model, Terms()

    def scores(self, texts: list[str | None]) -> np.ndarray:
        m = self.model
        out = np.full(len(texts), m.share)
        if not len(m.labels):
            return out
        k = min(NEIGHBOURS, len(m.labels))
        for start in range(0, len(texts), BLOCK):
            found = [self.terms.of(t) for t in texts[start : start + BLOCK]]
            some = [i for i, (at, _) in enumerate(found) if len(at)]
            if not some:
                continue
            near = _unit(np.stack([found[i][1] @ m.axes[found[i][0]] for i in some])) @ m.vectors.T
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            votes = np.clip(np.take_along_axis(near, best, 1), 0, 1).astype(np.float64) ** POWER * m.stands[best]
            out[[start + i for i in some]] = ((votes * m.labels[best]).sum(1) + PRIOR * m.share) / (votes.sum(1) + PRIOR)
        return out


def sample(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 5, held_fold: int = 0,
) -> tuple[DataFrame, float]:
    """(y, stands, places, weights of at most SAMPLE_ROWS labelled rows of each class outside the held-out fold, chosen by
    a seeded hash of the id; the share of label 1). Terms are made where the texts are read; no text leaves its task."""
    ready(docs.sparkSession)
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(F.col(id_col), folds) != held_fold))
    known = known.groupBy(id_col).agg(F.max((F.col(label_col) > 0).cast("int")).alias("__y"))
    n = {r[0]: r[1] for r in known.groupBy("__y").count().collect()}
    share = n.get(1, 0) / sum(n.values()) if n else 0.0
    order = F.xxhash64(F.col(id_col).cast("string"), F.lit(SEED))
    parts = [known.filter(F.col("__y") == y).orderBy(order, id_col).limit(SAMPLE_ROWS) for y in (0, 1)]
    # A bounded table: SAMPLE_ROWS ids of each class.
    picked = F.broadcast(parts[0].unionByName(parts[1]).select(F.col(id_col).alias("__id"), "__y"))
    texts = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
    rows = texts.join(picked, "__id").groupBy("__id").agg(F.min("__t").alias("__t"), F.first("__y").alias("__y"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            made = [terms.of(t.as_py()) for t in batch.column("__t")]
            columns = [pa.array([p.tolist() for p, _ in made], pa.list_(pa.int32())), pa.array([w.tolist() for _, w in made], pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("__y"), *columns], names=["id", "y", "places", "weights"])
        release()

    made = rows.select("__id", "__y", "__t").mapInArrow(run, f"id {kind}, y int, places array<int>, weights array<float>")
    stands = F.when(F.col("y") == 1, max(1.0, n.get(1, 0) / SAMPLE_ROWS)).otherwise(max(1.0, n.get(0, 0) / SAMPLE_ROWS))
    dealt = made.filter(F.size("places") > 0).withColumn("stands", stands).repartition(PARTS, "id").sortWithinPartitions("id")
    return stage_table(dealt, "labelled"), share


def _sparse(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    at, weight = batch.column("places"), batch.column("weights")
    return [(at[i].values.to_numpy(), weight[i].values.to_numpy()) for i in range(batch.num_rows)]


def _times(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """(rows' transpose * rows) * basis. Each task adds up its own rows; the sums of a block of terms meet in one task."""
    width = 1024

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(basis.shape)
        for batch in batches:
            for at, weight in _sparse(batch):
                total[at] += np.outer(weight, weight @ basis[at])
        blocks = [total[i : i + width].tobytes() for i in range(0, len(total), width)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array(blocks, pa.binary())], names=["block", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s, np.float64) for s in sorted(table["sums"].to_pylist()))
        return pa.table({"block": table["block"][:1], "sums": pa.array([total.tobytes()], pa.binary())})

    sums = rows.select("places", "weights").mapInArrow(partial, "block int, sums binary").groupBy("block").applyInArrow(add, "block int, sums binary")
    # TERMS x (DIMS + SPARE) numbers, however many rows there are.
    return np.concatenate([np.frombuffer(r.sums, np.float64) for r in sorted(sums.collect())]).reshape(basis.shape)


def _onto(rows: DataFrame, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows * basis, y, stands) of the labelled rows, in the order of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [(weight @ basis[at]).astype(np.float64).tobytes() for at, weight in _sparse(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), batch.column("stands"), pa.array(vectors, pa.binary())], names=["id", "y", "stands", "v"])

    kind = rows.schema["id"].dataType.simpleString()
    # At most 2 * SAMPLE_ROWS rows of DIMS + SPARE numbers.
    got = sorted(rows.mapInArrow(run, f"id {kind}, y int, stands double, v binary").collect(), key=lambda r: r.id)
    vectors = np.array([np.frombuffer(r.v, np.float64) for r in got]).reshape(len(got), basis.shape[1])
    return vectors, np.array([r.y for r in got], np.float32), np.array([r.stands for r in got], np.float32)


def fit(labelled: DataFrame, share: float) -> Model:
    """The latent space of sample()'s rows and their vectors in it."""
    basis = np.random.default_rng(SEED).standard_normal((TERMS, DIMS + SPARE))
    for _ in range(STEPS):
        basis = np.linalg.qr(_times(labelled, basis))[0]
    vectors, y, stands = _onto(labelled, basis)
    if not len(y):
        return Model(share)
    turn = np.linalg.svd(vectors, full_matrices=False)[2][:DIMS].T
    return Model(share, (basis @ turn).astype(np.float32), _unit(vectors @ turn).astype(np.float32), y, stands)


def score_texts(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """id, score, predicted of every row; nothing is shuffled."""
    ready(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            scores = scorer.scores(batch.column(1).to_pylist())
            columns = [batch.column(0), pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "score", "predicted"])
        release()

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double, predicted int")
