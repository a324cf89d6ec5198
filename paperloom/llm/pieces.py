"""SentencePiece encoding and decoding by a streaming Viterbi search.

For a BPE vocabulary with merges by score, a sequence of pieces is the encoding of its text exactly if every
two neighbours are the encoding of theirs, and the encoding of a prefix is a prefix of pieces whose last piece
is unique. So the search keeps for each position the back-pointer of the one last piece that fits the best path
to where it starts. Only as many positions as the longest piece has characters can still be extended; once all
their back-pointer paths run through one boundary, the ids before it are committed and forgotten. Characters
outside the vocabulary become byte pieces and are boundaries themselves. A unigram vocabulary keeps, for each
position, the path of the largest score instead; the window and the commits are the same.

Where no piece has the space mark after another character, a run of marks starts a new word, words are
independent, and each different word is searched once while it stays in a worker's memory, which is bounded in bytes.

Defined cases: a null text has null ids; an empty text no ids. Byte pieces that don't form UTF-8 decode to
U+FFFD; without byte pieces, characters outside the vocabulary in a row are one unknown id. Repeated rows are encoded
alike; other columns are kept, and a result whose name an input column has gets underscores after it. Texts of any
length are searched in a window. Empty tables give empty results. A model with a character map is refused.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.llm.common import free_name, ready, release

MARK = "▁"
MEMORY = 64 << 20  # bytes of words that a worker remembers
PAIRS = 48 << 20  # bytes of pairs that it remembers
SLICE = 1 << 20  # bytes of text that are held as Python strings at once, but for a longer text
UNKNOWN = 10.0  # fixed value: what an unknown character costs more than the rarest piece


class Recent(dict):
    """A memory in two halves: when the young one is full it becomes the old one, whose entries come back when asked for."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.held, self.old = limit // 2, 0, {}

    def keep(self, key, value, size: int):
        if self.held + size > self.limit:
            self.old, self.held = dict(self), 0
            self.clear()
        self.held += size
        self[key] = value
        return value


def _wire(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            n = varint() if kind == 2 else 8 if kind == 1 else 4
            yield key >> 3, data[at : at + n]
            at += n


class Pieces:
    """A vocabulary read from a SentencePiece model file."""

    def __init__(self, model: bytes):
        self.ids: dict[str, int] = {}
        self.score: list[float] = []
        self.text: list[str] = []
        self.kind: list[int] = []
        self.byte: dict[int, int] = {}
        self.unknown, self.unigram, self.dummy, self.trim, identity = 0, True, True, True, True
        for number, value in _wire(model):
            if number == 1:
                f = dict(_wire(value))
                piece, i = f.get(1, b"").decode(), len(self.text)
                kind = f.get(3, 1)
                self.text.append(piece)
                self.kind.append(kind)
                self.score.append(float(np.frombuffer(f[2], "<f4")[0]) if 2 in f else 0.0)
                if kind in (1, 4):  # normal, user-defined
                    self.ids[piece] = i
                elif kind == 6:
                    self.byte[int(piece[3:5], 16)] = i
                elif kind == 2:
                    self.unknown = i
            elif number == 2:
                self.unigram = dict(_wire(value)).get(3, 1) == 1
            elif number == 3:
                f = dict(_wire(value))
                identity = not f.get(2, b"") and f.get(1, b"identity") in (b"", b"identity")
                self.dummy, self.trim = bool(f.get(3, 1)), bool(f.get(4, 1))
        if not identity:
            raise ValueError("only models without a character map are supported")
        self.fallback = len(self.byte) == 256
        self.longest = max(map(len, self.ids), default=1)
        self.chars = {c for p in self.ids for c in p}
        if not self.unigram and not self.chars <= self.ids.keys():
            raise ValueError("a BPE vocabulary has to hold each of its characters as a piece")
        end = "" if "\n" in self.chars else "\n"  # a character outside the vocabulary is a boundary too
        self.cutter = re.compile(f"{MARK}+[^{MARK}{end}]*|[^{MARK}{end}]+|{end}" if end else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.splits = not any(MARK in p.lstrip(MARK) for p in self.ids)
        known = "".join(map(re.escape, sorted(self.chars)))
        self.runs = re.compile(f"[{known}]+|[^{known}]", re.S)
        self.whole = re.compile(f"[{known}]+").fullmatch
        self.size = [len(t) for t in self.text]
        self.pairs = Recent(PAIRS)
        if self.unigram:
            normal = [x for x, k in zip(self.score, self.kind, strict=True) if k == 1]
            self.rare = min(normal, default=0.0) - UNKNOWN
            top = max(normal, default=0.0)
            # A user's own piece is worth as much as the best piece for each of its bytes.
            self.score = [len(t.encode()) * top - 0.1 if k == 4 else x for t, x, k in zip(self.text, self.score, self.kind, strict=True)]

    @cached_property
    def finder(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for piece, i in self.ids.items():
            if self.unigram or self.merge(piece) == [piece]:  # a piece that its own text is not encoded as never appears
                found.add_word(piece, i)
        found.make_automaton()
        return found

    def merge(self, text: str) -> list[str]:
        """Encoding of a short text by the merges themselves; the pair test rests on it."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -np.inf, -1
            for i in range(len(parts) - 1):
                j = self.ids.get(parts[i] + parts[i + 1])
                if j is not None and self.score[j] > best:
                    best, at = self.score[j], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, key: int) -> bool:
        """Whether two pieces side by side (left * 2^32 + right) are the encoding of their text."""
        known = self.pairs.old.get(key)
        if known is None:
            a, b = self.text[key >> 32], self.text[key & 0xFFFFFFFF]
            known = self.merge(a + b) == [a, b]
        return self.pairs.keep(key, known, 110)

    def stream(self, text: str) -> Iterator[int]:
        """Ids of a normalised text, committed as soon as they are certain."""
        if self.unigram:
            yield from self._unigram(text)
            return
        for m in self.runs.finditer(text):
            run = m.group()
            if run[0] in self.chars:
                yield from self._run(run) if len(run) > 4 * self.longest else self._window(run)
            else:
                yield from self._unknown(run)

    def _unknown(self, char: str) -> list[int]:
        return [self.byte[b] for b in char.encode("utf-8", "surrogatepass")] if self.fallback else [self.unknown]

    def _unigram(self, text: str) -> Iterator[int]:
        """Ids on the path of the largest score; a character that is no piece can stand alone as unknown."""
        best, step, ids, base, full = [0.0], [0], [-1], 0, 4 * self.longest

        def path(at: int) -> Iterator[int]:
            out = []
            while at > 0:
                out.append((ids[at], base + at - 1))
                at -= step[at]
            for i, place in reversed(out):
                yield from self._unknown(text[place]) if i < 0 else (i,)

        found = iter(self.finder.iter(text))
        end, i = next(found, (-1, -1))
        for place, char in enumerate(text):
            at = place + 1 - base
            if at > full and (cut := self._shared(step)):
                yield from path(cut)
                best, step, ids, base, at = best[cut:], step[cut:], ids[cut:], base + cut, at - cut
                step[0] = 0
            best.append(-np.inf)
            step.append(0)
            ids.append(-1)
            while end == place:  # the longest piece comes first, and a tie stays with it
                n = self.size[i]
                if n <= at and best[at - n] + self.score[i] > best[at]:
                    best[at], step[at], ids[at] = best[at - n] + self.score[i], n, i
                end, i = next(found, (-1, -1))
            if char not in self.ids and best[at - 1] + self.rare > best[at]:
                best[at], step[at], ids[at] = best[at - 1] + self.rare, 1, -1
        yield from path(len(step) - 1)

    def _shared(self, step: list[int]) -> int:
        """The last boundary that the paths from all positions where a later piece can start have in common."""
        common, n = None, len(step) - 1
        for at in range(max(1, n - self.longest + 1), n + 1):
            marks = set()
            while at > 0:
                marks.add(at)
                at -= step[at]
            common = marks if common is None else common & marks
        return max((x for x in common or () if x <= n - self.longest), default=0)

    def _window(self, text: str) -> list[int]:
        """Ids of a run that one window holds, so that nothing is committed before its end."""
        size, known, last = self.size, self.pairs.get, [-1] + [-2] * len(text)
        for end, i in self.finder.iter(text):
            if last[end + 1] == -2:
                before = last[end + 1 - size[i]]
                if before < 0 or ((fits := known(before << 32 | i)) is None and self.fits(before << 32 | i)) or fits:
                    last[end + 1] = i
        out, at = [], len(text)
        while at:
            i = last[at]
            out.append(i)
            at -= size[i]
        out.reverse()
        return out

    def _run(self, text: str) -> Iterator[int]:
        """Ids of characters that are all in the vocabulary."""
        size, pairs, longest = self.size, self.pairs, self.longest
        last = [-1]  # per position of the window, the piece that ends there on its best path; -2: none does
        base = 0  # the window's start, a boundary before which all is committed
        full = 4 * longest

        def path(at: int) -> list[int]:
            out = []
            while at > 0:
                i = last[at]
                out.append(i)
                at -= size[i]
            return out[::-1]

        for end, i in self.finder.iter(text):  # all pieces that end at a position, the longest first
            at = end + 1 - base
            if at == len(last):
                if at > full:
                    cut = self._settled(last)
                    if cut:
                        done = path(cut)
                        yield from done
                        # Of what is committed, only the last piece bears on later ones.
                        last, base, at = [done[-1], *last[cut + 1 :]], base + cut, at - cut
                last.append(-2)
            start = at - size[i]
            if start < 0 or (before := last[start]) == -2 or last[at] != -2:
                continue
            if before == -1:
                last[at] = i
            else:
                key = before << 32 | i
                known = pairs.get(key)
                if self.fits(key) if known is None else known:
                    last[at] = i
        yield from path(len(last) - 1)

    def _settled(self, last: list[int]) -> int:
        """The last boundary that the paths from all positions where a later piece can start have in common."""
        common, n = None, len(last) - 1
        for at in range(n - self.longest + 1, n + 1):
            if last[at] == -2:
                continue
            marks = set()
            while at > 0:
                marks.add(at)
                at -= self.size[last[at]]
            common = marks if common is None else common & marks
        return max((x for x in common or () if x <= n - self.longest), default=0)

    def normal(self, text: str) -> str:
        text = re.sub(" +", " ", text.strip(" ")) if self.trim else text
        return ((MARK if self.dummy and text else "") + text).replace(" ", MARK)

    def settle(self, ids: np.ndarray) -> np.ndarray:
        """Unknown characters in a row are one id, unless they are written as bytes."""
        if self.fallback or len(ids) < 2:
            return ids
        return ids[np.concatenate([[True], (ids[1:] != self.unknown) | (ids[:-1] != self.unknown)])]

    def search(self, text: str) -> list[int]:
        """Ids of a whole text by the streaming search alone."""
        return self.settle(np.fromiter(self.stream(self.normal(text)), np.int32)).tolist()

    def segments(self, normal: str) -> Iterator[str]:
        """Stretches of a normalised text that no piece spans, as the vocabulary shows."""
        if not self.splits:
            return iter([normal] if normal else [])
        return iter(self.cutter.findall(normal)) if len(normal) < SLICE else (m.group() for m in self.cutter.finditer(normal))

    def decode(self, ids: list[int]) -> str:
        out: list[str] = []
        raw = bytearray()
        for k, i in enumerate(ids):
            if self.kind[i] == 6:
                raw.append(int(self.text[i][3:5], 16))
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            piece = "" if self.kind[i] == 3 else " \u2047 " if self.kind[i] == 2 else self.text[i].replace(MARK, " ")
            out.append(piece[1:] if k == 0 and (self.dummy or self.trim) and piece.startswith(" ") else piece)
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)

    @cached_property
    def table(self) -> tuple[pa.Array, np.ndarray]:
        """The bytes of every id and, after them, those of every id that starts a text; and where the two differ."""
        plain = [
            bytes([int(t[3:5], 16)]) if k == 6 else b"" if k == 3 else " \u2047 ".encode() if k == 2 else t.replace(MARK, " ").encode()
            for t, k in zip(self.text, self.kind, strict=True)
        ]
        lead = np.array([(self.dummy or self.trim) and k != 6 and p[:1] == b" " for p, k in zip(plain, self.kind, strict=True)], bool)
        return pa.array([*plain, *[p[1:] if cut else p for p, cut in zip(plain, lead, strict=True)]], pa.binary()), lead

    def decode_array(self, ids: pa.ListArray) -> pa.Array:
        """decode of many rows at once: the ids' bytes side by side, read as UTF-8."""
        known, lead = self.table
        flat = ids.flatten().to_numpy(zero_copy_only=False).copy()
        ends = np.cumsum([0, *pc.fill_null(pc.list_value_length(ids), 0).to_pylist()], dtype=np.int32)
        first = ends[:-1][np.diff(ends) > 0]
        flat[first] += np.where(lead[flat[first]], len(lead), 0).astype(flat.dtype)
        offsets = pa.array(ends, pa.int32(), mask=np.append(ids.is_null().to_numpy(zero_copy_only=False), False))
        raw = pc.binary_join(pa.ListArray.from_arrays(offsets, known.take(pa.array(flat))), b"")
        try:
            return raw.cast(pa.string())
        except pa.ArrowInvalid:  # byte pieces that are no UTF-8
            return pa.array([None if r is None else r.decode("utf-8", "replace") for r in raw.to_pylist()], pa.string())


class Memo(Recent):
    """Ids of a segment as int32 bytes, searched when first asked for."""

    def __init__(self, pieces: Pieces):
        super().__init__(MEMORY)
        self.pieces = pieces

    def __missing__(self, segment: str) -> bytes:
        p = self.pieces
        if (found := self.old.get(segment)) is None:
            short = len(segment) <= 4 * p.longest and p.whole(segment) and not p.unigram
            found = array("i", p._window(segment) if short else p.stream(segment)).tobytes()
        if len(segment) > 64:
            return found
        return self.keep(segment, found, 250 + len(found))  # both objects and their place, by estimate for words of 64 characters

    def encode(self, text: str | None) -> np.ndarray | None:
        if text is None:
            return None
        raw = b"".join(map(self.__getitem__, self.pieces.segments(self.pieces.normal(text))))
        return self.pieces.settle(np.frombuffer(raw, np.int32))

    def encode_array(self, texts: list[str | None]) -> pa.ListArray:
        coded = [self.encode(t) for t in texts]
        known = [c for c in coded if c is not None]
        ends = np.cumsum([0, *[0 if c is None else len(c) for c in coded]], dtype=np.int32)
        offsets = pa.array(ends, pa.int32(), mask=np.array([*[c is None for c in coded], False]))
        return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(known) if known else np.zeros(0, np.int32)))


@lru_cache(maxsize=2)
def _loaded(model: bytes) -> Memo:
    return Memo(Pieces(model))


def encode(text: str | None, model: bytes) -> np.ndarray | None:
    return _loaded(model).encode(text)


def _sliced(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of bounded bytes of one column, rows of more bytes alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False) + 16
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _shared(docs: DataFrame, model: str):
    """The model file (its size is that of a vocabulary, not of the data), read on the driver and broadcast."""
    ready(docs.sparkSession)
    with open(model, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode_texts(docs: DataFrame, model: str, *, text_col: str = "text", ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all but the text, if none are named) and the text's ids; nothing is shuffled."""
    shared = _shared(docs, model)
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    ids_col, names = free_name(ids_col, keep), [*dict.fromkeys([*keep, text_col])]
    cols = docs.select(*[f"`{c}`" for c in names])
    schema = T.StructType([*[cols.schema[c] for c in keep], T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, text = _loaded(shared.value), names.index(text_col)
        for batch in batches:
            for part in _sliced(batch, text):
                ids = memo.encode_array(part.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([*[part.column(names.index(c)) for c in keep], ids], names=[*keep, ids_col])
        release()

    return cols.mapInArrow(run, schema)


def decode_ids(coded: DataFrame, model: str, *, ids_col: str = "ids", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all but the ids, if none are named) and the text that the ids stand for; nothing is shuffled."""
    shared = _shared(coded, model)
    keep = [c for c in coded.columns if c != ids_col] if keep is None else keep
    text_col, names = free_name(text_col, keep), [*dict.fromkeys([*keep, ids_col])]
    cols = coded.select(*[f"`{c}`" for c in names])
    schema = T.StructType([*[cols.schema[c] for c in keep], T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _loaded(shared.value).pieces.decode_array
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), 512):
                part = batch.slice(at, 512)
                texts = decode(part.column(names.index(ids_col)))
                yield pa.RecordBatch.from_arrays([*[part.column(names.index(c)) for c in keep], texts], names=[*keep, text_col])
        release()

    return cols.mapInArrow(run, schema)


def round_trip(docs: DataFrame, model: str, *, text_col: str = "text", ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """What encode_texts gives, and of every row's ids decoded again: decoded_chars, decoded_sha256, round_trip.

    round_trip says whether the decoded text is the text itself; it can't be where the text holds the space mark, which
    decodes to a space. A null text is decoded as null, and that is a round trip. A slice of rows is encoded and, from
    its ids, decoded in one pass, so that a task has one Python worker and no text travels with the ids.
    """
    shared = _shared(docs, model)
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    names = [*dict.fromkeys([*keep, text_col])]
    cols = docs.select(*[f"`{c}`" for c in names])
    kinds = [(ids_col, T.ArrayType(T.IntegerType())), ("decoded_chars", T.LongType()), ("decoded_sha256", T.StringType()), ("round_trip", T.BooleanType())]
    out = [free_name(c, keep) for c, _ in kinds]
    schema = T.StructType([*[cols.schema[c] for c in keep], *[T.StructField(c, k) for c, (_, k) in zip(out, kinds, strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, text = _loaded(shared.value), names.index(text_col)
        for batch in batches:
            for part in _sliced(batch, text):
                texts = part.column(text)
                ids = memo.encode_array(texts.to_pylist())
                back = memo.pieces.decode_array(ids)
                chars = pc.fill_null(pc.utf8_length(back), 0).cast(pa.int64())
                sha = pa.array([None if t is None else hashlib.sha256(t).hexdigest() for t in back.cast(pa.binary()).to_pylist()], pa.string())
                same = pc.fill_null(pc.equal(back, texts.cast(pa.string())), True)
                yield pa.RecordBatch.from_arrays([*[part.column(names.index(c)) for c in keep], ids, chars, sha, same], names=[*keep, *out])
        release()

    return cols.mapInArrow(run, schema)
