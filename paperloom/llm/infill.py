"""Fill-in-middle transformation by succinct rank and select.

The bytes of a text that start a token are ones of a bit vector, packed eight to a byte, with a directory of the ones
before each block. The total of the directory is the number of tokens n; a cut before token r is found by select: the
block that holds one number r by a search of the directory, then its byte, then its bit. Two seeded ranks cut a text
into prefix, middle and suffix, which are written in another order behind sentinels; restored() takes the parts apart
again.

A token is white space (space, tab, line feed, vertical tab, form feed, carriage return) with what follows it up to the
next white space; white space at the end is a token. These are single bytes in UTF-8, so cuts never split a character.

Defined cases: a null text is transformed like an empty one: no tokens, form plain, an empty output. A text that holds a
sentinel stays plain, as it could not be restored. A null id hashes as the empty string. Rows that share id and text get
the same result. Texts of any length are cut whole; bytes that are no UTF-8 stay as they are. Nothing is shuffled. Other
columns are kept, and a new column whose name is taken gets underscores after it. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.llm.common import free_name, ready, release

#: What stands before the parts, and the forms.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = 42
RATE = 50  # texts of a hundred that are cut
SPM_RATE = 80  # of a hundred cut texts, those with the suffix first
BLOCK = 64  # bytes of the bit vector that one number of the directory stands for


class Boundaries:
    """The bits of a text's bytes that start a token, with a directory of the ones before each block."""

    def __init__(self, text: bytes):
        b = np.frombuffer(text, np.uint8)
        space = (b == 0x20) | ((b >= 0x09) & (b <= 0x0D))
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[:1] = True
        packed = np.packbits(first)
        self.bits = np.zeros(-(-len(packed) // BLOCK) * BLOCK, np.uint8)
        self.bits[: len(packed)] = packed
        ones = np.bitwise_count(self.bits).reshape(-1, BLOCK).sum(axis=1, dtype=np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])
        self.n, self.length = int(self.before[-1]), len(b)

    def rank(self, place: int) -> int:
        """Ones before a byte."""
        block, byte = place // (8 * BLOCK), place // 8
        some = int(np.bitwise_count(self.bits[block * BLOCK : byte]).sum(dtype=np.int64))
        part = int(self.bits[byte]) >> (8 - place % 8) if place % 8 else 0
        return int(self.before[block]) + some + part.bit_count()

    def select(self, r: int) -> int:
        """The byte that starts token r; the length for r = n."""
        if r >= self.n:
            return self.length
        block = int(np.searchsorted(self.before, r, side="right")) - 1
        within = np.cumsum(np.bitwise_count(self.bits[block * BLOCK : (block + 1) * BLOCK]), dtype=np.int64)
        left = r - int(self.before[block])
        byte = int(np.searchsorted(within, left, side="right"))
        left -= int(within[byte - 1]) if byte else 0
        ones = np.flatnonzero(np.unpackbits(self.bits[block * BLOCK + byte : block * BLOCK + byte + 1]))
        return (block * BLOCK + byte) * 8 + int(ones[left])


def draws(key: str, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from the seed and a row's key."""
    digest = hashlib.sha256(f"{seed}:{key}".encode("utf-8", "surrogatepass")).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))  # type: ignore[return-value]


def cut(text: bytes, key: str, *, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> tuple[int, str, tuple[int, int] | None, bytes]:
    """(n, form, byte cuts, output) of a text; plain texts have no cuts."""
    bounds = Boundaries(text)
    h1, h2, h3, h4 = draws(key, seed)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        return bounds.n, PLAIN, None, text
    low, high = sorted((h1 % (bounds.n + 1), h2 % (bounds.n + 1)))
    a, b = bounds.select(low), bounds.select(high)
    if h4 % 100 < spm_rate:
        return bounds.n, SPM, (a, b), b"".join((SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b]))
    return bounds.n, PSM, (a, b), b"".join((PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b]))


def chars(text: bytes) -> int:
    """Code points: bytes that continue none."""
    return int(((np.frombuffer(text, np.uint8) & 0xC0) != 0x80).sum())


COLUMNS = ("n_tokens", "form", "prefix_chars", "middle_chars", "output")


def transform(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE,
) -> DataFrame:
    """docs with n_tokens, form, prefix_chars and middle_chars (null if plain) and output, the text as it is trained on."""
    ready(docs.sparkSession)
    names = []
    for c in COLUMNS:
        names.append(free_name(c, [*docs.columns, *names]))
    kinds = (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType())
    key = free_name("key", docs.columns)
    schema = T.StructType([*docs.schema, *[T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            rows = [[] for _ in names]
            for text, name in zip(texts, batch.column(batch.num_columns - 1), strict=True):
                whole = text.as_py() or b""
                n, form, cuts, output = cut(whole, name.as_py(), seed=seed, rate=rate, spm_rate=spm_rate)
                a, b = cuts or (0, 0)
                sizes = (chars(whole[:a]), chars(whole[a:b])) if cuts else (None, None)
                for column, value in zip(rows, (n, form, *sizes, output), strict=True):
                    column.append(value)
            made = [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
            made[-1] = made[-1].view(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=schema.names)
        release()

    return docs.withColumn(key, F.coalesce(F.col(id_col).cast("string"), F.lit(""))).mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of, byte by byte."""
    p, s, m = (x.decode() for x in (PREFIX, SUFFIX, MIDDLE))
    # Sentinels stand once each: no text that is cut holds one, and none can arise where parts meet.
    between = lambda a, b: F.substring_index(F.substring_index(output, b, 1), a, -1)
    middle = F.substring_index(output, m, -1)
    psm, spm = F.concat(between(p, s), middle, between(s, m)), F.concat(between(p, m), middle, between(s, p))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
