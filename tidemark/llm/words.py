"""Words of whole texts as 64-bit numbers, for a batch of texts at once.

A word is a run of bytes outside white space (0x20, 0x09-0x0D). White space is
ASCII, so cutting UTF-8 bytes gives the same words as cutting characters. All
work is done by numpy on the bytes of an Arrow string column; no Python object
is made per word. Numbers depend on the word alone, so they agree between
tasks, executors and runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_GOLD = U64(0x9E3779B97F4A7C15)
_STEP = U64(0xD1342543DE82EF95)  # odd: powers never vanish modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _table(seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, 257, dtype=U64) * _GOLD + U64(seed))


def _powers(n: int) -> np.ndarray:
    out = np.ones(max(n, 1), U64)
    with np.errstate(over="ignore"):
        out[1:] = _STEP
        return np.multiply.accumulate(out)


_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_TABLES = {seed: _table(seed) for seed in (1, 2)}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """Words of a batch. ``doc`` is the row of each word in the batch, ``first``
    the index of each row's first word, ``count`` its number of words."""

    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    count: np.ndarray
    start: np.ndarray  # byte offsets in ``data``
    end: np.ndarray
    data: np.ndarray


def column_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the row offsets in them (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def words_of(texts: pa.Array, lower: bool = False, seed: int = 1) -> Words:
    """The words of every row of ``texts``; ``lower`` folds A-Z only."""
    data, off = column_bytes(texts)
    if lower:
        data = _LOWER[data]
    n_rows = len(off) - 1
    inside = _IS_WORD[data]
    row_starts = off[:-1][off[:-1] < off[1:]]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[row_starts] = inside[row_starts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = row_starts[row_starts > 0] - 1
    ends[last] = inside[last]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    if not len(start):
        z = np.zeros(0, np.int64)
        return Words(np.zeros(0, U64), z, np.zeros(n_rows, np.int64), np.zeros(n_rows, np.int64), z, z, data)
    size = end - start
    at = np.cumsum(size) - size
    letters = data[inside]
    within = np.arange(len(letters)) - np.repeat(at, size)
    with np.errstate(over="ignore"):
        h = np.add.reduceat(_TABLES[seed][letters] * _powers(int(size.max()))[within], at)
        h = mix(h + size.astype(U64) * _GOLD)
    doc = np.searchsorted(off[1:], start, side="right")
    count = np.bincount(doc, minlength=n_rows).astype(np.int64)
    return Words(h, doc, np.cumsum(count) - count, count, start, end, data)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """A number for each run of ``k`` consecutive words (rows may be crossed;
    use ``gram_mask`` to leave those out)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        out = h[:n].copy()
        for j in range(1, k):
            out *= _STEP
            out += h[j:j + n]
        return mix(out + U64(k))


def gram_mask(doc: np.ndarray, k: int) -> np.ndarray:
    """True where a run of ``k`` words lies in one row."""
    n = len(doc) - k + 1
    return doc[:n] == doc[k - 1:] if n > 0 else np.zeros(0, bool)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most_bytes`` of text, so that work
    arrays stay small. A row is never cut: a longer text is a run of its own."""
    sizes = batch.column(column)
    lengths = np.diff(column_bytes(sizes)[1])
    group = (np.cumsum(lengths) - lengths) // most_bytes
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        if b > a:
            yield batch.slice(a, b - a)
