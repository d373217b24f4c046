"""Number arrays as bytes, and runs of sorted numbers: helpers of operators that
send many small numbers through a shuffle in few rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dump(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed value, byte planes side by side: small numbers
    leave their high bytes zero, and zero planes cost nothing."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts.append(np.array([len(a)], "<i8").tobytes() + a.dtype.str.encode().ljust(8))
        parts.append(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def load(blob: bytes) -> list[np.ndarray]:
    """The arrays of ``dump``."""
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(raw):
        n, kind = int(np.frombuffer(raw, "<i8", 1, at)[0]), np.dtype(raw[at + 8:at + 16].decode().strip())
        at += 16
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return out


def run_starts(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    n = len(sorted_columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in sorted_columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def spread(per_run: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """A value of each run, given to each of its rows."""
    return np.repeat(per_run, np.diff(np.append(starts, n)))


def sliding(least: Callable, a: np.ndarray, n: int) -> np.ndarray:
    """``least`` (np.minimum or np.maximum) over every ``n`` neighbours."""
    if len(a) < n:
        return a[:0]
    size = 1
    while 2 * size <= n:
        a, size = least(a[:-size], a[size:]), 2 * size
    rest = n - size
    return least(a[:-rest], a[rest:]) if rest else a


def filled(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[list[pa.RecordBatch]]:
    """Lists of slices of batches that hold about ``most_bytes`` of text together."""
    from tidemark.llm.words import slices

    held, size = [], 0
    for batch in batches:
        for part in slices(batch, column):
            held.append(part)
            size += part.nbytes
            if size >= most_bytes:
                yield held
                held, size = [], 0
    if held:
        yield held


def bucket_count(docs: DataFrame, column: str, bucket_bytes: int) -> int:
    """As many buckets as give each about ``bucket_bytes`` of text."""
    total = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(1, -(-total // bucket_bytes))
