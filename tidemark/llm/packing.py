"""Harmonic packing of tokenised documents into fixed-length sequences.

A document's ids (its tokens, then the end id 0) are cut into pieces, and the
pieces are packed by class. Class ``k`` holds the pieces whose length lies in
``(capacity/(k+1), capacity/k]``; a bin of class ``k`` takes exactly ``k``
pieces, so a worker fills bins without looking at any other worker, or at any
other class, and needs one open bin per class.

Cuts make that tight. A document gives its whole capacities first, each a
sequence of its own. The rest is cut at powers of two down to ``least_cut``:
such a piece is exactly ``capacity/k``, so its full bins have no padding. Only
the tail under ``least_cut`` is packed with the slack of its class, at most one
part in ``capacity/least_cut``.

When a partition ends, its open bins hold fewer than ``k`` pieces each. They
are joined, longest pieces first, into as few sequences as next-fit gives. That
is at most one open bin per class and partition.

There is no shuffle: a partition of documents is read, tokenised, cut and
packed in one pass, so no source or length can be a hot key, and a lost
executor costs its partitions only. Sequence ids are the partition's number
and a counter.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

END_ID = 0
_PARTITION_SHIFT = 40

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

# Texts made of these only are tokenised by the fast library; others by the
# reference library itself, as the two may carry different Unicode tables.
_COMMON = re.compile("[\t\n\r -~\u00a0-\u024f\u2010-\u2027\u20ac]*")

_encoders: dict[str, Callable[[str], np.ndarray]] = {}


def byte_encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text -> ids, as the ``tokenizers`` library gives for the byte-level BPE
    file at ``path`` without added special tokens. Loaded once per process."""
    if path not in _encoders:
        _encoders[path] = _load_encoder(path)
    return _encoders[path]


def _load_encoder(path: str) -> Callable[[str], np.ndarray]:
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    spec = json.loads(open(path, encoding="utf-8").read())
    special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
    to_byte = {c: b for b, c in _byte_letters().items()}
    ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    library = Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        if _COMMON.fullmatch(text):
            return np.asarray(fast.encode_to_numpy(text, allowed_special="all", disallowed_special=()), "<u4")
        return np.array(library.encode(text, add_special_tokens=False).ids, "<u4")

    return encode


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte:
    itself if printable in Latin-1, else the next free letter from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def cut_lengths(total: int, capacity: int, least_cut: int) -> list[int]:
    """Lengths of the pieces of a document of ``total`` ids, in order."""
    pieces = [capacity] * (total // capacity)
    rest, size = total % capacity, capacity // 2
    while rest and size >= least_cut:
        if rest >= size:
            pieces.append(size)
            rest -= size
        size //= 2
    return pieces + [rest] * (rest > 0)


class _Bins:
    """Open bins of one worker: at most one per class."""

    def __init__(self, capacity: int, base: int):
        self.capacity, self.next_id, self.open = capacity, base, {}

    def add(self, piece: tuple) -> list[tuple]:
        """Take a piece (doc_id, start, length, ...); the full bin, if one is."""
        k = self.capacity // piece[2]
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) < k:
            return []
        del self.open[k]
        return self._close(held)

    def rest(self) -> Iterator[tuple]:
        """The pieces of all open bins, longest first, next-fit."""
        held, used = [], 0
        for piece in sorted((p for b in self.open.values() for p in b), key=lambda p: -p[2]):
            if used + piece[2] > self.capacity:
                yield from self._close(held)
                held, used = [], 0
            held.append(piece)
            used += piece[2]
        if held:
            yield from self._close(held)
        self.open = {}

    def _close(self, pieces: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        for p in pieces:
            out.append((*p, self.next_id, offset))
            offset += p[2]
        self.next_id += 1
        return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, least_cut: int = 64,
         with_ids: bool = False) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` ids.

    One row per piece; with ``with_ids`` also the ids themselves (``ids``,
    array of int), which is what a trainer reads. A null text is an empty one
    and gives the end id alone; a null doc_id is kept as it is; repeated rows
    are packed each; other columns are not read. An empty table gives no rows.
    """
    if capacity & (capacity - 1) or least_cut > capacity:
        raise ValueError("capacity must be a power of two, and least_cut at most that")
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    types = [pa.int64()] * len(names)
    schema = SCHEMA + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoder(tokenizer)
        bins = _Bins(capacity, TaskContext.get().partitionId() << _PARTITION_SHIFT)
        order = [0, 1, 2, 3, 4, 6, 7, 5] if with_ids else range(len(names))

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(columns[i], t) for i, t in zip(order, types, strict=False)]
            if with_ids:
                arrays.append(pa.array([c.astype("i4") for c in columns[5]], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                start = 0
                for length in cut_lengths(len(ids), capacity, least_cut):
                    part = ids[start:start + length]
                    piece = (doc_id, start, length, zlib.crc32(part.tobytes()), len(ids))
                    rows += bins.add((*piece, part) if with_ids else piece)
                    start += length
                if len(rows) > 50_000:
                    yield out(rows)
                    rows = []
            if rows:
                yield out(rows)
        if rows := list(bins.rest()):
            yield out(rows)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
