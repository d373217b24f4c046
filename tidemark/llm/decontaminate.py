"""Benchmark decontamination by spaced-seed hashing.

A document overlaps a benchmark item if a window of ``WINDOW`` consecutive words
of the item (the whole item, if it is shorter) stands in the document with at
most ``allowed(window)`` words replaced. Words are compared with A-Z folded.

A seed hashes the words of a window at some of its places and ignores the
others. The masks of a window length cut it into ``allowed + 2`` blocks and keep
two of them: whichever words are replaced, two blocks are untouched, so one
mask's seed agrees. No overlap is lost, and six words or so must agree at once
for a hit by chance.

Benchmark seeds are a table; documents' seeds are joined to it by hash. Before
that, a bitmap of the benchmark's seeds drops nearly all seeds that cannot join
while they are made. Its size follows the number of seeds up to ``MOST_BITS``;
beyond, it drops fewer, and the join alone decides. Hits carry the words of
their window. Distinct windows meet, each pair once however many documents and
items hold them, and are compared word by word; only then do the pairs that
hold lead back to documents and items.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.salt import dealt_join
from tidemark.llm.words import U64, Words, gram_mask, mix, slices, words_of
from tidemark.session import scratch_root

WINDOW = 13
LEAST_ITEM = 5  # items of fewer words are no evidence
LEAST_BITS, MOST_BITS = 16, 30  # of the bitmap: 8 KiB to 128 MiB
SPARE_BITS = 8  # 256 bits a seed or more, two of them set: under 1 of 10,000 seeds passes by chance
DEALS = 16

_STEP = U64(0x9FB21C651E98DF25)


def allowed(window: int) -> int:
    """Words of a window that may be replaced: 2 of 12 or 13, 1 from 9 on, else 0."""
    return 2 if window >= 12 else 1 if window >= 9 else 0


def masks(window: int) -> list[list[int]]:
    """Places kept by each mask of a window length."""
    edges = np.linspace(0, window, allowed(window) + 3).round().astype(int)
    blocks = [list(range(a, b)) for a, b in zip(edges, edges[1:], strict=False)]
    if allowed(window) == 0:
        return [list(range(window))]
    return [a + b for a, b in combinations(blocks, 2)]


def seeds(h: np.ndarray, window: int, number: int, places: list[int]) -> np.ndarray:
    """The seed of every window, under one mask."""
    n = len(h) - window + 1
    with np.errstate(over="ignore"):
        out = np.full(max(n, 0), U64(window * 64 + number))
        for p in places:
            out *= _STEP
            out += h[p:p + n]
        return mix(out)


def _windows(w: Words, at: np.ndarray, window: int) -> pa.Array:
    """The folded words of the windows at ``at``, joined by one space."""
    spans = zip(w.start[at].tolist(), w.end[at + window - 1].tolist(), strict=True)
    return pa.array([b" ".join(w.data[a:b].tobytes().split()) for a, b in spans], pa.binary())


def benchmark_seeds(benchmark: DataFrame) -> DataFrame:
    """seed, item_id, words of every window of every item under every mask, and
    the window's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = words_of(part.column("text"), lower=True)
                ids = part.column("item_id")
                for length in np.unique(np.minimum(w.count, WINDOW)):
                    if length < LEAST_ITEM:
                        continue
                    at = np.flatnonzero(gram_mask(w.doc, length))
                    at = at[np.minimum(w.count[w.doc[at]], WINDOW) == length]
                    for number, places in enumerate(masks(length)):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(seeds(w.hash, length, number, places)[at].view(np.int64)),
                             ids.take(pa.array(w.doc[at])), _windows(w, at, length),
                             pa.array(np.full(len(at), length, np.int32))], ["seed", "item_id", "item_words", "window"])

    return benchmark.select("item_id", "text").where("item_id is not null").mapInArrow(
        run, "seed long, item_id long, item_words binary, window int")


def bitmap_bits(n_seeds: int) -> int:
    """The size of the bitmap for a number of seeds, as a power of two."""
    return min(max(n_seeds.bit_length() + SPARE_BITS, LEAST_BITS), MOST_BITS)


def seed_bitmap(table: DataFrame, bits: int) -> np.ndarray:
    """For every seed the bits at its upper and at its lower ``bits`` are set.
    Spark sets the bits of each 64-bit cell; at most ``2 ** (bits - 6)`` cells
    come to the driver."""
    places = F.array(F.shiftrightunsigned("seed", 64 - bits), F.col("seed").bitwiseAND(F.lit((1 << bits) - 1)))
    cells = table.select(F.explode(places).alias("place")).groupBy(F.shiftrightunsigned("place", 6).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("word"))
    out = np.zeros(1 << (bits - 6), np.int64)
    got = cells.toArrow()
    out[got.column("cell").to_numpy()] = got.column("word").to_numpy()
    return out.view(U64)


def _in_bitmap(seed: np.ndarray, bitmap: np.ndarray, bits: int) -> np.ndarray:
    """Indexes of seeds that may be in the table."""
    def is_set(place: np.ndarray) -> np.ndarray:
        return (bitmap[place >> U64(6)] >> (place & U64(63))) & U64(1) > 0

    at = np.flatnonzero(is_set(seed >> U64(64 - bits)))
    return at[is_set(seed[at] & U64((1 << bits) - 1))]


def document_seeds(docs: DataFrame, lengths: list[int], bitmap: np.ndarray, bits: int) -> DataFrame:
    """seed, doc_id, words of the documents' windows whose seed is in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = words_of(part.column("text"), lower=True)
                ids = part.column("doc_id")
                for length in lengths:
                    inside = gram_mask(w.doc, length)
                    for number, places in enumerate(masks(length)):
                        seed = seeds(w.hash, length, number, places)
                        at = _in_bitmap(seed, bitmap, bits)
                        at = at[inside[at]]
                        if len(at):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(seed[at].view(np.int64)), ids.take(pa.array(w.doc[at])), _windows(w, at, length)],
                                ["seed", "doc_id", "doc_words"])

    return docs.select("doc_id", "text").where("doc_id is not null").mapInArrow(
        run, "seed long, doc_id long, doc_words binary")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of windows that differ in no more words than allowed."""
    for batch in batches:
        good = []
        for left, right in zip(batch.column("doc_words").to_pylist(), batch.column("item_words").to_pylist(), strict=True):
            a, b = left.split(b" "), right.split(b" ")
            good.append(len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) <= allowed(len(a)))
        yield batch.filter(pa.array(good, pa.bool_()))


def _met(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Windows by document (doc_id, doc_words) and by item (item_id, item_words),
    and the pairs of distinct windows (doc_words, item_words) that overlap."""
    scratch_root(docs.sparkSession)
    table = benchmark_seeds(benchmark).checkpoint()
    n_seeds, lengths = table.agg(F.count("*"), F.collect_set("window")).first()
    bits = bitmap_bits(n_seeds)
    hits = document_seeds(docs, sorted(lengths), seed_bitmap(table, bits), bits).checkpoint()
    pairs = hits.select("seed", "doc_words").distinct().join(table.select("seed", "item_words").distinct(), "seed")
    met = pairs.select("doc_words", "item_words").distinct().mapInArrow(_verified, "doc_words binary, item_words binary")
    return hits.select("doc_id", "doc_words").distinct(), table.select("item_id", "item_words").distinct(), met


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id) of every document that overlaps a benchmark item.

    A null text is an empty one and overlaps nothing; rows without doc_id or
    item_id cannot be named and are left out; repeated rows give a pair once;
    other columns are not read; an empty table on either side gives no rows.
    """
    by_doc, by_item, met = _met(docs, benchmark)
    items = dealt_join(by_item, met, ["item_words"], "item_id", DEALS).select("doc_words", "item_id").distinct()
    return dealt_join(by_doc, items, ["doc_words"], "doc_id", DEALS).select("doc_id", "item_id").distinct()


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, all columns kept.
    Rows without doc_id are kept. Items are not told apart."""
    by_doc, _, met = _met(docs, benchmark)
    found = dealt_join(by_doc, met.select("doc_words").distinct(), ["doc_words"], "doc_id", DEALS).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*(f"`{c}`" for c in docs.columns))
