"""Language model scores by context-tree weighting over binary-decomposed bytes.

A text is its words in lower case (A-Z), each with a space, and an end byte. A
byte is eight binary choices from its highest bit down; the node of a choice is
the context (up to ``DEPTH`` bytes before it) and the bits already known. With
its training counts (n0, n1) a node has the Krichevsky-Trofimov estimate

    KT(n0, n1) = G(n0 + 1/2) G(n1 + 1/2) / (pi G(n0 + n1 + 1))

and mixes "this context is enough" with "look one byte further back", each at
one half: ``Pw = (KT + product of Pw of the longer contexts) / 2``. So all
suffix trees up to ``DEPTH`` are weighted at once. A choice is then predicted
by the posterior mixture along its path,

    p = w (n1 + 1/2) / (n0 + n1 + 1) + (1 - w) p(one byte further),  w = KT / 2Pw,

and a byte's code length is the sum of its choices' ``-log2 p``; a text's score
is the log10 probability of all its bytes.

In Spark:

1. *Survey.* A task reads a block of documents (``block_bytes`` of text) and keeps
   each distinct gram, ``DEPTH`` context bytes and the byte as one exact
   number, with its training count; those seen only in held-out texts count 0.
   Likewise for words. Grams go to the slot of their two nearest context bytes, so
   that the whole subtree below these two is in one place; words by hash.
2. *Counts.* A slot's grams are merged as they stream by, so it holds distinct
   grams, not occurrences. Its subtree is summed from the longest
   contexts up; the sums at two bytes go on to one byte and none, which are at
   most 256 * 255 nodes whatever the input: the driver weights these.
3. *Answers.* Slots weight their paths down from there and tell each block its
   grams' log probabilities and its words' counts; the block adds them up per document.

Blocks are written once, with their texts, so nothing depends on reading the
input in the same order again. What is gathered follows the distinct grams and
words of the input; no count is capped or pruned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blobs import bucket_count, dump, filled, load, run_starts, spread
from tidemark.llm.words import U64, mix, words_of
from tidemark.session import scratch_dir

DEPTH = 5  # context bytes; with the byte itself at most 8
SHARED = 2  # context bytes that a slot's grams have in common
_END, _SPACE = 0x0A, 0x20
_BLOCKS = "block long, slot long, texts binary, asked binary"
_NODES = 256  # binary nodes of a byte are numbered 1 to 255, as in a heap


def byte_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, each word with a space and each text with its end;
    every text's number of bytes and of words; every word's hash."""
    w = words_of(texts, lower=True)
    size = w.end - w.start
    letters = np.repeat(w.start - np.cumsum(size) + size, size) + np.arange(size.sum())
    length = np.bincount(w.doc, weights=size + 1, minlength=len(w.count)).astype(np.int64) + 1
    out = np.full(length.sum(), _SPACE, np.uint8)
    word = np.repeat(np.arange(len(size)), size)
    out[np.arange(len(letters)) + word + w.doc[word]] = w.data[letters]
    out[np.cumsum(length) - 1] = _END
    return out, length, w.count, w.hash


def grams(data: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A number for each byte and its context, the nearest context byte on top
    and the byte itself lowest. Before a text stand end bytes."""
    begin = np.cumsum(length) - length + DEPTH * np.arange(1, len(length) + 1)
    padded = np.full(len(data) + DEPTH * len(length), _END, np.uint8)
    at = np.repeat(begin - np.cumsum(length) + length, length) + np.arange(len(data))
    padded[at] = data
    out = padded.astype(U64)
    for j in range(1, DEPTH + 1):
        out[j:] |= padded[:-j].astype(U64) << U64(8 * (DEPTH + 1 - j))
    return out[at]


def _near(gram: np.ndarray) -> np.ndarray:
    """The ``SHARED`` nearest context bytes of a gram."""
    return gram >> U64(8 * (DEPTH + 1 - SHARED))


# 1. Survey -------------------------------------------------------------------


class _Tally:
    """Distinct numbers and their training counts."""

    def __init__(self):
        self.keys, self.counts = [], []

    def add(self, keys: np.ndarray, trained: np.ndarray) -> None:
        for part, times in ((keys[trained], 1), (keys[~trained], 0)):
            found, n = np.unique(part, return_counts=True)
            self.keys.append(found)
            self.counts.append(n * times)

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = run_starts(keys)
        self.keys, self.counts = [keys[starts]], [np.add.reduceat(counts, starts) if len(starts) else counts]
        return self.keys[0], self.counts[0]


def _steps(sorted_keys: np.ndarray) -> np.ndarray:
    """Sorted numbers as differences, which have fewer bytes."""
    return np.diff(sorted_keys, prepend=U64(0))


def _in_slots(keys: np.ndarray, slot: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Slots and the places of their keys, in order."""
    order = np.argsort(slot, kind="stable")
    starts = run_starts(slot[order])
    for at in np.split(order, starts[1:]) if len(order) else []:
        yield int(slot[at[0]]), at


def _gram_slot(gram: np.ndarray, n_slots: int) -> np.ndarray:
    return (mix(_near(gram)) % U64(n_slots)).astype(np.int64)


def _word_slot(word: np.ndarray, n_slots: int) -> np.ndarray:
    return ((word >> U64(32)) * U64(n_slots) >> U64(32)).astype(np.int64)


def _survey(n_slots: int, block_bytes: int):
    names = [f.split()[0] for f in _BLOCKS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        for held in filled(batches, "text", block_bytes):
            tallies, parts = (_Tally(), _Tally()), []
            for part in held:
                data, length, n_words, words = byte_texts(part.column("text"))
                train = part.column("train").to_numpy(zero_copy_only=False).astype(bool)
                tallies[0].add(grams(data, length), np.repeat(train, length))
                tallies[1].add(words, np.repeat(train, n_words))
                ids = part.column("doc_id")
                parts.append((ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), ids.is_valid().to_numpy(zero_copy_only=False),
                              train, length, data))
            (gram, n), (word, m) = (t.total() for t in tallies)
            asked: dict[int, list] = {}
            for kind, (keys, counts, slot) in enumerate(((gram, n, _gram_slot(gram, n_slots)), (word, m, _word_slot(word, n_slots)))):
                for s, at in _in_slots(keys, slot):
                    asked.setdefault(s, [np.zeros(0, U64), np.zeros(0, np.int64)] * 2)[2 * kind:2 * kind + 2] = [_steps(keys[at]), counts[at]]
            rows = [(block, -1, dump(*map(np.concatenate, zip(*parts, strict=True))), None)]
            rows += [(block, s, None, dump(*arrays)) for s, arrays in asked.items()]
            for i in range(0, len(rows), 500):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + 500], strict=True), types, strict=True)], names)
            block += 1

    return run


# 2. The tree -------------------------------------------------------------------


def _log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log KT of counts, by the log-gamma function."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log G(x) for x > 0: Stirling's series above 8, reached by G(x+1) = x G(x)."""
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift[low] -= np.log(y[low])
        y[low] += 1
    r = 1 / (y * y)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r / 1188)))) / y
    return shift + (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series


class Level:
    """Nodes of one context length: counts, log Pw, the weight of stopping here."""

    def __init__(self, n0: np.ndarray, n1: np.ndarray, longer: np.ndarray | None):
        self.n0, self.n1 = n0, n1
        kt = _log_kt(n0, n1)
        self.log_w = np.zeros_like(kt) if longer is None else kt - np.logaddexp(kt, longer)
        self.log_pw = kt if longer is None else np.logaddexp(kt, longer) - np.log(2)

    def predict(self) -> np.ndarray:
        """KT's probability of a one."""
        return (self.n1 + 0.5) / (self.n0 + self.n1 + 1)


class Subtree:
    """The tree over distinct grams (sorted) with training counts, from contexts
    of ``DEPTH`` bytes up to those of ``SHARED`` bytes."""

    def __init__(self, gram: np.ndarray, count: np.ndarray):
        byte = gram & U64(255)
        context = gram >> U64(8)
        self.levels: list[Level] = []
        self.parents: list[np.ndarray] = []  # place of each node's parent
        # nodes of the longest contexts: one for each known beginning of a byte
        node = np.concatenate([(context << U64(8)) | ((byte | U64(256)) >> U64(8 - k)) for k in range(8)])
        bit = np.concatenate([(byte >> U64(7 - k)) & U64(1) for k in range(8)]).astype(bool)
        times = np.tile(count.astype(float), 8)
        keys, place = self._grouped(node)
        self.leaf, self.bit = place.reshape(8, -1), bit.reshape(8, -1)
        n0, n1 = (np.bincount(place, weights=times * side, minlength=len(keys)) for side in (~bit, bit))
        self.levels.append(Level(n0, n1, None))
        for _ in range(DEPTH - SHARED):
            above, place = self._grouped((keys >> U64(16) << U64(8)) | (keys & U64(255)))
            low = self.levels[-1]
            sums = [np.bincount(place, weights=v, minlength=len(above)) for v in (low.n0, low.n1, low.log_pw)]
            self.levels.append(Level(*sums))
            self.parents.append(place)
            keys = above
        self.keys = keys  # (SHARED context bytes, node)

    @staticmethod
    def _grouped(node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(node, return_inverse=True)

    def log_probs(self, above: np.ndarray, share: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's byte. ``above`` and ``share``: for each
        top node, what shorter contexts give to a one, and how much is left."""
        for i in range(len(self.levels) - 1, 0, -1):
            level = self.levels[i]
            stop = np.exp(level.log_w)
            above, share = above + share * stop * level.predict(), share * -np.expm1(level.log_w)
            above, share = above[self.parents[i - 1]], share[self.parents[i - 1]]
        one = above + share * self.levels[0].predict()
        return np.log10(np.where(self.bit, one[self.leaf], 1 - one[self.leaf])).sum(axis=0)


def top_tables(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """What contexts of one byte and of none give: (above, share) by nearest
    byte and node. ``rows``: (nearest byte, node, n0, n1, log Pw of the longer)."""
    sums = np.zeros((3, 256, _NODES))
    for near, node, n0, n1, longer in rows:
        sums[:, near, node] = n0, n1, longer
    one = Level(*sums)
    none = Level(*(v.sum(axis=0) for v in (one.n0, one.n1, one.log_pw)))
    w0, w1 = np.exp(none.log_w), np.exp(one.log_w)
    above = w0 * none.predict() + (1 - w0) * w1 * one.predict()
    return above, (1 - w0) * -np.expm1(one.log_w)


def _merge_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks' tallies in order of slots -> each slot's merged ones, the sums of
    its subtree's top, and its words' figures."""
    slot, tallies, size, most = None, None, 0, 0

    def close() -> pa.RecordBatch:
        (gram, n), (word, m) = (t.total() for t in tallies)
        tops = []
        if len(gram):
            tree = Subtree(gram, n)
            top = tree.levels[-1]
            # contexts of one byte: the nearest, on top of the keys
            near = (tree.keys >> U64(8 * SHARED)).astype(np.int64)
            node = (tree.keys & U64(255)).astype(np.int64)
            place = near * _NODES + node
            found, at = np.unique(place, return_inverse=True)
            sums = [np.bincount(at, weights=v) for v in (top.n0, top.n1, top.log_pw)]
            tops = [{"near": int(p // _NODES), "node": int(p % _NODES), "n0": a, "n1": b, "longer": c}
                    for p, a, b, c in zip(found.tolist(), *(s.tolist() for s in sums), strict=True)]
        struct = pa.list_(pa.struct([("near", pa.int32()), ("node", pa.int32()), ("n0", pa.float64()), ("n1", pa.float64()), ("longer", pa.float64())]))
        held = dump(_steps(gram), n, _steps(word), m)
        return pa.RecordBatch.from_arrays(
            [pa.array([slot], pa.int64()), pa.array([held], pa.binary()), pa.array([tops], struct),
             pa.array([int(m.sum())], pa.int64()), pa.array([int((m > 0).sum())], pa.int64())],
            ["slot", "held", "tops", "n_words", "n_distinct"])

    for batch in batches:
        for s, blob in zip(batch.column("slot").to_pylist(), batch.column("asked"), strict=True):
            if s != slot:
                if tallies is not None:
                    yield close()
                slot, tallies, size, most = s, (_Tally(), _Tally()), 0, 1 << 21
            steps, n, word_steps, m = load(blob.as_py())
            for tally, keys, counts in ((tallies[0], steps, n), (tallies[1], word_steps, m)):
                tally.keys.append(np.cumsum(keys, dtype=U64))
                tally.counts.append(counts)
            size += len(n) + len(m)
            if size > most:  # merge; again after as many more as are left
                size = sum(len(t.total()[0]) for t in tallies)
                most = max(1 << 21, 2 * size)
    if tallies is not None:
        yield close()


_SLOTS = "slot long, held binary, tops array<struct<near:int,node:int,n0:double,n1:double,longer:double>>, n_words long, n_distinct long"


# 3. Answers ----------------------------------------------------------------------


def _answer(above: np.ndarray, share: np.ndarray, base):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            for slot, block, blob in zip(batch.column("slot").to_pylist(), batch.column("block").to_pylist(), batch.column("blob"), strict=True):
                steps, n, word_steps, m = load(blob.as_py())
                gram, word = np.cumsum(steps, dtype=U64), np.cumsum(word_steps, dtype=U64)
                if block is None:
                    logs = np.zeros(0)
                    if len(gram):
                        tree = Subtree(gram, n)
                        near, node = (tree.keys >> U64(8 * SHARED)).astype(np.int64), (tree.keys & U64(255)).astype(np.int64)
                        logs = tree.log_probs(above[near, node], share[near, node])
                    held = gram, logs, word, base(m), m > 0
                else:
                    at, w = np.searchsorted(held[0], gram), np.searchsorted(held[2], word)
                    out.append((block, slot, dump(steps, held[1][at], word_steps, held[3][w], held[4][w])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["block", "slot", "blob"])
    return run


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"


def _per_doc(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of each document's run of values (runs may be empty)."""
    out = np.zeros(len(sizes))
    some = sizes > 0
    starts = (np.cumsum(sizes) - sizes)[some]
    if len(starts):
        out[some] = np.add.reduceat(values, starts)
    return out


def _score(train_tokens: int, end_base: float, end_known: bool, slice_bytes: int = 2 << 20):
    """A block's answers, slot by slot, then its texts -> scores."""
    names = [f.split()[0] for f in _SCORED.split(", ")]

    def scored(answers: list, texts: tuple) -> Iterator[pa.RecordBatch]:
        gram, log, word, base, known = (np.concatenate(c) for c in zip(*answers, strict=True))
        by_gram, by_word = np.argsort(gram), np.argsort(word)
        gram, log, word, base, known = gram[by_gram], log[by_gram], word[by_word], base[by_word], known[by_word]
        ids, valid, train, length, data = texts
        ends = np.cumsum(length)
        group = (ends - length) // slice_bytes
        for a, b in zip(cuts := run_starts(group), np.append(cuts[1:], len(length)), strict=True):
            size = length[a:b]
            part = data[ends[a] - size[0]:ends[b - 1]]
            found, at = np.unique(grams(part, size), return_inverse=True)
            score = _per_doc(log[np.searchsorted(gram, found)][at], size)
            w = words_of(_as_texts(part, size))
            at = np.searchsorted(word, w.hash)
            n_known = _per_doc(known[at].astype(float), w.count).astype(np.int64) + end_known
            columns = [pa.array(ids[a:b], pa.int64(), mask=~valid[a:b]), pa.array(~train[a:b]), pa.array(w.count + 1), pa.array(n_known),
                       pa.array(np.full(b - a, train_tokens)), pa.array(_per_doc(base[at], w.count) + end_base), pa.array(score), pa.array(size)]
            yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, answers = None, []
        for batch in batches:
            for b, kind, blob in zip(batch.column("block").to_pylist(), batch.column("kind").to_pylist(), batch.column("blob"), strict=True):
                if b != block:
                    block, answers = b, []
                arrays = load(blob.as_py())
                if kind == 0:
                    steps, log, word_steps, base, known = arrays
                    answers.append((np.cumsum(steps, dtype=U64), log, np.cumsum(word_steps, dtype=U64), base, known))
                else:
                    yield from scored(answers, arrays)

    return run


def _as_texts(data: np.ndarray, length: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(length)))
    return pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo
    10, is 0. A null id counts as an empty text, whose crc32 is 0."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 10 == 0


def score(docs: DataFrame, train: Column | None = None, block_bytes: int = 16 << 20, slot_bytes: int = 16 << 20) -> DataFrame:
    """Per document of ``docs`` (doc_id, text): tokens (words and an end), those
    known from training, the unigram base score, the tree's score (both log10),
    and its bytes; ``-score * log2(10) / n_bytes`` is its code length per byte.

    ``train`` tells the rows to learn from (by default those not ``held_out``).
    A null text is an empty one, which has an end only; a null doc_id stays;
    repeated rows count and are scored each; other columns are not read; an empty
    table gives no rows. Without training rows every choice is a half.
    """
    spark = docs.sparkSession
    train = ~held_out() if train is None else F.coalesce(train, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), train.alias("train"))
    n_slots = bucket_count(docs, "text", slot_bytes)
    folder = scratch_dir(spark, "context-tree")
    docs.mapInArrow(_survey(n_slots, block_bytes), _BLOCKS).write.parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")
    asked = blocks.where("slot >= 0").select("slot", "block", F.col("asked").alias("blob"))
    slots = asked.select("slot", F.col("blob").alias("asked")).repartition("slot").sortWithinPartitions("slot").mapInArrow(_merge_slots, _SLOTS)
    slots.write.parquet(f"{folder}/slots")
    slots = spark.read.parquet(f"{folder}/slots")

    # At most 256 * 255 sums, and two figures: bounded whatever the input.
    top = slots.select(F.inline("tops")).groupBy("near", "node").agg(F.sum("n0"), F.sum("n1"), F.sum("longer"))
    above, share = top_tables([tuple(r) for r in top.collect()])
    words = slots.agg(F.sum("n_words"), F.sum("n_distinct")).first()
    ends = docs.where("train").count()
    n, v = (words[0] or 0) + ends, (words[1] or 0) + (ends > 0)
    base = _base(n, v)

    held = slots.select("slot", F.lit(None).cast("long").alias("block"), F.col("held").alias("blob"))
    met = held.unionByName(asked).repartition("slot").sortWithinPartitions("slot", F.col("block").asc_nulls_first())
    answers = met.mapInArrow(_answer(above, share, base), "block long, slot long, blob binary")
    rows = answers.select("block", F.lit(0).alias("kind"), "blob").unionByName(
        blocks.where("slot = -1").select("block", F.lit(1).alias("kind"), F.col("texts").alias("blob")))
    ordered = rows.repartition("block").sortWithinPartitions("block", "kind")
    return ordered.mapInArrow(_score(n, float(base(np.array([ends]))[0]), ends > 0), _SCORED)


def _base(n: int, v: int):
    """log10 of the smoothed share of a token counted c times."""
    return lambda c: np.log10((c + 0.1) / (n + 0.1 * (v + 1)))
