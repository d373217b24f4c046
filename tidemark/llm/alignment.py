"""Alignment of two tokenizers by inverted pair bitmaps.

Tokenizer A is a byte-level BPE file, B a sentencepiece model; both cover the
bytes of ``" " + text``. Where tokens of both end, the text is cut into
*groups*. Every stretch between neighbouring ends of either lies in exactly one
token of each, so the stretches are the *links*: all overlapping pairs.

A pair (A id, B id) is *scored* by the number of documents that hold it linked:

1. *Blocks.* A task numbers the documents of a block (about ``block_bytes`` of
   text, at most 65,536 documents) and inverts them: per pair a compressed
   bitmap of documents, a list of 16-bit numbers where sparse and plain bits
   where dense, and beside it *multiplicity planes*, one per binary digit of
   how often (less once) each of the documents holds it.
2. *Counts.* The bitmaps meet by a hash of the A id. Blocks hold different
   documents, so bitmaps of a pair OR-merge container by container: the
   popcounts of bitmaps add up to its documents, those of planes to its links.
   As containers stream by, a task holds counts, never bitmaps. The pairs of an
   A id are together, so the most frequent of them is known there too.
3. *Scores.* Counts go back to the blocks that hold the pair, and the block's
   postings (its bitmaps and planes, as written) return them to documents.

A pair that all documents hold costs one bit a document and plane, and one
entry a block elsewhere, so hot tokens and copies weigh no more than others.
The blocks are written once, so a lost executor repeats reads, not tokenising.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blobs import bucket_count, dump, filled, load, run_starts
from tidemark.llm.packing import _COMMON, _byte_letters
from tidemark.llm.words import U64, mix
from tidemark.session import scratch_dir

MOST_DOCS = 1 << 16  # document numbers in a block are 16 bits
_BLOCKS = "block long, slot long, docs binary, pairs binary, postings binary"

_pairs_of_tokenizers: dict[tuple[str, str], "Tokenizers"] = {}


class Tokenizers:
    """Both tokenizers of a process, and the bytes of their ids."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN

        spec = json.loads(open(a_path, encoding="utf-8").read())
        special = {t["content"] for t in spec["added_tokens"]}
        to_byte = {c: b for b, c in _byte_letters().items()}
        ranks = {bytes(to_byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.a_path, self._library = a_path, None
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        self.a_shown = [_shown(len(self.a_bytes), end) for end in (b",", b"|")]
        self.b_shown = [_shown(len(self.b_bytes), end) for end in (b",", b";", b"")]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode_a(self, text: str) -> list[int]:
        """Ids of a text, special strings in it ordinary text."""
        if _COMMON.fullmatch(text):
            return self.fast.encode_ordinary(text)
        if self._library is None:  # the two may carry different Unicode tables
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_file(self.a_path)
            self._library.encode_special_tokens = True
        return self._library.encode(text, add_special_tokens=False).ids


def _shown(n: int, end: bytes) -> np.ndarray:
    out = np.empty(n, object)
    out[:] = [b"%d%s" % (i, end) for i in range(n)]
    return out


def tokenizers_of(a_path: str, b_path: str) -> Tokenizers:
    key = a_path, b_path
    if key not in _pairs_of_tokenizers:
        _pairs_of_tokenizers[key] = Tokenizers(a_path, b_path)
    return _pairs_of_tokenizers[key]


def _encoded(texts: list, t: Tokenizers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of A and B of all texts in a row, and how many each text has (none if
    either does not give back the bytes of the text)."""
    a, b = [], []
    n_a, n_b = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for row, text in enumerate(texts):
        if not text:
            continue
        raw = b" " + text.encode()
        ids = t.encode_a(" " + text)
        if b"".join(map(t.a_bytes.__getitem__, ids)) != raw:
            continue
        others = t.b.encode(text)
        if b"".join(map(t.b_bytes.__getitem__, others)) != raw:
            continue
        a.append(np.array(ids, np.int64))
        b.append(np.array(others, np.int64))
        n_a[row], n_b[row] = len(ids), len(others)
    none = np.zeros(0, np.int64)
    return np.concatenate(a or [none]), np.concatenate(b or [none]), n_a, n_b


def _groups(a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, cuts: np.ndarray, n_a: np.ndarray,
            n_b: np.ndarray, t: Tokenizers) -> list[bytes]:
    """sha256 of every text's groups as written, b'' for one without tokens."""
    before_a, before_b = np.searchsorted(end_a, cuts, "right"), np.searchsorted(end_b, cuts, "right")
    group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
    written = np.empty(len(a) + len(b), object)
    # A's ids of a group come after B's of all earlier groups, and B's after A's
    # of this one.
    last_a = np.zeros(len(a), bool)
    last_a[before_a - 1] = True
    last_b = np.zeros(len(b), bool)
    last_b[before_b - 1] = True
    shown = t.a_shown[0][a]
    shown[last_a] = t.a_shown[1][a[last_a]]
    written[np.arange(len(a)) + np.concatenate(([0], before_b))[group_a]] = shown
    shown = t.b_shown[0][b]
    shown[last_b] = t.b_shown[1][b[last_b]]
    ends = np.cumsum(n_b)[n_b > 0] - 1
    shown[ends] = t.b_shown[2][b[ends]]
    written[np.arange(len(b)) + before_a[group_b]] = shown
    parts, out, at = written.tolist(), [], 0
    for n in (n_a + n_b).tolist():
        out.append(hashlib.sha256(b"".join(parts[at:at + n])).digest() if n else b"")
        at += n
    return out


def invert(texts: list, t: Tokenizers, first_doc: int = 0) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[bytes]]:
    """(pair, document) keys in order and how often each is linked; per text n_a,
    n_b, n_groups, n_links; its groups' digest. A key is A id, B id and document
    number in 24, 24 and 16 bits from the top."""
    a, b, n_a, n_b = _encoded(texts, t)
    end_a, end_b = np.cumsum(t.a_size[a]), np.cumsum(t.b_size[b])
    ends = np.union1d(end_a, end_b)
    cuts = np.intersect1d(end_a, end_b, assume_unique=True)
    text_ends = np.concatenate(([0], end_a))[np.cumsum(n_a)]
    stretches, groups = (np.diff(np.searchsorted(e, text_ends, "right"), prepend=0) for e in (ends, cuts))
    if not len(ends):
        none = np.zeros(0, U64)
        return none, none.astype(np.int64), [n_a, n_b, n_a, n_a], [b""] * len(texts)
    doc = np.repeat(np.arange(first_doc, first_doc + len(texts)), stretches)
    linked = a[np.searchsorted(end_a, ends)] << 40 | b[np.searchsorted(end_b, ends)] << 16 | doc
    keys, times = np.unique(linked.astype(U64), return_counts=True)
    return keys, times, [n_a, n_b, groups, stretches], _groups(a, b, end_a, end_b, cuts, n_a, n_b, t)


# Bitmaps ---------------------------------------------------------------------


def pack_bitmaps(docs: np.ndarray, times: np.ndarray, starts: np.ndarray, n_docs: int) -> bytes:
    """Bitmaps and planes of pairs whose postings begin at ``starts``."""
    sizes = np.diff(np.append(starts, len(docs)))
    width = -(-n_docs // 8)
    dense = 2 * sizes > width
    row = np.repeat(np.cumsum(dense) - 1, sizes)
    is_dense = np.repeat(dense, sizes)
    bits = np.zeros((int(dense.sum()), width), np.uint8)
    at = docs[is_dense]
    np.bitwise_or.at(bits, (row[is_dense], at >> 3), (1 << (at & 7)).astype(np.uint8))
    more = times - 1
    planes = [np.packbits((more >> j) & 1) for j in range(int(more.max(initial=0)).bit_length())]
    return dump(np.array([n_docs], np.int64), sizes.astype(np.uint32), docs[~is_dense].astype(np.uint16), bits.reshape(-1), *planes)


def _bitmaps(blob: bytes) -> tuple:
    (n_docs,), sizes, sparse, bits, *planes = load(blob)
    width = -(-int(n_docs) // 8)
    sizes = sizes.astype(np.int64)
    return int(n_docs), sizes, sparse, bits.reshape(-1, width), planes, 2 * sizes > width


def popcounts(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Per pair: documents by its bitmap, links by bitmap and planes."""
    _, sizes, _, bits, planes, dense = _bitmaps(blob)
    documents = sizes.copy()
    documents[dense] = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    links = documents.copy()
    for j, plane in enumerate(planes):
        marks = np.unpackbits(plane, count=int(sizes.sum())).astype(np.int64)
        links += np.add.reduceat(marks, starts) << j
    return documents, links


def postings(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per posting, in order of pairs: the pair's place, document, times."""
    _, sizes, sparse, bits, planes, dense = _bitmaps(blob)
    total = int(sizes.sum())
    pair = np.repeat(np.arange(len(sizes)), sizes)
    is_dense = np.repeat(dense, sizes)
    docs = np.empty(total, np.int64)
    docs[~is_dense] = sparse
    docs[is_dense] = np.nonzero(np.unpackbits(bits, axis=1, bitorder="little"))[1]
    times = np.ones(total, np.int64)
    for j, plane in enumerate(planes):
        times += np.unpackbits(plane, count=total).astype(np.int64) << j
    return pair, docs, times


# Stages ----------------------------------------------------------------------


def _slot(pairs: np.ndarray, n_slots: int) -> np.ndarray:
    """Where a pair meets its like: all pairs of an A id together."""
    return (mix(pairs >> U64(24)) % U64(n_slots)).astype(np.int64)


def _invert_blocks(a_path: str, b_path: str, n_slots: int, block_bytes: int):
    names = [f.split()[0] for f in _BLOCKS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def finish(block: int, held: list) -> Iterator[pa.RecordBatch]:
        ids, known, keys, times, counts, digests = zip(*held, strict=True)
        digests = [d for part in digests for d in part]
        columns = [np.concatenate([c[i] for c in counts]) for i in range(4)]
        has = np.array([bool(d) for d in digests])
        docs = dump(np.concatenate(ids), np.concatenate(known), *columns, has, np.frombuffer(b"".join(digests), np.uint8))
        rows = [(block, -1, docs, None, None)]
        key, n = np.concatenate(keys), np.concatenate(times)
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        if len(key):
            pair = key >> U64(16)
            starts = run_starts(pair)
            slot = _slot(pair[starts], n_slots)
            sizes = np.diff(np.append(starts, len(key)))
            by_slot = np.argsort(slot, kind="stable")
            cuts = run_starts(slot[by_slot])
            for chosen in np.split(by_slot, cuts[1:]):
                size = sizes[chosen]
                begins = np.cumsum(size) - size
                at = np.repeat(starts[chosen] - begins, size) + np.arange(size.sum())
                rows.append((block, int(slot[chosen[0]]), None, dump(pair[starts[chosen]]),
                             pack_bitmaps((key[at] & U64(MOST_DOCS - 1)).astype(np.int64), n[at], begins, len(digests))))
        for i in range(0, len(rows), 500):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + 500], strict=True), types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, turn = tokenizers_of(a_path, b_path), TaskContext.get().partitionId() << 24
        for part in filled(batches, "text", block_bytes):
            held, n = [], 0
            for piece in part:
                for start in range(0, piece.num_rows, 1000):
                    rows = piece.slice(start, 1000)
                    if n + rows.num_rows > MOST_DOCS:
                        yield from finish(turn, held)
                        held, n, turn = [], 0, turn + 1
                    doc_id = rows.column("doc_id")
                    keys, times, counts, digests = invert(rows.column("text").to_pylist(), t, n)
                    held.append((doc_id.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
                                 doc_id.is_valid().to_numpy(zero_copy_only=False), keys, times, counts, digests))
                    n += rows.num_rows
            yield from finish(turn, held)
            turn += 1

    return run


def invert_documents(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = 16 << 20, slot_bytes: int = 16 << 20) -> DataFrame:
    """The blocks of ``docs``, written to the shared folder: per block its
    documents' own figures (slot -1), and per slot pairs with their postings."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_slots = bucket_count(docs, "text", slot_bytes)
    path = f"{scratch_dir(docs.sparkSession, 'alignment')}/blocks"
    docs.mapInArrow(_invert_blocks(a_path, b_path, n_slots, block_bytes), _BLOCKS).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _merged(pairs: list, documents: list, links: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pair, n, m = map(np.concatenate, (pairs, documents, links))
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    starts = run_starts(pair)
    return pair[starts], np.add.reduceat(n[order], starts), np.add.reduceat(m[order], starts)


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks' bitmaps in order of slots -> each slot's pairs and counts."""
    slot, held, size = None, ([], [], []), 0

    def close() -> pa.RecordBatch:
        pair, n, m = _merged(*held)
        starts = run_starts(pair >> U64(24))
        best = np.repeat(np.maximum.reduceat(n, starts), np.diff(np.append(starts, len(pair)))) == n
        return pa.RecordBatch.from_arrays([pa.array([slot], pa.int64()), pa.array([dump(pair, n, m, best)], pa.binary())], ["slot", "counts"])

    for batch in batches:
        for s, pairs, blob in zip(batch.column("slot").to_pylist(), batch.column("pairs"), batch.column("postings"), strict=True):
            if s != slot:
                if size:
                    yield close()
                slot, held, size = s, ([], [], []), 0
            for column, values in zip(held, (load(pairs.as_py())[0], *popcounts(blob.as_py())), strict=True):
                column.append(values)
            size += len(held[0][-1])
            if size > 1 << 21:
                held = tuple([c] for c in _merged(*held))
                size = len(held[0][0])
                size = size if size < 1 << 20 else 1  # many distinct pairs: merge again only after as many more
    if size:
        yield close()


def pair_slots(blocks: DataFrame) -> DataFrame:
    """slot, counts: the pairs of a slot, their documents, links and whether
    they are the most frequent of their A id, in one value."""
    asked = blocks.where("slot >= 0").select("slot", "pairs", "postings")
    return asked.repartition("slot").sortWithinPartitions("slot").mapInArrow(_count_pairs, "slot long, counts binary")


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A slot's counts, then the pairs that blocks ask for -> their answers."""
    table = None
    for batch in batches:
        out = []
        for slot, block, blob in zip(batch.column("slot").to_pylist(), batch.column("block").to_pylist(), batch.column("blob"), strict=True):
            if block is None:
                table = load(blob.as_py())
            else:
                at = np.searchsorted(table[0], load(blob.as_py())[0])
                out.append((block, slot, dump(table[1][at], table[3][at])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["block", "slot", "blob"])


_ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's documents, then per slot its answers and postings -> scores."""
    names = [f.split()[0] for f in _ALIGNED.split(", ")]
    docs = best = total = answer = None

    def close() -> pa.RecordBatch:
        ids, known, n_a, n_b, n_groups, n_links, has, digests = docs
        shown, at = [], 0
        raw = digests.tobytes()
        for h in has:
            shown.append(raw[at:at + 32].hex() if h else "")
            at += 32 * int(h)
        figures = [n_a, n_b, n_groups, n_links, best, total]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64(), mask=~known), *(pa.array(f.astype(np.int64)) for f in figures), pa.array(shown, pa.string())], names)

    for batch in batches:
        for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob"), strict=True):
            value = blob.as_py()
            if kind == 0:
                if docs is not None:
                    yield close()
                docs = load(value)
                best, total = np.zeros(len(docs[0]), np.int64), np.zeros(len(docs[0]), np.int64)
            elif kind == 1:
                answer = load(value)
            else:
                pair, doc, times = postings(value)
                count, is_best = answer
                np.add.at(total, doc, times * count[pair])
                np.add.at(best, doc, times * is_best[pair])
    if docs is not None:
        yield close()


def align(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = 16 << 20, slot_bytes: int = 16 << 20) -> DataFrame:
    """Per document of ``docs`` (doc_id, text): tokens of A and B, groups, links,
    links whose pair is the most frequent of its A id, the sum of the links'
    counts, and the digest of its groups.

    A null or empty text, and one that either tokenizer does not give back byte
    by byte, has no tokens: zeros and an empty digest. A null doc_id stays;
    repeated rows are documents of their own, in counts too; other columns are
    not read; an empty table gives no rows. Ties for the most frequent pair all
    count as best.
    """
    blocks = invert_documents(docs, a_path, b_path, block_bytes, slot_bytes)
    path = f"{scratch_dir(docs.sparkSession, 'alignment')}/slots"
    pair_slots(blocks).write.parquet(path)
    none = F.lit(None).cast("long")
    held = docs.sparkSession.read.parquet(path).select("slot", none.alias("block"), F.col("counts").alias("blob"))
    asked = blocks.where("slot >= 0").select("slot", "block", F.col("pairs").alias("blob"))
    met = held.unionByName(asked).repartition("slot").sortWithinPartitions("slot", F.col("block").asc_nulls_first())
    answers = met.mapInArrow(_answer, "block long, slot long, blob binary")
    parts = [blocks.where("slot = -1").select("block", "slot", F.lit(0).alias("kind"), F.col("docs").alias("blob")),
             answers.select("block", "slot", F.lit(1).alias("kind"), "blob"),
             blocks.where("slot >= 0").select("block", "slot", F.lit(2).alias("kind"), F.col("postings").alias("blob"))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    ordered = rows.repartition("block").sortWithinPartitions("block", "slot", "kind")
    return ordered.mapInArrow(_score, _ALIGNED)


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column("counts"):
            pair, n, m, best = load(blob.as_py())
            for i in range(0, len(pair), 100_000):
                cut = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array((pair[cut] >> U64(24)).astype(np.int64)), pa.array((pair[cut] & U64(0xFFFFFF)).astype(np.int64)),
                                                  pa.array(n[cut]), pa.array(m[cut]), pa.array(best[cut])],
                                                 ["a_id", "b_id", "documents", "links", "is_best"])


def pair_counts(blocks: DataFrame) -> DataFrame:
    """a_id, b_id, documents, links and is_best of every linked pair."""
    return pair_slots(blocks).mapInArrow(_pair_rows, "a_id long, b_id long, documents long, links long, is_best boolean")
