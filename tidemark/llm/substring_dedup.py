"""Removal of repeated token spans by a compacted de Bruijn graph.

An edge of the graph is a window of ``WINDOW`` words; neighbouring windows of a
text are neighbouring edges. A word goes if a window that covers it also starts
in a document with a smaller doc_id. Most edges occur once, so the graph is
built from the repeated part only:

1. *Anchors.* Of the ``ANCHOR``-word runs in a window the one with the least
   hash is its anchor: about a quarter of all places, and equal windows have
   equal anchors. Anchors meet by hash; those of one document only are left out.
2. *Edges.* Windows whose anchor is repeated become edges: a 128-bit number and
   their place. Edges of one anchor meet; the source of an edge is the smallest
   (doc_id, place) that the task or bucket knows, and each later document's edge
   is repeated.
   Edges that a task finds side by side leave it as one piece (doc, start,
   length, source, source start); pieces end where the anchor changes.
3. *Compaction.* Pieces of a document that run along the same diagonal of the
   same source lie on one track. The node at which one piece closes is joined to
   the node at which another opens; a node of one piece in and one piece out does
   not branch and is inside a path. What is left are the paths' two ends, and
   rows, not windows, go through the remaining joins.
4. *Verification.* Paths are joined to the text at their source coordinates;
   a path counts only if the digest of its words equals that of the source.

Exact copies of a text are found first, by a 128-bit number of the whole text,
and take no part beyond their first document: all their windows start there.

Hot groups: a task sends each bucket at most two entries for an anchor, and one
document's entries for an edge, that it has met in several documents itself;
the others are settled in the task, and travel in parts that are groups of their
own. So what meets in a bucket grows with the
number of tasks and distinct windows, not with the copies of a passage. Joins on
the number of a text or on a source's span, which many documents may share, deal
the documents to ``DEALS`` parts of a key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.blobs import bucket_count, dump, filled, load, run_starts, sliding, spread
from tidemark.llm.salt import dealt_join
from tidemark.llm.words import U64, gram_mask, grams, words_of
from tidemark.session import scratch_dir

WINDOW = 13
ANCHOR = 6
SPAN = WINDOW - ANCHOR + 1  # anchor candidates in a window
PART = 1 << 18  # settled entries in one group
DEALS = 8

_BUCKETS = "bucket long, settled boolean, blob binary"
_NAMES = ["doc_id", "start", "length", "source_id", "source_start", "shared"]
_PIECES = "doc_id long, start long, length long, source_id long, source_start long, shared boolean"
_TRACK = ["doc_id", "source_id", "diagonal"]


def window_anchors(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchor runs' hashes, and each window's least one (0: crosses documents)."""
    g = grams(h, ANCHOR)
    least = sliding(np.minimum, g, SPAN)
    least[~gram_mask(doc, WINDOW)] = 0
    return g, least


def anchor_places(g: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Places that are the anchor of a window over them."""
    if not len(least):
        return np.zeros(0, np.int64)
    ends = np.zeros(SPAN - 1, U64)
    top = sliding(np.maximum, np.concatenate([ends, least, ends]), SPAN)
    return np.flatnonzero(top == g)


def _to_buckets(key: np.ndarray, doc: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (bucket, rest of the key, document), the bucket of each, and its
    32-bit rest."""
    bucket = ((key >> U64(32)) % U64(n_buckets)).astype(np.int64)
    rest = (key & U64(0xFFFFFFFF)).astype(np.uint32)
    order = np.lexsort((doc, rest, bucket))
    return order, bucket[order], rest[order]


def _rows(rows: list[tuple[int, bool, bytes]]) -> pa.RecordBatch:
    bucket, settled, blob = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(settled, pa.bool_()), pa.array(blob, pa.binary())],
                                      ["bucket", "settled", "blob"])


def _settled(turn: int, *arrays: np.ndarray) -> list[tuple[int, bool, bytes]]:
    """Entries that need no meeting, in parts of bounded size. Each part has a
    group of its own: a negative number by task, flush and part."""
    task, out = TaskContext.get().partitionId(), []
    for part, lo in enumerate(range(0, len(arrays[0]), PART)):
        group = hashlib.blake2b(f"{task} {turn} {part}".encode(), digest_size=8).digest()
        out.append((-1 - (int.from_bytes(group) >> 1), True, dump(*(a[lo:lo + PART] for a in arrays))))
    return out


def _doc_ids(part: pa.RecordBatch) -> np.ndarray:
    return part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)


# 1. Anchors --------------------------------------------------------------


def _send_anchors(n_buckets: int, flush_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for turn, held in enumerate(filled(batches, "text", flush_bytes)):
            keys, ids, places = [], [], []
            for part in held:
                part = part.filter(part.column("doc_id").is_valid())
                if not part.num_rows:
                    continue
                w = words_of(part.column("text"))
                at = anchor_places(*(a := window_anchors(w.hash, w.doc)))
                keys.append(a[0][at])
                ids.append(_doc_ids(part)[w.doc[at]])
                places.append(at - w.first[w.doc[at]])
            if not keys:
                continue
            key, doc, place = map(np.concatenate, (keys, ids, places))
            order, bucket, rest = _to_buckets(key, doc, n_buckets)
            doc, place, key = doc[order], place[order], key[order]
            starts = run_starts(key)
            if not len(starts):
                continue
            several = spread(np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts), starts, len(key))
            send = ~several
            send[starts] = True  # two documents tell other tasks of a key repeated here
            send[np.append(starts[1:], len(key)) - 1] = True
            rows = _settled(turn, doc[several], place[several].astype(np.uint32))
            bucket, rest, doc, place = bucket[send], rest[send], doc[send], place[send]
            cuts = run_starts(bucket)
            for a, b in zip(cuts, np.append(cuts[1:], len(bucket)), strict=True):
                table, local = np.unique(doc[a:b], return_inverse=True)
                rows.append((int(bucket[a]), False, dump(np.diff(rest[a:b], prepend=np.uint32(0)), table,
                                                         local.astype(np.uint32), place[a:b].astype(np.uint32))))
            yield _rows(rows)
    return run


def _repeated_anchors(table: pa.Table) -> pa.Table:
    """Places (doc_id, place) of a bucket's anchors that two documents have."""
    out, rests, docs, places = [], [], [], []
    for settled, blob in zip(table.column("settled").to_pylist(), table.column("blob").to_pylist(), strict=True):
        arrays = load(blob)
        if settled:
            out.append((arrays[0], arrays[1]))
            continue
        rests.append(np.cumsum(arrays[0], dtype=np.uint32))
        docs.append(arrays[1][arrays[2]])
        places.append(arrays[3])
    if rests:
        rest, doc, place = map(np.concatenate, (rests, docs, places))
        order = np.argsort(rest, kind="stable")
        rest, doc, place = rest[order], doc[order], place[order]
        starts = run_starts(rest)
        several = spread(np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts), starts, len(rest))
        out.append((doc[several], place[several]))
    doc, place = (np.concatenate([o[i] for o in out]) for i in (0, 1))
    return pa.table({"doc_id": doc, "place": place.astype(np.int32)})


# 2. Edges ------------------------------------------------------------------


def pieces(doc: np.ndarray, at: np.ndarray, source: np.ndarray, source_at: np.ndarray, shared: np.ndarray) -> list[np.ndarray]:
    """Repeated edges that lie side by side as one piece; ``length`` in edges.
    Those of a ``shared`` id may be of different texts and stay single."""
    order = np.lexsort((at, doc))
    doc, at, source, source_at, shared = (x[order] for x in (doc, at, source, source_at, shared))
    n = np.arange(len(at))
    starts = run_starts(doc, source, at - source_at, at - n, np.where(shared, n, -1))
    return [doc[starts], at[starts], np.diff(np.append(starts, len(doc))), source[starts], source_at[starts], shared[starts]]


def _sources(a: np.ndarray, b: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of edges by number and place, and the smallest place of each as
    an index into that order."""
    order = np.lexsort((at, doc, b, a))
    starts = run_starts(a[order], b[order])
    return order, spread(starts, starts, len(order))


def _later(a: np.ndarray, b: np.ndarray, doc: np.ndarray, at: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Edges that no smaller document has, and the others as pieces."""
    order, first = _sources(a, b, doc, at)
    doc, at, shared = doc[order], at[order], shared[order]
    later = doc > doc[first]
    source = first[later]
    return order[~later], pieces(doc[later], at[later], doc[source], at[source], shared[later] | shared[source])


def _send_edges(n_buckets: int, flush_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for turn, held in enumerate(filled(batches, "text", flush_bytes)):
            found: list[tuple] = []
            for part in held:
                part = part.filter(part.column("places").is_valid())
                if part.num_rows:
                    found.append(_edges_of(part))
            if not any(len(f[0]) for f in found):
                continue
            a, b, doc, at, shared, anchor = (np.concatenate([f[i] for f in found]) for i in range(6))
            send, repeated = _later(a, b, doc, at, shared)
            rows = _settled(turn, *repeated)
            bucket = ((anchor[send] >> U64(32)) % U64(n_buckets)).astype(np.int64)
            order = np.lexsort((at[send], doc[send], bucket))  # neighbours in a text lie together
            send, bucket = send[order], bucket[order]
            cuts = run_starts(bucket)
            for lo, hi in zip(cuts, np.append(cuts[1:], len(bucket)), strict=True):
                s = send[lo:hi]
                rows.append((int(bucket[lo]), False, dump(a[s], b[s], doc[s], at[s].astype(np.uint32), shared[s])))
            yield _rows(rows)
    return run


def _edges_of(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Windows over the repeated anchors of some documents."""
    w, other = words_of(part.column("text")), words_of(part.column("text"), seed=2)
    _, least = window_anchors(w.hash, w.doc)
    n = len(least)
    places = part.column("places")
    row = np.repeat(np.arange(part.num_rows), np.diff(places.offsets.to_numpy()))
    anchor = w.first[row] + places.flatten().to_numpy()
    inside = anchor < w.first[row] + w.count[row]  # rows that share a doc_id may have shorter texts
    anchor, row = anchor[inside], row[inside]
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, np.clip(np.maximum(anchor - SPAN + 1, w.first[row]), 0, n), 1)
    np.add.at(mark, np.clip(anchor + 1, 0, n), -1)
    at = np.flatnonzero((np.cumsum(mark[:n]) > 0) & (least > 0))
    doc = w.doc[at]
    shared = part.column("shared").to_numpy(zero_copy_only=False).astype(np.uint8)
    return (_at(w.hash, at), _at(other.hash, at), _doc_ids(part)[doc], at - w.first[doc], shared[doc], least[at])


def _at(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    return grams(h, WINDOW)[at] if len(at) else np.zeros(0, U64)


def _repeated_edges(table: pa.Table) -> pa.Table:
    """Pieces of a bucket's edges that also start in a smaller document."""
    settled, entries = [], []
    for is_settled, blob in zip(table.column("settled").to_pylist(), table.column("blob").to_pylist(), strict=True):
        (settled if is_settled else entries).append(load(blob))
    if entries:
        a, b, doc, at, shared = (np.concatenate([e[i] for e in entries]) for i in range(5))
        settled.append(_later(a, b, doc, at.astype(np.int64), shared)[1])
    columns = [np.concatenate([s[i] for s in settled]) for i in range(len(_NAMES))]
    return pa.table(dict(zip(_NAMES, [*(c.astype(np.int64) for c in columns[:-1]), columns[-1].astype(bool)], strict=True)))


# 3. Compaction -------------------------------------------------------------


def compacted(found: DataFrame) -> DataFrame:
    """Pieces as paths (doc_id, start, length, source_id, source_start).

    A piece runs from the node ``start`` to the node ``start + length`` of its
    track. Nodes at which one piece closes and one opens are inside a path; of
    the others a path's opening and closing node follow each other. A doc_id of
    several rows (``shared``) may have pieces of different texts on a track:
    those stay as they are.
    """
    on_track = found.where("not shared").withColumn("diagonal", F.col("start") - F.col("source_start"))
    opens = on_track.groupBy(*_TRACK, F.col("start").alias("node")).agg(F.count("*").alias("opens"))
    closes = on_track.groupBy(*_TRACK, (F.col("start") + F.col("length")).alias("node")).agg(F.count("*").alias("closes"))
    ends = opens.join(closes, [*_TRACK, "node"], "full").where("not (opens <=> 1 and closes <=> 1)")
    follows = F.lead("node").over(Window.partitionBy(*_TRACK).orderBy("node"))
    compact = ends.withColumn("end", follows).where("opens = 1").select(
        "doc_id", F.col("node").alias("start"), (F.col("end") - F.col("node")).alias("length"), "source_id",
        (F.col("node") - F.col("diagonal")).alias("source_start"))
    return compact.unionByName(found.where("shared").drop("shared"))


# 4. Verification and removal ----------------------------------------------


def _span_digest(words: list[bytes], start: int, length: int) -> bytes:
    return hashlib.blake2b(b" ".join(words[start:start + length + WINDOW - 1]), digest_size=16).digest()


def _text_words(value: pa.Scalar) -> list[bytes]:
    return value.as_buffer().to_pybytes().split() if value.is_valid else []


def _source_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for doc_id, text, asked in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("asked"), strict=True):
            if asked.is_valid:
                words = _text_words(text)
                out += [(doc_id, s["source_start"], s["length"], _span_digest(words, s["source_start"], s["length"])) for s in asked.as_py()]
        columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
            ["source_id", "source_start", "length", "digest"])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, removed, digests, texts = [], [], [], []
        for text, copy, spans in zip(batch.column("text"), batch.column("is_copy").to_pylist(), batch.column("spans"), strict=True):
            words = _text_words(text)
            gone = np.zeros(len(words), bool)
            if copy and len(words) >= WINDOW:
                gone[:] = True
            elif spans.is_valid:
                for s in spans.as_py():
                    if _span_digest(words, s["start"], s["length"]) == s["digest"]:
                        gone[s["start"]:s["start"] + s["length"] + WINDOW - 1] = True
            left = b" ".join([x for x, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words)
            counts.append(len(words))
            removed.append(int(gone.sum()))
            digests.append(hashlib.sha256(left).hexdigest())
            texts.append(left)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests),
             pa.array(texts, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def _text_number() -> list[Column]:
    """The number of a whole text: two hashes and its length."""
    text = F.col("text")
    return [F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("h2"), F.octet_length(text).alias("n")]


def _is_copy() -> Column:
    """Whether a row's own text is among those ``copied`` under its doc_id."""
    return F.coalesce(F.array_contains("copied", F.struct(*_text_number())), F.lit(False))


def repeated_pieces(docs: DataFrame, bucket_bytes: int = 16 << 20, flush_bytes: int = 16 << 20) -> tuple[DataFrame, DataFrame]:
    """Pieces of repeated edges, not yet compacted or verified, and the texts
    that are whole copies, by doc_id (``copied``).

    Pieces: (doc_id, start, length, source_id, source_start, shared), length in
    edges; ``shared`` if one of the ids is that of several rows.
    """
    n_buckets = bucket_count(docs, "text", bucket_bytes)
    whole = docs.where("doc_id is not null").groupBy(*_text_number())
    first = whole.agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last and n is not null")
    copies = (dealt_join(docs.select("doc_id", *_text_number()), first, ["h", "h2", "n"], "doc_id", DEALS).where("doc_id > first")
              .groupBy("doc_id").agg(F.collect_set(F.struct("h", "h2", "n")).alias("copied")))

    sent = docs.mapInArrow(_send_anchors(n_buckets, flush_bytes), _BUCKETS)
    anchors = sent.groupBy("bucket").applyInArrow(_repeated_anchors, "doc_id long, place int")
    places = anchors.groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    several = docs.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    looked = docs.join(places, "doc_id", "left").join(copies, "doc_id", "left").join(several, "doc_id", "left").select(
        "doc_id", "text", F.when(~_is_copy(), F.col("places")).alias("places"), F.col("rows").isNotNull().alias("shared"))
    edges = looked.mapInArrow(_send_edges(n_buckets, flush_bytes), _BUCKETS)
    return edges.groupBy("bucket").applyInArrow(_repeated_edges, _PIECES), copies


def _written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def dedup_substrings(docs: DataFrame, bucket_bytes: int = 16 << 20, flush_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept_text of every document.

    A null text has no words. A document without doc_id keeps all its words and
    is no source. Rows that share a doc_id are each judged on their own text,
    and none is a source for the others, as no id is smaller. Texts under
    ``WINDOW`` words keep all. Other columns are not read; an empty table gives
    no rows. Pieces and paths are written to the shared folder once each.
    """
    docs = docs.select("doc_id", "text")
    found, copies = repeated_pieces(docs, bucket_bytes, flush_bytes)
    found = _written(compacted(_written(found, "pieces")), "paths")
    span = ["source_id", "source_start", "length"]
    asked = found.select(*span).distinct().groupBy(F.col("source_id").alias("doc_id")).agg(
        F.collect_list(F.struct("source_start", "length")).alias("asked"))
    digests = docs.join(asked, "doc_id", "left").mapInArrow(
        _source_digests, "source_id long, source_start long, length long, digest binary")
    spans = dealt_join(found, digests, span, "doc_id", DEALS).groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "length", "digest")).alias("spans"))
    rows = docs.join(spans, "doc_id", "left").join(copies, "doc_id", "left")
    return rows.select("doc_id", "text", _is_copy().alias("is_copy"), "spans").mapInArrow(
        _remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
