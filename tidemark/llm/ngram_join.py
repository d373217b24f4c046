"""N-gram Jaccard join by prefix trees.

A document's set holds its distinct shingles of ``shingle`` words, ordered by one global
order: shingles met in many documents last, by frequency, all others by hash.
Two sets with a Jaccard similarity of ``percent`` or more agree in a shingle
among the first ``n - ceil(percent * n) + 1`` of each, so those few are sent out
and meet by shingle; the order makes them rare.

What meets often enough is a candidate (``_enough``: the leading shingles two
sets share bound all they can share), and a candidate is settled in a *prefix
tree*: the candidates of a document form a trie over their ordered sets, in
which sets that begin alike share a path. The document's own set walks the trie, counts its
overlap once per shared path, and leaves a subtree as soon as the overlap so far
and the lengths that remain cannot reach the similarity.

Groups of near copies are joined without looking at all their pairs:

1. Equal sets are one node; they are linked by their fingerprint.
2. Of the documents that meet at a shingle, each is compared with a few leaders.
   A leader has the least hash of its id, so a group finds the same leaders at
   most shingles, and a copy that is unlike one is like another. Links give
   first components.
3. Where documents of different components meet, those pairs are compared, by
   sketches first, which bound in how many shingles two sets differ, and only
   those. No link is lost: a pair that is not compared lies in one
   component already, or shares no leading shingle.

Leaders with many candidates are split into blocks, each with its own trie.
Tables between the steps are checkpointed in the shared folder, and a step's
shuffle files go when it ends; components are
found by star contraction in Spark, nothing is gathered on the driver but the
table of frequent shingles, which has ``HOT`` rows at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blobs import bucket_count, dump, filled, load, run_starts, spread
from tidemark.llm.steps import shuffles_dropped
from tidemark.llm.words import U64, grams, mix, slices, words_of
from tidemark.session import scratch_root

SHINGLE = 3  # words of a shingle by the contract of the query op7; other callers name their own
HOT = 65_536  # frequent shingles that have a place of their own in the order
HOT_TIMES = 3  # documents of one flush that make a shingle worth reporting
SKETCH = 1024  # bits of a set's parity sketch
TOGETHER = 2048  # documents of a shingle that one task compares with each other
LEADERS = 4  # documents of a shingle that all others there are compared with
PART = 1 << 18  # entries settled by a flush in one group
BLOCK = 512  # candidates of a leader in one trie

_SURVEY = "doc_id long, n_shingles long, fp1 long, fp2 long, bits binary, shingle long, times long"


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingles of every text, sorted by hash. A text of fewer words
    than a shingle has its whole sequence as one; one without words has none."""
    w = words_of(texts, lower=True)
    runs = {k: grams(w.hash, k) for k in range(1, shingle + 1)}
    out = []
    for first, count in zip(w.first.tolist(), w.count.tolist(), strict=True):
        k = min(count, shingle)
        s = np.sort(runs[k][first:first + count - k + 1]) if k else np.zeros(0, U64)
        out.append(s[run_starts(s)])
    return out


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set (signed, as Spark's long)."""
    with np.errstate(over="ignore"):
        a = mix(s + U64(1)).sum(dtype=U64)
        b = mix(s ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def sketch(s: np.ndarray) -> bytes:
    """One bit per shingle, of even or odd number: two sets differ in at least as
    many shingles as their sketches differ in bits."""
    places, times = np.unique(s % U64(SKETCH), return_counts=True)
    odd = np.zeros(SKETCH, np.uint8)
    odd[places[times % 2 == 1].astype(np.int64)] = 1
    return np.packbits(odd).tobytes()


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of n shares with any set it is linked to."""
    return -(-percent * n // 100)


def _survey(shingle: int, flush_bytes: int):
    """Per document its size and fingerprint; per flush its frequent shingles."""
    names = [f.split()[0] for f in _SURVEY.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in filled(batches, "text", flush_bytes):
            sets = []
            for part in held:
                found = shingle_sets(part.column("text"), shingle)
                prints = [fingerprint(s) for s in found]
                n = pa.nulls(len(found), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in found], pa.int64()), pa.array([p[0] for p in prints], pa.int64()),
                     pa.array([p[1] for p in prints], pa.int64()), pa.array([sketch(s) for s in found], pa.binary()), n, n], names)
                sets += found
            every = np.sort(np.concatenate(sets)) if sets else np.zeros(0, U64)
            starts = run_starts(every)
            times = np.diff(np.append(starts, len(every)))
            top = np.flatnonzero(times >= HOT_TIMES)
            top = top[np.argsort(-times[top], kind="stable")[:HOT]]
            none = pa.nulls(len(top), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, none, pa.nulls(len(top), pa.binary()), pa.array(every[starts[top]].view(np.int64)), pa.array(times[top].astype(np.int64))], names)
    return run


class Order:
    """The global order: shingles that are not in the table of frequent ones
    first, by hash; then the table's, the less frequent first."""

    def __init__(self, hot: np.ndarray, times: np.ndarray):
        by_value = np.argsort(hot)
        rank = np.empty(len(hot), np.int64)
        rank[np.lexsort((hot, times))] = np.arange(1, len(hot) + 1)
        self.hot, self.rank = hot[by_value], rank[by_value]

    def ordered(self, s: np.ndarray) -> np.ndarray:
        if not len(self.hot) or not len(s):
            return s
        at = np.minimum(np.searchsorted(self.hot, s), len(self.hot) - 1)
        is_hot = self.hot[at] == s
        if not is_hot.any():
            return s
        return np.concatenate([s[~is_hot], s[is_hot][np.argsort(self.rank[at[is_hot]])]])


_PREFIXES = "bucket long, known boolean, blob binary"
_MEETINGS = "shingle long, doc_id long, fp long, n long"


def _near(key: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
    """Which entries, sorted by key and size, have one of like size at their key."""
    near = (key[1:] == key[:-1]) & (100 * size[:-1] >= percent * size[1:])
    keep = np.zeros(len(key), bool)
    keep[1:] |= near
    keep[:-1] |= near
    return keep


def _blob(rest: np.ndarray, doc: np.ndarray, *columns: np.ndarray) -> bytes:
    """Entries sorted by ``rest``, the documents' values once for each document."""
    table, local = np.unique(doc, return_inverse=True)
    return dump(np.diff(rest, prepend=np.uint32(0)), local.astype(np.uint32), *(c[table] for c in columns))


def _send_prefixes(order: Order, n_buckets: int, percent: int, shingle: int, flush_bytes: int):
    """Leading shingles by bucket. Equal sets of a flush send the smallest id.

    What meets within the flush is known to meet: it travels in parts, each of
    which has a group of its own (a negative number by task, flush and part), and
    only one entry a shingle goes to the bucket, marked ``known``, to tell the
    entries of other flushes. So a bucket holds, besides entries that met nothing
    of like size in their flush, one entry a flush of a shingle, however many
    documents have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for turn, held in enumerate(filled(batches, "text", flush_bytes)):
            best: dict[tuple, tuple] = {}
            for part in held:
                for doc_id, s in zip(part.column("doc_id").to_pylist(), shingle_sets(part.column("text"), shingle), strict=True):
                    if doc_id is not None and len(s):
                        p = (*fingerprint(s), len(s))
                        if p not in best or doc_id < best[p][0]:
                            leading = len(s) - least_overlap(len(s), percent) + 1
                            best[p] = (doc_id, order.ordered(s)[:leading].copy())
            if not best:
                continue
            prints, docs = list(best), list(best.values())
            counts = np.array([len(d[1]) for d in docs])
            key = np.concatenate([d[1] for d in docs])
            doc = np.repeat(np.arange(len(docs)), counts)
            bucket = ((key >> U64(32)) % U64(n_buckets)).astype(np.int64)
            rest = (key & U64(0xFFFFFFFF)).astype(np.uint32)
            ids, fp = np.array([d[0] for d in docs], np.int64), np.array([p[0] for p in prints], np.int64)
            size = np.array([p[2] for p in prints], np.int64)
            by = np.lexsort((size[doc], rest, bucket))
            bucket, rest, doc = bucket[by], rest[by], doc[by]
            place = (bucket << 32) | rest
            met = _near(place, size[doc], percent)
            rows = []
            settled = np.flatnonzero(met)
            for part, lo in enumerate(range(0, len(settled), PART)):
                at = settled[lo:lo + PART]
                group = hashlib.blake2b(f"{task} {turn} {part}".encode(), digest_size=8).digest()
                rows.append((-1 - (int.from_bytes(group) >> 1), True, dump(place[at], ids[doc[at]], fp[doc[at]], size[doc[at]].astype(np.uint32))))
            tells = settled[run_starts(place[settled])]
            for known, send in ((True, tells), (False, np.flatnonzero(~met))):
                cuts = np.append(run_starts(bucket[send]), len(send))
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    at = send[a:b]
                    rows.append((int(bucket[at[0]]), known, _blob(rest[at], doc[at], ids, fp, size.astype(np.uint32))))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.bool_()),
                                              pa.array([r[2] for r in rows], pa.binary())], ["bucket", "known", "blob"])
    return run


def _meetings(percent: int):
    """Documents of a bucket that meet others of like size at a shingle, or one
    that is known to meet others there; parts that are settled, as they are."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        blobs = [load(b) for b in table.column("blob").to_pylist()]
        if bucket < 0:
            place, ids, fp, size = (np.concatenate([p[i] for p in blobs]) for i in range(4))
            return pa.table({"shingle": place, "doc_id": ids, "fp": fp, "n": size.astype(np.int64)})
        rest = np.concatenate([np.cumsum(p[0], dtype=np.uint32) for p in blobs])
        known = np.repeat(table.column("known").to_numpy(), [len(p[0]) for p in blobs])
        ids, fp, size = (np.concatenate([p[i][p[1]] for p in blobs]) for i in (2, 3, 4))
        size = size.astype(np.int64)
        by = np.lexsort((ids, fp, size, rest))
        rest, ids, fp, size, known = rest[by], ids[by], fp[by], size[by], known[by]
        starts = run_starts(rest)
        known = spread(np.logical_or.reduceat(known, starts), starts, len(rest)) if len(rest) else known
        first = run_starts(rest, size, fp)  # equal sets: the smallest id
        rest, ids, fp, size, known = rest[first], ids[first], fp[first], size[first], known[first]
        keep = _near(rest, size, percent) | known
        return pa.table({"shingle": (rest[keep].astype(np.int64) | (bucket << 32)), "doc_id": ids[keep], "fp": fp[keep], "n": size[keep]})
    return run


def meetings(docs: DataFrame, order: Order, percent: int, shingle: int, bucket_bytes: int, flush_bytes: int) -> DataFrame:
    """(shingle, doc_id, n): the documents that meet others at a leading shingle,
    of equal sets the smallest id. Buckets only find who meets; the rows of one
    shingle are brought together by aggregates and joins, which Spark splits."""
    n_buckets = bucket_count(docs, "text", bucket_bytes)
    sent = docs.mapInArrow(_send_prefixes(order, n_buckets, percent, shingle, flush_bytes), _PREFIXES)
    met = sent.groupBy("bucket").applyInArrow(_meetings(percent), _MEETINGS)
    return met.groupBy("shingle", "fp", "n").agg(F.min("doc_id").alias("doc_id")).select("shingle", "doc_id", "n")


def _like(percent: int, a: str, b: str) -> Column:
    """Sizes that allow a link."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (100 * n >= percent * m) & (100 * m >= percent * n)


def _enough(meetings: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of meetings (a, b, n_a, n_b; one row per shingle) that may
    be linked by the number of leading shingles they share.

    Take the set whose leading shingles end first in the order. What it shares
    among them is leading in the other set too, so it is counted; the rest of it
    has ``least_overlap(n) - 1`` shingles, and no more can be shared there."""
    rest = lambda n: F.floor((percent * F.col(n) + 99) / 100) - 1
    shared = meetings.groupBy("a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("c"))
    most = F.col("c") + F.greatest(rest("n_a"), rest("n_b"))
    return shared.where((100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _across(percent: int):
    """Rows (shingle, i, j, block, doc_id, component, n, bits) sorted by the first
    three: the pairs (a, b, n_a, n_b) of different components whose sketches allow
    a link, once for each shingle they meet at."""

    def pairs(rows: list[tuple], within: bool) -> list[np.ndarray]:
        block, ids, comp, n = (np.array([r[k] for r in rows], np.int64) for k in range(4))
        bits = np.frombuffer(b"".join(r[4] for r in rows), U64).reshape(len(rows), -1)
        out = []
        for lo in range(0, len(rows), 64):
            hi = min(lo + 64, len(rows))
            differ = np.bitwise_count(bits[lo:hi, None, :] ^ bits[None, :, :]).sum(2, dtype=np.int64)
            both = n[lo:hi, None] + n[None, :]
            good = ((100 + percent) * differ <= (100 - percent) * both) & (comp[lo:hi, None] != comp[None, :])
            good &= (100 * n[lo:hi, None] >= percent * n[None, :]) & (100 * n[None, :] >= percent * n[lo:hi, None])
            if not within:
                good &= block[lo:hi, None] != block[None, :]
            x, y = np.nonzero(good & (ids[lo:hi, None] < ids[None, :]))
            out.append((ids[lo:hi][x], ids[y], n[lo:hi][x], n[y]))
        return [np.concatenate(o) for o in zip(*out, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def found() -> Iterator[pa.RecordBatch]:
            if len(rows) > 1:
                columns = pairs(rows, key[1] == key[2])
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "n_a", "n_b"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shingle", "i", "j", "block", "doc_id", "component", "n", "bits")]
            for row in zip(*columns, strict=True):
                if row[:3] != key:
                    yield from found()
                    key, rows = row[:3], []
                rows.append(row[3:])
        yield from found()
    return run


def across_components(apart: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that meet at a shingle and may be
    linked. A shingle of many documents is dealt out in pairs of blocks, so that
    a task holds two blocks of it at most."""
    sized = apart.join(apart.groupBy("shingle").agg(F.ceil(F.count(F.lit(1)) / TOGETHER).cast("int").alias("blocks")), "shingle")
    dealt = sized.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")).withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("shingle", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block",
                         "doc_id", "component", "n").join(sketches, "doc_id")
    rows = dealt.repartition("shingle", "i", "j").sortWithinPartitions("shingle", "i", "j")
    return _enough(rows.mapInArrow(_across(percent), "a long, b long, n_a long, n_b long"), percent)


class PrefixTree:
    """A trie over ordered sets, paths without branches kept as one array."""

    __slots__ = ("path", "children", "ids", "least", "rest")

    def __init__(self, path: np.ndarray):
        self.path, self.children, self.ids = path, {}, []
        self.least, self.rest = 1 << 62, 0  # smallest set below; longest way below the path

    def add(self, s: np.ndarray, key: object, size: int) -> None:
        self.least, self.rest = min(self.least, size), max(self.rest, len(s))
        if not len(s):
            self.ids.append((key, size))
            return
        child = self.children.get(int(s[0]))
        if child is None:
            child = self.children[int(s[0])] = PrefixTree(s)
        m = min(len(child.path), len(s))
        differ = np.flatnonzero(child.path[:m] != s[:m])
        same = int(differ[0]) if len(differ) else m
        if same < len(child.path):
            upper = PrefixTree(child.path[:same])
            lower, child.path = child, child.path[same:]
            upper.children[int(lower.path[0])] = lower
            upper.least, upper.rest = lower.least, lower.rest + len(lower.path)
            child = self.children[int(s[0])] = upper
        child.add(s[same:], key, size)

    def linked(self, probe: np.ndarray, percent: int) -> Iterator[object]:
        """Keys of the sets whose similarity with ``probe`` (sorted by hash) is
        ``percent`` or more."""
        n = len(probe)
        todo = [(self, 0)]
        while todo:
            node, overlap = todo.pop()
            if len(node.path):
                at = np.minimum(np.searchsorted(probe, node.path), n - 1)
                overlap += int((probe[at] == node.path).sum())
            if (100 + percent) * (overlap + min(node.rest, n - overlap)) < percent * (n + node.least):
                continue
            yield from (k for k, size in node.ids if (100 + percent) * overlap >= percent * (n + size))
            todo += [(c, overlap) for c in node.children.values()]


def _settle(order: Order, percent: int, shingle: int):
    """Rows (leader, block, role, doc_id, text) sorted so that a leader's own
    text comes first: the linked pairs of every (leader, block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, probe, tree = None, None, None

        def links() -> list[tuple[int, int]]:
            return [(group[0], d) for d in tree.linked(probe, percent)] if tree else []

        for batch in batches:
            for part in slices(batch, "text"):
                found: list[tuple[int, int]] = []
                keys = zip(*(part.column(c).to_pylist() for c in ("leader", "block", "role", "doc_id")), strict=True)
                for (leader, block, role, doc_id), s in zip(keys, shingle_sets(part.column("text"), shingle), strict=True):
                    if (leader, block) != group:
                        found += links()
                        group, probe, tree = (leader, block), None, None
                    if role == 0:
                        probe, tree = s.copy(), PrefixTree(s[:0])
                    elif tree is not None:
                        tree.add(order.ordered(s).copy(), doc_id, len(s))
                if found:
                    yield _pairs(found)
        if found := links():
            yield _pairs(found)
    return run


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def settle(pairs: DataFrame, docs: DataFrame, order: Order, percent: int, shingle: int) -> DataFrame:
    """The linked ones (a, b) of candidate pairs (a: leader, b).

    Texts travel to the tries, not sets: a compressed text is a third of its
    shingles' hashes."""
    sized = pairs.join(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("many")), "a")
    block = F.pmod(F.xxhash64("b"), F.ceil(F.col("many") / BLOCK)).cast("int")
    blocked = sized.select(F.col("a").alias("leader"), block.alias("block"), F.col("b").alias("doc_id"))
    members = blocked.withColumn("role", F.lit(1))
    leaders = blocked.select("leader", "block", F.col("leader").alias("doc_id")).distinct().withColumn("role", F.lit(0))
    needed = members.unionByName(leaders).groupBy("doc_id").agg(F.collect_list(F.struct("leader", "block", "role")).alias("needed"))
    rows = docs.join(needed, "doc_id").select("doc_id", "text", F.inline("needed"))
    return rows.repartition("leader", "block").sortWithinPartitions("leader", "block", "role").mapInArrow(
        _settle(order, percent, shingle), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(doc_id, component) of every id in ``links`` (a, b): the smallest id that
    it is connected with. Star contraction: every id is tied to the smallest one
    near it, in turns over its larger and its smaller neighbours, until nothing
    changes; a constant number of edges each turn, about a logarithm of turns.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        tied = small.select(F.col("u"), F.col("m").alias("v")).union(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct().checkpoint()
        same = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if same == tied.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first():
            break
        edges = tied
    roots = tied.select(F.col("v").alias("u"), F.col("v").alias("m")).union(tied.select("u", F.col("v").alias("m")))
    return roots.groupBy(F.col("u").alias("doc_id")).agg(F.min("m").alias("component"))


def jaccard_components(docs: DataFrame, percent: int = 90, bucket_bytes: int = 16 << 20,
                       flush_bytes: int = 16 << 20, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by
    links, itself included) of every document.

    A null text is an empty one; an empty set is linked with nothing, so its
    component is itself. A row without doc_id is linked with nothing and has no
    component. Rows that share a doc_id are one node: what links one links all.
    Other columns are not read; an empty table gives no rows.
    """
    with shuffles_dropped(docs.sparkSession):
        return _components(docs, percent, bucket_bytes, flush_bytes, shingle)


def _components(docs: DataFrame, percent: int, bucket_bytes: int, flush_bytes: int, shingle: int) -> DataFrame:
    spark = docs.sparkSession
    scratch_root(spark)
    docs = docs.select("doc_id", "text")
    survey = docs.mapInArrow(_survey(shingle, flush_bytes), _SURVEY).checkpoint()
    hot = survey.where("shingle is not null").groupBy("shingle").agg(F.sum("times").alias("times")).orderBy(
        F.desc("times"), "shingle").limit(HOT).toArrow()
    order = Order(hot.column("shingle").to_numpy().astype(np.int64).view(U64), hot.column("times").to_numpy())

    rows = survey.where("shingle is null").select("doc_id", "n_shingles", "fp1", "fp2")
    same = ["fp1", "fp2", "n_shingles"]
    classes = rows.where("doc_id is not null and n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("first"))

    met = meetings(docs, order, percent, shingle, bucket_bytes, flush_bytes).checkpoint()
    least = [F.min(F.struct(F.xxhash64("doc_id", F.lit(turn)).alias("h"), "doc_id", "n")).alias(f"l{turn}") for turn in range(LEADERS)]
    leaders = met.groupBy("shingle").agg(*least).select(
        "shingle", F.inline(F.array_distinct(F.array(*(F.struct(f"l{turn}.doc_id", f"l{turn}.n") for turn in range(LEADERS))))))
    by_leader = met.alias("x").join(leaders.alias("l"), "shingle").where(F.col("x.doc_id") != F.col("l.doc_id")).where(
        _like(percent, "x", "l")).select(F.col("l.doc_id").alias("a"), F.col("x.doc_id").alias("b"),
                                         F.col("l.n").alias("n_a"), F.col("x.n").alias("n_b"))
    tried = _enough(by_leader, percent).checkpoint()
    links = settle(tried, docs, order, percent, shingle).checkpoint()
    known = components(links)

    labelled = met.join(known, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    mixed = labelled.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    apart = labelled.join(mixed.select("shingle"), "shingle", "left_semi")
    sketches = survey.where("doc_id is not null").select("doc_id", "bits")
    across = across_components(apart, sketches, percent)
    across = across.join(tried, ["a", "b"], "left_anti").join(
        tried.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
    more = settle(across.checkpoint(), docs, order, percent, shingle)

    # Rows that share a doc_id but not their set tie their classes together.
    ties = rows.where("doc_id is not null and n_shingles > 0").join(classes, same).where("doc_id <> first").select(
        F.col("doc_id").alias("a"), F.col("first").alias("b"))
    joined = components(links.union(more).union(ties))
    return rows.join(joined, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = 90, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` without those whose group has a smaller doc_id, all
    columns kept. Rows without doc_id stay."""
    others = jaccard_components(docs, percent, shingle=shingle).where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*(f"`{c}`" for c in docs.columns))
