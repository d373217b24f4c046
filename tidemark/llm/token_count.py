"""Token counts by a finite-state transducer compiled from a BPE tokenizer file.

The tokenizer splits a normalised text into words and merges each word's bytes
by rank. Merging left to right has finite memory: the encoding of a prefix ends
in one token, and a token ``b`` may follow a token ``a`` exactly if the encoding
of their joined bytes is ``[a, b]``. So the token that ends at a byte is known
from the tokens that end within reach before it, and reach is the longest run
of bytes that still begins some token.

``Transducer`` is that machine, made deterministic. A state is the reachable
run of bytes with the token and count at each place in it; a transition reads
one byte and carries the number of tokens it emits (the count of the longer
prefix less that of the shorter, so it may be negative). The last byte of a
word is read by a final transition, as tokenizers mark it (``</w>``). States
and transitions are compiled when first met and kept; past ``most_states`` the
table is emptied and filled anew, as lazily built automata do.

A long text is read in chunks. What a chunk does to the machine is a map from the
state it is entered with: the letters before its first word boundary go to the
entering word, the words inside count on their own, the letters after the last
boundary are the word it leaves open. Such maps (``head, count, tail``) compose,
and composing is associative. So the chunks of a text are rows of their own,
mapped on any executor, and their maps are composed by the up-sweep of a parallel
prefix scan: every ``FAN`` neighbours become one map, round by round, each round
a shuffle of maps, never of text. A special string is a map too: a boundary on
both sides that counts one.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.packing import _byte_letters
from tidemark.session import scratch_dir

_transducers: dict[str, "Transducer"] = {}

# Characters whose normal form, case and class agree in every Unicode table of
# the last ten years; texts with others are counted by the library itself.
_COMMON = re.compile("[\t\n\r -~\u00a0-\u017f\u2010-\u2027\u20ac]*")


class Transducer:
    """Counts of one word-ended BPE file (see the module's text)."""

    def __init__(self, path: str, most_states: int = 400_000):
        spec = json.loads(open(path, encoding="utf-8").read())
        model = spec["model"]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: not a word-ended BPE file with the expected normalizer")
        self.end = model["end_of_word_suffix"]
        self.ranks = {tuple(m): i for i, m in enumerate(model["merges"])}
        self.letters = _byte_letters()
        self.words = regex.compile(split["pattern"]["Regex"])
        self.specials = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.cut_special = regex.compile("|".join(map(regex.escape, self.specials)))
        # Tokens that their own merges give, plain and word-ended, and every
        # run of bytes that begins one.
        shown = {t: list(t[:-len(self.end)]) if t.endswith(self.end) else list(t) for t in model["vocab"]}
        self.plain, self.ended, self.begins = set(), set(), {""}
        for token, symbols in shown.items():
            is_end = token.endswith(self.end) and len(token) > len(self.end)
            if is_end:
                symbols[-1] += self.end
            if self.merged(symbols) == [token]:
                (self.ended if is_end else self.plain).add(token)
                text = "".join(symbols).removesuffix(self.end) if is_end else token
                self.begins.update(text[:i] for i in range(1, len(text)))
                self.begins.add(text)
        self.follows: dict[tuple[str, str], bool] = {}
        self.most_states = most_states
        self.most_words = 300_000
        self._reset()

    def _reset(self) -> None:
        # A state: (reachable run, tokens ending at each place in it, counts
        # there less the count here). None: the beginning of the word.
        self.states = [("", (None,), (0,))]
        self.ids = {self.states[0]: 0}
        self.moves: dict[tuple[int, str], tuple[int, int]] = {}
        self.finals: dict[tuple[int, str], int] = {}
        self.known: dict[str, int] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """Symbols after all merges, lowest rank first, leftmost first."""
        symbols = list(symbols)
        while len(symbols) > 1:
            rank, at = min((self.ranks.get(p, len(self.ranks)), i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)))
            if rank == len(self.ranks):
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def may_follow(self, a: str | None, b: str) -> bool:
        if a is None:
            return True
        if (known := self.follows.get((a, b))) is None:
            ended = b.endswith(self.end) and b in self.ended
            symbols = list(a) + list(b.removesuffix(self.end) if ended else b)
            if ended:
                symbols[-1] += self.end
            known = self.follows[a, b] = self.merged(symbols) == [a, b]
        return known

    def _last(self, state: tuple, byte: str, final: bool) -> tuple[str, int]:
        """The token that ends at ``byte`` read in ``state``, and its emission."""
        run, tokens, counts = state
        text = run + byte
        among = self.ended if final else self.plain
        for at in range(len(text)):
            token = text[at:] + self.end if final else text[at:]
            if token in among and self.may_follow(tokens[at], token):
                return token, counts[at] + 1
        raise ValueError(f"no token ends at {byte!r} after {run!r}")

    def _move(self, key: tuple[int, str]) -> tuple[int, int]:
        state = self.states[key[0]]
        run, tokens, counts = state
        token, emits = self._last(state, key[1], final=False)
        text = run + key[1]
        drop = next(i for i in range(len(text) + 1) if text[i:] in self.begins)
        new = (text[drop:], (*tokens[drop:], token), (*(c - emits for c in counts[drop:]), 0))
        if new not in self.ids:
            self.ids[new] = len(self.states)
            self.states.append(new)
        self.moves[key] = out = (self.ids[new], emits)
        return out

    def count_word(self, word: str) -> int:
        """Tokens of one word of the normalised text."""
        if (known := self.known.get(word)) is not None:
            return known
        if len(self.states) > self.most_states or len(self.known) > self.most_words or len(self.follows) > 4 * self.most_states:
            self._reset()
            self.follows.clear()
        letters = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
        state, total, moves = 0, 0, self.moves
        for byte in letters[:-1]:
            move = moves.get((state, byte)) or self._move((state, byte))
            state = move[0]
            total += move[1]
        key = (state, letters[-1])
        if (emits := self.finals.get(key)) is None:
            emits = self.finals[key] = self._last(self.states[state], letters[-1], final=True)[1]
        total += emits
        if len(word) < 32:
            self.known[word] = total
        return total

    def count_words(self, words: list[str]) -> int:
        known = self.known
        return sum(n * (known.get(w) or self.count_word(w)) for w, n in Counter(words).items())

    def normalized(self, text: str) -> str:
        """As the file's normalizer gives: composed, lower case letter by letter."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    # Chunk maps -------------------------------------------------------------

    def chunk_map(self, chunk: str) -> tuple[str, int | None, str]:
        """What a chunk of normalised text does: ``(head, count, tail)``. Count
        None: no boundary inside, so the chunk only lengthens the open word.

        White space is the boundary: every pattern of the file ends a word
        there, so nothing before one can change what comes after."""
        first = re.search(r"\s", chunk)
        if first is None:
            return chunk, None, ""
        last = max(chunk.rfind(c) for c in set(re.findall(r"\s", chunk)))
        return chunk[:first.start()], self.count_words(self.words.findall(chunk[first.start():last + 1])), chunk[last + 1:]

    def composed(self, a: tuple, b: tuple) -> tuple:
        """The map of two neighbouring chunks."""
        if a[1] is None:
            return (a[0] + b[0], b[1], b[2])
        if b[1] is None:
            return (a[0], a[1], a[2] + b[0])
        return a[0], a[1] + self.count_words(self.words.findall(a[2] + b[0])) + b[1], b[2]

    def closed(self, m: tuple) -> int:
        """The count of a map entered and left at a text's ends."""
        return self.count_words(self.words.findall(m[0])) + (m[1] or 0) + self.count_words(self.words.findall(m[2]))

    def count(self, text: str) -> int:
        """Tokens of a text, special strings in it one token each."""
        parts = self.cut_special.split(text)
        return len(parts) - 1 + sum(self.count_words(self.words.findall(self.normalized(p))) for p in parts)

    def chunks(self, text: str, chunk_chars: int) -> Iterator[str | None]:
        """The chunks of a text's normalised parts, None for a special string."""
        for i, part in enumerate(self.cut_special.split(text)):
            if i:
                yield None
            part = self.normalized(part)
            yield from (part[j:j + chunk_chars] for j in range(0, len(part), chunk_chars))


SPECIAL = ("", 1, "")  # the map of a special string


def transducer(path: str) -> Transducer:
    """The compiled transducer of a file, once per process."""
    if path not in _transducers:
        _transducers[path] = Transducer(path)
    return _transducers[path]


FAN = 64  # maps composed into one in a round
_PARTS = "doc_id long, n_bytes long, n_tokens long, row long, chunk long, text string"
_MAPS = "row long, chunk long, head string, count long, tail string"


def _columns(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)],
                                      [n for n, _ in fields])


def _read(tokenizer: str, chunk_chars: int):
    """Texts -> their counts, and long ones as a row without count and its chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        machine, library = transducer(tokenizer), None
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            out, size = [], 0
            for doc_id, n_bytes, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = value.as_py()
                if not _COMMON.fullmatch(text):
                    library = library or Tokenizer.from_file(tokenizer)
                    out.append((doc_id, n_bytes, len(library.encode(text, add_special_tokens=False).ids), None, None, None))
                elif len(text) <= chunk_chars:
                    out.append((doc_id, n_bytes, machine.count(text), None, None, None))
                else:
                    out.append((doc_id, n_bytes, None, row, None, None))
                    for at, chunk in enumerate(machine.chunks(text, chunk_chars)):
                        out.append((None, None, None, row, at, chunk))
                        size += len(chunk or "")
                        if size > 8 << 20:
                            yield _columns(out, _PARTS)
                            out, size = [], 0
                    row += 1
            if out:
                yield _columns(out, _PARTS)

    return run


def _map_chunks(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(tokenizer)
        for batch in batches:
            rows = [(row, chunk, *(SPECIAL if not text.is_valid else machine.chunk_map(text.as_py())))
                    for row, chunk, text in zip(batch.column("row").to_pylist(), batch.column("chunk").to_pylist(), batch.column("text"), strict=True)]
            if rows:
                yield _columns(rows, _MAPS)
    return run


def _compose(tokenizer: str, fan: int):
    """Maps in order of (row, chunk) -> one map for each run of ``fan`` chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, key, held = transducer(tokenizer), None, None
        for batch in batches:
            out = []
            for row, chunk, head, count, tail in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (row, chunk // fan) != key:
                    if key is not None:
                        out.append((*key, *held))
                    key, held = (row, chunk // fan), (head, count, tail)
                else:
                    held = machine.composed(held, (head, count, tail))
            if out:
                yield _columns(out, _MAPS)
        if key is not None:
            yield _columns([(*key, *held)], _MAPS)

    return run


def _close(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(tokenizer)
        for batch in batches:
            rows = [(row, machine.closed((head, count, tail))) for row, _, head, count, tail in zip(
                *(c.to_pylist() for c in batch.columns), strict=True)]
            if rows:
                yield _columns(rows, "row long, counted long")
    return run


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, chunk_chars: int = 1 << 14, fan: int = FAN) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit of every whole text.

    A null text is an empty one (0 tokens); a null doc_id stays; repeated rows
    are counted each; other columns are not read; an empty table gives no rows.
    A text up to ``chunk_chars`` is counted where it is read. The chunks of longer
    ones are written to the shared folder and dealt to all tasks. A text with
    characters outside common Latin is the library's, and one task's.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    path = f"{scratch_dir(docs.sparkSession, 'token-counts')}/parts"
    read.mapInArrow(_read(tokenizer, chunk_chars), _PARTS).write.parquet(path)
    parts = docs.sparkSession.read.schema(_PARTS).parquet(path)
    chunks = parts.where("chunk is not null").select("row", "chunk", "text")
    last = chunks.agg(F.max("chunk")).first()[0]
    counted = parts.where("row is null").select("doc_id", "n_bytes", "n_tokens")
    if last is not None:
        maps = chunks.repartition("row", "chunk").mapInArrow(_map_chunks(tokenizer), _MAPS)
        while last > 0:  # the number of rounds is the logarithm of the longest text's chunks
            dealt = maps.repartition(F.col("row"), F.floor(F.col("chunk") / fan)).sortWithinPartitions("row", "chunk")
            maps, last = dealt.mapInArrow(_compose(tokenizer, fan), _MAPS), last // fan
        long_ = parts.where("row is not null and chunk is null").select("doc_id", "n_bytes", "row")
        totals = long_.join(maps.mapInArrow(_close(tokenizer), "row long, counted long"), "row")
        counted = counted.unionByName(totals.select("doc_id", "n_bytes", F.col("counted").alias("n_tokens")))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
