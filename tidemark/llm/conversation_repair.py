"""Conversation structure repair by a dynamic program over a Re-Pair grammar.

A sound conversation has the role initials ``(s?(ua)+)?`` and no faulty row. The
cheapest edits that make it so are a shortest path through the automaton of
that pattern, where a row offers moves by its symbol (role initial and fault):
keep, rerole, delete, and insertions before it. As a matrix over the automaton's
states, entry (i, j) holding the cost and the audit of the best way from i to
j, a row is one *transfer matrix*, and a run of rows is their min-plus product.

Runs recur in all conversations, so the symbol strings are compressed by
*Re-Pair*: Spark counts the adjacent pairs of all distinct strings, the most
frequent become rules and are replaced, round by round. A rule's matrix is
the product of its two parts', evaluated once, bottom-up; a conversation is
the product of the few symbols left of it. Audits inside the matrices are
*ropes*: trees that share their parts with the rules', with a hash to compare
two of them without reading them out. Rules are few and bounded (``rounds`` x
``per_round``), a parameter that changes the work, never a result.

Of equally cheap audits the ASCII-least counts. Equal costs over equal rows
never make one audit the beginning of another (it would lack insertions, which
cost), so the least of two stays least whatever follows, and products may
choose early.

What is shuffled: narrow rows (ids and text hashes) twice, to find repeats and
to order conversations; whole rows once, to write the repaired turns. Python
reads sorted rows as a stream; it holds one conversation's symbols and audit,
one letter a row, which is what a result row holds too, and never its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

# Cost of each edit, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# Symbols of rows: the role's initial, upper case if truncated, x for other
# roles; d for a row that must go whatever its role.
MUST_GO = "d"
_FIRST_RULE = 0xE000  # rules are written as private-use characters

_BASE, _MOD = 1_000_003, (1 << 61) - 1


class Rope:
    """A string as a tree of parts, with its length and hash."""

    __slots__ = ("text", "left", "right", "length", "hash")
    LEAF = 32

    def __init__(self, text: str | None, left: "Rope | None" = None, right: "Rope | None" = None):
        self.text, self.left, self.right = text, left, right
        if text is not None:
            self.length, self.hash = len(text), reduce(lambda h, c: (h * _BASE + ord(c)) % _MOD, text, 0)
        else:
            self.length = left.length + right.length
            self.hash = (left.hash * pow(_BASE, right.length, _MOD) + right.hash) % _MOD

    def __add__(self, other: "Rope") -> "Rope":
        if not self.length or not other.length:
            return self if self.length else other
        if self.text is not None and other.text is not None and self.length + other.length <= self.LEAF:
            return Rope(self.text + other.text)
        return Rope(None, self, other)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            r = todo.pop()
            if r.text is not None:
                out.append(r.text)
            else:
                todo += [r.right, r.left]
        return "".join(out)

    def __lt__(self, other: "Rope") -> bool:
        """ASCII order; equal parts are passed over by their hash."""
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x.length == y.length and x.hash == y.hash:
                continue
            if x.text is not None and y.text is not None:
                n = min(x.length, y.length)
                if x.text[:n] != y.text[:n]:
                    return x.text[:n] < y.text[:n]
                if x.length > n:
                    a.append(Rope(x.text[n:]))
                if y.length > n:
                    b.append(Rope(y.text[n:]))
            elif y.text is not None or (x.text is None and x.length >= y.length):
                a += [x.right, x.left]
                b.append(y)
            else:
                b += [y.right, y.left]
                a.append(x)
        return bool(b) and not a


# The automaton: nothing yet, after s, after u, after a.
_START, _S, _U, _A = range(4)
_STATES = range(4)
_NEXT = {"s": {_START: _S}, "u": {_START: _U, _S: _U, _A: _U}, "a": {_U: _A}}
_ACCEPTS = (_START, _A)
_EMPTY = Rope("")
Matrix = list  # [from][to] -> (cost, Rope) or None


def _better(a: tuple | None, b: tuple | None) -> tuple | None:
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if b[1] < a[1] else a


def product(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product: first ``a``, then ``b``."""
    out = [[None] * 4 for _ in _STATES]
    for i in _STATES:
        for j in _STATES:
            if a[i][j] is None:
                continue
            for k in _STATES:
                if b[j][k] is not None:
                    cost, held = a[i][j][0] + b[j][k][0], out[i][k]
                    if held is None or cost <= held[0]:
                        out[i][k] = _better(held, (cost, a[i][j][1] + b[j][k][1]))
    return out


def _identity() -> Matrix:
    return [[(0, _EMPTY) if i == j else None for j in _STATES] for i in _STATES]


def _insertions() -> Matrix:
    """Any insertions between two rows: as few as lead from state to state."""
    one = _identity()
    for role in "ua":
        for i, j in _NEXT[role].items():
            one[i][j] = _better(one[i][j], (INSERT, Rope("I")))
    return product(product(one, one), one)


def _row(symbol: str) -> Matrix:
    """Insertions before a row, then its edit."""
    edit = [[None] * 4 for _ in _STATES]
    extra = TRUNCATED if symbol.isupper() else 0
    for i in _STATES:
        edit[i][i] = (DELETE, Rope("D"))
        if symbol == MUST_GO:
            continue
        for role in "ua":
            if (j := _NEXT[role].get(i)) is not None:
                edit[i][j] = _better(edit[i][j], (REROLE + extra, Rope("R")))
        if (j := _NEXT.get(symbol.lower(), {}).get(i)) is not None:
            edit[i][j] = _better(edit[i][j], (KEEP + extra, Rope("K")))
    return product(_insertions(), edit)


class Grammar:
    """Transfer matrices of row symbols and rules. ``rules``: (pair, symbol)
    in the order in which they were made, so parts come before wholes."""

    MEMO = 10_000

    def __init__(self, rules: list[tuple[str, str]]):
        self.rules = rules
        self.matrices = {s: _row(s) for s in (MUST_GO, *"suaxSUAX")}
        for (a, b), symbol in rules:
            self.matrices[symbol] = product(self.matrices[a], self.matrices[b])
        self.memo: dict[str, tuple[int, str]] = {}

    def packed(self, symbols: str) -> str:
        for pair, symbol in self.rules:
            symbols = symbols.replace(pair, symbol)
        return symbols

    def solve(self, symbols: str) -> tuple[int, str]:
        """Cost and audit of a conversation given by its rows' symbols."""
        key = self.packed(symbols)
        if (known := self.memo.get(key)) is not None:
            return known
        # a balanced product, so that ropes stay shallow
        parts = [self.matrices[s] for s in key]
        while len(parts) > 1:
            parts = [product(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        whole = product(parts[0], _insertions()) if parts else _insertions()
        cost, audit = reduce(_better, (whole[_START][j] for j in _ACCEPTS))
        if len(self.memo) >= self.MEMO:
            self.memo.clear()
        if len(key) <= 64:
            self.memo[key] = cost, str(audit)
        return cost, str(audit)


# Rows ------------------------------------------------------------------------


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of ``turns`` after the contract's damage, by
    crc32 of ``conv_id:turn`` (null: one space) modulo 20: 0 drops the row, 1
    empties its text, 2 removes ``.!?`` from it, 3 repeats it, 4 makes it a
    user's. A null text or role is one space."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    hit = F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), hit.alias("_hit")).where("_hit <> 0")
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("_hit") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_hit") == 1, F.lit("")).when(F.col("_hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
            F.col("text")).alias("text"),
        F.explode(F.when(F.col("_hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
    return rows.drop("_copy")


_WORDY = r"[^\x20\x09-\x0D]"
_ORDER = ["turn", "role", "h", "h2"]


def _prepared(turns: DataFrame) -> DataFrame:
    """Rows with nulls as one space and the text's 128-bit number."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        role.alias("role"), text.alias("text"),
                        F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("h2"))


def _symbol(text: Column) -> Column:
    """A row's symbol, were it no repeat."""
    letter = F.substring("role", 1, 1)
    letter = F.when(letter.isin("s", "u", "a"), letter).otherwise("x")
    ended = text.rlike(r"[.!?][\x20\x09-\x0D]*+\z")
    return F.when(~text.rlike(_WORDY), MUST_GO).when(ended, letter).otherwise(F.upper(letter))


def _symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted narrow rows -> each conversation's symbols and counts."""
    legal = {"su", "ua", "au"}
    fields = ["conv_id", "symbols", "gaps", "blank", "duplicate", "truncated", "illegal"]
    types = [pa.int64(), pa.string()] + [pa.int64()] * 5
    conv, held = object(), None

    def close() -> tuple:
        letters, turns, counts = held["letters"], held["turns"], held["counts"]
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
        return conv, "".join(letters), gaps, *counts

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], fields)

    for batch in batches:
        rows = []
        names = ["conv_id", "is_row", "turn", "letter", "symbol", "again"]
        for conv_id, is_row, turn, letter, symbol, again in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            if held is None or conv_id != conv:
                if held is not None:
                    rows.append(close())
                conv, held = conv_id, {"letters": [], "turns": None, "counts": [0, 0, 0, 0], "before": None}
            if not is_row:
                continue
            counts = held["counts"]
            if turn is not None:
                first, last, n = held["turns"] or (turn, None, 0)
                held["turns"] = (first, turn, n + (turn != last))
            if held["before"] is not None and held["before"] + letter not in legal:
                counts[3] += 1
            held["before"] = letter
            if symbol == MUST_GO:
                counts[0] += 1
            elif again:
                counts[1] += 1
            elif symbol.isupper():
                counts[2] += 1
            held["letters"].append(MUST_GO if again else symbol)
        if rows:
            yield batch_of(rows)
    if held is not None:
        yield batch_of([close()])


def symbol_strings(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """conv_id, symbols (one letter a row, in order) and counts of every
    conversation of ``turns``, and of those that only ``ids`` (conv_id) has."""
    rows = _prepared(turns)
    text = F.col("text")
    narrow = rows.select("conv_id", "turn", "role", "h", "h2", _symbol(text).alias("symbol"))
    seen = Window.partitionBy("conv_id", "role", "h", "h2").orderBy(F.col("turn").asc_nulls_first())
    narrow = narrow.select(
        "conv_id", F.lit(True).alias("is_row"), *_ORDER, F.substring("role", 1, 1).alias("letter"), "symbol",
        (F.row_number().over(seen) > 1).alias("again"))
    if ids is not None:
        named = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        narrow = narrow.unionByName(named.withColumn("is_row", F.lit(False)), allowMissingColumns=True)
    ordered = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", *_ORDER, "again")
    return ordered.mapInArrow(_symbols, "conv_id long, symbols string, gaps long, blank long, duplicate long, "
                                        "truncated long, illegal long")


def repair_grammar(strings: DataFrame, rounds: int = 8, per_round: int = 8) -> Grammar:
    """Re-Pair over all symbol strings (column ``symbols``), in Spark.

    Each round counts the adjacent pairs of the distinct strings, takes the most
    frequent ones that share no symbol (so the order of replacing them does not
    matter), and writes the shortened strings. It ends when no pair occurs twice.
    The driver sees ``16 * per_round`` pairs a round.
    """
    spark = strings.sparkSession
    folder = scratch_dir(spark, "repair-grammar")
    state = strings.where(F.length("symbols") > 1).groupBy("symbols").agg(F.count(F.lit(1)).alias("n"))
    rules: list[tuple[str, str]] = []
    for turn in range(rounds):
        state.write.parquet(f"{folder}/{turn}")
        state = spark.read.parquet(f"{folder}/{turn}")
        # letters once per string: cutting each pair from it would read it from the start
        letters = state.select(F.regexp_extract_all("symbols", F.lit("."), F.lit(0)).alias("s"), "n")
        both = F.zip_with(F.slice("s", F.lit(1), F.size("s") - 1), F.slice("s", F.lit(2), F.size("s") - 1), lambda x, y: F.concat(x, y))
        pairs = letters.select(F.explode(both).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))
        chosen, used = [], set()
        for r in pairs.where("n > 1").orderBy(F.desc("n"), "pair").limit(16 * per_round).collect():
            if len(chosen) < per_round and not used & set(r["pair"]):
                chosen.append(r["pair"])
                used |= set(r["pair"])
        if not chosen:
            break
        column = F.col("symbols")
        for pair in chosen:
            rules.append((pair, chr(_FIRST_RULE + len(rules))))
            column = F.replace(column, F.lit(pair), F.lit(rules[-1][1]))
        state = state.select(column.alias("symbols"), "n").where(F.length("symbols") > 1).groupBy("symbols").agg(F.sum("n").alias("n"))
    return Grammar(rules)


_REPAIRED = ("conv_id long, position long, role string, text string, edit string, gaps long, blank long, duplicate long, "
             "truncated long, illegal long, cost long, audit string")


def _write_turns(grammar: Grammar):
    """Sorted rows, each conversation's symbols first -> its repaired turns."""
    names = [f.split()[0] for f in _REPAIRED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()] + [pa.int64()] * 6 + [pa.string()]
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal"]

    class Writer:
        """Turns of one conversation, in order, as its audit says."""

        def __init__(self, conv_id: int | None, audit: str):
            self.conv_id, self.audit, self.at, self.state, self.position = conv_id, audit, 0, _START, 0

        def turn(self, role: str, text: str, edit: str) -> tuple:
            self.position += 1
            self.state = _NEXT[role[:1]][self.state]
            return (self.conv_id, self.position, role, text, edit, *[None] * 7)

        def wanted(self) -> str:
            return "assistant" if self.state == _U else "user"

        def inserted(self) -> Iterator[tuple]:
            while self.at < len(self.audit) and self.audit[self.at] == "I":
                self.at += 1
                yield self.turn(self.wanted(), "", "I")

        def row(self, role: str, text: str) -> Iterator[tuple]:
            yield from self.inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit != "D":
                yield self.turn(role if edit == "K" else self.wanted(), text, edit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            out: list[tuple] = []
            heads = batch.select(counts + ["symbols"]).to_pylist()
            for head, conv_id, role, text in zip(heads, *(batch.column(n).to_pylist() for n in ("conv_id", "role", "text")), strict=True):
                if head["symbols"] is not None:
                    if writer is not None:
                        out += writer.inserted()
                    cost, audit = grammar.solve(head["symbols"])
                    writer = Writer(conv_id, audit)
                    out.append((conv_id, 0, None, None, None, *(head[c] for c in counts), cost, audit))
                else:
                    out += writer.row(role, text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
        if writer is not None and (rest := list(writer.inserted())):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rest, strict=True), types, strict=True)], names)

    return run


def repaired(turns: DataFrame, ids: DataFrame | None = None, rounds: int = 8, per_round: int = 8) -> DataFrame:
    """The repaired turns of every conversation, in order: conv_id, position
    (from 1), role, text and edit (K, R or I). Position 0 carries the counts, the
    cost and the whole audit of the conversation.

    Rows are taken by turn, nulls first; ties by role, then by a number of the
    text. A null role or text is one space; a role without s, u or a in front,
    an empty one too, must be reroled or deleted. Rows without conv_id are one
    conversation. ``ids`` names conversations that may have no rows left; they
    get position 0 alone. Repeated rows are duplicates of the first; other
    columns are not read; empty tables give no rows.
    """
    strings = symbol_strings(turns, ids)
    path = f"{scratch_dir(turns.sparkSession, 'symbols')}/strings"
    strings.write.parquet(path)
    strings = turns.sparkSession.read.parquet(path)
    grammar = repair_grammar(strings, rounds, per_round)
    rows = _prepared(turns).withColumn("is_row", F.lit(True)).unionByName(
        strings.withColumn("is_row", F.lit(False)), allowMissingColumns=True)
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", *_ORDER)
    return ordered.mapInArrow(_write_turns(grammar), _REPAIRED)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    types = [pa.int64()] * 7 + [pa.string()] * 2
    head, digest, first = None, None, True

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                          [*kept, "repaired_sha256"])

    for batch in batches:
        rows = []
        heads = zip(*(batch.column(n).to_pylist() for n in kept), strict=True)
        for new, position, role, text in zip(heads, *(batch.column(n).to_pylist() for n in ("position", "role", "text")), strict=True):
            if position == 0:
                if head is not None:
                    rows.append((*head, digest.hexdigest()))
                head, digest, first = new, hashlib.sha256(), True
            else:
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        if rows:
            yield batch_of(rows)
    if head is not None:
        yield batch_of([(*head, digest.hexdigest())])


def digest_repaired(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``repaired`` rows as they come: counts, cost,
    audit, and the digest of its turns."""
    return turns.mapInArrow(_digests, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
                                      "cost long, audit string, repaired_sha256 string")
