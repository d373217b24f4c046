"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are its
context, its own text alone is trainable. A conversation that does not end with
an assistant turn also gives one example without a trainable part, so that its
last turns are in the output too.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. Inside roles and
texts a backslash is written twice and ``<|`` as ``<\\|``, so no text can hold a
control string, and reading undoes it exactly. A newline in a role is ``\\n``.

Turns of a conversation are brought together and in order by one shuffle, and
read as a stream: a task holds the formatted turns of one conversation at a
time, which is the text of its last example.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame

START, END = "<|im_start|>", "<|im_end|>"
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
_ESCAPED = re.compile(r"\\([\\|n])")

EXAMPLES = "conv_id long, example long, text string, loss_start long, loss_end long"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text) if "\\" in text else text


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted example."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    size = 0
    conv, prefix, number, is_open = object(), "", count(), False

    def flush() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                          ["conv_id", "example", "text", "loss_start", "loss_end"])

    for batch in batches:
        for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if conv_id != conv:
                if is_open:  # the turns after the last reply
                    rows.append((conv, next(number), prefix, len(prefix), len(prefix)))
                conv, prefix, number = conv_id, "", count()
            head = f"{START}{escape(role or '').replace(chr(10), chr(92) + 'n')}\n"
            body = escape(text or "")
            start = len(prefix) + len(head)
            prefix = f"{prefix}{head}{body}{END}\n"
            is_open = role != "assistant"
            if not is_open:
                rows.append((conv, next(number), prefix, start, start + len(body)))
                size += len(prefix)
            if size > 8 << 20:
                yield flush()
                rows, size = [], 0
    if is_open:
        rows.append((conv, next(number), prefix, len(prefix), len(prefix)))
    if rows:
        yield flush()


def format_examples(turns: DataFrame) -> DataFrame:
    """Examples (conv_id, example, text, loss_start, loss_end) of conversations
    given by rows (conv_id, turn, role, text); offsets are code points.

    A null text or role is an empty one. Turns are ordered by turn, then role
    and text, nulls first, so ties and repeated rows have a defined order and
    are all kept. Rows without conv_id are one conversation. Other columns are
    not read; an empty table gives no rows.
    """
    keys = ["conv_id", "turn", "role", "text"]
    ordered = turns.select(*keys).repartition("conv_id").sortWithinPartitions(*keys)
    return ordered.mapInArrow(_examples, EXAMPLES)


class _Digest:
    """What the examples of one conversation say, read back from their texts."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.loss, self.loss_chars, self.chars, self.last = conv_id, hashlib.sha256(), 0, 0, ""

    def add(self, text: str, start: int, end: int) -> None:
        trained = unescape(text[start:end])
        self.loss.update(trained.encode())
        self.loss_chars += len(trained)
        self.chars += len(text)
        self.last = text  # the last example has every turn

    def row(self) -> tuple:
        turns = read_turns(self.last)
        said = hashlib.sha256()
        for role, text in turns:
            said.update(f"{role}\n{text}\n".encode())
        return self.conv_id, len(turns), said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    for batch in batches:
        rows = []
        for conv_id, text, start, end in zip(batch.column("conv_id").to_pylist(), batch.column("text"),
                                             batch.column("loss_start").to_pylist(), batch.column("loss_end").to_pylist(), strict=True):
            if held is None or held.conv_id != conv_id:
                if held is not None:
                    rows.append(held.row())
                held = _Digest(conv_id)
            held.add(text.as_py(), start, end)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(held.row(), types, strict=True)], names)


def digest_examples(examples: DataFrame) -> DataFrame:
    """One row per conversation, read back from its examples: turns, their
    digest, the trainable text and the formatted length. ``examples`` as
    ``format_examples`` gives them, each conversation's rows together."""
    return examples.mapInArrow(
        _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
