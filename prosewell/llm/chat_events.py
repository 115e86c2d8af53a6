"""Chats from event logs: fold the log of each message, render it by a template, mask what to learn from.

A log has a row per event: (conv_id, turn, copy, seq, kind, role, text). `copy` tells messages of one turn apart. Events are
partitioned by conversation and message and sorted by sequence, so a conversation of any length is spread over many tasks,
and a task holds one message at a time.

kind        effect on the message
open        sets the role; a text, if there is one, begins the message
delta       appends its text
edit        replaces all text so far
regenerate  drops all text so far; the deltas that follow build it anew
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.llm.common import BATCH_ROWS

# The template. Marks of the three usual roles; any other role is written out.
MARKS = {
    "system": ("<<SYS>> ", " <</SYS>>"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": ("<s> ", " </s>"),
}
OTHER = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
CONTROL = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[TEXT]", "[/ROLE]"]
LEARNT_ROLE = "assistant"

_TO_ESCAPE = re.compile("|".join(map(re.escape, ["\\", *CONTROL])))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)

LOG = ["conv_id", "turn", "copy", "seq", "kind", "role", "text"]
PIECES = "conv_id long, turn long, copy int, formatted string, loss_start int, loss_end int"
CHATS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def escape(text: str) -> str:
    """No control string is left in the result. A backslash is doubled; one goes after a control string's first character."""
    return _TO_ESCAPE.sub(lambda m: m[0] + "\\" if len(m[0]) == 1 else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The formatted message, and where in it the text begins and ends (code points)."""
    if role in MARKS:
        before, after = MARKS[role]
    else:
        before, after = OTHER[0] + escape(role) + OTHER[1], OTHER[2]
    body = escape(text)
    return before + body + after, len(before), len(before) + len(body)


def parse(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted message."""
    for role, (before, after) in MARKS.items():
        if formatted.startswith(before):
            return role, unescape(formatted[len(before) : len(formatted) - len(after)])
    role, _, rest = formatted[len(OTHER[0]) :].partition(OTHER[1])
    return unescape(role), unescape(rest[: len(rest) - len(OTHER[2])])


def fold(events: Iterator[tuple]) -> Iterator[tuple[tuple, str, str]]:
    """(key, role, text) of each message from (key, seq, kind, role, text) in order.

    An event delivered twice has the same seq, kind, role and text, and counts once. Nulls: a text is empty, a kind is a
    delta, and a role leaves the role as it is. A message that was never opened has the role ''.
    """
    current, last = None, None
    role, parts = "", []
    for key, seq, kind, of_role, text in events:
        if key != current:
            if current is not None:
                yield current, role, "".join(parts)
            current, last, role, parts = key, None, "", []
        event = (seq, kind, of_role, text)
        if seq is not None and event == last:
            continue
        last = event
        if kind in ("open", "edit", "regenerate"):
            parts = []
        if of_role is not None:
            role = of_role
        if text and kind != "regenerate":
            parts.append(text)
    if current is not None:
        yield current, role, "".join(parts)


def _rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


_PIECE_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()), ("turn", pa.int64()), ("copy", pa.int32()),
        ("formatted", pa.string()), ("loss_start", pa.int32()), ("loss_end", pa.int32()),
    ]
)
_CHAT_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ]
)


def _in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= BATCH_ROWS or size >= 1 << 24:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pieces() -> Iterator[tuple]:
        rows = _rows(batches, *LOG)
        events = ((row[:3], *row[3:]) for row in rows)
        for key, role, text in fold(events):
            formatted, start, end = render(role, text)
            learnt = role == LEARNT_ROLE
            yield *key, formatted, start if learnt else None, end if learnt else None

    return _in_batches(pieces(), _PIECE_SCHEMA)


def format_chats(events: DataFrame) -> DataFrame:
    """(conv_id, turn, copy, formatted, loss_start, loss_end): a row per message, from a log with the columns of `LOG`.

    The formatted chat is the `formatted` of its rows by turn and copy, one after the other. The loss mask covers code points
    `loss_start` to `loss_end` of a row; both are null where nothing is to be learnt. Rows without conv_id make a chat of
    their own; messages without turn come first. An empty log gives no row; columns not in `LOG` are ignored.
    """
    kinds = {"conv_id": "long", "turn": "long", "copy": "int", "seq": "long"}
    log = events.select(*(F.col(f"`{c}`").cast(kinds.get(c, "string")).alias(c) for c in LOG))
    ordered = log.repartition("conv_id", "turn", "copy").sortWithinPartitions(*LOG)
    return ordered.mapInArrow(_format, PIECES)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def chats() -> Iterator[tuple]:
        current, started = None, False
        n = loss = size = 0
        turns, learnt = hashlib.sha256(), hashlib.sha256()
        columns = ["conv_id", "formatted", "loss_start", "loss_end"]
        for conv_id, formatted, start, end in _rows(batches, *columns):
            if started and conv_id != current:
                yield current, n, turns.hexdigest(), loss, learnt.hexdigest(), size
                n = loss = size = 0
                turns, learnt = hashlib.sha256(), hashlib.sha256()
            current, started = conv_id, True
            role, text = parse(formatted)
            turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            n, size = n + 1, size + len(formatted)
            if start is not None:
                masked = unescape(formatted[start:end])
                learnt.update(masked.encode("utf-8", "surrogatepass"))
                loss += len(masked)
        if started:
            yield current, n, turns.hexdigest(), loss, learnt.hexdigest(), size

    return _in_batches(chats(), _CHAT_SCHEMA)


def read_chats(spark: SparkSession, path: str) -> DataFrame:
    """A row per chat from formatted messages at `path`: sizes and digests of its turns and of what its mask covers.

    A digest runs over a chat from first to last turn, so its rows pass one task in order; that task holds one message.
    """
    pieces = spark.read.schema(PIECES).parquet(path)
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "copy")
    return ordered.mapInArrow(_digest, CHATS)
