"""Chat formatting with a grammar round trip.

A turn is rendered as

    <|im_start|>ROLE NEWLINE TEXT<|im_end|>NEWLINE

and reparsed by a deterministic parser; if the parser doesn't give back the turn,
the conflicting content is escaped and the turn is rendered again, until it does.
`<|` inside content becomes `<\\|`; where content has backslashes between the two
signs already, one more is put in, so the parser takes out exactly one. A role also
has its line ends and backslashes escaped. A turn ends with its own end mark and no
content has one, so that a conversation parses as its turns do.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLES = ("assistant",)
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)
_MARK, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _MARK.sub(lambda m: f"<\\{m[1]}|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"<{m[1]}|", text)


def _render(role: str, text: str) -> str:
    return f"{START}{role}\n{text}{END}\n"


def parse(rendered: str) -> list[tuple[str, str, int, int]] | None:
    """(role, text, start, end) of the turns, where text stands in `rendered`; None if it doesn't fit the grammar."""
    turns, at = [], 0
    while at < len(rendered):
        m = _TURN.match(rendered, at)
        if m is None or any(mark in part for mark in (START, END) for part in (m[1], m[2])):
            return None
        turns.append((_role(m[1]), unescape(m[2]), m.start(2), m.end(2)))
        at = m.end()
    return turns


def _role(raw: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(raw))


def format_turn(role: str | None, text: str | None) -> tuple[str, str, str, int, int]:
    """Rendered turn, then role and text as read back from it, and where the text stands."""
    role, text = role or "", text or ""
    attempts = ((role, text), (role, escape(text)), (_safe_role(role), escape(text)))
    for r, t in attempts:
        out = _render(r, t)
        back = parse(out)
        if back is not None and len(back) == 1 and back[0][:2] == (role, text):
            return out, *back[0]
    raise ValueError("the turn can't be formatted")


def _safe_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [format_turn(r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
        cols = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("turn"), *(pa.array(c, pa.string()) for c in cols[:3]), *(pa.array(c, pa.int64()) for c in cols[3:])],
            ["conv_id", "turn", "formatted", "role", "text", "start", "end"],
        )


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, formatted, role, text, start, end), a row for each row of `conversations`.

    role and text are read back from `formatted`, whose code points start to end
    (exclusive) hold the text. Null role or text counts as empty.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_turns, "conv_id long, turn long, formatted string, role string, text string, start long, end long")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a conversation stand together, in order; one is never held whole."""
    key: object = batches
    n = chars = loss = 0
    all_, masked = hashlib.sha256(), hashlib.sha256()

    def done():
        row = [[key], [n], [all_.hexdigest()], [loss], [masked.hexdigest()], [chars]]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    for batch in batches:
        for conv, out in zip(batch.column("conv_id").to_pylist(), batch.column("formatted").to_pylist()):
            if conv != key or key is batches:
                if key is not batches:
                    yield done()
                key, n, chars, loss, all_, masked = conv, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            (role, text, _, _), = parse(out)
            n, chars = n + 1, chars + len(out)
            all_.update(f"{role}\n{text}\n".encode())
            if role in LOSS_ROLES:
                loss += len(text)
                masked.update(text.encode())
    if key is not batches:
        yield done()


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """One row a conversation of `format_turns`, read back from column formatted.

    Turns go by turn, null first; ties by formatted text. Rows of null conv_id are one conversation.
    """
    rows = formatted.select("conv_id", "turn", "formatted").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return rows.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
