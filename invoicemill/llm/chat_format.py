"""Chat formatting by columnar byte assembly.

A turn becomes ``<s>`` role, line feed, text, ``</s>``. Control strings inside a role or a text are broken up by a backslash after their first
character, and backslashes are doubled, so the output is read back without loss. For a batch of turns the lengths of all segments, their
offsets and the place of every byte are computed in numpy; headers and contents are then copied into one buffer
that becomes the Arrow column.

Formatting is narrow: any task formats any turn, so a conversation with very many turns is spread. A digest of a whole conversation runs
over its turns in order, as a stream that holds one batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from invoicemill.llm.texts import runs_of_rows, text_bytes

# The control strings of the template and of common chat templates.
BEGIN, MIDDLE, END = b"<s>", b"\n", b"</s>"
CONTROLS = (b"<s>", b"</s>", b"[INST]", b"[/INST]", b"<<SYS>>", b"<</SYS>>", b"<|im_start|>", b"<|im_end|>", b"<|endoftext|>")
ESCAPE, LINE_FEED, N = 92, 10, 110
TRAINED_ROLE = "assistant"


def _control_starts(data: np.ndarray) -> np.ndarray:
    """True where a control string begins."""
    starts = np.zeros(len(data), bool)
    for control in CONTROLS:
        if len(data) >= len(control):
            at = np.flatnonzero(data[:len(data) - len(control) + 1] == control[0])
            for i, c in enumerate(control[1:], 1):
                at = at[data[at + i] == c]
            starts[at] = True
    return starts


def escaped(data: np.ndarray, where: np.ndarray, line_feeds: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Escaped bytes of all rows, and where each row begins. One byte is added after each backslash and each start of a control string."""
    added = (data == ESCAPE) | _control_starts(data)
    if line_feeds:
        data = data.copy()
        feeds = data == LINE_FEED
        added |= feeds
        data[feeds] = ESCAPE
    at = np.arange(len(data)) + np.concatenate([[0], np.cumsum(added)[:-1]]) if len(data) else np.zeros(0, int)
    out = np.full(len(data) + int(added.sum()), ESCAPE, np.uint8)
    out[at] = data
    if line_feeds:
        out[at[feeds] + 1] = N
    return out, where + np.concatenate([[0], np.cumsum(added)])[where]


def unescaped(text: bytes) -> bytes:
    """The inverse of ``escaped``: a doubled backslash is one, backslash n is a line feed (in roles only), any other single one was added."""
    if b"\\" not in text:
        return text
    parts = text.split(b"\\\\")
    return b"\\".join(p.replace(b"\\", b"") for p in parts)


def unescaped_role(text: bytes) -> bytes:
    parts = text.split(b"\\\\")
    return b"\\".join(p.replace(b"\\n", b"\n").replace(b"\\", b"") for p in parts)


def _letters_of(data: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Code points of each row of UTF-8 bytes."""
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return np.diff(begins[where])


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(formatted turns, first code point of each text, code points of each escaped text, code points of each turn)."""
    role, role_at = escaped(*text_bytes(roles), line_feeds=True)
    text, text_at = escaped(*text_bytes(texts))
    n_role, n_text = np.diff(role_at), np.diff(text_at)
    lengths = len(BEGIN) + n_role + len(MIDDLE) + n_text + len(END)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    buffer = np.empty(offsets[-1], np.uint8)
    first = offsets[:-1]

    def put(fixed: bytes, at: np.ndarray) -> np.ndarray:
        buffer[at[:, None] + np.arange(len(fixed))] = np.frombuffer(fixed, np.uint8)
        return at + len(fixed)

    def scatter(data: np.ndarray, where: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        buffer[np.arange(len(data)) + np.repeat(at - where[:-1], n)] = data
        return at + n

    at = scatter(role, role_at, put(BEGIN, first), n_role)
    at = scatter(text, text_at, put(MIDDLE, at), n_text)
    put(END, at)
    column = pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(buffer)])
    role_points, text_points = _letters_of(role, role_at), _letters_of(text, text_at)
    start = len(BEGIN) + role_points + len(MIDDLE)
    return column, start, text_points, start + text_points + len(END)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = text_bytes(batch.column(3))[1]
        for first, last in runs_of_rows(sizes):
            part = batch.slice(first, last - first)
            formatted, start, n, total = assemble(part.column(2), part.column(3))
            trained = np.array([r == TRAINED_ROLE for r in part.column(2).to_pylist()], bool)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), formatted.cast(pa.string()), pa.array(np.where(trained, start, 0)), pa.array(np.where(trained, n, 0)), pa.array(total)],
                ["conv_id", "turn", "formatted", "loss_start", "loss_length", "chars"])


def chat_format(turns: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, formatted, loss_start, loss_length, chars.

    A conversation's formatted text is its turns in the order of (turn, formatted). loss_start and loss_length give the part of ``formatted`` that is
    trained on, in code points: the whole escaped text of a turn of the assistant, else nothing. A null role or text is empty. Rows
    that repeat (conv_id, turn) are turns of their own, a null turn comes first, and rows with a null conv_id are one conversation. Other
    columns are not looked at.
    """
    return turns.select("conv_id", "turn", "role", "text").mapInArrow(
        _format, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, turn {turns.schema['turn'].dataType.simpleString()}, "
                 "formatted string, loss_start bigint, loss_length bigint, chars bigint")


def read_turn(formatted: bytes) -> tuple[bytes, bytes]:
    """(role, text) of one formatted turn."""
    if not formatted.startswith(BEGIN) or formatted.find(END) != len(formatted) - len(END):
        raise ValueError("not one formatted turn")
    role, _, text = formatted[len(BEGIN):-len(END)].partition(MIDDLE)
    return unescaped_role(role), unescaped(text)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    state, done = None, []
    table = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    close = lambda s: (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])
    for batch in batches:
        columns = (batch.column(c) for c in ("conv_id", "formatted", "loss_start", "loss_length"))
        for conv_id, formatted, start, n in zip(*columns):
            conv_id, whole, start, n = conv_id.as_py(), formatted.as_py(), start.as_py(), n.as_py()
            if state is None or state[0] != conv_id:
                if state is not None:
                    done.append(close(state))
                state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = read_turn(whole.encode())
            state[1] += 1
            state[2].update(role + b"\n" + text + b"\n")
            if n:
                loss = unescaped(whole[start:start + n].encode())
                state[3] += len(loss.decode())
                state[4].update(loss)
            state[5] += len(whole)
        if len(done) > 1000:
            yield table(done)
            done = []
    if state is not None:
        done.append(close(state))
    if done:
        yield table(done)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Reads the formatted turns back: one row per conversation with its digests."""
    rows = formatted.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "formatted", "loss_start", "loss_length")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return rows.mapInArrow(_digests, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
