"""Texts inside tasks: Arrow batches as numpy bytes, word bounds and word hashes without a loop per word."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

PART_BYTES = 1 << 20       # bytes hashed at once; a longer text is cut at white space, whole words stay whole
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as they were needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            def powers(base: int) -> np.ndarray:
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                return np.multiply.accumulate(steps)
            self.up, self.down = powers(_BASE), powers(pow(_BASE, -1, 1 << 64))


_powers = _Powers()


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def white(data: np.ndarray) -> np.ndarray:
    """True at space and 0x09-0x0D."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_bounds(data: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal run without white space; a text that begins inside ``data`` begins a word too."""
    inside = ~white(data)
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    if starts is not None:
        cuts = starts[(starts > 0) & (starts < len(data))]
        begins[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def hash_runs(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes, by differences of one running polynomial sum."""
    if not len(begins):
        return np.zeros(0, np.uint64)
    _powers.reach(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers.up[:len(data)], out=total[1:])
    return mix((total[ends] - total[begins]) * _powers.down[begins] + (ends - begins).astype(np.uint64) * _ODD)


def parts(data: np.ndarray, size: int = PART_BYTES) -> Iterator[np.ndarray]:
    """``data`` in pieces of about ``size`` bytes, cut before white space only."""
    at = 0
    while at < len(data):
        to = at + size
        while to < len(data):
            gap = np.flatnonzero(white(data[to:to + size]))
            if len(gap):
                to += int(gap[0])
                break
            to += size
        yield data[at:to]
        at = to


def word_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all words of one text, whatever its length."""
    found = [hash_runs(part, *word_bounds(part)) for part in parts(data)]
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and where each row's begin (one more for the end); a null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, where, values = column.buffers()
    where = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    return data[where[0]:where[-1]], where - where[0]


def give_back() -> None:
    """At the end of a task: freed memory goes back to the system; a worker that waits for the next task would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
    if trim:
        trim(0)


def beside_text(docs: DataFrame, text_col: str, replaced: tuple[str, ...]) -> tuple[DataFrame, StructType, list[Column]]:
    """(rows of ``row``, the other columns in a struct, and ``text``; their schema; the columns as they were, without those replaced).

    So a text (or a list of ids) goes to the Python worker and back once, though it is both a column to keep and the one to look at.
    """
    kept = [c for c in docs.columns if c not in replaced]
    others = [c for c in kept if c != text_col]
    rows = docs.select((F.struct(*others) if others else F.lit(0)).alias("row"), F.col(text_col).alias("text"))
    return rows, StructType(list(rows.schema.fields)), [(F.col("text") if c == text_col else F.col("row")[c]).alias(c) for c in kept]


def runs_of_rows(where: np.ndarray, size: int = PART_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes each; a longer row stands alone."""
    first, rows = 0, len(where) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(where, where[first] + size, "right")) - 1)
        yield first, min(last, rows)
        first = last


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each run of equal integer keys, from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cuts = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1 if len(batch) > 1 else np.zeros(0, int)
        if held and any(held[-1].column(k)[len(held[-1]) - 1].as_py() != c[0] for k, c in zip(keys, columns)):
            yield pa.Table.from_batches(held)
            held = []
        edges = [0, *cuts.tolist(), len(batch)]
        for first, last in zip(edges[:-1], edges[1:]):
            held.append(batch.slice(first, last - first))
            if last < len(batch):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)
