"""Batch helpers: cutting Arrow text columns into bounded slices and words.

All functions run inside tasks.  A *slice* is a run of whole rows whose texts
together stay near a byte bound (one longer text makes a slice of its own), so
the numpy temporaries of a task stay small whatever the batch size.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

#: bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return
WHITE = bytes([0x20, *range(0x09, 0x0E)])
U64 = np.uint64


def byte_table(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


#: a byte of a word `[^\x20\x09-\x0D]+`
WORD = ~byte_table(WHITE)
#: a byte of a word `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` before lower-casing A-Z
ALNUM = byte_table(bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Texts:
    """The texts of some rows as one byte buffer; a null is an empty text."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        if column.null_count:
            column = column.fill_null(b"")
        self.array = column
        off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
        raw = column.buffers()[2] if len(column) else None
        data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        self.data, self.off = data[off[0] : off[-1]], off - off[0]

    def __len__(self) -> int:
        return len(self.off) - 1


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about `limit` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = Texts(batch.column(column)).off
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def released(run: Callable) -> Callable:
    """The same function of batches; at the end of a task it hands freed memory back to the system, as Python workers live on."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
        if trim:
            trim(0)

    return wrapped


def ragged(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... for each (start, length), one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values (two multiply-shift rounds)."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings data[start:end], eight bytes a step."""
    lanes = np.ndarray(len(data) + 1, "<u8", np.append(data, np.zeros(8, np.uint8)).tobytes(), strides=(1,))
    size = (end - start).astype(U64)
    out = size * U64(0x9E3779B97F4A7C15)
    at, todo, left = start, None, end - start
    while True:
        lane = lanes[at]
        short = left < 8
        lane[short] &= (U64(1) << (left[short].astype(U64) * U64(8))) - U64(1)
        if todo is None:
            out = mix(out ^ lane)
        else:
            out[todo] = mix(out[todo] * U64(0xC2B2AE3D27D4EB4F) ^ lane)
        more = np.flatnonzero(left > 8)
        if not len(more):
            return out
        todo = more if todo is None else todo[more]
        at, left = at[more] + 8, left[more] - 8


def same_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether the byte string of each span is that of the span numbered `other`, byte by byte."""
    size = end - start
    same = size == size[other]
    own = np.flatnonzero(same & (other != np.arange(len(other))) & (size > 0))
    for a in range(0, len(own), 1 << 16):
        some = own[a : a + (1 << 16)]
        at = ragged(size[some], start[some])
        alike = data[at] == data[ragged(size[some], start[other[some]])]
        same[some] = np.logical_and.reduceat(alike, np.cumsum(size[some]) - size[some])
    return same


def exact_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A code for each span, equal for equal byte strings only: by hash, and by bytes should hashes ever collide."""
    code, first = distinct(hashes)
    if same_spans(data, start, end, first[code]).all():
        return code
    return pd.factorize(pd.Series([data[a:b].tobytes() for a, b in zip(start.tolist(), end.tolist(), strict=True)], dtype=object))[0]


def spans(texts: Texts, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each maximal run of member bytes within a row, and the first run of each row."""
    inside = member[texts.data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = texts.off[:-1][texts.off[:-1] < len(inside)]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = texts.off[1:][texts.off[1:] > 0] - 1
    last[tails] = inside[tails]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, texts.off)


class Words:
    """Words of a slice: start and end byte of each, the first word of each row, a 64-bit hash of each."""

    def __init__(self, texts: Texts, member: np.ndarray = WORD, lower: bool = False):
        self.data = LOWER[texts.data] if lower else texts.data
        self.start, self.end, self.off = spans(texts, member)
        self.hash = span_hashes(self.data, self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.off)

    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.off) - 1), self.counts)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """A code for each word, and the first word that has each code."""
        return distinct(self.hash)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A code for each value in order of appearance, and the first place of each code."""
    code, kinds = pd.factorize(values)
    first = np.empty(len(kinds), np.int64)
    first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    return code, first


def _runs(values: np.ndarray, size: int) -> np.ndarray:
    if size == 1:
        return values
    left = _runs(values, (size + 1) // 2)
    right = left if size % 2 == 0 else _runs(values, size // 2)
    m = len(values) - size + 1
    out = left[:m] * U64(0x9E3779B97F4A7C15 + 2 * size)
    out += right[(size + 1) // 2 :][:m]
    return out


def roll(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive 64-bit values, each made from runs of half the length."""
    return mix(_runs(values, k)) if len(values) >= k else np.zeros(0, U64)


def inside_rows(off: np.ndarray, width: int) -> np.ndarray:
    """For each position, whether a run of `width` from it ends within its row."""
    n = int(off[-1])
    step = np.zeros(n + 1, np.int8)
    length = np.diff(off)
    fits = length >= width
    # a row's last run starts where the next row has not yet begun, so marks never meet
    step[off[:-1][fits]] += 1
    np.subtract.at(step, off[1:][fits] - width + 1, 1)
    return np.cumsum(step[:-1], dtype=np.int8).astype(bool)
