"""Removal of word windows that an earlier document has, by super-k-mers.

Buckets hold packed strings of words.  There, windows are ranked by doubling:
ranks of runs of one, two, four and more words come from sorting pairs of ranks
of half the length.  Equal ranks are equal windows; sorting them counts the
windows and tells the least document of each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import Texts, Words, distinct, exact_codes, slices
from .repeats import Sequence, covered, repeated

WIDTH, KMER = 50, 10


def word_symbols(texts: Texts) -> Sequence:
    words = Words(texts)
    return Sequence(words.hash, words.off, texts.data, words.start, words.end)


def window_ranks(codes: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """A number for each window from `start`, equal for equal windows only."""
    rank, size = codes.astype(np.int64), 1
    while size * 2 <= width:
        n = len(rank) - size
        rank = distinct(rank[:n] * (int(rank.max()) + 1) + rank[size : size + n])[0].astype(np.int64)
        size *= 2
    if size < width:
        # two overlapping runs make the whole window
        return distinct(rank[start] * (int(rank.max()) + 1) + rank[start + width - size])[0].astype(np.int64)
    return rank[start]


def count_resolver(width: int):
    def run(s: Sequence, start: np.ndarray, docs: np.ndarray) -> np.ndarray:
        rank = window_ranks(exact_codes(s.data, s.start, s.end, s.values), start, width)
        order = np.lexsort((docs, rank))
        first = np.flatnonzero(np.append(True, rank[order][1:] != rank[order][:-1]))
        count = np.diff(np.append(first, len(order)))
        hit = np.zeros(len(start), bool)
        hit[order] = docs[order] > np.repeat(docs[order][first], count)
        return hit

    return run


SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def window_dedup(docs: DataFrame, width: int = WIDTH, kmer: int = KMER, with_text: bool = False) -> DataFrame:
    """Remove each word covered by a window whose words also start in a document with a smaller doc_id.

    Windows are judged on the input.  A null text has no words.  A null doc_id
    takes no part: its row stays whole.  Rows of one doc_id do not count as
    earlier than each other.  An empty table gives no rows.  `with_text` adds
    the words left, joined by one space.
    """
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = Words(Texts(part["text"]))
            raw, counts = words.data.tobytes(), words.counts
            gone = np.zeros(len(words), bool)
            for i, (found, copy) in enumerate(zip(part["found"].to_pylist(), part["copy"].to_pylist(), strict=True)):
                a, b = words.off[i], words.off[i + 1]
                if copy and b - a >= width:
                    gone[a:b] = True
                elif found:
                    gone[a:b] = covered(found, width, int(b - a))
            left, texts = np.flatnonzero(~gone), []
            off = np.searchsorted(left, words.off)
            start, end = words.start[left].tolist(), words.end[left].tolist()
            for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                texts.append(b" ".join([raw[x:y] for x, y in zip(start[a:b], end[a:b], strict=True)]))
            columns = [part["doc_id"], pa.array(counts, pa.int64()), pa.array(counts - np.diff(off), pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array([x.decode("utf-8", "replace") for x in texts], pa.string())] if with_text else []), names + ["text"] * with_text)

    return repeated(docs, word_symbols, count_resolver(width), width, kmer).mapInArrow(run, SCHEMA + (", text string" if with_text else ""))
