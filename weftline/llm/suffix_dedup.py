"""Removal of byte strings that an earlier document has, by longest previous factors.

In a bucket of super-k-mers the windows are sorted as suffixes, cut at the
window's length.  Around each suffix the nearest ones before and behind it in
that order which belong to a smaller document have the longest matches with it;
the longer of the two is its longest previous factor.  A factor as long as a
window means that the window also starts in a smaller document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Texts, mix, released, slices
from .repeats import Sequence, covered, repeated, run_lengths

BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
WIDTH, KMER = 50, 20


def byte_symbols(texts: Texts) -> Sequence:
    at = np.arange(len(texts.data) + 1)
    return Sequence(BYTE_VALUES[texts.data], texts.off, texts.data, at[:-1], at[1:])


def suffix_lanes(data: np.ndarray, start: np.ndarray, width: int) -> list[np.ndarray]:
    """The first `width` bytes of each suffix as big-endian 64-bit numbers; the last one may overlap the one before."""
    lanes = np.ndarray(len(data) + 1, ">u8", np.append(data, np.zeros(8, np.uint8)).tobytes(), strides=(1,))
    places = [*range(0, width - 7, 8)] + ([width - 8] if width % 8 else [])
    return [lanes[start + p].astype(np.uint64) for p in places]


def common_prefixes(lanes: list[np.ndarray], width: int) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it, at most `width`; 0 for the first."""
    n = len(lanes[0])
    out = np.zeros(n, np.int64)
    open_ = np.arange(1, n)
    places = [*range(0, width - 7, 8)] + ([width - 8] if width % 8 else [])
    for lane, p in zip(lanes, places, strict=True):
        differ = lane[open_] ^ lane[open_ - 1]
        unlike = differ != 0
        at = differ[unlike]
        zeros = np.zeros(len(at), np.int64)  # leading bytes that agree
        for shift in (32, 16, 8):
            high = (at >> np.uint64(64 - shift)) == 0
            zeros += np.where(high, shift // 8, 0)
            at = np.where(high, at << np.uint64(shift), at)
        out[open_[unlike]] = p + zeros
        open_ = open_[~unlike]
    out[open_] = width
    return out


def longest_previous(docs: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Longest match of each suffix, in suffix order, with a suffix of a smaller document.

    The nearest smaller one on a side is reached by jumps: from a neighbour that
    is not smaller to that one's own nearest, keeping the least common prefix.
    """
    n = len(docs)
    best = np.zeros(n, np.int64)
    for back in (True, False):
        # the side's neighbour of each suffix and the common prefix with it
        near = np.arange(n) - 1 if back else np.arange(n) + 1
        match = prefix.copy() if back else np.append(prefix[1:], 0)
        live = np.arange(n)
        while len(live):
            on = near[live]
            live = live[(on >= 0) & (on < n) & (match[live] > 0)]
            live = live[docs[near[live]] >= docs[live]]
            # all jumps of a round read the links as they were, so each goes over larger ones only
            on = near[live]
            onward, less = near[on], np.minimum(match[live], match[on])
            near[live], match[live] = onward, less
        on = np.clip(near, 0, n - 1)
        best = np.maximum(best, np.where((near >= 0) & (near < n) & (docs[on] < docs), match, 0))
    return best


def suffix_resolver(width: int):
    def run(s: Sequence, start: np.ndarray, docs: np.ndarray) -> np.ndarray:
        lanes = suffix_lanes(s.data, start, width)
        order = np.lexsort((docs, *lanes[::-1]))
        prefix = common_prefixes([x[order] for x in lanes], width)
        hit = np.zeros(len(start), bool)
        hit[order] = longest_previous(docs[order], prefix) >= width
        return hit

    return run


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def suffix_dedup(docs: DataFrame, width: int = WIDTH, kmer: int = KMER, with_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove each byte covered by a `width`-byte string that also starts in a document with a smaller doc_id.

    Strings are judged on the input.  A null text is empty.  A null doc_id is
    neither smaller nor larger than any: its row takes no part and stays whole.
    Rows of one doc_id do not count as earlier than each other.  An empty table
    gives no rows.  `with_text` adds what is left as text; characters of which
    only a part is left go.  `carry` names columns of docs that are returned too, as
    carried_<name> where a column of the result has the name.
    """
    kept_columns = [f for f in docs.schema if f.name in carry]
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    # on their way they have names that nothing else has
    ways = {f.name: f"_carry{i}" for i, f in enumerate(kept_columns)}
    taken = {*names, *(["text"] if with_text else [])}
    returned = {f.name: f"carried_{f.name}" if f.name in taken else f.name for f in kept_columns}
    docs = docs.select("doc_id", "text", *(F.col(f"`{old}`").alias(new) for old, new in ways.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out: list[list] = [[] for _ in range(5)]
            for raw, found, copy in zip(Texts(part["text"]).array.to_pylist(), part["found"].to_pylist(), part["copy"].to_pylist(), strict=True):
                kept, removed, spans = raw, 0, 0
                if copy and len(raw) >= width:
                    kept, removed, spans = b"", len(raw), 1
                elif found:
                    gone = covered(found, width, len(raw))
                    first, _ = run_lengths(gone)
                    kept, removed, spans = np.frombuffer(raw, np.uint8)[~gone].tobytes(), int(gone.sum()), int(gone[first].sum())
                for x, v in zip(out, (len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if with_text else None), strict=True):
                    x.append(v)
            columns = [part["doc_id"], *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string())]
            columns += [pa.array(out[4], pa.string())] * with_text + [part[ways[f.name]] for f in kept_columns]
            yield pa.RecordBatch.from_arrays(columns, names + ["text"] * with_text + [returned[f.name] for f in kept_columns])

    schema = SCHEMA + ", text string" * with_text + "".join(f", `{returned[f.name]}` {f.dataType.simpleString()}" for f in kept_columns)
    return repeated(docs, byte_symbols, suffix_resolver(width), width, kmer, tuple(ways.values())).mapInArrow(released(run), schema)
