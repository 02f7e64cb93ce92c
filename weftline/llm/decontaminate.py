"""Benchmark decontamination by searching test suffixes in suffix arrays of the training texts.

The training side is dealt in shards (slices of a task's rows).  A shard's word
sequence gets a suffix array by prefix doubling, cut at the longest window.
Every suffix of every test item is then found by binary search: the range of
training suffixes that start with the test window gives the documents and the
places.  Words that no test item has cannot lie inside a match; suffixes that
run into one within a window's length are left out of the array.  Where windows
of a document follow each other as they do in an item, they make a longer
verbatim match; the longest one and its place are told for every document.

The test side is a stated query set.  Items are worked through in blocks of
bounded size: their index is a few arrays, about five times the texts.  A block
adds the runs of hit words and the items it finds to what came before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import ALNUM, Texts, Words, ragged, released, slices
from .tables import written

#: bytes of test texts of a block; pairs of a word and a place in an item that are looked at together
TEST_BLOCK_BYTES, PAIRS = 16 << 20, 2 << 20


class Tests:
    """Words of some test items as one sequence of codes, and its distinct windows.

    `code` has the items one after another, each with a 0 behind it.  A window
    is a first place in `code` and a length; `at` has all places of each window.
    """

    def __init__(self, ids: list, texts: pa.Array, width: int):
        w = Words(Texts(texts), ALNUM, lower=True)
        self.ids = np.array([str(x) for x in ids], object)
        self.words, known = np.unique(w.hash, return_inverse=True)
        row = w.row()
        self.code = np.zeros(len(w) + len(self.ids), np.int32)
        place = np.arange(len(w)) + row
        self.code[place] = known + 1  # 0 stands for the end of an item, and for any word that no item has
        left = w.off[1:][row] - np.arange(len(w))  # words from here to the item's end
        starts = np.flatnonzero((left >= width) | (left == w.counts[row]))
        length = np.minimum(left[starts], width)
        _, rank = suffix_order(self.code, width)
        kind = rank[place[starts]] * (width + 1) + length
        by = np.argsort(kind, kind="stable")
        first = np.flatnonzero(np.append(True, kind[by][1:] != kind[by][:-1])) if len(by) else np.zeros(0, np.int64)
        self.at, self.item = place[starts][by].astype(np.int32), row[starts][by].astype(np.int32)
        self.off = np.append(first, len(by))
        self.start, self.length = self.at[first], length[by][first]
        self.shortest, self.width = int(self.length.min(initial=width)), width

    def __len__(self) -> int:
        return len(self.start)


def suffix_order(code: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes by their first `width` codes, and the rank of each suffix by those, by prefix doubling.

    Codes of 0 end a suffix: what follows them does not count.
    """
    n = len(code)
    rank = code.astype(np.int64)
    done = 1
    while done < width:
        step = min(done, width - done)
        back = np.zeros(n, np.int64)
        back[: n - step] = rank[step:] if step < n else 0
        key = rank * (int(rank.max(initial=0)) + 2) + back
        key[code == 0] = 0
        _, rank = np.unique(key, return_inverse=True)
        done += step
        rank = rank + 1
        rank[code == 0] = 0
    return np.argsort(rank, kind="stable"), rank


def search(order: np.ndarray, code: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """First and last+1 place in the suffix order of the suffixes that begin with each window.

    All windows narrow their ranges together, word by word: within a range the
    suffixes agree so far and are sorted by the next word, so two binary
    searches find the part that has the window's.
    """
    n, padded = len(code), np.append(code, np.zeros(tests.width, code.dtype))
    low, high = np.zeros(len(tests), np.int64), np.full(len(tests), len(order), np.int64)
    for j in range(tests.width):
        live = np.flatnonzero((tests.length > j) & (low < high))
        if not len(live):
            break
        want = tests.code[tests.start[live] + j]
        ends = []
        for right in (False, True):
            a, b = low[live].copy(), high[live].copy()
            while True:
                open_ = np.flatnonzero(a < b)
                if not len(open_):
                    break
                mid = (a[open_] + b[open_]) // 2
                word = padded[np.minimum(order[mid] + j, n)]
                go = word <= want[open_] if right else word < want[open_]
                a[open_] = np.where(go, mid + 1, a[open_])
                b[open_] = np.where(go, b[open_], mid)
            ends.append(a)
        low[live], high[live] = ends
    return low, high


def shard_matches(words: Words, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """Every occurrence of a test window in the shard: the window's number and the word where it begins."""
    none = np.zeros(0, np.int64)
    if not len(words) or not len(tests):
        return none, none
    at = np.minimum(np.searchsorted(tests.words, words.hash), len(tests.words) - 1)
    code = np.where(tests.words[at] == words.hash, at + 1, 0)
    # rows are parted by a 0, so no suffix runs from one document into the next
    row = words.row()
    spread = np.zeros(len(code) + len(words.off), np.int64)
    place = np.arange(len(code)) + row
    spread[place] = code
    # runs of known words shorter than the shortest window cannot match: leave them out
    known = np.concatenate(([0], (spread > 0).astype(np.int8), [0]))
    edges = np.flatnonzero(np.diff(known))
    first, last = edges[::2], edges[1::2]
    keep = last - first >= tests.shortest
    first, size = first[keep], (last - first)[keep]
    if not len(first):
        return none, none
    take = ragged(size + 1, first)
    text = spread[take]  # each run and the 0 behind it
    order, _ = suffix_order(text, tests.width)
    order = order[text[order] > 0]
    low, high = search(order, text, tests)
    count = high - low
    hit = np.flatnonzero(count)
    where = order[ragged(count[hit], low[hit])]
    back = np.zeros(len(spread), np.int64)
    back[place] = np.arange(len(code))
    return np.repeat(hit, count[hit]), back[take[where]]


def longest_matches(words: Words, tests: Tests, window: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Length of each row's longest verbatim match with an item, in words, and its first word in the row; 0 and -1 if none.

    Pairs (word, place in an item) of hit windows lie on diagonals; places that
    follow each other on one make one match.  Pairs are looked at in order of
    words, PAIRS at a time; the ends of the matches so far are kept between.
    """
    rows = len(words.off) - 1
    best, begin = np.zeros(rows, np.int64), np.full(rows, -1, np.int64)
    order = np.lexsort((tests.length[window], at)) if len(at) else np.zeros(0, np.int64)
    window, at, row = window[order], at[order], words.row()[at[order]]
    count = np.diff(tests.off)[window]
    upto = np.cumsum(count)
    a, ends = 0, (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    while a < len(at):
        b = int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS, "right"))
        b = max(b, a + 1)
        while b < len(at) and at[b] == at[b - 1]:  # all pairs of a word together
            b += 1
        some = np.arange(a, b)
        pos = np.repeat(at[some], count[some])
        own = np.repeat(window[some], count[some])
        diagonal = pos - tests.at[ragged(count[some], tests.off[window[some]])]
        by = np.lexsort((pos, diagonal))
        pos, own, diagonal = pos[by], own[by], diagonal[by]
        who = row[a:b][np.searchsorted(at[a:b], pos)]
        new = np.append(True, (diagonal[1:] != diagonal[:-1]) | (pos[1:] != pos[:-1] + 1) | (who[1:] != who[:-1]))
        first = np.flatnonzero(new)
        start = pos[first]
        # matches that go on from the pairs before
        old_diagonal, old_next, old_start = ends
        if len(old_diagonal):
            k = np.minimum(np.searchsorted(old_diagonal, diagonal[first]), len(old_diagonal) - 1)
            on = (old_diagonal[k] == diagonal[first]) & (old_next[k] == start) & (words.off[who[first]] <= old_start[k])
            start = np.where(on, old_start[k], start)
        since = np.repeat(start, np.diff(np.append(first, len(pos))))
        length = pos - since + tests.length[own]
        for r, n, p in ((who, length, since),):
            top = np.lexsort((p, -n, r))
            head = np.append(True, r[top][1:] != r[top][:-1])
            r, n, p = r[top][head], n[top][head], p[top][head] - words.off[r[top][head]]
            better = (n > best[r]) | ((n == best[r]) & (p < begin[r]))
            best[r[better]], begin[r[better]] = n[better], p[better]
        last = pos == pos.max()
        keep = np.argsort(diagonal[last], kind="stable")
        ends = diagonal[last][keep], pos[last][keep] + 1, since[last][keep]
        a = b
    return best, begin


def item_blocks(benchmark: DataFrame, limit: int) -> Iterator[tuple[list, pa.Array]]:
    """Items in blocks of about `limit` bytes of text, one block on the driver at a time; one empty block if there are none."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter("item_id is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, -(-total // limit))
    for k in range(blocks):
        own = rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).toArrow()
        yield own["item_id"].to_pylist(), own["text"].combine_chunks()


#: what a block of items adds to: runs of hit words (first word, end, ...), items, the number of hit words, the longest match
FOUND = {"n_words": 0, "n_hit": 0, "longest_match": 0, "longest_at": -1}
SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_match long, longest_at long"


def covered(words: Words, tests: Tests, window: np.ndarray, at: np.ndarray, spans: list) -> np.ndarray:
    """Which words lie in an occurrence of a window, or in the runs (first word, end, ...) of their row found before."""
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + tests.length[window], -1)
    for base, own in zip(words.off[:-1].tolist(), spans, strict=True):
        if own:
            np.add.at(step, base + np.array(own[::2]), 1)
            np.add.at(step, base + np.array(own[1::2]), -1)
    return np.cumsum(step[:-1]) > 0


def block_pass(rows: DataFrame, tests: Tests) -> DataFrame:
    """Rows with what this block of items finds added to spans, items and the columns of FOUND."""
    own = rows.sparkSession.sparkContext.broadcast(tests)  # about five times TEST_BLOCK_BYTES at most
    names = rows.columns
    kinds = {"spans": pa.list_(pa.int64()), "items": pa.list_(pa.string())} | dict.fromkeys(FOUND, pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = own.value
        for part in slices(batches):
            words = Words(Texts(part["text"]), ALNUM, lower=True)
            window, at = shard_matches(words, t)
            spans, items = part["spans"].to_pylist(), part["items"].to_pylist()
            if len(at):
                row = words.row()
                hit = np.append(covered(words, t, window, at, spans), False)
                edge = np.append(True, row[1:] != row[:-1])
                first = np.flatnonzero(hit[:-1] & (edge | ~np.append(False, hit[:-2])))
                end = np.flatnonzero(hit[:-1] & (np.append(edge[1:], True) | ~hit[1:])) + 1
                for r in np.unique(row[at]).tolist():
                    mine = slice(*np.searchsorted(row[first], [r, r + 1]))
                    spans[r] = (np.stack([first[mine], end[mine]], 1) - words.off[r]).reshape(-1).tolist()
                pairs = np.unique(np.stack([row[at], window], 1), axis=0)
                count = np.diff(t.off)[pairs[:, 1]]
                named = np.unique(np.stack([np.repeat(pairs[:, 0], count), t.item[ragged(count, t.off[pairs[:, 1]])]], 1), axis=0)
                for r, k in named.tolist():
                    items[r] = sorted({*items[r], t.ids[k]}) if t.ids[k] not in items[r] else items[r]
            best, begin = longest_matches(words, t, window, at)
            old, old_at = part["longest_match"].to_numpy(), part["longest_at"].to_numpy()
            up = (best > old) | ((best == old) & (begin < old_at) & (best > 0))
            n_hit = [sum(x[1::2]) - sum(x[::2]) for x in spans]
            made = {"spans": spans, "items": items, "n_words": words.counts, "n_hit": n_hit, "longest_match": np.where(up, best, old), "longest_at": np.where(up, begin, old_at)}
            yield pa.RecordBatch.from_arrays([pa.array(made[c], kinds[c]) if c in made else part[c] for c in names], names)

    return rows.mapInArrow(released(run), rows.schema)


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, limit: int = TEST_BLOCK_BYTES, carry: tuple[str, ...] = ()) -> DataFrame:
    """Hits of windows of `width` test words in every document, and its longest verbatim match of a window or more.

    A null text has no words and no hits; an item with fewer words than `width`
    is one window, an item without words or id gives none.  Repeated rows and
    null doc_ids give rows of their own.  Without documents there is no row;
    without items nothing is hit.  longest_match is 0 and longest_at, its first
    word, -1 where nothing is hit; of equal ones the first counts.  `carry`
    names columns of docs that are returned too.
    """
    text = F.col("text").cast("string").alias("text")
    start = [F.array().cast("array<bigint>").alias("spans"), F.array().cast("array<string>").alias("items"), *(F.lit(x).cast("long").alias(c) for c, x in FOUND.items())]
    # carried columns have other names while the search adds its own
    kept = [F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry) if c != "text"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, *kept, *start)
    for number, (ids, texts) in enumerate(item_blocks(benchmark, limit)):
        rows = block_pass(written(rows, "decontaminated") if number else rows, Tests(ids, texts, width))
    rows = rows.withColumns({"n_items": F.size("items").cast("long"), "items_sha256": F.sha2(F.array_join("items", ","), 256), "contaminated": F.col("n_hit") > 0})
    back = [F.col("text") if c == "text" else F.col(f"carried_{i}").alias(c) for i, c in enumerate(carry)]
    return rows.select(*(x.split()[0] for x in SCHEMA.split(", ")), *back)
