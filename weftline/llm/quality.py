"""Quality rules with an isolation forest over rule statistics.

Base rules come first.  The forest then splits rule statistics at random: an
odd document is alone after few splits, so its mean path is short.  Trees are
grown on samples of a fixed size, as the method has it; every document is
scored.  The score from which a document goes is set on labelled rows: the one
that catches most rows of quality 0 while at most `lost_good` of the rows of
quality 1 go.  Without labels of both kinds the forest rejects nothing.  One
labelled row in FOLDS sets nothing: `unseen` tells what is caught there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import U64, WORD, Texts, Words, byte_table, distinct, inside_rows, mix, roll, slices, span_hashes
from .language import remainder
from .tables import written

SYMBOLS = byte_table(b"#*$%&|<>")
_HEAD = np.arange(256) & 0xC0 != 0x80  # first bytes of code points
_UPPER = byte_table(bytes(range(0x41, 0x5B)))
_PUNCT = byte_table(bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum()))
#: rows a tree is grown on, number of trees, rows that all trees draw from, score bins of the calibration: bounds of
#: what the driver gets.  Small trees, so that odd rows that are like each other do not hide one another; the size was
#: chosen among 8 to 256 on labelled rows with remainder 1, the threshold being set on those with remainder 0
SAMPLE, TREES, DRAWN, BINS = 64, 256, 1 << 14, 2048
#: labelled rows by crc32 of the doc_id; those with remainder FOLDS - 1 are left out of the calibration
FOLDS = 3
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_punct", "n_distinct", "n_lines"]


def per_row(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of byte values over each row."""
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    return total[off[1:]] - total[off[:-1]]


def distinct_per_row(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Number of distinct values in each row."""
    if not len(values):
        return np.zeros(rows, np.int64)
    _, first = distinct(values ^ mix(row.astype(U64) + U64(1)))
    return np.bincount(row[first], minlength=rows)


def statistics(texts: Texts) -> dict[str, np.ndarray]:
    rows, data, off = len(texts), texts.data, texts.off
    words = Words(texts)
    n_words, row = words.counts, words.row()
    # lines: between line feeds and row ends
    feed = data == 0x0A
    edge = np.zeros(len(data) + 1, bool)
    edge[np.flatnonzero(feed) + 1] = True
    edge[off] = True
    start = np.flatnonzero(edge[:-1])
    end = np.append(start[1:], len(data))[: len(start)]
    end = end - feed[end - 1]
    chars = np.append(0, np.cumsum(WORD[data], dtype=np.int64))
    own = chars[end] > chars[start]
    start, end = start[own], end[own]
    line_row = np.searchsorted(off, start, "right") - 1
    n_lines = np.bincount(line_row, minlength=rows)
    n_dup = n_lines - distinct_per_row(span_hashes(data, start, end), line_row, rows)
    # words within windows of five that their text has twice or more
    repeat = np.zeros(rows, np.int64)
    if len(words) >= 5:
        fits = np.flatnonzero(inside_rows(words.off, 5)[: len(words) - 4])
        if len(fits):
            code, _ = distinct(roll(words.hash, 5)[fits] ^ mix(row[fits].astype(U64) + U64(1)))
            twice = fits[np.bincount(code)[code] > 1]
            step = np.zeros(len(words) + 1, np.int64)
            step[twice] += 1
            step[twice + 5] -= 1
            repeat = np.bincount(row[np.cumsum(step[:-1]) > 0], minlength=rows)
    return {
        "n_words": n_words,
        "word_chars": per_row(WORD[data] & _HEAD[data], off),
        "n_symbols": per_row(SYMBOLS[data], off),
        "n_dup_lines": n_dup,
        "n_repeat_words": repeat,
        "n_upper": per_row(_UPPER[data], off),
        "n_punct": per_row(_PUNCT[data], off),
        "n_distinct": distinct_per_row(words.hash, row, rows),
        "n_lines": n_lines,
    }


def rule_statistics(docs: DataFrame) -> DataFrame:
    """Counts of every document (null: none) and `base_failed`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = statistics(Texts(part["text"]))
            yield pa.RecordBatch.from_arrays([part["doc_id"], *(pa.array(found[c].astype(np.int64)) for c in STATS)], ["doc_id", *STATS])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = source.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in STATS))
    return rows.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """What the forest splits: shares, so that length does not decide; repeats of words have a base rule of their own."""
    words, chars, lines = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1), np.maximum(s["n_lines"], 1)
    return np.stack([s["word_chars"] / words, s["n_symbols"] / words, s["n_upper"] / chars, s["n_punct"] / chars, s["n_distinct"] / words**0.9, s["n_dup_lines"] / lines], 1)


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean path of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, float)
    big = 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


class Forest:
    """Isolation trees in arrays: feature (-1: leaf), cut, children, path length at leaves."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, size: int = SAMPLE, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.size = min(size, len(sample))
        self.trees = [self.grow(sample[rng.permutation(len(sample))[: self.size]], rng) for _ in range(trees)] if len(sample) > 1 else []

    def grow(self, rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        depth = math.ceil(math.log2(max(self.size, 2)))
        nodes: list[list[float]] = [[-1, 0, 0, 0, 0]]
        todo = [(0, rows, 0)]
        while todo:
            at, own, level = todo.pop()
            spread = np.flatnonzero(own.max(0) > own.min(0)) if len(own) > 1 else []
            if level >= depth or not len(spread):
                nodes[at][4] = level + float(average_path(len(own)))
                continue
            k = int(rng.choice(spread))
            cut = rng.uniform(own[:, k].min(), own[:, k].max())
            left = own[:, k] < cut
            nodes[at][:4] = [k, cut, len(nodes), len(nodes) + 1]
            todo += [(len(nodes), own[left], level + 1), (len(nodes) + 1, own[~left], level + 1)]
            nodes += [[-1, 0, 0, 0, 0], [-1, 0, 0, 0, 0]]
        table = np.array(nodes)
        return table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3].astype(np.int64), table[:, 4]

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; above one half is odder than the average."""
        if not self.trees:
            return np.zeros(len(x))
        total = np.zeros(len(x))
        for feature, cut, left, right, path in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                live = np.flatnonzero(feature[at] >= 0)
                if not len(live):
                    break
                here = at[live]
                at[live] = np.where(x[live, feature[here]] < cut[here], left[here], right[here])
            total += path[at]
        return 2.0 ** (-total / len(self.trees) / max(float(average_path(self.size)), 1e-9))


def sample_rows(stats: DataFrame, limit: int) -> DataFrame:
    """At most `limit` rows, the same for the same rows: those with the least hashes.

    All but a share of the hashes that holds enough rows goes before the order
    is looked at, so a task sends its part of the sample and not the whole.
    """
    hash_ = F.xxhash64("doc_id", *STATS)
    share = min(1.0, 2.0 * limit / max(stats.count(), 1))
    least = min(2**63 - 1, -(2**63) + int(share * 2**64))
    return stats.filter(hash_ <= least).orderBy(hash_).limit(limit)


def threshold(histogram: list, lost_good: float) -> float:
    """The score that lets at most `lost_good` of good rows go and catches most bad ones; above 1 if there is none."""
    counts = np.zeros((2, BINS + 1))
    for label, b, n in histogram:
        counts[int(label), min(max(int(b), 0), BINS)] += n
    if not counts[0].sum() or not counts[1].sum():
        return 2.0
    above = counts[:, ::-1].cumsum(1)[:, ::-1]  # rows that a threshold at the lower edge of a bin rejects
    fine = np.flatnonzero(above[1] <= lost_good * counts[1].sum())
    if not len(fine):
        return 2.0
    # of thresholds that catch equally many, the highest
    best = fine[above[0][fine] == above[0][fine].max()].max()
    return best / BINS if above[0][best] else 2.0


def quality(docs: DataFrame, labels: DataFrame, lost_good: float = 0.005, trees: int = TREES) -> DataFrame:
    """Rule statistics, base verdict, anomaly score and the final `kept` of every document.

    A null or empty text has no words and fails the base rules.  Repeated rows
    and null doc_ids give rows of their own; a null doc_id or quality labels
    nothing.  Empty documents give no rows.
    """
    stats = written(rule_statistics(docs), "stats")
    # only rows that the base rules pass are the forest's: it looks for what those rules miss
    passed = stats.filter(~F.col("base_failed"))
    rows = sample_rows(passed, DRAWN).select(*STATS).toPandas()
    forest = Forest(features({c: rows[c].to_numpy(float) for c in STATS}), trees)
    model = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features({c: batch[c].to_numpy().astype(float) for c in STATS})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.value.score(x))], [*batch.schema.names, "anomaly"])

    kinds = "doc_id long, " + ", ".join(f"{c} long" for c in STATS) + ", base_failed boolean"
    scored = stats.mapInArrow(run, kinds + ", anomaly double")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marked = scored.filter(~F.col("base_failed")).join(known, "doc_id").filter(remainder("doc_id", FOLDS) != FOLDS - 1)
    histogram = marked.groupBy("quality", F.floor(F.col("anomaly") * BINS).alias("bin")).count().collect()  # at most 2 * (BINS + 1) rows
    limit = threshold([tuple(r) for r in histogram], lost_good)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.floor(F.col("anomaly") * BINS) < limit * BINS))


def unseen(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Of the labelled rows that the base rules pass and that set nothing: their number by quality, and how many the forest rejects."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter("doc_id is not null and quality in (0, 1)")
    marked = rows.filter(~F.col("base_failed")).join(known, "doc_id").filter(remainder("doc_id", FOLDS) == FOLDS - 1)
    return marked.groupBy("quality").agg(F.count("*").alias("n"), F.count_if(~F.col("kept")).alias("rejected"))
