"""Language identification as inference of multilingual mixtures.

Training: counts of byte trigrams of words for each language, from a bounded
sample of labelled documents.  Prediction: each word of a text comes from one
of the languages; expectation-maximisation estimates the document's language
proportions from the words' n-gram likelihoods.  Sets of the leading languages
are compared by likelihood less a penalty for each language more (half the log
of the number of words).  Sets of up to LEAST_SETS languages are always looked
at; larger ones as long as the last language added was worth its penalty.  The
largest share of the chosen set is the prediction and its score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import U64, Texts, Words, byte_table, mix, ragged, released, slices

#: bits of a hashed trigram at most; entries of the table of features by languages at most (bounds what is collected and broadcast)
BITS, ENTRIES = 16, 1 << 24
#: labelled documents of a language that are learned from, about; languages that are learned, the most frequent ones
PER_LANGUAGE, MOST_LANGUAGES = 20_000, 1 << 16
ITERATIONS, LEAST_SETS = 8, 3
#: bytes of text that a task works on together, times languages: words by languages stay near the same number
SLICE_BYTES = 16 << 20
LETTERS = byte_table(bytes([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))


def remainder(column: str, of: int) -> Column:
    """crc32 of a value as text, modulo `of`; null as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(of))


def bits_for(languages: int) -> int:
    """Bits of features: BITS, or as many fewer as keep the table of all languages within ENTRIES."""
    return min(BITS, (ENTRIES // max(languages, 1)).bit_length() - 1)


def word_trigrams(words: Words, first: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of the given words with a space on both sides: the number of the word, the feature."""
    start, size = words.start[first], words.end[first] - words.start[first]
    buffer = np.full(int(size.sum()) + len(first) + 2, 0x20, np.int64)
    begin = np.cumsum(size + 1) - size  # behind a space each
    buffer[ragged(size, begin)] = words.data[ragged(size, start)]
    number = np.repeat(np.arange(len(first)), size)
    middle = ragged(size, begin)
    code = buffer[middle - 1] | buffer[middle] << 8 | buffer[middle + 1] << 16
    return number, (mix(code.astype(U64)) >> U64(64 - bits)).astype(np.int64)


def trigram_counts(docs: DataFrame, bits: int) -> DataFrame:
    """Counts of features by language number (column k) over whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for part in slices(batches):
            words = Words(Texts(part["text"]), LETTERS, lower=True)
            if not len(words):
                continue
            code, first = words.distinct()
            number, feature = word_trigrams(words, first, bits)
            lang = part["k"].to_numpy()[words.row()]
            for k in np.unique(lang).tolist():
                uses = np.bincount(code[lang == k], minlength=len(first))
                total[k] = total.get(k, 0) + np.bincount(feature, weights=uses[number], minlength=1 << bits)
        for k, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["k", "feature", "n"])

    return docs.select("text", "k").mapInArrow(released(run), "k int, feature int, n double").groupBy("k", "feature").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities of features, from the rows given that have a lang and a text.

    Of more than MOST_LANGUAGES values of lang the most frequent ones are
    learned.  More than ENTRIES / 2^BITS languages share a table of the same
    size, with fewer features each.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter("lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()}
    names, bits = sorted(sizes), bits_for(len(sizes))
    if not names:
        return [], np.zeros((1 << bits, 0), np.float32)
    known = docs.sparkSession.createDataFrame([(name, k, per_language / sizes[name]) for k, name in enumerate(names)], "lang string, k int, share double")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.join(F.broadcast(known), "lang").filter(place < F.col("share"))
    # numbers only, and as many rows as the table has entries at most
    got = trigram_counts(drawn, bits).toArrow()
    counts = np.zeros((1 << bits, len(names)), np.float32)
    counts[got["feature"].to_numpy(), got["k"].to_numpy()] = got["n"].to_numpy()
    return names, np.log((counts + 0.5) / (counts.sum(0, dtype=np.float64) + 0.5 * len(counts))).astype(np.float32)


def _sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros((1, *values.shape[1:])), np.cumsum(values, 0, dtype=np.float64)))
    return total[off[1:]] - total[off[:-1]]


def expectation_maximisation(likelihood: np.ndarray, uses: np.ndarray, off: np.ndarray, allowed: np.ndarray, iterations: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the allowed languages in each row, and the log-likelihood they give.

    Row i has the words off[i] to off[i + 1] - 1, each with its number of uses.
    """
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    share = allowed / np.maximum(allowed.sum(1, keepdims=True), 1)
    count = np.maximum(_sums(uses[:, None], off), 1)
    for _ in range(iterations):
        joint = likelihood * share[row].astype(np.float32)
        joint *= (uses / np.maximum(joint.sum(1), 1e-30)).astype(np.float32)[:, None]
        share = _sums(joint, off) / count
    mixed = (likelihood * share[row].astype(np.float32)).sum(1)
    return share, _sums((uses * np.log(np.maximum(mixed, 1e-30)))[:, None], off)[:, 0]


def some_rows(off: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of some rows, and where each of these rows begins among them."""
    size = np.diff(off)[rows]
    return ragged(size, off[:-1][rows]), np.append(0, np.cumsum(size))


def mixtures(words: Words, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leading language of each row and its share in the set of languages chosen."""
    rows, languages = len(words.off) - 1, logs.shape[1]
    code, first = words.distinct()
    number, feature = word_trigrams(words, first, len(logs).bit_length() - 1)
    known = np.add.reduceat(logs[feature], np.searchsorted(number, np.arange(len(first))), axis=0)
    known = np.exp(known - known.max(1, keepdims=True))  # a word's own factor does not change what is best
    # a word that a row has often is looked at once
    pair, uses = np.unique(words.row() * len(first) + code, return_counts=True)
    likelihood, off = known[pair % len(first)], np.searchsorted(pair, np.arange(rows + 1) * len(first))
    share, _ = expectation_maximisation(likelihood, uses, off, np.ones((rows, languages)), ITERATIONS)
    order = np.argsort(-share, axis=1, kind="stable")
    best, lead, score = np.full(rows, -np.inf), order[:, 0].copy(), np.ones(rows)
    penalty = 0.5 * np.log(np.maximum(words.counts, 2))
    live = np.arange(rows)
    for size in range(1, languages + 1):
        allowed = np.zeros((len(live), languages))
        np.put_along_axis(allowed, order[live, :size], 1.0, axis=1)
        at, starts = some_rows(off, live)
        own, value = expectation_maximisation(likelihood[at], uses[at], starts, allowed, ITERATIONS if size > 1 else 0)
        value = value - (size - 1) * penalty[live]
        better = value > best[live]
        up = live[better]
        best[up], lead[up], score[up] = value[better], own[better].argmax(1), own[better].max(1)
        if size >= LEAST_SETS:
            live = up
            if not len(live):
                break
    return lead, np.clip(score, 0.0, 1.0)


def has_letter(texts: Texts, letters: np.ndarray) -> np.ndarray:
    """Whether each text has a letter; only texts without an ASCII letter are looked at by character."""
    ascii_letters = np.append(0, np.cumsum((LETTERS & (np.arange(256) < 0x80))[texts.data], dtype=np.int64))
    out = ascii_letters[texts.off[1:]] > ascii_letters[texts.off[:-1]]
    for i in np.flatnonzero(~out & letters):
        out[i] = any(map(str.isalpha, bytes(texts.data[texts.off[i] : texts.off[i + 1]]).decode("utf-8", "replace")))
    return out


def predict(docs: DataFrame, names: list[str], logs: np.ndarray, columns: list[str]) -> DataFrame:
    """Adds lang_pred and score to the given columns of every row; texts alone are looked at."""
    model = docs.sparkSession.sparkContext.broadcast(logs)  # ENTRIES floats at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES // max(len(names), 8)):
            texts = Texts(part["text"])
            words = Words(texts, LETTERS, lower=True)
            good = has_letter(texts, words.counts > 0) if names else np.zeros(len(texts), bool)
            pred, score = np.full(len(texts), -1), np.zeros(len(texts))
            if len(words) and names:
                lead, value = mixtures(words, model.value)
                pred[good], score[good] = lead[good], value[good]
            yield pa.RecordBatch.from_arrays([*(part[c] for c in columns), pa.array([names[k] if k >= 0 else "und" for k in pred], pa.string()), pa.array(score)], [*columns, "lang_pred", "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in columns)
    return docs.select(*dict.fromkeys([*columns, "text"])).mapInArrow(released(run), kinds + ", lang_pred string, score double")


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE, folds: int = 5) -> DataFrame:
    """Language of every document, learned from the folds that are not held out.

    held_out: the crc32 of the doc_id as text is divisible by `folds`.  A text
    that is null or has no letter, or any text if nothing can be learned, is
    `und` with score 0.  Repeated rows and null doc_ids (held out) give rows of
    their own; a row without lang is predicted, not learned from.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).withColumn("held_out", remainder("doc_id", folds) == 0)
    names, logs = train(rows.filter(~F.col("held_out")), per_language)
    return predict(rows, names, logs, ["doc_id", "held_out"])
