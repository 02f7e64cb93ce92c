import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa

from weftline.llm import language, quality
from weftline.llm.blocks import Texts, Words

from .conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def random_texts(n, seed):
    rng = random.Random(seed)
    parts = ["a", "b", "é#", " ", "  ", "\n", "\t", "*$|", "漢", "a b c d e ", "line\n", "\r\n"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def test_statistics_against_brute_force():
    texts = random_texts(500, 1) + [t for _, t in ODD]
    got = quality.statistics(Texts(pa.array(texts)))
    for i, t in enumerate(texts):
        assert tuple(int(got[c][i]) for c in quality.STATS[:5]) == brute_statistics(t), t


def test_quality_keeps_clean_rows_and_finds_odd_ones(spark, frame):
    rng = random.Random(2)
    plain = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(60, 90)))
    junk = lambda: " ".join("".join(rng.choice("#$%1239&") for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(20, 90)))
    rows = [(i, junk() if i % 20 == 0 else plain()) for i in range(800)]
    labels = spark.createDataFrame([(i, int(i % 20 != 0), None) for i in range(400)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.quality(frame(rows), labels).collect()}
    assert len(got) == 800
    assert sum(got[i].kept for i in got if i % 20) >= 745
    assert sum(not got[i].kept for i in got if i % 20 == 0) >= 30


def test_quality_finds_junk_of_one_kind(spark, frame):
    rng = random.Random(2)
    plain = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(60, 90)))
    junk = lambda: " ".join("".join(rng.choice("#$%1239&") for _ in range(14)) for _ in range(60))
    rows = [(i, junk() if i % 10 == 0 else plain()) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 10 != 0), None) for i in range(200)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    scored = quality.quality(frame(rows), labels)
    got = {r.doc_id: r for r in scored.collect()}
    assert sum(got[i].kept for i in got if i % 10) >= 354
    assert sum(not got[i].kept for i in got if i % 10 == 0) >= 38
    told = {r.quality: (r.n, r.rejected) for r in quality.unseen(scored, labels).collect()}
    left = [i for i in range(200) if crc32(str(i).encode()) % quality.FOLDS == quality.FOLDS - 1]
    assert told[0][0] == sum(i % 10 == 0 for i in left) and told[1][0] == sum(i % 10 != 0 for i in left)


def test_quality_of_odd_rows_and_empty_tables(spark, odd, frame):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.quality(odd, none).collect()
    want = sorted((str(i), *brute_statistics(t)) for i, t in ODD)
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed)  # nothing is labelled, so the forest rejects nothing
    assert quality.quality(frame([]), none).count() == 0


def brute_mixture(words, logs, penalised=True):
    """Leading language and share of one text, word by word, with sets as large as pays."""

    def em(allowed, rounds):
        share = {k: 1 / len(allowed) for k in allowed}
        for _ in range(rounds):
            total = dict.fromkeys(allowed, 0.0)
            for p in words:
                whole = sum(share[k] * p[k] for k in allowed)
                for k in allowed:
                    total[k] += share[k] * p[k] / whole
            share = {k: x / len(words) for k, x in total.items()}
        return share, sum(np.log(sum(share[k] * p[k] for k in allowed)) for p in words)

    every = list(range(logs))
    share, _ = em(every, language.ITERATIONS)
    order = sorted(every, key=lambda k: (-share[k], k))
    best = (-np.inf, None)
    for size in range(1, logs + 1):
        own, value = em(order[:size], language.ITERATIONS if size > 1 else 0)
        value -= (size - 1) * 0.5 * np.log(max(len(words), 2))
        if value > best[0]:
            best = (value, own)
        elif size >= language.LEAST_SETS:
            break
    lead = max(best[1], key=lambda k: best[1][k])
    return lead, best[1][lead], len(best[1])


def test_mixtures_against_brute_force():
    rng = np.random.default_rng(5)
    logs = np.log(rng.dirichlet(np.full(1 << language.BITS, 0.05), 6).T + 1e-9).astype(np.float32)
    alphabets = ["abcd", "efgh", "ijkl", "mnop", "qrst", "uvwx"]
    for k, letters in enumerate(alphabets):  # words of a language's letters are likely in it
        probe = Words(Texts(pa.array([" ".join(a + b + c for a in letters for b in letters for c in letters)])), language.LETTERS, lower=True)
        logs[language.word_trigrams(probe, np.arange(len(probe)), language.BITS)[1], k] = np.log(0.02)
    pick = random.Random(6)
    word = lambda k: "".join(pick.choice(alphabets[k]) for _ in range(4))
    texts = [" ".join(word(pick.choice(mix)) for _ in range(n)) for mix in ([0], [1, 2], [0, 3, 5], [0, 1, 2, 3, 4], [2, 2, 2, 4]) for n in (1, 40, 200)] + ["long " * 60_000]
    words = Words(Texts(pa.array(texts)), language.LETTERS, lower=True)
    lead, score = language.mixtures(words, logs)
    sizes = set()
    for i, t in enumerate(texts[:-1]):
        own = Words(Texts(pa.array([t])), language.LETTERS, lower=True)
        number, feature = language.word_trigrams(own, np.arange(len(own)), language.BITS)
        known = np.array([logs[feature[number == j]].astype(float).sum(0) for j in range(len(own))])
        want, share, size = brute_mixture(np.exp(known - known.max(1, keepdims=True)), 6)
        sizes.add(size)
        assert abs(score[i] - share) < 1e-3 and (lead[i] == want or share < 0.5)
    assert max(sizes) >= 4
    assert 0 <= score[-1] <= 1


def test_isolation_of_one_far_row():
    x = np.random.default_rng(4).normal(size=(1000, 3))
    x[0] = 9
    scores = quality.Forest(x).score(x)
    assert scores.argmax() == 0 or scores[0] > np.quantile(scores, 0.99)


def language_rows():
    rng = random.Random(3)
    tongues = {"xx": "aeioukl", "yy": "mnprstö", "zz": "bdghwzé"}
    word = lambda k: "".join(rng.choice(tongues[k]) for _ in range(rng.randint(2, 7)))
    rows = [(i, " ".join(word(k) for _ in range(rng.randint(3, 40))), k) for i in range(300) for k in [rng.choice("xyz") * 2]]
    mixed = [(1000, " ".join(word("xx") for _ in range(60)) + " " + " ".join(word("yy") for _ in range(40)), None)]
    return rows, mixed


def test_language_on_held_out_rows(spark):
    rows, mixed = language_rows()
    odd = [(2000, None, "xx"), (2001, "", "xx"), (2002, "12 ½ —", "yy"), (None, "akkela", "xx"), (2003, "漢", None), (5, rows[5][1], rows[5][2])]
    docs = spark.createDataFrame([(*r, "src", 1) for r in rows + mixed + odd], "doc_id long, text string, lang string, held_out string, score int")
    out = language.identify(docs).collect()
    assert len(out) == len(rows) + len(mixed) + len(odd)
    got = {r.doc_id: r for r in out}
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    assert all(0 <= r.score <= 1 for r in out)
    held = [r for r in rows if got[r[0]].held_out]
    assert sum(got[i].lang_pred == k for i, _, k in held) >= 0.97 * len(held)
    assert got[1000].lang_pred == "xx" and 0.5 < got[1000].score < 0.7
    assert [got[i].lang_pred for i in (2000, 2001, 2002)] == ["und"] * 3
    assert got[2003].lang_pred in ("xx", "yy", "zz")


def test_language_without_rows_or_labels(spark):
    kind = "doc_id long, text string, lang string"
    assert language.identify(spark.createDataFrame([], kind)).count() == 0
    assert [r.lang_pred for r in language.identify(spark.createDataFrame([(1, "a b", None)], kind)).collect()] == ["und"]


def test_hundreds_of_languages_share_a_table_of_the_same_size(spark):
    """300 languages, each with words of its own: all are learned, none is refused, and held-out rows are told."""
    rng = np.random.default_rng(7)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    lexicon = [["".join(rng.choice(letters, rng.integers(4, 8))) for _ in range(12)] for _ in range(300)]
    rows = [(i, " ".join(rng.choice(lexicon[i % 300], 30)), f"l{i % 300}") for i in range(3000)]
    out = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    held = [(i, lang) for i, _, lang in rows if out[i].held_out]
    assert sum(out[i].lang_pred == lang for i, lang in held) >= 0.95 * len(held) and len({out[i].lang_pred for i, _ in held}) > 200
    assert language.bits_for(4) == language.bits_for(256) == 16 and language.bits_for(300) == 15
    assert all((1 << language.bits_for(n)) * n <= language.ENTRIES for n in (257, 1000, language.MOST_LANGUAGES))
