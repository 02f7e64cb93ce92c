import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from weftline.llm import blocks, repeats, suffix_dedup, window_dedup

from .conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def least(seqs, width):
    first = {}
    for i, s in seqs:
        if i is not None:
            for p in range(len(s) - width + 1):
                w = tuple(s[p : p + width])
                first[w] = min(first.get(w, i), i)
    return first


def gone(i, s, first, width):
    out = [False] * len(s)
    if i is not None:
        for p in range(len(s) - width + 1):
            if first[tuple(s[p : p + width])] < i:
                out[p : p + width] = [True] * width
    return out


def brute_bytes(rows, width):
    seqs = [(i, (t or "").encode()) for i, t in rows]
    first, out = least(seqs, width), []
    for i, s in seqs:
        g = gone(i, s, first, width)
        kept = bytes(b for b, x in zip(s, g) if not x)
        spans = sum(x and (p == 0 or not g[p - 1]) for p, x in enumerate(g))
        out.append((str(i), len(s), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def brute_words(rows, width):
    seqs = [(i, WORD.findall(t or "")) for i, t in rows]
    first, out = least(seqs, width), []
    for i, s in seqs:
        g = gone(i, s, first, width)
        kept = " ".join(w for w, x in zip(s, g) if not x)
        out.append((str(i), len(s), sum(g), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def cases(seed):
    rng = random.Random(seed)
    make = lambda n: " ".join(rng.choice(["a", "bé", "ccc", "dd", "漢"]) + str(rng.randrange(40)) for _ in range(n))
    shared = [make(rng.randint(5, 40)) for _ in range(8)]
    rows = []
    for k in range(60):
        parts = [rng.choice(shared) if rng.random() < 0.4 else make(rng.randint(0, 15)) for _ in range(rng.randint(0, 5))]
        rows.append((k, rng.choice([" ", "\n", "  "]).join(parts)))
    rows += [(200 + k, shared[0] * 2) for k in range(30)] + [(300 + k, "abcab" * 40) for k in range(3)] + [(7, rows[3][1]), (400, "x" * 300), (401, "x" * 310)]
    rng.shuffle(rows)
    return rows + ODD + [(None, rows[0][1])]


@pytest.mark.parametrize(("seed", "fan"), [(1, 1024), (2, 3)])
def test_bytes_against_brute_force(frame, seed, fan, monkeypatch):
    monkeypatch.setattr(repeats, "FLUSH", 200)
    monkeypatch.setattr(repeats, "FAN", fan)  # of 3: 8 and 16 buckets take two and three exchanges
    rows = cases(seed)
    got = suffix_dedup.suffix_dedup(frame(rows).repartition(5)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_bytes(rows, 50)


@pytest.mark.parametrize(("seed", "fan"), [(1, 1024), (2, 3)])
def test_words_against_brute_force(frame, seed, fan, monkeypatch):
    monkeypatch.setattr(repeats, "FAN", fan)
    rows = cases(seed)
    got = window_dedup.window_dedup(frame(rows).repartition(5), width=12, kmer=4).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_words(rows, 12)


def test_words_of_the_contract_width(frame):
    rows = cases(5)
    got = window_dedup.window_dedup(frame(rows)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_words(rows, 50)


def test_rows_of_an_exchange_follow_the_entries(monkeypatch):
    """Five times the entries and buckets make five times the rows, once there are more buckets than a task sends to."""
    monkeypatch.setattr(repeats, "FAN", 16)
    rng, count = np.random.default_rng(4), []
    for times in (1, 5, 25):
        rows, buckets = 0, 100 * times
        span = repeats.steps(buckets)[0]
        assert -(-buckets // span) <= 16
        for _ in range(times):  # one flush of a task each
            n = 5000
            e = repeats.Entries(np.sort(rng.integers(0, 99, n)), np.ones(n, np.int64), rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2), np.zeros((n, 1), np.int64))
            rows += sum(b.num_rows for b in repeats.packed(e, np.zeros(n, bool), buckets, span))
        count.append(rows)
    assert count[1] <= 5 * 16 and count[2] <= 25 * 16


def test_minimisers_spread_evenly_over_buckets():
    text = np.random.default_rng(2).integers(97, 123, 200_000).astype(np.uint8)
    s = suffix_dedup.byte_symbols(blocks.Texts(pa.array([text.tobytes().decode()])))
    keys = repeats.super_kmers(s.values, s.off, 50, 20)[3]
    sizes = np.bincount(((keys >> np.uint64(32)) * np.uint64(50) >> np.uint64(32)).astype(int), minlength=50)
    assert sizes.max() < 1.4 * sizes.mean()


def test_equal_hashes_of_different_words_do_not_count():
    data = np.frombuffer(b"oneTWOone", np.uint8)
    start, end = np.array([0, 3, 6]), np.array([3, 6, 9])
    code = blocks.exact_codes(data, start, end, np.zeros(3, np.uint64))
    assert code[0] == code[2] != code[1]


def test_odd_rows_and_empty_tables(odd, frame):
    assert suffix_dedup.suffix_dedup(frame([])).count() == 0
    assert window_dedup.window_dedup(frame([])).count() == 0
    assert {r.n_removed for r in suffix_dedup.suffix_dedup(odd).collect()} == {0}
    assert {r.n_removed for r in window_dedup.window_dedup(odd).collect()} == {0}


def test_longest_previous_factors_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        data = rng.integers(97, 100, 300).astype(np.uint8)
        start, docs = np.arange(280), rng.integers(0, 6, 280)
        lanes = suffix_dedup.suffix_lanes(data, start, 18)
        order = np.lexsort((docs, *lanes[::-1]))
        got = suffix_dedup.longest_previous(docs[order], suffix_dedup.common_prefixes([x[order] for x in lanes], 18))
        for i, p in enumerate(order.tolist()):
            best = 0
            for q in np.flatnonzero(docs < docs[p]).tolist():
                m = 0
                while m < 18 and data[p + m] == data[q + m]:
                    m += 1
                best = max(best, m)
            assert got[i] == best


def test_carried_columns_may_have_any_name(spark):
    names = ["found", "copy", "id0", "fp", "n_bytes", "_carry0", "digest"]
    rows = [(1, "x" * 80, *range(7)), (2, "y" + "x" * 80, *range(7, 14)), (3, None, *range(14, 21))]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    got = {r.doc_id: r for r in suffix_dedup.suffix_dedup(df, with_text=True, carry=tuple(names)).collect()}
    assert (got[2].n_removed, got[2].text, got[3].n_bytes) == (80, "y", 0)
    assert [got[2]["carried_n_bytes" if n == "n_bytes" else n] for n in names] == list(range(7, 14))
