import random
import re

import numpy as np
import pytest

from weftline.llm import minhash
from weftline.llm.components import components

from .conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows, percent):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and i is not None and j is not None and 100 * len(s & t) >= percent * len(s | t):
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return sorted((str(i), len(s), str(find(i) if i is not None else None), i is None or find(i) == i) for i, s in sets)


def rows_of(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in df.collect())


def family(rng, base, edits):
    words = base.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_against_brute_force(frame):
    rng = random.Random(1)
    make = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    rows = list(ODD)
    for k in range(12):
        base = make(rng.choice([3, 6, 60, 200]))
        for _ in range(8):
            rows.append((100 + len(rows), family(rng, base, rng.choice([0, 0, 1, 1, 2, 3]))))
    common = make(60)
    rows += [(5000 + k, common + " " + make(25)) for k in range(40)]  # a shared passage that does not link
    rng.shuffle(rows)
    assert rows_of(minhash.near_duplicates(frame(rows), 85)) == brute(rows, 85)
    assert rows_of(minhash.near_duplicates(frame(rows), 80)) == brute(rows, 80)


def test_large_buckets_keep_pairs_of_one_band(frame, monkeypatch):
    rng = random.Random(2)
    make = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    common, rows = make(300), []
    for k in range(40):  # pairs of near copies; others share the passage and do not link
        text = common + " " + make(60)
        rows += [(k, text), (1000 + k, text + " " + make(4))]
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 3000)
    monkeypatch.setattr(minhash, "bands_for", lambda threshold: (1, 1))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame(rows), 85).collect()}
    keys = {r.doc_id: r.bands[0] for r in minhash.signatures(frame(rows), 1, 1).collect()}
    met = [k for k in range(40) if keys[k] == keys[1000 + k]]
    assert len(met) > 30 and max(list(keys.values()).count(x) for x in keys.values()) > 20
    assert [k for k in met if got[1000 + k][1] != k] == []
    want = brute(rows, 85)
    assert all(str(got[i][1]) == c or i >= 1000 and i - 1000 not in met for i, _, c, _ in ((int(w[0]), *w[1:]) for w in want))


@pytest.mark.parametrize(("block", "weight"), [(8192, 1 << 20), (100, 9000)])
def test_many_near_copies_around_the_threshold(frame, monkeypatch, block, weight):
    """Copies of one text with one to five words changed: most pairs lie just above or below the threshold."""
    rng = random.Random(8)
    base = " ".join(f"w{rng.randrange(10**6)}" for _ in range(150))
    rows = [(k, family(rng, base, rng.choice([1, 1, 2, 2, 3, 4, 5]))) for k in range(700)]
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", weight)
    assert rows_of(minhash.near_duplicates(frame(rows), 85)) == brute(rows, 85)


def test_what_leaves_buckets_and_groups_grows_with_their_members(frame):
    rng = random.Random(9)
    base = " ".join(f"w{rng.randrange(10**6)}" for _ in range(150))
    rows = [(k, family(rng, base, rng.choice([1, 2]))) for k in range(400)]
    size, bands = minhash.bands_for(0.85)
    classes = minhash.signatures(frame(rows), size, bands).selectExpr("*", "doc_id as c", "doc_id as node")
    members = classes.selectExpr("c", "explode(bands) as grp").groupBy("grp").count().filter("count > 1").selectExpr("sum(count) - count(*) as n").first().n
    assert minhash.candidate_links(classes, size * bands, 85).count() <= members
    groups = classes.selectExpr("c", "0L as grp")
    assert minhash.confirmed_links(frame(rows), classes, groups, 85).count() < len(rows)


def test_search_finds_what_links_connect():
    rng = np.random.default_rng(3)
    first = np.array([0, 1, 4, 4, 40, 90])
    group = np.repeat(np.arange(5), np.diff(first))
    links = np.zeros((90, 90), bool)
    for _ in range(60):
        a, b = rng.integers(0, 90, 2)
        links[a, b] = links[b, a] = group[a] == group[b]
    root = np.arange(90)
    while True:  # the least of what is connected
        low = np.where(links, root[None, :], 90).min(1)
        if (np.minimum(root, low) == root).all():
            break
        root = np.minimum(root, low)
    assert (minhash.search(first, lambda x, y: links[x, y]) == root).all()


def test_sketches_rule_out_only_what_is_too_far(frame):
    rng = np.random.default_rng(6)
    for n in (1, 5, 100, 5000):
        base = rng.integers(0, 2**63, n).astype(np.uint64)
        other = np.concatenate((base[: n - n // 10], rng.integers(0, 2**63, n // 20).astype(np.uint64)))
        bits = minhash.sketches(np.concatenate((base, other)), np.array([0, n, n + len(other)])).reshape(2, -1)
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= n // 10 + n // 20
        assert not (minhash.sketches(base[:0], np.array([0, 0]))).any()


def test_empty_table(frame):
    assert minhash.near_duplicates(frame([])).count() == 0
    assert rows_of(minhash.near_duplicates(frame([(1, None), (2, None)]))) == brute([(1, None), (2, None)], 85)


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + k) for k in range(1, 40)] + [(200, 201), (201, 202), (202, 200)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for u, v in edges:
            m = min(parent[u], parent[v])
            changed |= parent[u] != m or parent[v] != m
            parent[u] = parent[v] = m
    linked = {x for u, v in edges if u != v for x in (u, v)}
    assert got == {x: parent[x] for x in linked}


def test_minima_estimate_similarity():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 1000).astype(np.uint64)
    other = np.concatenate((base[:850], rng.integers(0, 2**63, 150).astype(np.uint64)))
    low = minhash.minima(np.concatenate((base, other)), np.array([0, 1000, 2000]), 1000)
    assert abs((low[:, 0] == low[:, 1]).mean() - 850 / 1150) < 0.05


def test_band_sizes():
    for t in (0.8, 0.85, 0.9):
        size, bands = minhash.bands_for(t)
        assert (1 - t**size) ** bands <= minhash.MISS
