import itertools
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from weftline.llm import queries, simhash

WHITE = re.compile(rb"[^\x20\x09-\x0d]+")


def fingerprint(text):
    words = WHITE.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def least_reachable(rows, radius=2):
    prints = [fingerprint(t) for _, t in rows]
    part = list(range(len(rows)))

    def find(i):
        while part[i] != i:
            part[i] = i = part[part[i]]
        return i

    kinds = {}
    for i, p in enumerate(prints):
        part[find(i)] = find(kinds.setdefault(p, i))
    for a, b in itertools.combinations(kinds, 2):
        if (a ^ b).bit_count() <= radius:
            part[find(kinds[a])] = find(kinds[b])
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints, strict=True))), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_any_positions_are_free_of_one_mask(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    if radius < 3:
        for places in itertools.combinations(range(64), radius):
            bits = sum(1 << p for p in places)
            assert any(m & bits == 0 for m in masks)
    # the tables tell texts apart: over half of the positions are kept
    assert all((m & (2**64 - 1)).bit_count() >= 30 for m in masks)


def test_fingerprints_and_components_equal_brute_force(spark, frame):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(0, 90))] for _ in range(40)]
    rows = []
    for i in range(700):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2])):
            if words:
                words[rng.randrange(len(words))] = rng.choice(vocabulary).upper()
        rows.append((i * 3 % 701, rng.choice([" ", "\t", " \n "]).join(words)))
    rows += [(2000, None), (2001, "one"), (2002, "one two"), (2003, "é ü 漢"), (2004, "a b c")]
    want = least_reachable(rows)
    assert rows_of(simhash.near_duplicates(frame(rows))) == want
    assert len({c for *_, c in want}) < len({p for _, p, _ in want})  # there are links


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert rows_of(simhash.near_duplicates(odd)) == least_reachable(rows)
    assert simhash.near_duplicates(odd.limit(0)).collect() == []


def test_long_texts_are_hashed_in_turns(spark, frame, monkeypatch):
    rows = [(1, "a b c d e " * 500), (2, "f g " * 300), (3, "")]
    want = rows_of(simhash.near_duplicates(frame(rows)))
    monkeypatch.setattr(simhash, "TURN", 7)
    assert simhash.fingerprint_rows(simhash.Texts(__import__("pyarrow").array([t for _, t in rows]))).tolist() == [fingerprint(t) for _, t in rows]
    assert want == least_reachable(rows)


def test_links_of_dense_buckets_equal_all_pairs(spark):
    """Fingerprints around a few points: buckets of hundreds, most pairs beyond the radius."""
    rng = random.Random(2)
    prints = {x ^ (sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 5))) & (2**64 - 1)) for x in [0, 2**64 - 1, rng.getrandbits(64)] for _ in range(400)}
    signed = [p - (p >> 63 << 64) for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    assert found.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) > 2).count() == 0
    part = {p: p for p in signed}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for u, v in found.collect():
        part[find(u)] = find(v)
    for a, b in itertools.combinations(signed, 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
            assert find(a) == find(b)


def test_links_grow_with_members_not_pairs(spark):
    """Thousands of fingerprints in one bucket: rows stay below those of the points."""
    rng = random.Random(4)
    n = 3000
    prints = {sum(1 << b for b in rng.sample(range(0, 64, 2), 8)) for _ in range(n)}
    found = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"))
    assert found.count() <= len(prints) * 66


def test_the_query_equals_brute_force_over_whole_texts(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(queries.op12_simhash(spark, folder)) == least_reachable(rows)
