import hashlib
import random
import zlib

from pyspark.sql import functions as F

from weftline.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth long, place long, n string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def frame(spark, rows):
    """Turns with columns that clash with inner names."""
    return spark.createDataFrame([(*r, 1, None, "x") for r in rows], SCHEMA)


def brute(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns.setdefault(c, []).append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), (role, text)))
    turns = {c: [x[3] for x in sorted(t)] for c, t in turns.items()}
    members, ends = {}, {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        rest = c % 5 if c >= 0 else -(-c % 5)
        whole = tuple(turns.get(c - rest, [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
        ends.setdefault(whole, []).append(c)
    kids, leaves, saved = {}, {}, {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids.get(node, [])) or 1
        saved[node] = sum(saved[k] for k in kids.get(node, [])) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids.get(n, [])), leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest()) for n, m in members.items())


def check(spark, rows):
    got = sorted((tuple(r) for r in pt.prefix_trie(frame(spark, rows)).select(*COLUMNS).collect()))
    assert got == brute(rows)
    return got


def branching(n, depth, seed, choices=("a", "b", "ü c")):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.1 else "user", rng.choice(choices)) for c in range(n) for t in range(rng.randint(1, depth))]


def test_equals_brute_force(spark):
    rows = branching(400, 9, 1)
    random.Random(0).shuffle(rows)
    got = check(spark, rows)
    assert any(r[4] > 2 for r in got) and any(r[6] > 0 for r in got)


def test_many_light_edges_and_deep_paths_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(pt, "BLOCK", 4)
    monkeypatch.setattr(pt, "PACK", 3)
    # a long shared way that conversations leave at every depth, in no order of their numbers
    rng = random.Random(8)
    rows = []
    for c in range(60):
        away = rng.randint(0, 40)
        rows += [(c, t, "user", "on" if t < away else f"off {c % 7} {t}") for t in range(away + rng.randint(1, 6))]
    check(spark, rows)


def test_one_conversation_with_most_rows_and_copies(spark, monkeypatch):
    monkeypatch.setattr(pt, "BLOCK", 16)
    rows = [(10, t, "user", f"t{t}") for t in range(500)] + [(c, t, "user", "same") for c in range(100, 300) for t in range(4)]
    rows += [(7, 3, "user", "repeated")] * 40
    check(spark, rows)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, None, "", None), (2, 5, "user", "x"), (2, 5, "assistant", "x"), (2, 5, "user", "x"), (None, 1, "user", "lost"), (-3, 1, "user", "minus"), (-5, 0, "user", "minus"), (0, 0, "user", "zero"), (6, 0, "user", "y" * 100_000), (5, 0, "user", "y" * 100_000), (9, 0, "user", "turnless"), (13, 0, "u", "ser")]
    check(spark, rows)
    assert pt.prefix_trie(frame(spark, [])).collect() == []
    assert pt.prefix_trie(frame(spark, [(None, 1, "user", "x")])).collect() == []


def test_places_are_ranks_whatever_the_partitions(spark):
    rows = [(c, t % 5, "user", str(t)) for c in (1, 2) for t in range(300)]
    got = pt.places(frame(spark, rows).repartition(13)).groupBy("conv_id").agg(F.count_distinct("place").alias("n"), F.min("place").alias("low"), F.max("place").alias("high")).collect()
    assert {(r.n, r.low, r.high) for r in got} == {(300, 1, 300)}


def test_rounds_are_logarithmic(spark, monkeypatch):
    """A complete binary tree of 64 leaves has six light edges on a way at most."""
    rows = [(5 * c, t, "user", str(c >> (5 - t) & 1)) for c in range(64) for t in range(6)]
    names = []
    monkeypatch.setattr(pt, "written", lambda df, name, f=pt.written: (names.append(name), f(df, name))[1])
    check(spark, rows)
    assert names.count("sent") <= 7
