import math

import numpy as np
import pytest
from pyspark.sql import Row

from weftline.llm import ball_tree as bt

SCHEMA = "vec_id long, embedding array<float>, label int, uid string, score long, low long"


def frame(spark, rows):
    """Vectors with columns that clash with inner names."""
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows], SCHEMA)


def brute(rows):
    part = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        part.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], (label + 1) % 10 if vec_id % 7 == 0 else label))
    out = []
    for i, (anchor, v, label) in enumerate(part):
        if anchor % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), other, kind) for j, (other, w, kind) in enumerate(part) if j != i]
        positives = sorted((s, o) for s, o, kind in scored if kind == label)[:5]
        for s, positive in positives:
            fit = sorted((n, o) for n, o, kind in scored if kind != label and 50 * -s <= 100 * -n <= 95 * -s)[:3]
            out += [(anchor, positive, rank + 1, o, -s, -n) for rank, (n, o) in enumerate(fit)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def clustered(n, width=8, seed=3, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width)) + 0.6
    kinds = rng.integers(0, labels, n)
    return [(int(i * 5), (centres[k] + rng.normal(size=width) * 0.5).tolist(), int(k)) for i, k in zip(rng.permutation(n), kinds)]


def test_equals_brute_force_over_many_blocks_and_leaves(spark, monkeypatch):
    for name, size in (("ROW_BLOCK", 100), ("ANCHOR_BLOCK", 16), ("LEAF", 8)):
        monkeypatch.setattr(bt, name, size)
    rows = clustered(600)
    got = rows_of(bt.hard_negatives(frame(spark, rows)))
    assert got == brute(rows) and len(got) > 100


def test_ties_copies_and_one_label_with_most_rows(spark, monkeypatch):
    for name, size in (("ROW_BLOCK", 64), ("LEAF", 4)):
        monkeypatch.setattr(bt, name, size)
    hot = [(i, [0.5, 0.25], 1) for i in range(1, 150)] + [(i * 50, [0.5, 0.5], i % 3) for i in range(6)]
    rows = hot + [(1000 + i, [0.3, 0.25 + (i % 3) / 100], 2) for i in range(120)]
    got = rows_of(bt.hard_negatives(frame(spark, rows)))
    assert got == brute(rows) and got


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [1.0, 1.0], 1), (2, [1.0], 1), (3, [], 1), (4, [0.9, 0.8, 5.0], 2), (5, [1.0, 0.5], 2), (None, [1.0, 1.0], 2), (6, None, 2), (8, [1.0, None], 2), (9, [nan, 1.0], 2), (10, [inf, 1.0], 2), (11, [1.0, 1.0], None), (12, [1.0, 0.9], 2), (50, [-1.0, -2.0], 2), (100, [0.0, 0.0], 1)]
    assert rows_of(bt.hard_negatives(frame(spark, rows))) == brute(rows)


def test_empty_and_null_tables(spark):
    assert bt.hard_negatives(frame(spark, [])).collect() == []
    assert bt.hard_negatives(frame(spark, [(None, None, None), (50, None, 1)])).collect() == []


def test_products_beyond_doubles_are_exact(spark):
    big = 3.0e5  # sums of squares beyond 2^53
    rows = [(0, [big, 1 / 256, big], 1), (1, [big, 2 / 256, big], 1), (2, [big, 3 / 256, 0.9 * big], 1), (3, [big, 1 / 256, 0.7 * big], 2), (4, [big, 2 / 256, 0.7 * big], 2), (5, [0.8 * big, 0.0, big], 3)]
    assert rows_of(bt.hard_negatives(frame(spark, rows))) == brute(rows)
    saturated = bt.hard_negatives(frame(spark, [(0, [3e38], 1), (1, [3e38], 1), (2, [3e38], 2)])).collect()
    assert saturated == [] or isinstance(saturated[0], Row)


def test_bounds_hold_and_nodes_are_left_out():
    rng = np.random.default_rng(1)
    vectors, labels = rng.integers(-200, 200, (500, 6)).astype(float), np.sort(rng.integers(0, 3, 500))
    order, root = bt.ball_tree(vectors, labels)
    q = rng.integers(-200, 200, (20, 6)).astype(float)
    todo = [root]
    while todo:
        node = todo.pop()
        s = q @ vectors[order[node.start : node.end]].T
        middle, reach = q @ node.centre, node.radius * np.linalg.norm(q, axis=1)
        assert (s <= (middle + reach + 1e-6)[:, None]).all() and (s >= (middle - reach - 1e-6)[:, None]).all()
        assert set(labels[order[node.start : node.end]]) >= set(node.labels)
        todo += node.children or ()


@pytest.mark.parametrize("same", [True, False])
def test_a_search_visits_fewer_leaves_than_there_are(monkeypatch, same):
    import pyarrow as pa

    rows = clustered(2000, labels=4)
    vec_id, vectors, labels = zip(*rows)
    table = pa.table({"uid": list(range(len(rows))), "vec_id": vec_id, "label": labels, "embedding": pa.array(vectors, pa.list_(pa.float32()))})
    asked = table.slice(0, 5)
    n = len(asked)
    asked = pa.table({"anchor_" + c: asked[c] for c in ("uid", "label", "embedding")} | {"anchor_low": pa.array([[bt.LEAST]] * n), "anchor_high": pa.array([[bt.MOST]] * n)})
    seen = []
    monkeypatch.setattr(bt.Search, "leaf", lambda self, node, some, f=bt.Search.leaf: (seen.append(len(some)), f(self, node, some)))
    bt.Search(table, asked, 5, same).run()
    leaves = len(rows) // bt.LEAF
    assert sum(seen) < leaves * n * (0.5 if same else 0.8)
