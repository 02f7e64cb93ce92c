import math
import random
import re
from collections import Counter
from zlib import crc32

import pyarrow as pa
import pyarrow.compute
import pytest

from weftline.llm import scoring

from .conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + [None]


def brute(rows, mu):
    held = lambda i: crc32(("" if i is None else str(i)).encode()) % 7 == 2
    single, double = Counter(), Counter()
    for i, t in rows:
        if not held(i):
            w = tokens(t)
            single.update(w)
            double.update(zip(["<s>"] + w[:-1], w))
    n, v = sum(single.values()), len(single)
    out = []
    for i, t in rows:
        w, base, score = tokens(t), 0.0, 0.0
        for h, x in zip(["<s>"] + w[:-1], w):
            p = (single[x] + 1) / (n + v + 1)
            before = single[None] if h == "<s>" else single[h]
            base += math.log10(p)
            score += math.log10((double[h, x] + mu * p) / (before + mu))
        out.append((str(i), held(i), len(w), sum(single[x] > 0 for x in w), n, base, score))
    return sorted(out, key=str)


def check(df, rows, mu=scoring.PRIOR):
    got = sorted(((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in df.collect()), key=str)
    want = brute(rows, mu)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda x: (x[0], x[2], x[5])), sorted(want, key=lambda x: (x[0], x[2], x[5]))):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


@pytest.mark.parametrize("fan", [512, 2])
def test_against_brute_force(frame, monkeypatch, fan):
    monkeypatch.setattr(scoring, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(scoring, "FAN", fan)  # of 2: blocks ask in groups of two
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(["a", "B", "cé", "d", "漢", f"w{rng.randrange(30)}"]) for _ in range(rng.randint(0, 60)))) for k in range(150)]
    rows += ODD + rows[:3]
    check(scoring.scores(frame(rows)), rows)


def test_small_tables(frame):
    assert scoring.scores(frame([])).count() == 0
    check(scoring.scores(frame([(1, "a b a")])), [(1, "a b a")])
    held = next(i for i in range(100) if crc32(str(i).encode()) % 7 == 2)
    check(scoring.scores(frame([(held, "a b")])), [(held, "a b")])


def test_rows_asked_follow_the_blocks(frame):
    """Every block and every group sends to a bounded number of buckets."""
    rng = random.Random(4)
    text = " ".join(f"w{rng.randrange(500)}" for _ in range(400))
    t = pa.table({"text": [text], "held_out": [False]})
    asked = scoring.ask(8)((pa.scalar(3),), t)
    assert asked.num_rows <= 8 and set(asked["block"].to_pylist()) == {3}
    both = pa.concat_tables([asked, scoring.ask(8)((pa.scalar(4),), t)])
    own = both.filter(pa.compute.equal(both["bucket"], 5))
    group = scoring.ask_for_group(64)((pa.scalar(5), pa.scalar(0)), own)
    assert group.num_rows <= 8 and {b // 8 for b in group["bucket"].to_pylist()} == {5}


def test_probabilities_of_what_follows_sum_to_one():
    mu, single, double = 20.0, Counter(a=3, b=2, e=1), Counter({("a", "b"): 2, ("a", "a"): 1})
    n, v = sum(single.values()), len(single)
    total = sum((double["a", x] + mu * (single[x] + 1) / (n + v + 1)) / (single["a"] + mu) for x in ["a", "b", "e", "unknown"])
    assert total == pytest.approx(1)
