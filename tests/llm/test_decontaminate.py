import hashlib
import random
import re

from weftline.llm import decontaminate
from weftline.llm.decontaminate import contamination

from .conftest import ODD

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, width):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), width)
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((str(doc), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit), *longest(w, items, width)))
    return sorted(out)


def longest(w, items, width):
    """The longest run of words that an item has too and that holds one of its windows, and where it first begins."""
    best = (0, -1)
    if len(w) > 1000:  # one word again and again: no item has it
        return best
    for _, text in items:
        own = words(text)
        for i in range(len(w)):
            for j in range(len(own)):
                n = 0
                while i + n < len(w) and j + n < len(own) and w[i + n] == own[j + n]:
                    n += 1
                if n >= min(width, len(own)) and n and (len(own) >= width or n == len(own)):
                    best = max(best, (n, -i), key=lambda x: (x[0], x[1])) if best[0] else (n, -i)
    return (best[0], -best[1]) if best[0] else best


def rows_of(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated, r.longest_match, r.longest_at) for r in df.collect())


def random_case(seed):
    rng = random.Random(seed)
    alphabet = ["a", "B", "é", "d1", "ee"]
    text = lambda n: rng.choice([" ", "-", "\n", ", "]).join(rng.choice(alphabet) for _ in range(n))
    items = [(k, text(rng.randint(0, 9))) for k in range(12)] + [(12, None), (13, ""), (14, "a B"), (15, "a b")]
    docs = [(k, text(rng.randint(0, 60))) for k in range(60)]
    return docs, items


def test_against_brute_force(spark, frame):
    for seed in range(3):
        docs, items = random_case(seed)
        docs += ODD
        bench = spark.createDataFrame(items, "item_id long, text string")
        assert rows_of(contamination(frame(docs), bench, width=4)) == brute(docs, items, 4)


def test_blocks_of_items_give_the_same(spark, frame):
    docs, items = random_case(7)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(contamination(frame(docs), bench, width=4, limit=64)) == brute(docs, items, 4)


def test_matches_are_followed_over_many_pairs(spark, frame, monkeypatch):
    monkeypatch.setattr(decontaminate, "PAIRS", 7)
    docs, items = random_case(9)
    docs += [(100, "a " * 40), (101, "a b " * 20 + "x " + "b a " * 30)]
    items += [(20, "a " * 12), (21, "a b " * 9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(contamination(frame(docs), bench, width=4)) == brute(docs, items, 4)


def test_carried_columns_may_have_any_name(spark):
    docs = spark.createDataFrame([(1, "a b c d e", "s", 5, None), (2, None, "t", 6, "y")], "doc_id long, text string, spans string, n_hit int, items string")
    bench = spark.createDataFrame([(1, "b c d", "q")], "item_id long, text string, doc_id string")
    carried = contamination(docs, bench, width=3, carry=("text", "spans", "items")).drop("n_hit", "n_items")
    assert sorted((r.doc_id, r.contaminated, r.text, r.spans, r.items) for r in carried.collect()) == [(1, True, "a b c d e", "s", None), (2, False, None, "t", "y")]


def test_empty_tables(spark, frame):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert rows_of(contamination(frame([]), bench)) == []
    assert rows_of(contamination(frame([(1, "a b")]), bench)) == brute([(1, "a b")], [], 10)
