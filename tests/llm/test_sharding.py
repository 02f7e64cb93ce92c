from collections import Counter
from zlib import crc32

from weftline.llm import sharding

from .conftest import ODD


def checked(rows, texts, shards):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted((str(i), len((t or "").encode()) + 16, crc32((t or "").encode())) for i, t in texts)
    count = Counter(r.shard for r in rows)
    assert set(count) <= set(range(shards))
    full = [count.get(s, 0) for s in range(shards)]
    assert max(full) - min(full) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(full[s]))
    assert {(r.law, r.grown_shard) for r in rows} <= {("rows", None)}


def test_groups_stay_together_and_counts_even(frame):
    # a group of a third of all rows, groups of two to nine, and rows without links
    texts, i = [], 0
    for k in range(60):
        for _ in range(2 + k % 8):
            texts.append((i, f"group {k}"))
            i += 1
    texts += [(i + j, "hot") for j in range(300)]
    texts += [(1000 + j, f"alone {j}") for j in range(280)]
    rows = sharding.shards(frame(texts), 8).collect()
    checked(rows, texts, 8)
    where = {}
    text = dict(texts)
    for r in rows:
        where.setdefault(text[r.doc_id], set()).add(r.shard)
    split = [t for t in where if t.startswith("group") and len(where[t]) > 1]
    assert len(split) <= 8
    assert len(where["hot"]) <= 5


def test_odd_rows_and_empty_tables(odd, frame):
    checked(sharding.shards(odd, 4).collect(), ODD, 4)
    assert sharding.shards(frame([]), 4).count() == 0
    only = [(i, "same") for i in range(50)]
    checked(sharding.shards(frame(only), 7).collect(), only, 7)


def test_no_python_on_the_main_path(frame, capsys):
    df = sharding.shards(frame([(1, "a"), (2, "a"), (3, "b")]), 2)
    df.explain()
    assert "Python" not in capsys.readouterr().out
