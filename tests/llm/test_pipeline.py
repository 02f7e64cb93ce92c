import random
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from weftline.llm.tokens import tokenizer_path

from .test_decontaminate import brute as brute_hits
from .test_minhash import brute as brute_groups
from .test_repeats import gone, least
from .test_tokens import check_sequences


def corpus():
    rng = random.Random(8)
    tongues = {"xx": "aeioukl", "yy": "mnprstö"}
    word = lambda k: "".join(rng.choice(tongues[k]) for _ in range(rng.randint(2, 7)))
    text = lambda k, n: " ".join(word(k) for _ in range(n))
    rows = [(i, text(k, rng.randint(30, 120)), k) for i in range(60) for k in [rng.choice(["xx", "yy"])]]
    items = [(k, text("xx", 14)) for k in range(3)]
    passage = text("yy", 20)
    for i, (a, t, k) in enumerate(list(rows[:20])):
        rows.append((100 + i, [t, t + " zusatz", passage + " " + text("xx", 60), text("yy", 60) + " " + items[i % 3][1]][i % 4], k))
    return rows + [(200, None, "xx"), (201, "", None), (202, "123 456", "yy"), (203, "* * *", "xx")], items


def write(spark, folder, rows, items):
    docs = spark.createDataFrame([(i, t, k, "src", len(t or "")) for i, t, k in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_stages_against_brute_force(spark, tmp_path):
    rows, items = corpus()
    write(spark, tmp_path, rows, items)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kinds = docs.dtypes
    have = {i: t for i, t, _ in rows}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.dtypes == kinds
            docs = spark.createDataFrame(out.collect(), out.schema)
            got = {r.doc_id: r.text for r in docs.collect()}
        if name == "language_id":
            assert got == {i: t for i, t in have.items() if i < 200}
        elif name == "near_dedup":
            kept = {int(r[0]) for r in brute_groups(list(have.items()), 80) if r[3]}
            assert got == {i: have[i] for i in kept}
        elif name == "substring_dedup":
            seqs = [(i, t.encode()) for i, t in have.items()]
            first = least(seqs, 50)
            want = {i: bytes(b for b, x in zip(s, gone(i, s, first, 50)) if not x).decode("utf-8", "ignore") for i, s in seqs}
            assert got == {i: t for i, t in want.items() if t.strip(" ")}
        elif name == "decontamination":
            clean = {int(r[0]) for r in brute_hits(list(have.items()), items, 10) if not r[5]}
            assert got == {i: have[i] for i in clean} and len(clean) < len(have)
        else:
            pieces = out.collect()
            tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
            total = Counter()
            for r in pieces:
                total[r.doc_id] += r.length
            assert total == {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in have.items()}
            assert check_sequences(pieces, 2048) == int(np.ceil(sum(total.values()) / 2048))
        have = got


def test_run_and_empty_tables(spark, tmp_path):
    write(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert corpus_pipeline.ORACLE_SQL is None
