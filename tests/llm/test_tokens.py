import functools
import random
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from weftline.llm import packing, token_files
from weftline.llm.blocks import Texts
from weftline.llm.tokens import Encoder, tokenizer_path

from .conftest import ODD

PARTS = ["a", "B", " ", "  ", "\n", "\t", "'s", "'", "don't", ".", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "é", "É", " ", "中", "1", "23", "ß", "İ", "\x1c", "$$$", "-", "word", "\r\n", "̀", "Ω", "😀"]


@functools.cache
def untouched(name):
    """The library's own tokenizer of the file, with nothing set on it."""
    return Tokenizer.from_file(tokenizer_path(name))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cut_texts_have_the_ids_of_whole_texts(name):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["", " ", "\n\n a", None]
    enc = Encoder(name)
    assert enc.cuttable
    ids, counts = enc.encode(Texts(pa.array(texts)))
    off = np.append(0, np.cumsum(counts))
    want = [e.ids for e in untouched(name).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    special = untouched(name).token_to_id("<|endoftext|>")
    assert any(special in x for x in want)
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == want


def expected(rows, name, end_id):
    return [(i, untouched(name).encode(t or "", add_special_tokens=False).ids + [end_id]) for i, t in rows]


def test_token_files_round_trip(spark, odd):
    blocks, index = token_files.token_files(odd, "word_bpe_49k.json", 1)
    got = token_files.read(spark, blocks, index, odd, with_ids=True).collect()
    want = expected(ODD, "word_bpe_49k.json", 1)
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(i), ids) for i, ids in want)
    assert all(r.ids_crc32 == crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == list(np.cumsum([0] + [r.n_tokens for r in ordered])[:-1])
    known = [r.doc_id for r in ordered if r.doc_id is not None]
    assert known == sorted(known)
    # keys that are not there, and one that is
    asked = spark.createDataFrame([(100,), (7,), (10**12,)], "doc_id long")
    assert [r.doc_id for r in token_files.read(spark, blocks, index, asked).collect()] == [7]


def test_token_files_of_an_empty_table(spark, frame):
    blocks, index = token_files.token_files(frame([]), "word_bpe_49k.json", 1)
    assert token_files.read(spark, blocks, index, frame([])).count() == 0


def test_perfect_hash_is_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64))
    f = token_files.PerfectHash.load(*token_files.PerfectHash.build(keys).dump())
    assert sorted(f.slots(keys)) == list(range(len(keys)))


def test_packing(spark, odd):
    got = packing.pack_documents(odd, capacity=64).collect()
    want = expected(ODD, "byte_bpe_50k.json", 0)
    pieces = []
    for i, ids in want:
        at = 0
        for k, n in enumerate(packing.cut_lengths(len(ids), 64)):
            pieces.append((str(i), k, at, n, crc32(np.array(ids[at : at + n], "<u4").tobytes())))
            at += n
        assert at == len(ids)
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(pieces)
    check_sequences(got, 64)


def check_sequences(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_in_many_partitions_meets_the_bound(spark):
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 1025, 5000)
    items = spark.createDataFrame([(int(n),) for n in lengths], "length long")
    rows = packing.pack(items, 2048, per_task=500).collect()
    assert sorted(r.length for r in rows) == sorted(lengths.tolist())
    assert check_sequences(rows, 2048) <= 1.02 * packing.lower_bound(lengths, 2048)


def test_bounds_never_exceed_a_packing():
    rng = np.random.default_rng(3)
    for _ in range(200):
        lengths = rng.integers(1, rng.integers(2, 65), rng.integers(1, 60))
        _, _, fill = packing.best_fit_decreasing(lengths, 64)
        assert packing.lower_bound(lengths, 64) <= len(fill)
        assert fill.max() <= 64 and fill.sum() == lengths.sum()


def test_empty_table_packs_nothing(frame):
    assert packing.pack_documents(frame([])).count() == 0


def test_sequences_hold_their_ids(spark, frame):
    docs = frame([(1, "one two three"), (2, "four five"), (3, None)])
    packed = packing.pack_documents(docs, capacity=8)
    ids = {r.sequence_id: np.frombuffer(bytes(r.ids), "<u4") for r in packing.sequences(docs, packed, capacity=8).collect()}
    for r in packed.collect():
        assert crc32(ids[r.sequence_id][r.offset : r.offset + r.length].tobytes()) == r.ids_crc32
