"""Language-model scores by a weighted backoff automaton.

The model is a smoothed bigram model: the probability of a word mixes its count
behind the word before it with its smoothed unigram probability, weighted as
`mu` words of prior.  As an automaton: every known word is a state, its seen
successors are arcs with their log-probabilities, and a failure arc with the
backoff weight leads to the empty state, where every known word has an arc.

The model grows with the corpus, so no task holds it.  Documents are dealt to
blocks of bounded size.  A block asks for its own distinct n-grams, with their
counts in its training documents; each n-gram's counts meet in one of many
buckets, and the sums go back to the blocks that asked.  A block then has all
n-grams that its documents can meet: it builds their automaton and walks its
documents through it, one word of every document at a step.

A block sends to FAN buckets at most.  Where there are more blocks than that,
blocks form groups of FAN: a group adds up what its blocks ask in each of FAN
slices of the keys, asks FAN finer buckets for the slice, and passes the sums
on to its blocks.  So rows grow with the blocks, not with their square.
"""

from __future__ import annotations

import math
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import U64, Texts, Words, mix
from .language import remainder
from .tables import partitions, text_key

#: bytes of text of a block on average; words of prior behind each context, the best of 20, 100, 500 and 2000 on a
#: development fold (remainder 3) of the training documents, with the held-out documents left out altogether
BLOCK_BYTES, PRIOR = 12 << 20, 500.0
#: buckets that a block, or a group of so many blocks, sends to at most
FAN = 512
END, BEGIN = U64(0x8F1BBCDC5A827999), U64(0xCA62C1D66ED9EBA1)
ASK = "bucket long, block long, keys binary, uses binary"
REPLY = "block long, bucket long, sums binary, tokens long, kinds long"


def press(values: np.ndarray) -> bytes:
    """Byte planes of integers, compressed: high planes of small numbers cost nothing."""
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes())


def unpress(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


class Tokens:
    """Tokens of a block's documents: words and one end each, the keys of their unigrams and bigrams."""

    def __init__(self, texts: Texts):
        words = Words(texts, lower=True)
        self.counts = words.counts + 1
        self.off = np.append(0, np.cumsum(self.counts))
        self.hash = np.full(int(self.off[-1]), END, U64)
        self.ends = self.off[1:] - 1
        word = np.ones(len(self.hash), bool)
        word[self.ends] = False
        self.hash[word] = words.hash
        before = np.empty_like(self.hash)
        before[1:] = self.hash[:-1]
        before[self.off[:-1]] = BEGIN
        # the least bit tells unigrams from bigrams
        self.single = mix(self.hash) & ~U64(1)
        self.context = mix(np.where(before == BEGIN, END, before)) & ~U64(1)  # as many texts begin as end
        self.double = mix(before * U64(0x9E3779B97F4A7C15) ^ mix(self.hash)) | U64(1)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in the order of keys."""
    return ((keys >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def ask(buckets: int):
    """Distinct n-grams of a block in order, cut by bucket, with their uses in training documents."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        t = Tokens(Texts(table["text"].combine_chunks()))
        learn = np.repeat(~table["held_out"].to_numpy().astype(bool), t.counts)
        keys, place = np.unique(np.concatenate((t.single, t.double)), return_inverse=True)
        uses = np.bincount(place, weights=np.concatenate((learn, learn)), minlength=len(keys)).astype(np.uint32)
        return sliced(keys, uses, buckets, key[0].as_py())

    return run


def sliced(keys: np.ndarray, uses: np.ndarray, buckets: int, block: int) -> pa.Table:
    """Rows of ASK: sorted keys cut by bucket, with their uses."""
    to = bucket_of(keys, buckets)
    cuts = np.flatnonzero(np.append(True, to[1:] != to[:-1])).tolist() + [len(keys)] if len(keys) else [0]
    rows = [(int(to[a]), block, press(np.diff(keys[a:b], prepend=U64(0))), press(uses[a:b])) for a, b in zip(cuts, cuts[1:])]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.table([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], names=[x.split()[0] for x in ASK.split(", ")])


def added(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """The keys of each row of ASK; the distinct ones in order, the place of each asked key among them, and their uses added up."""
    asked = [np.cumsum(unpress(x, "<u8"), dtype=U64) for x in table["keys"].to_pylist()]
    keys, place = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate([unpress(x, table_kind(table)) for x in table["uses"].to_pylist()]), minlength=len(keys)).astype("<u8")
    return asked, keys, place, total


def table_kind(table: pa.Table) -> str:
    """Uses of blocks have four bytes, those of groups eight."""
    return "<u8" if "group" in table.column_names else "<u4"


def ask_for_group(buckets: int):
    """What the blocks of a group ask in a slice of the keys, asked by the group of finer buckets."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, keys, _, total = added(table)
        rows = sliced(keys, total, buckets, key[1].as_py())
        return rows.append_column("group", rows["block"])

    return run


def pass_on(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """The sums of a slice, from the finer buckets to the blocks of a group as each asked."""
    names, kinds = [x.split()[0] for x in REPLY.split(", ")], [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    if not left.num_rows:
        return pa.schema(list(zip(names, kinds, strict=True))).empty_table()
    asked, keys, place, _ = added(left)
    replies = sorted(right.select(["bucket", "sums"]).to_pylist(), key=lambda r: r["bucket"])
    sums = np.concatenate([unpress(r["sums"], "<u8") for r in replies])
    assert len(sums) == len(keys), "a group's blocks differ from those it asked for"
    off = np.append(0, np.cumsum([len(x) for x in asked]))
    n = len(asked)
    columns = [left["block"].to_pylist(), [key[0].as_py()] * n, [press(sums[place[a:b]]) for a, b in zip(off, off[1:])], [0] * n, [0] * n]
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def add(key: tuple, table: pa.Table) -> pa.Table:
    """Sums of uses over all blocks, as each block asked; and the bucket's training tokens and kinds, for block -1."""
    asked, keys, place, total = added(table)
    single = total[(keys & U64(1)) == 0]
    off = np.append(0, np.cumsum([len(x) for x in asked]))
    bucket, n = key[0].as_py(), len(asked)
    sums = [press(total[place[a:b]]) for a, b in zip(off, off[1:])]
    return pa.table([pa.array([*table["block"].to_pylist(), -1], pa.int64()), pa.array([bucket] * (n + 1), pa.int64()), pa.array([*sums, None], pa.binary()), pa.array([0] * n + [int(single.sum())], pa.int64()), pa.array([0] * n + [int((single > 0).sum())], pa.int64())], names=[x.split()[0] for x in REPLY.split(", ")])


class Automaton:
    """States: 0 is the empty one, then one per known context. Arcs are kept sorted by state and word."""

    def __init__(self, word_logs: np.ndarray, word_state: np.ndarray, fail_logs: np.ndarray, arc_keys: np.ndarray, arc_logs: np.ndarray):
        self.word_logs, self.word_state, self.fail_logs, self.arc_keys, self.arc_logs = word_logs, word_state, fail_logs, arc_keys, arc_logs

    def walk(self, word: np.ndarray, off: np.ndarray, begin: int) -> np.ndarray:
        """Log-probability of each document, from one traversal in which all documents move by a word a step."""
        n, kinds = np.diff(off), len(self.word_logs)
        order = np.argsort(-n, kind="stable")
        start, sizes = off[:-1][order], n[order]
        state, score = np.full(len(order), begin), np.zeros(len(order))
        live = len(order)
        top = len(self.arc_keys) - 1
        for step in range(int(sizes[0]) if live else 0):
            while sizes[live - 1] <= step:
                live -= 1
            w = word[start[:live] + step]
            key = state[:live] * kinds + w
            at = np.minimum(np.searchsorted(self.arc_keys, key), top) if top >= 0 else np.zeros(live, np.int64)
            arc = self.arc_keys[at] == key if top >= 0 else np.zeros(live, bool)
            # without an arc: the failure arc to the empty state, and from there the word's own arc
            score[:live] += np.where(arc, self.arc_logs[at] if top >= 0 else 0.0, self.fail_logs[state[:live]] + self.word_logs[w])
            state[:live] = self.word_state[w]
        out = np.empty(len(order))
        out[order] = score
        return out


def block_scores(t: Tokens, sums: np.ndarray, keys: np.ndarray, place: np.ndarray, tokens: int, kinds: int, mu: float) -> tuple[np.ndarray, ...]:
    """n_known, base score and score of each document of a block."""
    n = len(t.hash)
    whole = float(tokens + kinds + 1)
    count, pair = sums[place[:n]].astype(float), sums[place[n:]].astype(float)
    # words of the block as numbers, and the contexts that are known as states
    kind, first, word = np.unique(place[:n], return_index=True, return_inverse=True)
    own = count[first]
    word_logs = np.log10((own + 1) / whole)
    state = np.where(own > 0, np.arange(1, len(kind) + 1), 0)
    fail = np.append(0.0, np.log10(mu / (own + mu)))
    # a document begins in the state of the end: what follows it are first words
    closing = int(word[t.ends[0]]) if len(t.ends) else 0
    before = np.empty(n, np.int64)
    before[1:] = word[:-1]
    before[t.off[:-1]] = closing
    seen = np.flatnonzero(pair > 0)
    arc_keys, at = np.unique(state[before[seen]] * len(kind) + word[seen], return_index=True)
    at = seen[at]
    arc_logs = np.log10((pair[at] + mu * (count[at] + 1) / whole) / (own[before[at]] + mu))
    machine = Automaton(word_logs, state, fail, arc_keys, arc_logs)
    score = machine.walk(word, t.off, int(state[closing]))
    each = word_logs[word]
    base = np.add.reduceat(each, t.off[:-1]) if n else np.zeros(0)
    known = np.add.reduceat((count > 0).astype(np.int64), t.off[:-1]) if n else np.zeros(0, np.int64)
    return known, base, score


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def answer(mu: float):
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        if not left.num_rows:
            return pa.schema(list(zip(names, kinds, strict=True))).empty_table()
        t = Tokens(Texts(left["text"].combine_chunks()))
        rows = sorted((r for r in right.to_pylist()), key=lambda r: r["bucket"])
        whole = [r for r in rows if r["bucket"] < 0]
        sums = np.concatenate([unpress(r["sums"], "<u8") for r in rows if r["bucket"] >= 0])
        keys, place = np.unique(np.concatenate((t.single, t.double)), return_inverse=True)
        assert len(keys) == len(sums), "a block's documents differ from those it asked for"
        tokens, distinct = whole[0]["tokens"], whole[0]["kinds"]
        known, base, score = block_scores(t, sums, keys, place, tokens, distinct, mu)
        n = left.num_rows
        return pa.table([left["doc_id"], left["held_out"], pa.array(t.counts, pa.int64()), pa.array(known, pa.int64()), pa.array(np.full(n, tokens), pa.int64()), pa.array(base), pa.array(score)], names=names)

    return run


def scores(docs: DataFrame, folds: int = 7, fold: int = 2, mu: float = PRIOR) -> DataFrame:
    """Log10 probability of every text under a model of the documents not held out.

    held_out: crc32 of the doc_id as text, modulo `folds`, is `fold`; a null
    doc_id counts as the empty text and is learned from.  A null or empty text
    is its end alone.  Repeated rows are learned from and scored as often as
    they come.  Without training rows all words are unknown.  An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total, n = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64), F.count("*")).first()
    blocks = max(1, math.ceil((total or 0) / BLOCK_BYTES))
    rows = rows.withColumn("held_out", remainder("doc_id", folds) == fold).withColumn("block", F.pmod(F.xxhash64("doc_id", text_key()), F.lit(blocks)))
    if blocks <= FAN:
        asked = rows.groupBy("block").applyInArrow(ask(min(FAN, max(partitions(spark), blocks))), ASK)
        replies = asked.groupBy("bucket").applyInArrow(add, REPLY)
        back = replies.filter("block >= 0")
    else:
        asked = rows.groupBy("block").applyInArrow(ask(FAN), ASK).withColumn("of", F.floor(F.col("block") / FAN))
        groups = asked.groupBy("bucket", "of").applyInArrow(ask_for_group(FAN * FAN), ASK + ", group long")
        replies = groups.groupBy("bucket").applyInArrow(add, REPLY)
        sums = replies.filter("block >= 0").withColumn("slice", F.floor(F.col("bucket") / FAN))
        back = asked.groupBy("bucket", "of").cogroup(sums.groupBy("slice", "block")).applyInArrow(pass_on, REPLY)
    whole = replies.filter("block = -1").agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("kinds"), F.lit(0)).alias("kinds"))
    # one row with the totals for each block
    whole = whole.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(-1).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("sums"), "tokens", "kinds")
    return rows.groupBy("block").cogroup(back.unionByName(whole).groupBy("block")).applyInArrow(answer(mu), SCHEMA)
