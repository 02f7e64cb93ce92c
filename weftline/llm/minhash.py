"""Near-duplicate documents by MinHash with exact confirmation.

Every text has a set of word shingles.  Texts with equal sets form a class; the
rest is done on classes.  Many universal hash functions give minima of each
set; bands of minima are keys of buckets.  Then, at every size alike:

1. Signature verification.  Within a bucket, two classes are a candidate pair if
   nothing rules a link out: neither their set sizes, nor their parities (a
   number of cells, each with the parity of how many values it holds: two sets
   differ in at least as many values as in parities), nor the agreement of all
   their minima (DEVIATIONS standard deviations below what a pair at the
   threshold shows).  A search over each bucket joins what candidate pairs
   connect; one row per class leaves it, not one per pair.
2. Those links are joined over all buckets by alternating large-star and
   small-star: groups of classes, each of which holds whole components.
3. Exact confirmation.  The texts of a group meet once, and the same search
   with full shingle sets tells which classes are linked.  Again one row per
   class leaves.  Star steps over the confirmed links give the components.

A search asks each member it reaches about those not reached yet, so members
that one neighbour connects are never compared with each other.  Buckets and
groups beyond a bound are cut into blocks by hash, and every two blocks meet in
one unit of work: no task holds more than two blocks, and no pair is left out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import U64, Texts, Words, distinct, inside_rows, mix, ragged, released, roll, slices
from .components import components
from .tables import keyed, written

WORDS = 5
#: chance at most to lose a link right at the threshold
MISS = 1e-6
#: parities in a sketch, a multiple of 64
CELLS = 1024
#: bits that are kept of a minimum, and how far below expectation the agreement of minima rules a link out
NIBBLE, DEVIATIONS = 4, 5
#: classes of a block of a bucket, shingles of a block of a group
BLOCK, BLOCK_SHINGLES = 8192, 1 << 20


def bands_for(threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Minima per band and number of bands: a pair at the threshold shares a band but for `miss`."""
    size = 8 if threshold >= 0.85 else 6 if threshold >= 0.8 else 4
    return size, math.ceil(math.log(miss) / math.log(1 - threshold**size))


def shingles(texts: Texts, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of each row, and where each row's begin; fewer words than `width` make one shingle."""
    words = Words(texts, lower=True)
    n = words.counts
    count = np.where(n >= width, n - width + 1, (n > 0).astype(n.dtype))
    off = np.append(0, np.cumsum(count))
    out = np.empty(int(off[-1]), U64)
    place = np.ones(len(out), bool)
    short = np.flatnonzero((n > 0) & (n < width))
    place[off[short]] = False
    if len(words) >= width:
        out[place] = roll(words.hash, width)[inside_rows(words.off, width)[: len(words) - width + 1]]
    for i in short.tolist():
        own = words.hash[words.off[i] : words.off[i + 1]]
        out[off[i]] = mix(roll(own, len(own)) + U64(len(own)))[0]
    return out, off


def unique_per_row(values: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row in order of appearance, and where each row's begin."""
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    if not len(values):
        return values, off
    _, first = distinct(values ^ mix(row.astype(U64) + U64(1)))
    return values[first], np.append(0, np.cumsum(np.bincount(row[first], minlength=len(off) - 1)))


def row_sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.append(U64(0), np.cumsum(values, dtype=U64))
    return total[off[1:]] - total[off[:-1]]


def minima(values: np.ndarray, off: np.ndarray, functions: int, seed: int = 11) -> np.ndarray:
    """Least value of each row under each of many universal hash functions a*x+b; rows must not be empty."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2**31, functions, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 2**32, functions, dtype=np.uint32)
    x = (values >> U64(32)).astype(np.uint32)
    out, own = np.empty((functions, len(off) - 1), np.uint32), np.empty_like(x)
    for j in range(functions):
        np.multiply(x, a[j], out=own)
        np.add(own, b[j], out=own)
        np.minimum.reduceat(own, off[:-1], out=out[j])
    return out


def band_keys(low: np.ndarray, size: int) -> np.ndarray:
    """Hashes of bands of `size` minima, one column per band."""
    out = np.empty((low.shape[0] // size, low.shape[1]), U64)
    for k in range(len(out)):
        h = np.full(low.shape[1], k + 1, U64)
        for j in range(size):
            h = mix(h * U64(0x9E3779B97F4A7C15) ^ low[k * size + j])
        out[k] = h
    return out.T


def sketches(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Parities of the number of each row's values in CELLS cells, as words of 64 bits."""
    width = CELLS // 64
    out = np.zeros((len(off) - 1) * width, U64)
    cell = mix(values ^ U64(0x2545F4914F6CDD1D)) % U64(CELLS)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    np.bitwise_xor.at(out, row * width + (cell >> U64(6)).astype(np.int64), U64(1) << (cell & U64(63)))
    return out


def nibbles(low: np.ndarray) -> np.ndarray:
    """Four bits of each minimum, sixteen to a word of 64 bits, one row per column of `low`; the last word may have zeros."""
    four = ((low * np.uint32(0x9E3779B1)) >> np.uint32(32 - NIBBLE)).astype(U64)
    words = -(-len(four) // 16)
    out = np.zeros((words, low.shape[1]), U64)
    for j in range(len(four)):
        out[j // 16] |= four[j] << U64(NIBBLE * (j % 16))
    return out.T


def binaries(rows: np.ndarray) -> pa.Array:
    """Rows of 64-bit words as one binary value each."""
    raw = np.ascontiguousarray(rows)
    off = np.arange(len(raw) + 1, dtype=np.int32) * np.int32(raw.shape[1] * 8)
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(off), pa.py_buffer(raw.tobytes())])


def signatures(docs: DataFrame, size: int, bands: int) -> DataFrame:
    """doc_id, fp, n_shingles, the set's fingerprint s1, s2, its band keys (none for an empty set) and its sketch: parities, then minima."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=1 << 18):
            values, off = unique_per_row(*shingles(Texts(part["text"])))
            n = np.diff(off)
            full = np.flatnonzero(n)
            keys = np.zeros((0, bands), U64)
            own = np.zeros((len(n), -(-size * bands // 16)), U64)
            if len(full):
                low = minima(values, np.append(off[full], off[-1]), size * bands)
                keys, own[full] = band_keys(low, size), nibbles(low)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum((n > 0) * bands)).astype(np.int32)), pa.array(keys.reshape(-1).view(np.int64)))
            s1, s2 = row_sums(mix(values), off), row_sums(mix(values ^ U64(0xA0761D6478BD642F)), off)
            sketch = binaries(np.concatenate((sketches(values, off).reshape(len(n), -1), own), 1))
            columns = [part["doc_id"], part["fp"], pa.array(n, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), lists, sketch]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", "n_shingles", "s1", "s2", "bands", "sketch"])

    schema = "doc_id long, fp long, n_shingles long, s1 long, s2 long, bands array<bigint>, sketch binary"
    return keyed(docs).select("doc_id", "fp", "text").mapInArrow(released(run), schema)


def search(first: np.ndarray, linked: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The first member that each member is connected with, inside its group.

    Group g has the members first[g] to first[g + 1] - 1; linked(x, y) tells for
    pairs of members whether they are linked, and is asked for all groups at
    once: at a step every group names one head, a member that is reached but
    not yet asked, or else the first not reached, and the head is tested
    against all that are not reached.
    """
    n = int(first[-1])
    root, state, live = np.arange(n), np.zeros(n, np.int8), np.arange(n)  # state: 0 not reached, 1 reached, 2 asked
    group = np.repeat(np.arange(len(first) - 1), np.diff(first))
    while len(live):
        begin = np.flatnonzero(np.append(True, group[live[1:]] != group[live[:-1]]))
        size = np.diff(np.append(begin, len(live)))
        heads = np.minimum.reduceat(live + np.where(state[live] == 1, 0, n), begin) % n
        state[heads] = 2
        other = state[live] == 0
        x, y = np.repeat(heads, size)[other], live[other]
        hit = linked(x, y) if len(y) else np.zeros(0, bool)
        root[y[hit]] = root[x[hit]]
        state[y[hit]] = 1
        open_ = np.repeat(np.logical_or.reduceat(state[live] == 0, begin), size)
        live = live[open_ & (state[live] < 2)]
    return root


def sizes_allow(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    return (100 - percent) * (x + y) >= (100 + percent) * np.abs(x - y)


def may_link(n: np.ndarray, sketch: np.ndarray, functions: int, percent: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Signature verification of pairs of members: whether nothing rules a link out."""
    width, t = CELLS // 64, percent / 100
    agree = t + (1 - t) / 2**NIBBLE
    most = functions * (1 - agree) + DEVIATIONS * math.sqrt(functions * agree * (1 - agree))  # minima that may differ
    ones = U64(0x1111111111111111)

    def linked(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = sizes_allow(n[x], n[y], percent)
        for a in range(0, len(x), 1 << 16):
            own = a + np.flatnonzero(out[a : a + (1 << 16)])
            apart = sketch[x[own]] ^ sketch[y[own]]
            parities = np.bitwise_count(apart[:, :width]).sum(1, dtype=np.int64)
            unlike = apart[:, width:]
            unlike |= unlike >> U64(2)
            unlike |= unlike >> U64(1)
            differ = np.bitwise_count(unlike & ones).sum(1, dtype=np.int64)
            out[own] = ((100 - percent) * (n[x[own]] + n[y[own]]) >= (100 + percent) * parities) & (differ <= most)
        return out

    return linked


def do_link(values: np.ndarray, off: np.ndarray, group: np.ndarray, percent: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Exact test of pairs of members of a group on their full sets; asked with one head per group at a time."""
    n = np.diff(off)
    code, _ = distinct(values ^ mix(np.repeat(group, n).astype(U64) + U64(1)))
    owner = np.full(int(code.max()) + 1 if len(code) else 0, -1)

    def linked(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = sizes_allow(n[x], n[y], percent)
        heads = np.unique(x)  # groups share no code, so all heads can stand together
        owner[code[ragged(n[heads], off[heads])]] = np.repeat(heads, n[heads])
        own = np.flatnonzero(out)
        upto = np.cumsum(n[y[own]])
        cuts = np.searchsorted(upto, np.arange(0, int(upto[-1]) if len(upto) else 0, 1 << 22)).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(own)]):
            some = own[a:b]
            if len(some):
                size = n[y[some]]
                same = owner[code[ragged(size, off[y[some]])]] == np.repeat(x[some], size)
                both = np.add.reduceat(same, np.cumsum(size) - size, dtype=np.int64)
                out[some] = 100 * both >= percent * (n[x[some]] + size - both)
        return out

    return linked


def units(members: DataFrame, group: str, weight: Column, limit: int) -> DataFrame:
    """Members (group, c, ...) of groups of two or more, with each unit of work that they take part in.

    A group of a weight up to `limit` is one unit.  A heavier one is cut into
    blocks by hash of c, and every two of its blocks make a unit.
    """
    total = members.groupBy(group).agg(F.count("*").alias("of"), F.ceil(F.sum(weight) / limit).cast("int").alias("blocks")).filter("of > 1").select(group, "blocks")
    rows = members.join(total, group).withColumn("own", F.expr("cast(pmod(xxhash64(c), blocks) as int)"))
    others = F.expr("transform(filter(sequence(0, blocks - 1), b -> b <> own), b -> least(b, own) * cast(blocks as bigint) + greatest(b, own))")
    return rows.withColumn("unit", F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long"))).otherwise(others))).drop("own", "blocks")


def whole_units(batches: Iterator[pa.RecordBatch], rows: int, size: int = 2**62) -> Iterator[pa.Table]:
    """Rows that come sorted by (grp, unit), some units at a time: a table is given out once it has so many rows or bytes of text."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= rows or sum(x.nbytes for x in held) >= size:
            table = pa.Table.from_batches(held).combine_chunks()
            grp, unit = table["grp"].to_numpy(), table["unit"].to_numpy()
            cut = int(np.flatnonzero(np.append(True, (grp[1:] != grp[:-1]) | (unit[1:] != unit[:-1])))[-1])  # the last unit may go on
            if cut:
                yield table.slice(0, cut).combine_chunks()
            held = [x for x in table.slice(cut).combine_chunks().to_batches() if x.num_rows]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def starts(table: pa.Table) -> np.ndarray:
    """First row of each unit, and the end."""
    grp, unit = table["grp"].to_numpy(), table["unit"].to_numpy()
    return np.append(np.flatnonzero(np.append(True, (grp[1:] != grp[:-1]) | (unit[1:] != unit[:-1]))), len(grp))


def stars(table: pa.Table, columns: tuple[str, str], root: np.ndarray) -> pa.RecordBatch:
    """One row for each member that is connected with an earlier one: itself and the first it is connected with."""
    own = np.flatnonzero(root != np.arange(len(root)))
    ids = table[columns[0]].to_numpy()
    return pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(ids[root[own]])], ["u", "v"])


def candidate_links(classes: DataFrame, functions: int, percent: int) -> DataFrame:
    """Links u, v of classes that join all candidate pairs of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_units(batches, 1 << 14):
            sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), U64)
            test = may_link(table["n_shingles"].to_numpy(), sketch.reshape(table.num_rows, -1), functions, percent)
            yield stars(table, ("c", "c"), search(starts(table), test))

    members = units(classes.select("c", F.explode("bands").alias("grp")), "grp", F.lit(1), BLOCK)
    rows = members.join(classes.select("c", "n_shingles", "sketch"), "c").select("grp", "unit", "c", "n_shingles", "sketch")
    return rows.repartition("grp", "unit").sortWithinPartitions("grp", "unit", "c").mapInArrow(released(run), "u long, v long")


def confirmed_links(docs: DataFrame, classes: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links u, v of documents that join all linked pairs of classes of each group, by full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_units(batches, 1 << 14, 4 << 20):
            values, off = unique_per_row(*shingles(Texts(table["text"].combine_chunks())))
            first = starts(table)
            group = np.repeat(np.arange(len(first) - 1), np.diff(first))
            yield stars(table, ("node", "node"), search(first, do_link(values, off, group, percent)))

    members = units(groups.join(classes.select("c", "node", "fp", "n_shingles"), "c"), "grp", F.col("n_shingles"), BLOCK_SHINGLES)
    wanted = members.groupBy(F.col("node").alias("id0"), "fp").agg(F.collect_list(F.struct("grp", "unit", "node")).alias("at"))
    # rows equal in doc_id and text come out of the join next to each other: one of them stays
    texts = keyed(docs).filter("doc_id is not null").select("id0", "fp", "text").join(wanted, ["id0", "fp"]).groupBy("id0", "fp").agg(F.first("text").alias("text"), F.first("at").alias("at"))
    rows = texts.select("text", F.inline("at"))
    return rows.select("grp", "unit", "node", "text").repartition("grp", "unit").sortWithinPartitions("grp", "unit", "node").mapInArrow(released(run), "u long, v long")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """n_shingles, component_id and kept of every document; links need `percent` of the union in common.

    A text without words, or null, has an empty set and is linked with nothing.
    A null doc_id takes no part: its component is null and it is kept.  Rows of
    one doc_id are one node; repeated rows get the same result each.  An empty
    table gives no rows.
    """
    size, bands = bands_for(percent / 100)
    marks = written(signatures(docs, size, bands), "minhash")
    full = marks.filter("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("s1", "s2", "n_shingles").agg(F.min(F.struct("doc_id", "fp")).alias("rep"), F.min_by(F.struct("bands", "sketch"), F.struct("doc_id", "fp")).alias("own"))
    classes = classes.select("s1", "s2", "n_shingles", F.col("rep.doc_id").alias("node"), F.col("rep.fp").alias("fp"), "own.bands", "own.sketch", F.monotonically_increasing_id().alias("c"))
    classes = written(classes, "minhash")
    groups = components(candidate_links(classes, size * bands, percent)).select(F.col("node").alias("c"), F.col("component").alias("grp"))
    known = components(confirmed_links(docs, classes, groups, percent))
    own = classes.join(known, "node", "left").select("s1", "s2", "n_shingles", F.coalesce("component", "node").alias("class_component"))
    out = marks.select("doc_id", "n_shingles", "s1", "s2").join(own, ["s1", "s2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id")).otherwise(F.col("class_component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
