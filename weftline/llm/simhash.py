"""SimHash near duplicates by covering locality-sensitive hashing.

A text's fingerprint has a bit set where over half of its shingles' hashes have
it.  Two fingerprints link at RADIUS or fewer differing bits.  Equal
fingerprints form a class; the rest is done on classes, each with one row:

1. Covering tables.  `covering_masks` gives 2^(RADIUS+1) - 1 structured masks
   such that any RADIUS positions are free of one mask at least, so two
   fingerprints that link agree under it and collide in its table: no link is
   missed, whatever the data.  A bucket is counted with its least and greatest
   fingerprint, so it is one row however many share it.
2. Check.  A bucket of two is settled by the distance of its two fingerprints.
   Members of a larger bucket differ in the mask's free bits only, and two of
   them are within two bits if and only if they share a point one free bit away
   from either, or are one themselves.  So each sends itself and its points,
   and what meets at a point links: work grows with the members of a bucket,
   not with their pairs, and at most BITS + 1 fingerprints meet at a point.
3. Large-star and small-star steps over the links give components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import LOWER, WORD, Texts, ragged, slices, spans
from .components import components
from .tables import written

WORDS, BITS, RADIUS, SEED = 3, 64, 2, 42
#: shingles hashed at once, bytes of text of a slice
TURN, SLICE = 1 << 16, 1 << 20


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Masks, as signed 64-bit numbers, such that any `radius` positions are outside one of them at least.

    Each position has a nonzero vector of radius + 1 bits, dealt in turn, and
    the mask of a nonzero vector v has the positions whose vector has an odd
    inner product with v.  The vectors of `radius` positions do not span all
    radius + 1 dimensions, so some v is orthogonal to all of them.
    """
    kinds = 2 ** (radius + 1) - 1
    masks = [sum(1 << i for i in range(bits) if (v & (1 + i % kinds)).bit_count() % 2) for v in range(1, kinds + 1)]
    return [m - (m >> 63 << 64) for m in masks]


def shingle_spans(texts: Texts, width: int = WORDS) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Words joined by one space, lower-cased; start and end of each shingle there; where each row's shingles begin."""
    data = LOWER[texts.data]
    start, end, first = spans(texts, WORD)
    size = end - start
    joined = np.append(data, np.uint8(0))[ragged(size + 1, start)] if len(start) else data[:0]
    stop = np.cumsum(size + 1)
    joined[stop - 1] = 0x20
    n = np.diff(first)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(n.dtype))
    head = ragged(count, first[:-1])
    tail = np.minimum(head + width, np.repeat(first[1:], count)) - 1
    return joined.tobytes(), stop[head] - size[head] - 1, stop[tail] - 1, np.append(0, np.cumsum(count))


def fingerprint_rows(texts: Texts) -> np.ndarray:
    """The fingerprint of each row: a bit is set if over half of its shingles' XXH64 have it; zero without words."""
    raw, start, end, off = shingle_spans(texts)
    rows, counts = np.repeat(np.arange(len(texts)), np.diff(off)), np.zeros((len(texts), BITS), np.int64)
    hashed = xxhash.xxh64_intdigest
    for a in range(0, len(start), TURN):
        some = zip(start[a : a + TURN].tolist(), end[a : a + TURN].tolist(), strict=True)
        h = np.fromiter((hashed(raw[i:j], SEED) for i, j in some), ">u8", len(start[a : a + TURN]))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1)
        own = rows[a : a + TURN]
        heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        counts[own[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    return np.packbits(2 * counts > np.diff(off)[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            fp = fingerprint_rows(Texts(batch.column("text"))).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def points(free: Column) -> Column:
    """A fingerprint and its neighbours one bit away in the free positions."""
    flips = [F.when(free.bitwiseAND(F.lit(bit)) != 0, F.col("fp").bitwiseXOR(F.lit(bit))) for bit in ((1 << i) - (1 << 64) * (i == 63) for i in range(BITS))]
    return F.filter(F.array(F.col("fp"), *flips), lambda x: x.isNotNull())


def links(classes: DataFrame) -> DataFrame:
    """(u, v) of distinct fingerprints (column fp) within RADIUS bits: enough of them to connect all that link."""
    masks = covering_masks()
    tables = classes.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in masks))).alias("mask", "part"))
    buckets = written(tables.groupBy("mask", "part").agg(F.count("*").alias("n"), F.min("fp").alias("v"), F.max("fp").alias("u")).filter("n > 1"), "buckets")
    two = buckets.filter(F.col("n") == 2).filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS).select("u", "v")
    large = tables.join(buckets.filter("n > 2").select("mask", "part"), ["mask", "part"])
    free = large.groupBy("fp").agg(F.bit_or(F.element_at(F.array(*(F.lit(~m) for m in masks)), F.col("mask") + 1)).alias("free"))
    # BITS + 1 fingerprints at most are one bit or less away from a point
    met = free.select("fp", F.explode(points(F.col("free"))).alias("point")).groupBy("point").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    near = met.select(F.explode("fps").alias("u"), F.array_min("fps").alias("v")).filter("u <> v").distinct()
    return two.unionByName(near)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the least doc_id that links lead to.

    Null, empty and wordless texts have fingerprint zero and link as any other.
    A null doc_id names no component: its row gets the least doc_id of its
    group, or null if there is none.  Repeated rows and ties link with
    themselves.  Other columns are left out.  An empty table gives no rows.
    """
    prints = written(fingerprints(docs), "prints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    parts = components(links(classes))
    joined = classes.join(parts, F.col("fp") == F.col("node"))
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = joined.join(least, "component").select(F.col("fp").alias("node"), "component_id")
    known = classes.join(linked, F.col("fp") == F.col("node"), "left").select(F.col("fp").alias("own"), F.coalesce("component_id", "least").alias("component_id"))
    # one fingerprint may have most rows: both sides of the join are exchanges alone, so Spark can split it
    out = prints.join(written(known, "known"), F.col("fp") == F.col("own"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
