"""Best-fit packing of token sequences with certified bin counts.

Documents are encoded once; only piece lengths travel afterwards.  Pieces are
dealt to partitions of bounded size, each packed by best-fit decreasing.  Lower
bounds from dual-feasible functions on the partition's histogram of lengths say
how many sequences it needs at least.  Partitions above their bound give the
pieces of their unfilled sequences to a pool, which is dealt anew and packed
again, until no partition has a gap or the pool is one partition.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Texts, released, slices
from .tables import dropped, written
from .tokens import encoder, with_end

#: pieces packed by one task at once
PIECES_PER_TASK = 40_000
ROUNDS = 4


def cut_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: whole capacities behind one shorter first piece."""
    if total <= capacity:
        return [total]
    first = total % capacity
    return ([first] if first else []) + [capacity] * (total // capacity)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest bound that two families of dual-feasible functions give.

    A dual-feasible function maps sizes so that what fits one bin maps to at
    most 1; the sum of the images bounds the number of bins from below.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    # f_k: sizes over C - k count whole, those under k not at all
    upto, sums = np.cumsum(count), np.cumsum(count * size)
    for k in range(1, capacity // 2 + 1):
        large = int(upto[-1] - upto[capacity - k])
        middle = int(sums[capacity - k] - sums[k - 1])
        best = max(best, large + -(-middle // capacity))
    # u_k: (k+1)x/C rounded down to k parts, kept where it is whole
    for k in range(1, 21):
        scaled = (k + 1) * size
        image = np.where(scaled % capacity == 0, size * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((count * image).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and the fill of each bin.

    Each length, longest first, goes to the open bin with the least room that
    holds it.  Rooms are small integers: a bit set finds the least one.
    """
    bins, offsets, fill = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        at = rooms >> n
        if at:
            room = n + (at & -at).bit_length() - 1
            b = with_room[room].pop()
            if not with_room[room]:
                rooms &= ~(1 << room)
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += n
        if room > n:
            with_room[room - n].append(b)
            rooms |= 1 << (room - n)
    return bins, offsets, np.array(fill, np.int64)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """One row per piece of every document; `with_ids` adds the ids as unsigned 32-bit binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for part in slices(batches, limit=2 << 20):
            ids, counts = with_end(*enc.encode(Texts(part["text"])), end_id)
            raw = memoryview(ids.astype("<u4").tobytes())
            row, piece, start, length, crc, own, at = [], [], [], [], [], [], 0
            for i, n in enumerate(counts.tolist()):
                begin = 0
                for k, m in enumerate(cut_lengths(n, capacity)):
                    data = raw[4 * (at + begin) : 4 * (at + begin + m)]
                    row.append(i), piece.append(k), start.append(begin), length.append(m), crc.append(crc32(data))
                    if with_ids:
                        own.append(bytes(data))
                    begin += m
                at += n
            columns = [part["doc_id"].take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(own, pa.binary())] if with_ids else []), names + ["ids"] * with_ids)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(released(run), PIECES + (", ids binary" if with_ids else ""))


def pack(items: DataFrame, capacity: int, per_task: int = PIECES_PER_TASK, rounds: int = ROUNDS) -> DataFrame:
    """Put rows with a `length` of 1 to `capacity` into sequences.

    Partitions whose number of bins lies above their bound exchange what is in
    unfilled bins, `rounds` times at most; after the last round a partition may
    keep its gap.  No row is lost by that, only some room.

    Adds sequence_id, offset, and of the partition that made the sequence
    `bins` and `bound`.  All other columns are kept.
    """
    names = items.columns
    items = written(items.withColumn("uid", F.monotonically_increasing_id()), "pack")
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema) + ", sequence_id long, offset long, fill long, bins long, bound long"

    def packer(turn: int):
        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            lengths = pdf["length"].to_numpy(np.int64)
            bins, offsets, fill = best_fit_decreasing(lengths, capacity)
            base = (turn << 58) + (int(key[0]) << 28)
            return pdf.drop(columns="part").assign(sequence_id=base + bins, offset=offsets, fill=fill[bins], bins=len(fill), bound=lower_bound(lengths, capacity))

        return run

    pool, done, spent = items, [], []
    for turn in range(rounds):
        n = pool.count()
        if not n and turn:
            break
        parts = max(1, math.ceil(n / per_task))
        dealt = pool.withColumn("part", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(parts)))
        packed = written(dealt.groupBy("part").applyInPandas(packer(turn), out_schema), "pack")
        spent.append(pool)
        again = (F.col("bins") > F.col("bound")) & (F.col("fill") < capacity)
        if turn == rounds - 1 or parts == 1:
            done.append(packed)
            break
        done.append(packed.filter(~again))
        pool = packed.filter(again).select(*names, "uid")
    for table in spent[:1]:
        dropped(table)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*names, "sequence_id", "offset", "bins", "bound")


def pack_documents(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pack all documents into few sequences of at most `capacity` ids.

    A null or empty text is a document of the end id alone.  Rows are packed as
    they come: a repeated row gives pieces of its own, a null doc_id stays null.
    An empty table gives no pieces.  Columns but doc_id and text are not read.
    """
    return pack(pieces(docs, tokenizer, capacity, end_id), capacity)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str = "byte_bpe_50k.json", capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """The packed sequences themselves: one row each, ids as unsigned 32-bit little-endian binary.

    doc_id must be unique and not null here, for ids are matched by it.
    """
    own = pieces(docs, tokenizer, capacity, end_id, with_ids=True).select("doc_id", "piece", "ids")
    rows = packed.select("doc_id", "piece", "sequence_id", "offset").join(own, ["doc_id", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return rows.groupBy("sequence_id").agg(F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
