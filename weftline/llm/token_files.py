"""Token-id files with a minimal perfect hash index.

Files: a Parquet table of blocks.  A block holds some consecutive documents in
ascending doc_id: their ids, their lengths and one payload of raw little-endian
ids (16 bits where the vocabulary allows, else 32).  Beside it lies the index:
one row per bucket of keys with a minimal perfect hash function (levels of bit
arrays; a key rests at the first level where nothing else hits its bit, and the
number of set bits before it is its slot), a stored 32-bit fingerprint per slot
and the places of the key's documents.  A lookup hashes the key, reads the slot,
compares the fingerprint, and then the doc_id stored in the block itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .blocks import U64, Texts, mix, ragged, slices
from .tables import new_path
from .tokens import encoder, with_end

#: ids of one block, a document more at most; keys of one index bucket on average
BLOCK_IDS = 1 << 20
BUCKET_KEYS = 50_000
#: bits a level has for each key that reaches it
ROOM = 2.0
BLOCKS = "part int, seq int, n_docs int, n_ids long, width int, doc_ids array<bigint>, lengths array<bigint>, payload binary"


def key_hash(doc_ids: np.ndarray, null: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of keys; null is a key of its own."""
    return mix(mix(doc_ids.astype(np.int64).view(U64) + U64(0x9E3779B97F4A7C15 * (seed + 1) % 2**64)) ^ np.where(null, U64(0x5851F42D4C957F2D), U64(0)))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit hashes, as levels of bits."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.append(0, np.cumsum([int(x.sum()) for x in levels])).astype(np.int64)
        self.rank = [np.cumsum(x) - x for x in levels]

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        levels, left = [], hashes
        while len(left):
            size = max(8, int(len(left) * ROOM))
            at = cls.place(left, len(levels), size)
            once = np.bincount(at, minlength=size) == 1
            levels.append(once)
            left = left[~once[at]]
        return cls(levels)

    @staticmethod
    def place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(hashes + U64(0xD1342543DE82EF95 * (level + 1) % 2**64)) % U64(size)).astype(np.int64)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash; -1 if it rests nowhere. Only keys of the build are sure to have their own."""
        out = np.full(len(hashes), -1, np.int64)
        todo = np.arange(len(hashes))
        for k, bits in enumerate(self.levels):
            at = self.place(hashes[todo], k, len(bits))
            here = bits[at]
            out[todo[here]] = self.before[k] + self.rank[k][at[here]]
            todo = todo[~here]
        return out

    def dump(self) -> tuple[list[int], bytes]:
        return [len(x) for x in self.levels], b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def load(cls, sizes: list[int], raw: bytes) -> PerfectHash:
        levels, at = [], 0
        for n in sizes:
            m = (int(n) + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(raw[at : at + m], np.uint8), count=int(n)).astype(bool))
            at += m
        return cls(levels)


def write_blocks(docs: DataFrame, path: str, tokenizer: str, end_id: int, block_ids: int = BLOCK_IDS) -> None:
    """Encode all texts and write blocks in ascending doc_id; nulls come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        width = 4 if enc.wide or end_id >= 1 << 16 else 2
        part, seq = TaskContext.get().partitionId(), 0
        own: list = []

        def block() -> pa.RecordBatch:
            doc_ids, lengths = [i for x in own for i in x[0]], np.concatenate([x[1] for x in own])
            payload = np.concatenate([x[2] for x in own]).astype(f"<u{width}").tobytes()
            values = [part, seq, len(doc_ids), int(lengths.sum()), width, doc_ids, lengths.tolist(), payload]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [x.split()[0] for x in BLOCKS.split(", ")])

        held = 0
        for rows in slices(batches):
            ids, counts = with_end(*enc.encode(Texts(rows["text"])), end_id)
            own.append((rows["doc_id"].to_pylist(), counts, ids))
            held += len(ids)
            if held >= block_ids:
                yield block()
                seq, held, own = seq + 1, 0, []
        if own:
            yield block()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, BLOCKS).write.option("compression", "zstd").parquet(path)


INDEX = "bucket long, n_keys long, sizes array<bigint>, bits binary, prints binary, run_off binary, runs binary"


def write_index(spark: SparkSession, blocks_path: str, path: str) -> None:
    """Build the index from the ids in the blocks; payloads are not read."""
    blocks = spark.read.parquet(blocks_path)
    n = blocks.agg(F.sum("n_docs")).first()[0] or 0
    buckets = max(1, math.ceil(n / BUCKET_KEYS))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, doc_ids in zip(batch["part"].to_pylist(), batch["seq"].to_pylist(), batch["doc_ids"], strict=True):
                column = doc_ids.values
                null = column.is_null().to_numpy(zero_copy_only=False)
                ids = column.fill_null(0).to_numpy()
                first = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (null[1:] != null[:-1]))) if len(ids) else np.zeros(0, np.int64)
                bucket = (key_hash(ids[first], null[first], 0) % U64(buckets)).astype(np.int64)
                m = len(first)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), column.take(pa.array(first)), pa.array(np.full(m, part, np.int32)), pa.array(np.full(m, seq, np.int32)), pa.array(first), pa.array(np.diff(np.append(first, len(ids))))], ["bucket", "doc_id", "part", "seq", "first", "n"])

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        null = pdf["doc_id"].isna().to_numpy()
        ids = pdf["doc_id"].fillna(0).to_numpy().astype(np.int64)
        hashes = key_hash(ids, null, 1)
        known, inverse = np.unique(hashes, return_inverse=True)
        f = PerfectHash.build(known)
        slot = f.slots(known)[inverse]
        order = np.lexsort((pdf["first"], pdf["seq"], pdf["part"], slot))
        prints = np.zeros(len(known), "<u4")
        prints[slot] = (key_hash(ids, null, 2) >> U64(32)).astype(np.uint32)
        run_off = np.append(0, np.cumsum(np.bincount(slot, minlength=len(known)))).astype("<i8")
        places = pdf[["part", "seq", "first", "n"]].to_numpy(np.int64)[order].astype("<i8")
        sizes, bits = f.dump()
        return pd.DataFrame({"bucket": [int(key[0])], "n_keys": [len(known)], "sizes": [sizes], "bits": [bits], "prints": [prints.tobytes()], "run_off": [run_off.tobytes()], "runs": [places.tobytes()]})

    rows = blocks.select("part", "seq", "doc_ids").mapInArrow(runs, "bucket long, doc_id long, part int, seq int, first long, n long")
    # a nullable long would pass through pandas as a float; the null key travels as its own flag
    rows.groupBy("bucket").applyInArrow(_exact(build), INDEX).withColumn("buckets", F.lit(buckets)).write.parquet(path)


def _exact(build):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        pdf = pd.DataFrame({c: table[c].to_numpy() for c in ("part", "seq", "first", "n")})
        pdf["doc_id"] = pd.array(table["doc_id"].to_pylist(), "Int64")
        return pa.Table.from_pandas(build((key[0].as_py(),), pdf), preserve_index=False)

    return run


def locate(spark: SparkSession, index_path: str, keys: DataFrame) -> DataFrame:
    """Places of the documents of each distinct key: doc_id, part, seq, first, n. A key that is not there gives no row."""
    index = spark.read.parquet(index_path)
    head = index.select("buckets").first()
    buckets = head[0] if head else 1

    def own_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch["doc_id"]
            hashes = key_hash(column.fill_null(0).to_numpy(), column.is_null().to_numpy(zero_copy_only=False), 0)
            yield pa.RecordBatch.from_arrays([column, pa.array((hashes % U64(buckets)).astype(np.int64))], ["doc_id", "bucket"])

    def find(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("first", pa.int64()), ("n", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        row = right.to_pylist()[0]
        f = PerfectHash.load(row["sizes"], row["bits"])
        column = left["doc_id"].combine_chunks()
        null, ids = column.is_null().to_numpy(zero_copy_only=False), column.fill_null(0).to_numpy()
        slot = f.slots(key_hash(ids, null, 1))
        prints = np.frombuffer(row["prints"], "<u4")
        good = slot >= 0
        good[good] = prints[slot[good]] == (key_hash(ids, null, 2) >> U64(32)).astype(np.uint32)[good]
        off, runs = np.frombuffer(row["run_off"], "<i8"), np.frombuffer(row["runs"], "<i8").reshape(-1, 4)
        at = np.flatnonzero(good)
        count = off[slot[at] + 1] - off[slot[at]]
        place = runs[ragged(count, off[slot[at]])]
        return pa.table([column.take(pa.array(np.repeat(at, count))), place[:, 0].astype(np.int32), place[:, 1].astype(np.int32), place[:, 2], place[:, 3]], schema=schema)

    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().mapInArrow(own_bucket, "doc_id long, bucket long")
    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(find, "doc_id long, part int, seq int, first long, n long")


def read(spark: SparkSession, blocks_path: str, index_path: str, keys: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of the given keys from the files, found through the index.

    Returns doc_id, start (ids of all documents before it), n_tokens, ids_crc32
    and, if asked for, the ids.  Only blocks that hold a key are read into Python.
    """
    blocks = spark.read.parquet(blocks_path)
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    sums = sums.select("part", (F.sum("part_ids").over(W.orderBy("part")) - F.col("part_ids")).alias("before"))
    inside = F.sum("n_ids").over(W.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    bases = blocks.select("part", "seq", "n_ids").withColumn("inside", inside).join(sums, "part").select("part", "seq", (F.col("before") + F.col("inside")).alias("base"))
    wanted = locate(spark, index_path, keys).groupBy("part", "seq").agg(F.collect_list(F.struct("doc_id", "first", "n")).alias("wanted"))
    rows = blocks.select("part", "seq", "width", "doc_ids", "lengths", "payload").join(wanted.join(bases, ["part", "seq"]), ["part", "seq"])
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i].as_py() for c in ("width", "payload", "base", "wanted")}
                lengths, doc_ids = batch["lengths"][i].values.to_numpy(), batch["doc_ids"][i].values.to_pylist()
                start = np.cumsum(lengths) - lengths
                ids = np.frombuffer(row["payload"], f"<u{row['width']}")
                out = []
                for want in row["wanted"]:
                    for k in range(want["first"], want["first"] + want["n"]):
                        if doc_ids[k] == want["doc_id"]:  # fingerprints can agree by chance
                            own = ids[start[k] : start[k] + lengths[k]].astype("<u4")
                            out.append((doc_ids[k], int(row["base"] + start[k]), int(lengths[k]), crc32(own.tobytes()), own.tolist() if with_ids else None))
                yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], k) for j, k in enumerate(kinds)], names)

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<bigint>" if with_ids else ""))


def token_files(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, folder: str | None = None) -> tuple[str, str]:
    """Write blocks and index of all documents; returns the two paths.

    A null or empty text is a document of the end id alone.  Rows that share a
    doc_id stay next to each other and are all found by it; a null doc_id is a
    key too, and comes first.  An empty table gives files without rows.
    """
    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")
    write_blocks(docs, f"{folder}/blocks", tokenizer, end_id)
    write_index(spark, f"{folder}/blocks", f"{folder}/index")
    return f"{folder}/blocks", f"{folder}/index"
