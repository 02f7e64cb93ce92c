"""An inverted file over vectors: cells around centres, each row in the cell of its nearest centre.

Centres are fitted on a bounded sample; every row is in the index.  A search
looks into the cells nearest to a query (`probes` of them).  With `certify` it
then looks into every further cell that could hold a better row: the angle
between a query and a row is at least that to the cell's centre less the cell's
radius.  The result is then that of a search over all rows.

Cells are cut into blocks of bounded size by hash, so a cell with many rows (or
many copies of one) is dealt over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.operators.vectors import matrix
from weftline.sources.folders import stored

#: vectors of the sample, cells at most, rounds of fitting, rows of a block of a cell
SAMPLE, CELLS, ROUNDS, BLOCK = 20_000, 2048, 12, 1 << 14
#: what rounding may add to an angle
SLACK = 1e-6


@dataclass
class Cells:
    rows: DataFrame  # key, vector, cell, block
    key: str
    vector: str
    centres: np.ndarray
    radius: np.ndarray  # the widest angle to a row, -1 where the cell is empty
    blocks: np.ndarray


def fitted(sample: np.ndarray, cells: int, seed: int = 7) -> np.ndarray:
    """Centres of unit vectors by spherical k-means; empty cells keep their last centre."""
    rng = np.random.default_rng(seed)
    if not len(sample):
        return np.zeros((1, sample.shape[1] if sample.ndim == 2 else 1))
    centres = sample[rng.permutation(len(sample))[:cells]]
    for _ in range(ROUNDS):
        own = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return centres


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows with a vector that has a direction: not null, no null or non-finite component, not all zeros."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col(vector).isNotNull()).filter(finite & F.exists(vector, lambda x: x != 0))


def indexed(rows: DataFrame, key: str, vector: str) -> Cells:
    """The inverted file of all rows that have a direction; the square root of their number of cells, CELLS at most.

    The sample is the SAMPLE rows of the least hashes of their keys.
    """
    rows = usable(rows, vector).select(key, vector)
    n = rows.count()
    drawn = rows.orderBy(F.xxhash64(key), key).limit(SAMPLE).select(vector).toArrow()
    centres = fitted(matrix(drawn[vector]) if drawn.num_rows else np.zeros((0, 1)), int(min(CELLS, max(1, round(n**0.5)))))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cosine = matrix(pa.chunked_array([batch.column(vector)])) @ centres.T
            own = cosine.argmax(axis=1)
            angle = np.arccos(np.clip(cosine[np.arange(len(own)), own], -1, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32)), pa.array(angle)], names=[*batch.schema.names, "cell", "angle"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    dealt = stored(rows.mapInArrow(assign, kinds + ", cell int, angle double"), "cells")
    radius, blocks = np.full(len(centres), -1.0), np.zeros(len(centres), np.int64)
    for r in dealt.groupBy("cell").agg(F.max("angle").alias("radius"), F.count("*").alias("n")).collect():  # a row a cell
        radius[r.cell], blocks[r.cell] = r.radius, -(-r.n // BLOCK)
    of_cell = F.element_at(F.lit(blocks.tolist()).cast("array<bigint>"), F.col("cell") + 1)
    return Cells(dealt.withColumn("block", F.pmod(F.xxhash64(key), of_cell).cast("int")).drop("angle"), key, vector, centres, radius, blocks)


def search(index: Cells, queries: DataFrame, k: int, probes: int = 8, certify: bool = False) -> DataFrame:
    """query, the key of a row, cosine (six places) and rank: the k nearest rows of each query among those of the cells looked into, without itself.

    Ties go to the lesser key.  Queries without a direction find nothing.
    """
    key, kind = index.key, index.rows.schema[index.key].dataType.simpleString()
    asked = usable(queries, index.vector).select(F.col(key).alias("query"), F.col(index.vector).alias("asked"))
    first = best(index, visits(index, asked, probes), k, kind)
    if certify:
        first = stored(first, "probed")
        # the k-th cosine so far; fewer rows than k rule nothing out
        kth = first.groupBy(F.col("query").alias("_query")).agg(F.count("*").alias("_n"), F.min("cosine").alias("_kth"))
        beyond = asked.join(kth, F.col("query") == F.col("_query"), "left").select("query", "asked", F.when(F.col("_n") >= k, F.col("_kth")).otherwise(-2.0).alias("kth"))
        first = first.unionByName(best(index, visits(index, beyond, probes), k, kind))
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("cosine"), key))
    return first.withColumn("rank", rank).filter(F.col("rank") <= k)


def visits(index: Cells, asked: DataFrame, probes: int) -> DataFrame:
    """query, asked, cell and block: what a query looks into: its nearest cells, or, if it has a kth, all further ones that may hold a row as good."""
    centres, radius, blocks = index.centres, index.radius, index.blocks
    later = "kth" in asked.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cosine = matrix(pa.chunked_array([batch.column("asked")])) @ centres.T
            cosine[:, radius < 0] = -np.inf
            order = np.argsort(-cosine, axis=1, kind="stable")
            near = np.zeros(cosine.shape, bool)
            np.put_along_axis(near, order[:, :probes], True, axis=1)
            near &= radius >= 0
            if later:
                least = np.maximum(0, np.arccos(np.clip(cosine, -1, 1)) - radius - SLACK)
                near = ~near & (radius >= 0) & (np.cos(least) >= batch.column("kth").to_numpy()[:, None] - SLACK)
            row, cell = np.nonzero(near)
            many = blocks[cell]
            row, cell, block = np.repeat(row, many), np.repeat(cell, many), np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            yield pa.RecordBatch.from_arrays([batch.column("query").take(pa.array(row)), batch.column("asked").take(pa.array(row)), pa.array(cell.astype(np.int32)), pa.array(block.astype(np.int32))], names=["query", "asked", "cell", "block"])

    kinds = ", ".join(f"{c} {asked.schema[c].dataType.simpleString()}" for c in ("query", "asked"))
    return asked.mapInArrow(run, kinds + ", cell int, block int")


def best(index: Cells, looked: DataFrame, k: int, kind: str) -> DataFrame:
    """The k best rows of each query in each block that it looks into, ties at the last place included."""
    key, vector = index.key, index.vector

    def unit(left: pa.Table, right: pa.Table) -> pa.Table:
        queries, found, cosines = [], [], []
        if left.num_rows and right.num_rows:
            rows, ids, asked = matrix(left[vector]), left[key].to_numpy(), right["query"].to_numpy()
            for a in range(0, len(asked), 256):
                cosine = np.round(matrix(right["asked"].slice(a, 256)) @ rows.T, 6) + 0.0
                cosine[asked[a : a + 256, None] == ids[None, :]] = -np.inf
                floor = np.partition(cosine, max(0, len(ids) - k), axis=1)[:, max(0, len(ids) - k)]
                row, at = np.nonzero((cosine >= floor[:, None]) & (cosine > -np.inf))
                order = np.lexsort((ids[at], -cosine[row, at], row))
                row, at = row[order], at[order]
                kept = np.arange(len(row)) - np.searchsorted(row, row) < k
                queries.append(a + row[kept])
                found.append(at[kept])
                cosines.append(cosine[row[kept], at[kept]])
        query, at, cosine = (np.concatenate(x) if x else np.zeros(0, int) for x in (queries, found, cosines))
        return pa.table([right["query"].take(pa.array(query)), left[key].take(pa.array(at)), pa.array(cosine.astype(float))], names=["query", key, "cosine"])

    at = ["cell", "block"]
    return index.rows.groupBy(*at).cogroup(looked.groupBy(*at)).applyInArrow(unit, f"query {kind}, `{key}` {kind}, cosine double")


def penalised(hits: DataFrame, ids: str, cosine: str = "cosine") -> DataFrame:
    """A row for each id of a hit: its cosine, cut to 0 to 1, over the root of the number of ids (ten at most count)."""
    n = F.greatest(F.lit(1), F.least(F.size(ids), F.lit(10)))
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(cosine))) / F.sqrt(n)
    return hits.withColumn("score", F.round(score, 6)).withColumn("id", F.explode(ids)).drop(ids)
