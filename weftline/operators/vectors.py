"""Exact vector search: a stated set of query vectors against all vectors, block by block.

Rows and queries are cut into blocks by hash, of bounded size whatever the
table's; every row block meets every query block in one task, as one product of
two matrices, and leaves the k best rows of each query.  A second step ranks
what the row blocks left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: vectors of a block of rows and of a block of queries
ROW_BLOCK, QUERY_BLOCK = 1 << 16, 1 << 11


def blocked(rows: DataFrame, key: str, size: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a block number each, and the one row that tells the number of blocks."""
    blocks = rows.agg(F.greatest(F.ceil(F.count("*") / size), F.lit(1)).cast("int").alias("_" + name))
    return rows.crossJoin(F.broadcast(blocks)).withColumn(name, F.expr(f"cast(pmod(xxhash64({key}), _{name}) as int)")).drop("_" + name), blocks


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten()
    out = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    size = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.where(size > 0, size, np.nan)


def nearest(rows: DataFrame, queries: DataFrame, key: str, vector: str, k: int, label: str | None = None) -> DataFrame:
    """The k nearest of all rows for each query row, without itself, by cosine rounded to six places, then by key.

    Rows without a vector, or with a zero one, are near to nothing.
    """
    extra = [label] if label else []
    kind = rows.schema[key].dataType.simpleString()
    shape = [f"query {kind}", f"{key} {kind}", "cosine double", *(f"query_{c} {rows.schema[c].dataType.simpleString()}" for c in extra), *(f"{c} {rows.schema[c].dataType.simpleString()}" for c in extra)]
    names = [x.split()[0] for x in shape]

    def best(left: pa.Table, right: pa.Table) -> Iterator[pa.RecordBatch] | pa.Table:
        picked: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            ids, asked = left[key].to_numpy(), right["_asked"].to_numpy()
            all_, q = matrix(left[vector]), matrix(right["_vector"])
            for a in range(0, len(q), 256):
                cosine = np.round(q[a : a + 256] @ all_.T, 6) + 0.0
                cosine[(asked[a : a + 256, None] == ids[None, :]) | np.isnan(cosine)] = -np.inf
                floor = np.partition(cosine, max(0, len(ids) - k), axis=1)[:, max(0, len(ids) - k)]
                row, at = np.nonzero((cosine >= floor[:, None]) & (cosine > -np.inf))  # ties at the floor included
                order = np.lexsort((ids[at], -cosine[row, at], row))
                row, at = row[order], at[order]
                rank = np.arange(len(row)) - np.searchsorted(row, row)
                picked.append((a + row[rank < k], at[rank < k], cosine[row, at][rank < k]))
        query, at, cosine = (np.concatenate([x[j] for x in picked]) if picked else np.zeros(0, int) for j in range(3))
        columns = [right["_asked"].take(pa.array(query)), left[key].take(pa.array(at)), pa.array(cosine.astype(float)), *(right["query_" + c].take(pa.array(query)) for c in extra), *(left[c].take(pa.array(at)) for c in extra)]
        return pa.table(columns, names=names)

    # the columns of both sides have names of their own: queries may be a part of the rows
    asked = queries.filter(F.col(vector).isNotNull()).select(F.col(key).alias("_asked"), F.col(vector).alias("_vector"), *(F.col(c).alias("query_" + c) for c in extra))
    left, row_blocks = blocked(rows.filter(F.col(vector).isNotNull()).select(key, vector, *extra), key, ROW_BLOCK, "row_block")
    right, query_blocks = blocked(asked, "_asked", QUERY_BLOCK, "query_block")
    left = left.crossJoin(F.broadcast(query_blocks)).withColumn("query_block", F.explode(F.expr("sequence(0, _query_block - 1)"))).drop("_query_block")
    right = right.crossJoin(F.broadcast(row_blocks)).withColumn("row_block", F.explode(F.expr("sequence(0, _row_block - 1)"))).drop("_row_block")
    unit = ["row_block", "query_block"]
    found = left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInArrow(best, ", ".join(shape))
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("cosine"), key))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query", key, "cosine", "rank", *("query_" + c for c in extra), *extra)
