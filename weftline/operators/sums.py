"""Running sums in a total order without one task that holds all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def running_before(rows: DataFrame, n: str, coarse: list[Column], fine: list[Column], name: str = "before") -> DataFrame:
    """The sum of `n` over all rows in front of each, in the order of `coarse`, then `fine`.

    Two levels: sums per value of `coarse`, whose values are few and whose
    order is the first part of the whole order; then within each value.  Only
    the few sums meet in one task.
    """
    keys = [f"_coarse{i}" for i in range(len(coarse))]
    keyed = rows.select("*", *(c.alias(k) for c, k in zip(coarse, keys, strict=True)))
    sums = keyed.groupBy(*keys).agg(F.sum(n).alias("_sum"))
    front = sums.select(*keys, (F.sum("_sum").over(W.orderBy(*keys).rowsBetween(W.unboundedPreceding, 0)) - F.col("_sum")).alias("_front"))
    within = F.sum(n).over(W.partitionBy(*keys).orderBy(*fine).rowsBetween(W.unboundedPreceding, 0)) - F.col(n)
    return keyed.withColumn("_within", within).join(front, keys).withColumn(name, F.col("_front") + F.col("_within")).drop(*keys, "_within", "_front")


def with_total(rows: DataFrame, n: str, name: str = "total") -> DataFrame:
    """The sum over all rows beside each row: one row is broadcast."""
    return rows.crossJoin(F.broadcast(rows.agg(F.sum(n).alias(name))))


def rank_within(rows: DataFrame, by: str, key: str, then: list[str], name: str = "rank", width: int = 1024) -> DataFrame:
    """The rank of each row (from 0) within `by`, whose values are few, in the order of a numeric key and further columns.

    Ranks are made within ranges of `width` keys and raised by what lies in front of the range.
    """
    numbered = running_before(rows.withColumn("_one", F.lit(1)), "_one", [F.col(by), F.floor(F.col(key) / width)], [key, *then], "_before")
    counts = rows.groupBy(F.col(by).alias("_by")).agg(F.count("*").alias("_n"))
    first = counts.select("_by", (F.sum("_n").over(W.orderBy("_by").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")).alias("_first"))
    return numbered.join(F.broadcast(first), F.col(by) == F.col("_by")).withColumn(name, F.col("_before") - F.col("_first")).drop("_one", "_before", "_by", "_first")
