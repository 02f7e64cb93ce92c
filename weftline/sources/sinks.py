"""Sinks: overwrite, append, append of absent keys, keyed upsert, vector caches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.operators.records import absent
from weftline.sources.readers import exists


def overwrite(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def append_absent(rows: DataFrame, path: str, key: list[str]) -> None:
    """Append rows whose key the table does not have yet."""
    spark = rows.sparkSession
    append(absent(rows, spark.read.parquet(path), key) if exists(spark, path) else rows, path)


def upsert(rows: DataFrame, old: str, new: str, key: list[str]) -> None:
    """Write the old table with the given rows in place of those with their keys, as a new version beside it."""
    spark = rows.sparkSession
    both = rows.withColumn("_batch", F.lit(1))
    if exists(spark, old):
        both = both.unionByName(spark.read.parquet(old).withColumn("_batch", F.lit(0)), allowMissingColumns=True)
    rank = F.row_number().over(W.partitionBy(*key).orderBy(F.desc("_batch")))
    overwrite(both.withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "_batch"), new)


def vector_cache(rows: DataFrame, path: str, size: int) -> None:
    """Vectors as compressed JSON lines; a vector of another size fails the write."""
    checked = rows.withColumn("values", F.when(F.size("values") == size, F.col("values")).otherwise(F.raise_error(F.lit("a vector has another size"))))
    checked.write.mode("overwrite").option("compression", "gzip").json(path)
