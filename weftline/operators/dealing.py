"""Numbers of partitions that grow with the input, so that what a task holds does not."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession


def partitions(spark: SparkSession, rows: float, each: int) -> int:
    """Enough partitions for `each` rows in one, and no fewer than a shuffle has by default."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(rows / each))


def dealt(rows: DataFrame, n: int, *by: str) -> DataFrame:
    """Rows dealt by columns to n partitions; where a shuffle has as many by default, the exchange is left to Spark."""
    return rows if n <= int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows.repartition(n, *by)
