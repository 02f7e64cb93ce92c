"""Time: band joins, sliding counts, calendar buckets, chains, recency, as-of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def recency(year: Column, as_of_year: int) -> Column:
    """1 up to a year ago, .85 up to three, .65 up to five, else .5; unknown counts as 1."""
    age = F.lit(as_of_year) - year
    return F.when(year.isNull() | (age <= 1), 1.0).when(age <= 3, 0.85).when(age <= 5, 0.65).otherwise(0.5)


def day_number(column: str) -> Column:
    return F.datediff(F.col(column), F.lit("1970-01-01").cast("date"))


def band_pairs(rows: DataFrame, key: str, by: str, day: str, width: int) -> DataFrame:
    """Pairs a < b of one `by` whose days are at most `width` apart.

    Days are put into buckets of the band's width: a pair lies in one bucket or
    in neighbours, so an equality join on (by, bucket) finds it, once.
    """
    left = rows.select(F.col(by).alias("by"), F.col(key).alias("a"), F.col(day).alias("day_a"), F.floor(F.col(day) / width).alias("bucket"))
    right = rows.select(F.col(by).alias("by"), F.col(key).alias("b"), F.col(day).alias("day_b"), F.explode(F.array(*(F.floor(F.col(day) / width) + k for k in (-1, 0, 1)))).alias("bucket"))
    return left.join(right, ["by", "bucket"]).filter((F.col("a") < F.col("b")) & (F.abs(F.col("day_a") - F.col("day_b")) <= width)).select("by", "a", "b", F.abs(F.col("day_a") - F.col("day_b")).alias("days"))


def sliding_count(rows: DataFrame, by: str, day: str, width: int, name: str) -> DataFrame:
    return rows.withColumn(name, F.count("*").over(W.partitionBy(by).orderBy(day).rangeBetween(-width, width)))


def iso_week(column: str) -> Column:
    return F.concat(F.date_part(F.lit("YEAROFWEEK"), F.col(column)).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(column).cast("string"), 2, "0"))


def chain(rows: DataFrame, by: str, order: list[str], key: str) -> DataFrame:
    """Position and length in each chain, and the next element."""
    own = W.partitionBy(by).orderBy(*order)
    return rows.withColumn("position", F.row_number().over(own)).withColumn("next_key", F.lead(key).over(own)).withColumn("length", F.count("*").over(W.partitionBy(by)))


def high_water_mark(rows: DataFrame, column: str, lookback_days: int) -> DataFrame:
    """Where an incremental read starts: the latest date less a lookback for late rows."""
    return rows.agg(F.date_sub(F.max(column).cast("date"), lookback_days).cast("string").alias("start_date"))


def as_of(left: DataFrame, right: DataFrame, by: str, ts: str, value: str) -> DataFrame:
    """The last value of `right` at or before each row of `left`, by one ordered pass over both."""
    both = left.withColumn("_v", F.lit(None).cast(right.schema[value].dataType)).withColumn("_side", F.lit(1))
    other = right.select(by, ts, F.col(value).alias("_v")).withColumn("_side", F.lit(0))
    joined = both.unionByName(other, allowMissingColumns=True)
    found = F.last("_v", ignorenulls=True).over(W.partitionBy(by).orderBy(ts, "_side").rowsBetween(W.unboundedPreceding, 0))
    return joined.withColumn("as_of_" + value, found).filter("_side = 1").drop("_v", "_side")


def sessions(rows: DataFrame, by: str, ts: str, order: str, gap_seconds: int) -> DataFrame:
    """Sessions of each `by`: a row later than the gap behind the one before opens a new one."""
    own = W.partitionBy(by).orderBy(ts, order)
    second = F.unix_micros(F.col(ts).cast("timestamp"))
    new = F.when(second - F.lag(second).over(own) > gap_seconds * 1_000_000, 1).otherwise(0)
    return rows.withColumn("_new", new).withColumn("session", F.sum("_new").over(own.rowsBetween(W.unboundedPreceding, 0))).drop("_new")
