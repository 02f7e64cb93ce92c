"""Sketches that are kept in a table and merged: distinct counts and quantiles of any span of days without a look at the rows.

Theta sketches count exactly up to their nominal number of entries (2^12 here)
and have a relative standard error of 1/sqrt(2^12) beyond, also for what two
spans have in common; HLL sketches are smaller, with .8/sqrt(2^12) and no
intersections; KLL sketches (k = 200) give quantiles with a rank error of 1.65 %.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.sources.folders import new_folder

LG = 12


def kept(rows: DataFrame, by: str, who: str, value: str) -> DataFrame:
    """A table with a row per `by` and its sketches; written once, merged ever after."""
    table = new_folder(rows.sparkSession, "sketches")
    out = rows.groupBy(by).agg(F.count("*").alias("n"), F.theta_sketch_agg(who, LG).alias("theta"), F.hll_sketch_agg(who, LG).alias("hll"), F.kll_sketch_agg_double(F.col(value).cast("double")).alias("kll"))
    out.write.parquet(table)
    return rows.sparkSession.read.parquet(table)


def kept_exactly(rows: DataFrame, by: str, who: str) -> DataFrame:
    """A table with a row per `by` and each that was there, with its number of rows: what counts any span of days without an error."""
    table = new_folder(rows.sparkSession, "counted")
    rows.groupBy(by, who).agg(F.count("*").alias("n")).write.parquet(table)
    return rows.sparkSession.read.parquet(table)


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches of coarser groups from those of finer ones: counts, distinct counts by both kinds, and sketches to go on with."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.theta_union_agg("theta", LG).alias("theta"), F.hll_union_agg("hll").alias("hll"), F.kll_merge_agg_double("kll").alias("kll"))


def estimates(sketches: DataFrame) -> DataFrame:
    """Distinct counts and the median that sketches tell."""
    drop = ("theta", "hll", "kll")
    return sketches.withColumns({"distinct": F.theta_sketch_estimate("theta"), "distinct_hll": F.hll_sketch_estimate("hll"), "median": F.kll_sketch_get_quantile_double("kll", F.lit(0.5))}).drop(*drop)
