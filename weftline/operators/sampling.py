"""Draws with replacement until a number of bytes is reached, a share of them from a pool of priority.

Draws are numbered.  What a draw takes hangs on its number alone, by hash, so
all draws are made at once, and cut where the sum of their bytes reaches the
target; the running sum goes over ranges of draws.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.sums import rank_within, running_before
from weftline.sources.folders import stored

#: draws beyond the expected number, as a share and as a number
SPARE, LEAST = 1.1, 1000


def uniform(seed: str, *what: Column | str, digits: int = 8) -> Column:
    """A whole number of so many hexadecimal digits from a hash of the seed and some values: the same wherever it is made."""
    text = F.concat_ws("|", F.lit(seed), *((F.col(c) if isinstance(c, str) else c).cast("string") for c in what))
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def byte_target(rows: DataFrame, key: str, size: str, priority: Column, target: int, share: float = 0.85, seed: str = "draws") -> DataFrame:
    """draw (from 1), the key of its row, its size, and whether it came from the pool of priority.

    The draws' bytes reach the target with the last one, and not before.  If no
    row has priority, all have.  Rows without a size, or of no bytes, are left
    out; without any other there are no draws.  key must be a whole number.
    """
    spark = rows.sparkSession
    usable = stored(rows.select(F.col(key).cast("long").alias("key"), F.col(size).cast("long").alias("size"), priority.alias("first")).filter("size > 0"), "pool")
    totals = usable.agg(F.count("*").alias("n"), F.count_if("first").alias("n_first"), F.avg("size").alias("mean"), F.avg(F.when(F.col("first"), F.col("size"))).alias("mean_first")).first()
    if not totals["n"] or target <= 0:
        return spark.createDataFrame([], f"draw long, `{key}` long, size long, priority boolean")
    pools = usable.select("key", "size", F.explode(F.array(F.lit(False), F.lit(True))).alias("priority"), "first")
    if totals["n_first"]:
        pools = pools.filter(F.col("first") | ~F.col("priority"))
    placed = rank_within(pools.drop("first"), "priority", "key", ["size"], "place")
    counts = F.when(F.col("priority"), totals["n_first"] or totals["n"]).otherwise(totals["n"])
    mean = share * (totals["mean_first"] or totals["mean"]) + (1 - share) * totals["mean"]
    n = int(SPARE * target / mean) + LEAST
    while True:
        draws = spark.range(1, n + 1).withColumnRenamed("id", "draw").withColumn("priority", uniform(seed, "draw", F.lit("pool")) < int(share * 2**32))
        draws = draws.withColumn("place", uniform(seed, "draw", F.lit("row"), digits=12) % counts)
        made = stored(draws.join(placed, ["priority", "place"]), "draws")
        if made.agg(F.sum("size")).first()[0] >= target:
            break
        n *= 2
    summed = running_before(made, "size", [F.floor(F.col("draw") / 1024)], ["draw"])
    return summed.filter(F.col("before") < target).select("draw", F.col("key").alias(key), "size", "priority")
