"""Record building: keyed upserts, anti-join passes, quotas, fixed groups, coverage, sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.operators.dealing import dealt
from weftline.operators.sums import running_before, with_total


def enrich(base: DataFrame, key: str, *sources: DataFrame) -> DataFrame:
    """Left joins of sources that have one row per key already; Spark broadcasts the small ones."""
    for source in sources:
        base = base.join(source, key, "left")
    return base


def absent(new: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is not there yet, one per key."""
    return new.join(existing.select(*key).distinct(), key, "left_anti")


def quota(rows: DataFrame, by: str, order: list[str], n: int) -> DataFrame:
    return rows.withColumn("_rank", F.row_number().over(W.partitionBy(by).orderBy(*order))).filter(F.col("_rank") <= n).drop("_rank")


def consecutive_groups(rows: DataFrame, by: str, order: str, size: int) -> DataFrame:
    """Groups of `size` consecutive rows of each `by`."""
    return rows.withColumn("group_no", F.floor((F.row_number().over(W.partitionBy(by).orderBy(order)) - 1) / size))


def shares(rows: DataFrame, by: str) -> DataFrame:
    """Counts and shares of the total, from one row per value."""
    counts = rows.groupBy(by).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy()), 6))


def coverage(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Share of rows in which each column is neither null nor empty, as one row per column."""
    one = rows.agg(*(F.round(F.avg(F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), 1.0).otherwise(0.0)), 6).alias(c) for c in columns))
    return one.unpivot([], columns, "field", "covered")


def rank_value(rows: DataFrame, column: str, share: float) -> DataFrame:
    """The value at index floor(n * share) of the sorted column, with mean and maximum.

    Counts per value come first; the running sum goes over distinct values only.
    """
    counts = rows.groupBy(column).agg(F.count("*").alias("c"))
    upto = counts.withColumn("upto", F.sum("c").over(W.orderBy(column).rowsBetween(W.unboundedPreceding, 0))).withColumn("n", F.sum("c").over(W.partitionBy()))
    at = F.floor(F.col("n") * share)
    return upto.agg(F.max("n").alias("n"), F.round(F.sum(F.col(column) * F.col("c")) / F.max("n"), 6).alias("mean"), F.min(F.when(F.col("upto") > at, F.col(column))).alias("at_share"), F.max(column).alias("most"))


def running_split(groups: DataFrame, key: str, n: str, share: float) -> DataFrame:
    """Whole groups, in the order of a hash of their keys, go to the evaluation side until it has its share.

    The running sum is over one row per group, in two levels: by the first
    digits of the hash, then within them.
    """
    h = F.md5(F.col(key).cast("string"))
    sums = with_total(running_before(groups, n, [F.substring(h, 1, 3)], [h, F.col(key)]), n)
    return sums.withColumn("side", F.when(F.col("before") < F.col("total") * share, "eval").otherwise("train")).drop("before", "total")


def profile(rows: DataFrame, by: str, texts: list[str], measured: str, prefix: int = 120, parts: int = 1) -> DataFrame:
    """Rows (section, name, n, value): groups with their percentage, lengths of one text column, empty texts, and rows that repeat the prefixes of others.

    Nulls are empty texts of no letters.  One pass gives groups, lengths and
    empty fields as partial sums, a second one groups by hashes of the prefixes,
    dealt to `parts` partitions if those are more than a shuffle has.
    """
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in texts}
    size = F.length(text[measured])
    per = rows.groupBy(F.col(by).alias("name")).agg(F.count("*").alias("n"), F.min(size).alias("least"), F.max(size).alias("most"), F.sum(size.cast("long")).alias("sum"), *(F.count_if(F.trim(text[c]) == "").alias("empty_" + c) for c in texts))
    whole = per.agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), (F.sum("sum") / F.sum("n")).alias("mean"), *(F.sum("empty_" + c).alias("empty_" + c) for c in texts)).filter("n > 0")
    none = F.lit(None).cast("double")
    line = lambda section, name, n, value: F.struct(F.lit(section).alias("section"), F.lit(name).alias("name"), n.cast("long").alias("n"), value.cast("double").alias("value"))
    lengths = [line("length", c, F.col("n"), F.round(F.col(c), 4)) for c in ("least", "most", "mean")]
    empties = [line("empty", c, F.col("empty_" + c), none) for c in texts]
    shares_ = per.select(F.lit("layer").alias("section"), "name", "n", F.round(100 * F.col("n") / F.sum("n").over(W.partitionBy()), 4).alias("value"))
    hashed = rows.select(F.sha2(F.concat_ws("\x00", *(F.substring(x, 1, prefix) for x in text.values())), 256).alias("h"))
    hashes = dealt(hashed, parts, "h").groupBy("h").agg(F.count("*").alias("c"))
    repeated = hashes.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("n")).select(F.lit("repeated").alias("section"), F.lit("prefix").alias("name"), "n", none.alias("value"))
    return shares_.unionByName(whole.select(F.inline(F.array(*lengths, *empties)))).unionByName(repeated)
