"""Scores of answers against what was expected of them: recall, invention, rejection, stated chances, direction.

An answer's mentions meet the expected names by containment either way, as
names are said longer or shorter.  All are expressions over arrays of a row,
whose lengths have a bound (an answer's words, a probe's names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECALLS = (3, 5, 10)


def meets(a: Column, b: Column) -> Column:
    return F.contains(a, b) | F.contains(b, a)


def scored(answers: DataFrame) -> DataFrame:
    """Adds recall_3, recall_5, recall_10, invented and rejected to rows with expected, absent and mentioned (arrays, expected in order of likelihood).

    Nothing mentioned, or nothing expected, invents nothing; without absent
    names all of them count as rejected.
    """
    any_of = lambda names, one: F.exists(names, lambda n: meets(n, one))
    out = answers
    for k in RECALLS:
        head = F.slice("expected", 1, k)
        hits = F.size(F.filter(head, lambda e: any_of(F.col("mentioned"), e)))
        out = out.withColumn(f"recall_{k}", hits / F.greatest(F.size(head), F.lit(1)))
    new = F.filter("mentioned", lambda m: ~any_of(F.col("expected"), m))
    some = (F.size("mentioned") > 0) & (F.size("expected") > 0)
    out = out.withColumn("invented", F.when(some, F.size(new) / F.greatest(F.size("mentioned"), F.lit(1))).otherwise(0.0))
    refused = F.filter("absent", lambda a: ~F.exists("mentioned", lambda m: F.contains(m, a)))
    return out.withColumn("rejected", F.when(F.size("absent") > 0, F.size(refused) / F.greatest(F.size("absent"), F.lit(1))).otherwise(1.0))


def stated_chances(text: Column) -> Column:
    """name -> chance of every `name in NN%` of a text; a chance of 0 or 100 % tells nothing."""
    found = F.regexp_extract_all(text, F.lit(r"([A-Za-z][A-Za-z ]{1,40}) in ([0-9]{1,3})%"), F.lit(1))
    share = F.transform(F.regexp_extract_all(text, F.lit(r"([A-Za-z][A-Za-z ]{1,40}) in ([0-9]{1,3})%"), F.lit(2)), lambda x: x.cast("int") / 100)
    both = F.arrays_zip(found.alias("name"), share.alias("chance"))
    return F.filter(both, lambda x: (x["chance"] >= 0.01) & (x["chance"] <= 0.99))


METRICS = (*(f"recall_{k}" for k in RECALLS), "invented", "rejected")


def report(results: DataFrame, by: str) -> DataFrame:
    """Means of all metrics for each kind and overall, from one pass."""
    means = [F.round(F.avg(m), 6).alias(m) for m in METRICS]
    out = results.rollup(by).agg(F.count("*").alias("n"), F.grouping(by).alias("_all"), *means)
    return out.select(F.when(F.col("_all") == 1, "overall").otherwise(F.col(by)).alias(by), "n", *METRICS)


def against(own: DataFrame, baseline: DataFrame, by: str) -> DataFrame:
    """A report with the change of every metric against another run's report; nulls where that has no such kind."""
    other = baseline.select(by, *(F.col(m).alias("_" + m) for m in METRICS))
    return own.join(other, by, "left").select(by, "n", *METRICS, *(F.round(F.col(m) - F.col("_" + m), 6).alias("delta_" + m) for m in METRICS))
