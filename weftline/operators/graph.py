"""Property graph in tables: edges (a, b, rel, score), neighbourhoods, tiers, data quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def unit(x: Column) -> Column:
    """Scores as 0 to 1: nothing below 0, up to 1 as it is, above as x/(1+x)."""
    return F.when(x <= 0, 0.0).when(x <= 1, x).otherwise(x / (F.lit(1.0) + x))


def combined_edges(rows: DataFrame, score: str, label: str, order: list[str], union: bool = False) -> DataFrame:
    """One edge per unordered pair: the best score, and the first label or all of them."""
    pairs = rows.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), score, label, *[c for c in order if c not in (score, label)]).filter("a <> b")
    labels = F.array_join(F.array_sort(F.collect_set(label)), ",") if union else F.min_by(label, F.struct(*order))
    return pairs.groupBy("a", "b").agg(F.max(score).alias("score"), labels.alias("labels"))


def both_ways(edges: DataFrame) -> DataFrame:
    swapped = edges.select(F.col("b").alias("a"), F.col("a").alias("b"), *(c for c in edges.columns if c not in ("a", "b")))
    return edges.unionByName(swapped)


def neighbours(own: DataFrame, k: int) -> DataFrame:
    """The k best neighbours of a node, of its own edges (b, rel, score); the best edge of each neighbour."""
    best = own.groupBy("b").agg(F.max(F.struct("score", "rel")).alias("best"))
    return best.select("b", "best.score", "best.rel").orderBy(F.desc("score"), "b").limit(k)


def first_hop(own: DataFrame) -> DataFrame:
    """via and s1, the best unit score, of the edges (b, score) of an origin."""
    return own.groupBy(F.col("b").alias("via")).agg(F.max(unit(F.col("score"))).alias("s1"))


def two_hops(hop1: DataFrame, edges: DataFrame, origin, decay: float = 0.75) -> DataFrame:
    """Targets behind the origin's neighbours with their best path: score * score * decay.

    `hop1` comes from `first_hop`, `edges` (a, b, score) are those that leave
    its nodes: nothing else of the graph is needed.  Neither the origin nor its
    neighbours are targets.
    """
    paths = hop1.join(edges, F.col("via") == F.col("a")).filter(F.col("b") != origin).select("via", F.col("b").alias("target"), (F.col("s1") * unit(F.col("score")) * decay).alias("score"))
    fresh = paths.join(hop1.select(F.col("via").alias("target")), "target", "left_anti")
    best = F.row_number().over(W.partitionBy("target").orderBy(F.desc("score"), "via"))
    return fresh.withColumn("_rank", best).filter("_rank = 1").drop("_rank")


def hops_from(edges: DataFrame, node) -> DataFrame:
    """Nodes on the left that share nodes on the right with one left node, and how many they share."""
    edges = edges.distinct()
    near = edges.filter(F.col("left") == node).select("right")
    return edges.join(near, "right", "left_semi").filter(F.col("left") != node).groupBy(F.col("left").alias("target")).agg(F.count("*").alias("n_paths"))


def mixed_top(rows: DataFrame, key: str, reserved: str, quota: int, k: int) -> DataFrame:
    """k rows by score of which `quota` are kept for one relation, if it has so many."""
    rank = F.row_number().over(W.partitionBy("rel").orderBy(F.desc("score"), key))
    tier = F.when((F.col("rel") == reserved) & (F.col("_rank") <= quota), 0).otherwise(1)
    ranked = rows.withColumn("_rank", rank).withColumn("tier", tier)
    # a neighbour over several relations counts once: its reserved place first
    once = F.row_number().over(W.partitionBy(key).orderBy("tier", F.desc("score"), "rel"))
    return ranked.withColumn("_once", once).filter("_once = 1").orderBy("tier", F.desc("score"), key).limit(k).drop("_rank", "_once")


def tiers(direct: DataFrame, second: DataFrame, third: DataFrame, key: str, k: int, need2: int = 5, need3: int = 3) -> DataFrame:
    """Rows of the first tier; those of the second where it has few, of the third where both have few.

    Tiers hold at most k rows each; how many came before is a sum over rows,
    so nothing is decided on the driver.
    """
    parts = [t.orderBy(F.desc("likelihood"), key).limit(k).withColumn("tier", F.lit(i)) for i, t in enumerate((direct, second, third), 1)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    once = F.row_number().over(W.partitionBy(key).orderBy("tier"))
    rows = rows.withColumn("_once", once).filter("_once = 1").drop("_once")
    before = {i: F.sum(F.when(F.col("tier") < i, 1).otherwise(0)).over(W.partitionBy()) for i in (2, 3)}
    rows = rows.withColumn("_two", before[2])
    rows = rows.filter((F.col("tier") != 2) | (F.col("_two") < need2)).withColumn("_three", before[3])
    rows = rows.filter((F.col("tier") != 3) | (F.col("_three") < need3))
    return rows.drop("_two", "_three").orderBy("tier", F.desc("likelihood"), key).limit(k)


def quality_counts(edges: DataFrame) -> DataFrame:
    """Per relation: edges, self loops, pairs that come more than once."""
    pairs = edges.groupBy("rel", F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(F.count("*").alias("n"))
    return pairs.groupBy("rel").agg(F.sum("n").alias("edges"), F.sum(F.when(F.col("x") == F.col("y"), F.col("n")).otherwise(0)).alias("self_loops"), F.count_if(F.col("n") > 1).alias("repeated_pairs"))


def fuse(graph: DataFrame, vector: DataFrame, key: str) -> DataFrame:
    """Likelihood of candidates: .88 of a direct or .55 of an inferred graph score, and .35 of a vector score on top."""
    base = F.round(F.when(F.col("hop") == 1, F.col("graph_score") * 0.88).when(F.col("hop") == 2, F.col("graph_score") * 0.55).otherwise(0.0), 3)
    joined = graph.join(vector.groupBy(key).agg(F.sum("vector_score").alias("vector_score")), key, "full")
    likelihood = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(base, F.lit(0.0)) + F.coalesce(F.col("vector_score") * 0.35, F.lit(0.0))))
    return joined.select(key, F.round(likelihood, 6).alias("likelihood"), F.when(F.col("hop") == 1, "direct").otherwise("inferred").alias("evidence"))


def review(rows: DataFrame) -> DataFrame:
    """Whether a person must look at a result.

    Columns direct and inferred (numbers of results), overall and top3
    (likelihoods); `sources` (array of names) and `kind` where they are there:
    sources disagree if the graph and another one speak without direct
    evidence, and weak support counts for entities only.
    """
    none = F.lit(False)
    graph = F.array_contains("sources", "graph") & F.arrays_overlap("sources", F.array(F.lit("vector"), F.lit("raw_pairs"))) if "sources" in rows.columns else none
    entity = F.col("kind") == "entity" if "kind" in rows.columns else F.lit(True)
    found = {
        "inferred_dominates": F.col("inferred") > F.col("direct"),
        "low_confidence": F.col("overall") < 0.45,
        "sources_disagree": graph & (F.col("direct") == 0),
        "weak_support": entity & (F.col("direct") < 2) & (F.col("top3") < 0.55),
    }
    reasons = F.concat_ws(",", *(F.when(hit, name) for name, hit in found.items()))
    return rows.withColumn("reasons", reasons).withColumn("required", F.col("reasons") != "")
