"""Answers to many questions at once: candidates from a graph and from vectors, fused, cited, summed up.

Questions are rows (question, node, origin): a node of the graph or none, and
what the question is on, by name.  Every step is a join by node or by question
and a rank within one; ranks have literal limits, so Spark cuts groups before
it exchanges them.  After the first step a question has at most k rows a step.

Edges are rows (a, b, rel, score, signals, reasons) and leave their a; a null
score counts as 0, an edge without an end is no edge.  An empty table of edges
or of hits gives questions without candidates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.operators.graph import review, unit
from weftline.sources.folders import stored

#: fixed values: weights of direct, inferred and vector scores, loss of a second step
DIRECT, INFERRED, VECTOR, DECAY = 0.88, 0.55, 0.35, 0.75
#: signals and reasons that a second step carries, and that an answer shows
SIGNALS2, REASONS2, SIGNALS, REASONS = 6, 4, 5, 3


def entity_of(text: Column, kind: Column, own: Column, vulnerability: str, weakness: str) -> Column:
    """Type and id of what a question is on: as given, or else the first vulnerability, or weakness, that its text names; unknown otherwise."""
    kind, own = F.lower(F.trim(kind)), F.upper(F.trim(own))
    cve, cwe = (F.upper(F.regexp_extract(text, x, 0)) for x in (vulnerability, weakness))
    given = F.coalesce(kind.isin("cve", "cwe") & (own != ""), F.lit(False))
    entity = lambda name, value: F.struct(name.alias("type"), value.alias("id"))
    return F.when(given, entity(kind, own)).when(cve != "", entity(F.lit("cve"), cve)).when(cwe != "", entity(F.lit("cwe"), cwe)).otherwise(entity(F.lit("unknown"), F.lit("")))


def rounded(x: Column) -> Column:
    """To three places; what is a half but for the error of a product goes up."""
    return F.round(x + 1e-9, 3)


def best(rows: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """The first k rows of each group, with their rank."""
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


def whole(edges: DataFrame) -> DataFrame:
    return edges.filter("a is not null and b is not null").withColumn("score", F.coalesce("score", F.lit(0.0)))


def mixed_neighbours(edges: DataFrame, reserved: str, quota: int, k: int) -> DataFrame:
    """The k first neighbours of each node: `quota` places for one relation, the others by score, then what is left of the first; a neighbour comes once."""
    rows = whole(edges).withColumn("_kept", F.coalesce(F.col("rel") == reserved, F.lit(False)))
    rows = best(rows, ["a", "_kept"], [F.desc("score"), "b", "rel"], k).withColumnRenamed("rank", "_place")
    held = F.least(F.sum(F.col("_kept").cast("int")).over(W.partitionBy("a")), F.lit(quota))
    step = F.when(F.col("_kept") & (F.col("_place") <= quota), 0).when(~F.col("_kept") & (F.col("_place") <= k - held), 1).otherwise(2)
    once = best(rows.withColumn("_step", step), ["a", "b"], ["_step", F.desc("score"), "rel"], 1).drop("rank")
    return best(once, ["a"], ["_step", F.desc("score"), "b"], k).drop("_kept", "_place", "_step")


def of_nodes(asked: DataFrame, neighbours: DataFrame) -> DataFrame:
    """First steps of questions on a node: (question, key, score, rel, signals, reasons, rank)."""
    return asked.join(neighbours, F.col("node") == F.col("a")).select("question", F.col("b").alias("key"), "score", "rel", "signals", "reasons", "rank")


def of_groups(members: DataFrame, edges: DataFrame, relation: str, k: int) -> DataFrame:
    """First steps of questions on a group: the k best edges of its members; a member without any stands for itself.

    `members` has (question, origin, member, own_score): the score that a member
    has by itself, .2 where it is null.
    """
    near = best(whole(edges), ["a"], [F.desc("score"), "b", "rel"], k).drop("rank")
    alone = F.col("b").isNull()
    rows = members.join(near, F.col("member") == F.col("a"), "left").select(
        "question",
        "member",
        F.coalesce("b", "member").alias("key"),
        F.when(alone, F.coalesce("own_score", F.lit(0.2))).otherwise(F.col("score")).alias("score"),
        F.coalesce("rel", F.lit(relation)).alias("rel"),
        F.when(alone, F.array(F.concat(F.lit("shared:"), "origin"))).otherwise(F.col("signals")).alias("signals"),
        F.coalesce("reasons", F.array().cast("array<string>")).alias("reasons"),
    )
    return best(rows, ["question"], [F.desc("score"), "key", "rel", "member"], k).drop("member")


def branch(k: int) -> int:
    """How many first steps of a question are followed."""
    return min(max(3, k // 2), 8)


def second_steps(asked: DataFrame, first: DataFrame, edges_of: Callable[[DataFrame], DataFrame], k: int) -> DataFrame:
    """What lies behind the first steps of each question: the best path to each target that is neither the question's node nor a first step.

    Only the leading first steps are followed, and of each only its leading
    edges; `edges_of` makes the edges that leave some nodes (column node).  A
    node that leads by several rows counts with its best score.
    """
    seeds = first.filter(F.col("rank") <= branch(k)).groupBy("question", F.col("key").alias("via")).agg(F.max(unit(F.col("score"))).alias("s1")).filter("s1 > 0")
    beyond = best(whole(edges_of(seeds.select(F.col("via").alias("node")).distinct())), ["a"], [F.desc("score"), "b", "rel"], max(k, 3 * branch(k))).drop("rank")
    paths = seeds.join(beyond, F.col("via") == F.col("a")).join(asked, "question").filter("coalesce(b <> node, true)")
    paths = paths.select("question", "origin", "via", F.col("b").alias("key"), F.least(F.lit(1.0), F.col("s1") * unit(F.col("score")) * DECAY).alias("score"), "rel", "signals", "reasons")
    fresh = paths.filter("score > 0").join(first.select("question", "key").distinct(), ["question", "key"], "left_anti")
    once = best(fresh, ["question", "key"], [F.desc("score"), "via", "rel"], 1).drop("rank")
    via, none = F.col("via").cast("string"), F.array().cast("array<string>")
    told = once.withColumn("signals", F.slice(F.array_distinct(F.concat(F.coalesce("signals", none), F.array(F.concat(F.lit("via:"), via), F.concat(F.lit("origin:"), "origin")))), 1, SIGNALS2))
    told = told.withColumn("reasons", F.slice(F.array_distinct(F.concat(F.coalesce("reasons", none), F.array(F.concat(F.lit("second step from "), via)))), 1, REASONS2))
    told = told.withColumn("rel", F.concat(F.lit("HOP2_"), F.coalesce("rel", F.lit("UNKNOWN")))).withColumn("path", F.concat_ws(" -> ", "origin", via, F.col("key").cast("string")))
    return best(told, ["question"], [F.desc("score"), "key"], k).drop("rank", "origin")


def graph_candidates(asked: DataFrame, first: DataFrame, edges_of: Callable[[DataFrame], DataFrame], k: int, hops: int = 2) -> DataFrame:
    """First and second steps of all questions: (question, key, score, rel, signals, reasons, hop, via, path)."""
    first = stored(first, "steps")
    one = first.drop("rank").withColumn("hop", F.lit(1))
    if hops < 2:
        return one.withColumn("via", F.lit(None).cast(one.schema["key"].dataType)).withColumn("path", F.lit(None).cast("string"))
    return one.unionByName(second_steps(asked, first, edges_of, k).withColumn("hop", F.lit(2)), allowMissingColumns=True)


def fused(graph: DataFrame, vector: DataFrame, k: int) -> DataFrame:
    """The k likeliest keys of each question, with evidence and citation.

    Rows of one key are merged: the strongest path speaks, the likelihood is the
    best of all, and one direct row makes the key direct.  Vector rows
    (question, key, score, place, snippet; a key once a hit) add to it hit by
    hit, rounded each time, up to 1; alone they are inferred.  Ties go to the
    smaller key, rows without a key are left out.
    """
    none = F.array().cast("array<string>")
    rows = graph.filter("key is not null").withColumn("graph_score", unit(F.coalesce("score", F.lit(0.0))))
    rows = rows.withColumn("likelihood", rounded(F.when(F.col("hop") >= 2, INFERRED).otherwise(DIRECT) * F.col("graph_score")))
    rows = rows.withColumn("snippet", F.coalesce(F.nullif("path", F.lit("")), F.nullif(F.array_join(F.slice("signals", 1, 2), ", "), F.lit("")), F.lit("edges of the graph")))
    strongest = F.max_by(F.struct("rel", "signals", "reasons", "snippet", "via"), F.struct("graph_score", -F.col("hop"), "rel", F.array_join("signals", ","), F.coalesce(F.col("via").cast("string"), F.lit(""))))
    merged = rows.groupBy("question", "key").agg(F.max("likelihood").alias("base"), F.max("graph_score").alias("graph_score"), F.min("hop").alias("hop"), strongest.alias("g"))
    hit = F.struct("place", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("score", F.lit(0.0)))).alias("v"), F.coalesce("snippet", F.lit("")).alias("snippet"))
    hits = vector.filter("key is not null").groupBy("question", "key").agg(F.array_sort(F.collect_list(hit)).alias("hits"))
    both = merged.join(hits, ["question", "key"], "full")
    raised = F.aggregate(F.coalesce("hits", F.array().cast(hits.schema["hits"].dataType)), F.coalesce("base", F.lit(0.0)), lambda a, h: rounded(F.least(F.lit(1.0), a + VECTOR * h["v"])))
    direct = F.coalesce(F.col("hop") == 1, F.lit(False))
    said = F.filter(F.transform("hits", lambda h: h["snippet"]), lambda s: s != "")
    out = both.select(
        "question",
        "key",
        raised.alias("likelihood"),
        F.when(direct, "direct").otherwise("inferred").alias("tier"),
        F.coalesce("g.rel", F.lit("VECTOR_SIMILARITY")).alias("rel"),
        F.slice(F.coalesce("g.signals", none), 1, SIGNALS).alias("signals"),
        F.slice(F.coalesce("g.reasons", none), 1, REASONS).alias("reasons"),
        F.when(direct, none).when(F.col("hop").isNull(), F.array(F.lit("vector_similarity"))).when(F.col("g.via").isNull(), F.array(F.lit("second step"))).otherwise(F.array(F.concat(F.lit("via:"), F.col("g.via").cast("string")))).alias("inferred_from"),
        F.when(direct, "graph").when(F.col("hop").isNull(), "vector").otherwise("graph_hop2").alias("source"),
        F.coalesce(F.when(F.size(said) > 0, F.element_at(said, -1)), "g.snippet", F.lit("a near vector")).alias("snippet"),
        F.coalesce("graph_score", F.lit(0.0)).alias("graph_score"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h["v"])), F.lit(0.0)).alias("vector_score"),
    )
    cited = F.concat(F.lit("cit-"), F.substring(F.sha1(F.concat(F.col("key").cast("string"), "rel", "source")), 1, 12))
    return best(out.withColumn("citation_id", cited), ["question"], [F.desc("likelihood"), "key"], k)


def answers(questions: DataFrame, evidence: DataFrame, graph: DataFrame, vector: DataFrame, hops: int = 2) -> DataFrame:
    """One row a question (question, text, type, id): entity, direct and inferred evidence, citations, summary, review and advice.

    The summary is the mean likelihood of the first five pieces of evidence,
    direct ones first.  A question without candidates gets empty lists and 0.
    """
    piece = F.struct((F.col("tier") != "direct").alias("late"), "rank", F.struct("key", "likelihood", "tier", "rel", "signals", "reasons", "inferred_from").alias("item"))
    citation = F.struct("rank", F.struct("citation_id", F.col("source").alias("source_type"), F.col("key").alias("entity_id"), "snippet", F.struct("graph_score", "vector_score", "tier").alias("metadata")).alias("item"))
    rows = evidence.groupBy("question").agg(F.array_sort(F.collect_list(piece)).alias("pieces"), F.array_sort(F.collect_list(citation)).alias("cited"))
    made = questions.join(rows, "question", "left")
    for name, found in (("n_graph", graph), ("n_vector", vector)):
        made = made.join(found.filter("key is not null").groupBy("question").agg(F.count("*").alias(name)), "question", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    made = made.withColumn("pieces", F.coalesce("pieces", F.array().cast(rows.schema["pieces"].dataType))).withColumn("cited", F.coalesce("cited", F.array().cast(rows.schema["cited"].dataType)))
    chances = F.transform("pieces", lambda x: x["item"]["likelihood"])
    mean = F.aggregate(F.slice(chances, 1, 5), F.lit(0.0), lambda a, x: a + x) / F.greatest(F.lit(1), F.least(F.lit(5), F.size("pieces")))
    judged = review(
        made.withColumn("direct", F.size(F.filter("pieces", lambda x: ~x["late"])))
        .withColumn("inferred", F.size("pieces") - F.col("direct"))
        .withColumn("overall", rounded(mean))
        .withColumn("top3", F.coalesce(F.array_max(F.slice(chances, 1, 3)), F.lit(0.0)))
        .withColumn("sources", F.array_distinct(F.transform("cited", lambda x: x["item"]["source_type"])))
        .withColumn("kind", F.when(F.col("type") == "cve", "entity").otherwise(F.col("type")))
    )
    nothing = (F.col("n_graph") == 0) & (F.col("n_vector") == 0)
    why = F.when(nothing, "neither edges nor vectors speak of it").otherwise(F.concat(F.col("n_graph").cast("string"), F.lit(" candidates of the graph and "), F.col("n_vector").cast("string"), F.lit(f" of vectors, steps: {hops}")))
    return judged.select(
        "question",
        F.lit("ok").alias("status"),
        F.col("text").alias("query"),
        F.struct("type", "id").alias("entity"),
        F.transform(F.filter("pieces", lambda x: ~x["late"]), lambda x: x["item"]).alias("direct_evidence"),
        F.transform(F.filter("pieces", lambda x: x["late"]), lambda x: x["item"]).alias("inferred_candidates"),
        F.transform("cited", lambda x: x["item"]).alias("citations"),
        F.struct("overall", why.alias("rationale")).alias("confidence_summary"),
        F.struct("required", F.filter(F.split("reasons", ","), lambda x: x != "").alias("reasons")).alias("hitl"),
        F.array(F.lit("Check direct evidence against what is in use."), F.lit("Test what is inferred before it is ranked.")).alias("recommended_actions"),
    )
