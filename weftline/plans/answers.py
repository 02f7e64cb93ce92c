"""Queries that answer many questions at once from the graph of parts and from vectors. Registered by `catalogue`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators import retrieval as r
from weftline.operators import vectors as vec
from weftline.plans.catalogue_parts import edges_from
from weftline.plans.family import NOTATIONS
from weftline.plans.oracles import WHOLE_EDGES
from weftline.sources.folders import stored

#: answers of a question, places kept for parts that are alike
K, QUOTA = 12, 2
#: edges of a node that are ranked at most, by a first or a second step
LEADING = max(K, 3 * r.branch(K))


def questions(q) -> DataFrame:
    """One question for every tenth vector: on a part by its text, on a size by a given id, or on nothing that has an id."""
    place = F.floor(F.col("vec_id") / 10) % 4
    key = (F.col("vec_id") + 1).cast("string")
    size = (F.col("vec_id") / 10 % 50 + 1).cast("int").cast("string")
    text = F.when(place < 2, F.concat(F.lit("What goes with cve-2024-"), key, F.lit("?"))).when(place == 2, "And with this?").otherwise("What goes with it?")
    asked = q("embeddings").filter("vec_id % 10 = 0").select("vec_id", text.alias("text"), F.when(place == 2, " CWE").alias("kind"), F.when(place == 2, F.concat(F.lit("cwe-"), size)).alias("own"))
    found = r.entity_of(F.col("text"), F.col("kind"), F.col("own"), NOTATIONS["vulnerabilities"], NOTATIONS["weaknesses"])
    rows = asked.select(F.col("vec_id").alias("question"), "text", found.alias("e")).select("question", "text", "e.type", "e.id")
    number = F.regexp_extract("id", "([0-9]+)$", 1).try_cast("long")
    return rows.withColumn("node", F.when(F.col("type") == "cve", number)).withColumn("size", F.when(F.col("type") == "cwe", number))


def told_edges(q, nodes: DataFrame) -> DataFrame:
    """Edges of parts with what speaks for them."""
    own = F.array(F.concat("rel", F.lit(":"), F.col("a").cast("string")), F.concat(F.lit("part:"), F.col("b").cast("string")))
    return edges_from(q, nodes, leading=LEADING, cap=None).withColumn("signals", own).withColumn("reasons", F.when(F.col("score") > 0.5, F.array(F.lit("more than once"))).otherwise(F.array().cast("array<string>")))


def retrieved(q) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Questions, candidates of the graph, candidates of vectors; each in a table, as each is used more than once."""
    asked = stored(questions(q), "questions")
    on = asked.select("question", F.col("node").cast("long").alias("node"), F.col("id").alias("origin"))
    edges_of = lambda nodes: told_edges(q, nodes)
    nodes = on.filter("node is not null")
    one = r.of_nodes(nodes, r.mixed_neighbours(edges_of(nodes), "alike", QUOTA, K))
    # questions on one size share its members, so these are ranked once a size
    sizes = asked.filter("size is not null").select(F.col("id").alias("origin"), "size").distinct()
    members = q("part").join(sizes, F.col("p_size") == F.col("size")).select(F.col("origin").alias("question"), "origin", F.col("p_partkey").alias("member"), F.when(F.col("p_partkey") % 3 > 0, F.round(F.col("p_retailprice") / 10000, 6)).alias("own_score"))
    many = r.of_groups(members, edges_of(members.select(F.col("member").alias("node"))), "HAS_SIZE", K).withColumnRenamed("question", "id")
    many = asked.filter("size is not null").select("question", "id").join(many, "id").select(*one.columns)
    graph = stored(r.graph_candidates(on, one.unionByName(many), edges_of, K), "candidates")
    e = q("embeddings")
    near = vec.nearest(e, e.filter("vec_id % 10 = 0"), "vec_id", "embedding", K)
    several = F.sequence(F.col("vec_id") + 1, F.col("vec_id") + 1 + F.col("vec_id") % 3)
    rows = near.select(F.col("query").alias("question"), F.col("rank").alias("place"), F.greatest(F.lit(0.0), "cosine").alias("cosine"), F.size(several).alias("n"), F.when(F.col("vec_id") % 2 == 0, F.concat(F.lit("vector "), F.col("vec_id").cast("string"))).alias("snippet"), F.explode(several).alias("key"))
    vector = rows.select("question", "key", (F.col("cosine") / F.sqrt(F.least(F.col("n"), F.lit(10)))).alias("score"), "place", "snippet")
    return asked, graph, stored(vector, "hits")


def hybrid_evidence(q) -> DataFrame:
    """The dozen likeliest parts for each question, with tier, origin and citation."""
    _, graph, vector = retrieved(q)
    rows = r.fused(graph, vector, K)
    lists = [F.array_join(c, "|").alias(c) for c in ("signals", "reasons", "inferred_from")]
    return rows.select("question", "rank", "key", "likelihood", "tier", "rel", *lists, "source", "snippet", F.round("graph_score", 6).alias("graph_score"), F.round("vector_score", 6).alias("vector_score"), "citation_id")


def hybrid_answers(q) -> DataFrame:
    """An answer to each question: what it is on, its evidence, summary, and whether a person must look at it."""
    asked, graph, vector = retrieved(q)
    rows = r.answers(asked, r.fused(graph, vector, K), graph, vector)
    keys = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["key"].cast("string"), x["rel"])), "|")
    return rows.select("question", "status", "query", "entity.type", "entity.id", keys("direct_evidence").alias("direct"), keys("inferred_candidates").alias("inferred"), F.array_join(F.transform("citations", lambda c: c["citation_id"]), "|").alias("citations"), "confidence_summary.overall", "confidence_summary.rationale", "hitl.required", F.array_join("hitl.reasons", ",").alias("reasons"))


QUERIES = [hybrid_evidence, hybrid_answers]

_UNIT = "CASE WHEN {0} <= 0 THEN 0.0::double WHEN {0} <= 1 THEN {0} ELSE {0} / (1 + {0}) END"
_R3 = "round({} + 1e-9::double, 3)"
EVIDENCE = f"""asked AS (SELECT vec_id AS question, (vec_id // 10) % 4 AS form, vec_id + 1 AS part_, (vec_id // 10) % 50 + 1 AS size_ FROM embeddings WHERE vec_id % 10 = 0),
qs AS (SELECT question, CASE WHEN form < 2 THEN 'What goes with cve-2024-' || part_ || '?' WHEN form = 2 THEN 'And with this?' ELSE 'What goes with it?' END AS query, CASE WHEN form < 2 THEN 'cve' WHEN form = 2 THEN 'cwe' ELSE 'unknown' END AS type, CASE WHEN form < 2 THEN 'CVE-2024-' || part_ WHEN form = 2 THEN 'CWE-' || size_ ELSE '' END AS id, CASE WHEN form < 2 THEN part_ END AS node, CASE WHEN form = 2 THEN size_ END AS size FROM asked),
{WHOLE_EDGES},
told AS (SELECT *, [rel || ':' || a, 'part:' || b] AS signals, CASE WHEN score > 0.5 THEN ['more than once'] ELSE []::varchar[] END AS reasons FROM both_ways),
places AS (SELECT *, row_number() OVER (PARTITION BY a, rel ORDER BY score DESC, b) AS place FROM told WHERE a IN (SELECT node FROM qs) QUALIFY place <= {K}),
steps AS (SELECT *, CASE WHEN rel = 'alike' AND place <= {QUOTA} THEN 0 WHEN rel <> 'alike' AND place <= {K} - least({QUOTA}, count(*) FILTER (WHERE rel = 'alike') OVER (PARTITION BY a)) THEN 1 ELSE 2 END AS step FROM places),
mixed AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY step, score DESC, b) AS rank FROM (SELECT * FROM steps QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY step, score DESC, rel) = 1) QUALIFY rank <= {K}),
of_size AS (SELECT question, coalesce(b, p_partkey) AS key, CASE WHEN b IS NULL THEN coalesce(CASE WHEN p_partkey % 3 > 0 THEN round(p_retailprice / 10000, 6) END, 0.2::double) ELSE score END AS score, coalesce(rel, 'HAS_SIZE') AS rel, CASE WHEN b IS NULL THEN ['shared:' || id] ELSE signals END AS signals, coalesce(reasons, []::varchar[]) AS reasons, p_partkey
FROM qs JOIN part ON p_size = size LEFT JOIN told ON a = p_partkey),
first_ AS (SELECT question, b AS key, score, rel, signals, reasons, rank FROM qs JOIN mixed ON a = node UNION ALL SELECT * EXCLUDE (p_partkey), row_number() OVER (PARTITION BY question ORDER BY score DESC, key, rel, p_partkey) AS rank FROM of_size QUALIFY rank <= {K}),
seeds AS (SELECT question, key AS via, max({_UNIT.format('score')}) AS s1 FROM first_ WHERE rank <= {min(max(3, K // 2), 8)} GROUP BY 1, 2),
beyond AS (SELECT * FROM told WHERE a IN (SELECT via FROM seeds) QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b, rel) <= {max(K, 3 * min(max(3, K // 2), 8))}),
paths AS (SELECT question, id, via, b AS key, least(1.0::double, s1 * ({_UNIT.format('score')}) * 0.75::double) AS score, rel, signals, reasons FROM seeds JOIN beyond ON a = via JOIN qs USING (question) WHERE (node IS NULL OR b <> node) AND NOT EXISTS (SELECT 1 FROM first_ f WHERE f.question = seeds.question AND f.key = b)),
second_ AS (SELECT * FROM (SELECT * FROM paths QUALIFY row_number() OVER (PARTITION BY question, key ORDER BY score DESC, via, rel) = 1) QUALIFY row_number() OVER (PARTITION BY question ORDER BY score DESC, key) <= {K}),
graph AS (SELECT question, key, score, rel, signals, reasons, 1 AS hop, NULL::bigint AS via, NULL AS path FROM first_
UNION ALL SELECT question, key, score, 'HOP2_' || rel, list_concat(signals, ['via:' || via, 'origin:' || id]), list_concat(reasons, ['second step from ' || via]), 2, via, id || ' -> ' || via || ' -> ' || key FROM second_),
near AS (SELECT q.vec_id AS question, e.vec_id, round(list_cosine_similarity(e.embedding::double[], q.embedding::double[]), 6) AS cosine, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(e.embedding::double[], q.embedding::double[]), 6) DESC, e.vec_id) AS place FROM embeddings e JOIN embeddings q ON q.vec_id % 10 = 0 AND e.vec_id <> q.vec_id QUALIFY place <= {K}),
hits AS (SELECT question, place, unnest(range(vec_id + 1, vec_id + 2 + vec_id % 3)) AS key, greatest(0.0, cosine) / sqrt(vec_id % 3 + 1) AS v, CASE WHEN vec_id % 2 = 0 THEN 'vector ' || vec_id END AS snippet FROM near),
scored AS (SELECT *, {_UNIT.format('score')} AS graph_score, coalesce(path, array_to_string(signals[1:2], ', ')) AS snippet, {_R3.format(f"CASE hop WHEN 2 THEN 0.55::double ELSE 0.88::double END * ({_UNIT.format('score')})")} AS likelihood FROM graph),
best AS (SELECT question, key, max(likelihood) OVER w AS base, graph_score, min(hop) OVER w AS hop, rel, signals, reasons, snippet, via FROM scored WINDOW w AS (PARTITION BY question, key) QUALIFY row_number() OVER (PARTITION BY question, key ORDER BY graph_score DESC, hop, rel DESC, array_to_string(signals, ',') DESC) = 1),
vs AS (SELECT question, key, list(v ORDER BY place) AS vs, max(v) AS vector_score, arg_max(snippet, place) FILTER (WHERE snippet IS NOT NULL) AS said FROM hits GROUP BY 1, 2),
both_ AS (SELECT coalesce(b.question, v.question) AS question, coalesce(b.key, v.key) AS key, list_reduce(list_prepend(coalesce(base, 0.0::double), coalesce(vs, []::double[])), lambda a, x: {_R3.format('least(1.0::double, a + 0.35::double * x)')}) AS likelihood, CASE WHEN hop = 1 THEN 'direct' ELSE 'inferred' END AS tier, coalesce(rel, 'VECTOR_SIMILARITY') AS rel, coalesce(signals, [])[1:5] AS signals, coalesce(reasons, [])[1:3] AS reasons,
CASE WHEN hop = 1 THEN '' WHEN hop = 2 THEN 'via:' || via ELSE 'vector_similarity' END AS inferred_from, CASE WHEN hop = 1 THEN 'graph' WHEN hop = 2 THEN 'graph_hop2' ELSE 'vector' END AS source, coalesce(said, snippet, 'a near vector') AS snippet, coalesce(graph_score, 0.0) AS graph_score, coalesce(vector_score, 0.0) AS vector_score FROM best b FULL JOIN vs v ON b.question = v.question AND b.key = v.key),
evidence AS (SELECT *, row_number() OVER (PARTITION BY question ORDER BY likelihood DESC, key) AS rank, 'cit-' || substring(sha1(key || rel || source), 1, 12) AS citation_id FROM both_ QUALIFY rank <= {K})"""
ORACLES = {
    "hybrid_evidence": f"WITH {EVIDENCE} SELECT question, rank, key, likelihood, tier, rel, array_to_string(signals, '|') AS signals, array_to_string(reasons, '|') AS reasons, inferred_from, source, snippet, round(graph_score, 6) AS graph_score, round(vector_score, 6) AS vector_score, citation_id FROM evidence",
    "hybrid_answers": f"""WITH {EVIDENCE}, line AS (SELECT *, row_number() OVER (PARTITION BY question ORDER BY tier, rank) AS spot FROM evidence),
sums AS (SELECT question, coalesce(string_agg(key || ':' || rel, '|' ORDER BY rank) FILTER (WHERE tier = 'direct'), '') AS direct, coalesce(string_agg(key || ':' || rel, '|' ORDER BY rank) FILTER (WHERE tier <> 'direct'), '') AS inferred, string_agg(citation_id, '|' ORDER BY rank) AS citations, count(*) FILTER (WHERE tier = 'direct') AS nd, count(*) FILTER (WHERE tier <> 'direct') AS ni, {_R3.format('avg(likelihood) FILTER (WHERE spot <= 5)')} AS overall, max(likelihood) FILTER (WHERE spot <= 3) AS top3, bool_or(source = 'graph') AND bool_or(source = 'vector') AS mixed_ FROM line GROUP BY 1),
n AS (SELECT question, (SELECT count(*) FROM graph g WHERE g.question = qs.question) AS ng, (SELECT count(*) FROM hits h WHERE h.question = qs.question) AS nv FROM qs),
whole AS (SELECT qs.*, coalesce(direct, '') AS direct, coalesce(inferred, '') AS inferred, coalesce(citations, '') AS citations, coalesce(overall, 0.0) AS overall, ng, nv, concat_ws(',', CASE WHEN coalesce(ni, 0) > coalesce(nd, 0) THEN 'inferred_dominates' END, CASE WHEN coalesce(overall, 0) < 0.45 THEN 'low_confidence' END, CASE WHEN mixed_ AND nd = 0 THEN 'sources_disagree' END, CASE WHEN type = 'cve' AND coalesce(nd, 0) < 2 AND coalesce(top3, 0) < 0.55 THEN 'weak_support' END) AS reasons FROM qs JOIN n USING (question) LEFT JOIN sums USING (question))
SELECT question, 'ok' AS status, query, type, id, direct, inferred, citations, overall, CASE WHEN ng + nv = 0 THEN 'neither edges nor vectors speak of it' ELSE ng || ' candidates of the graph and ' || nv || ' of vectors, steps: 2' END AS rationale, reasons <> '' AS required, reasons FROM whole""",
}
