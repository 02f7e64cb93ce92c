"""Queries that join, look up and filter linked records. Registered by `catalogue`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.functions import fields as fd
from weftline.operators import graph as g
from weftline.operators import pairs as p
from weftline.operators.dealing import dealt
from weftline.operators import records as rec
from weftline.operators import temporal as t


def used_parts(q) -> DataFrame:
    return q("lineitem").select("l_suppkey", "l_partkey").distinct()


def listed(column: str, most: int | None = None):
    """Distinct values of a group as text, sorted, at most so many."""
    values = F.array_sort(F.collect_set(column))
    return F.array_join(F.slice(values, 1, most) if most else values, ",")


# --- heterogeneous bundles and relationship objects


def bundle_mitigations(q) -> DataFrame:
    """A bundle of objects of several types: techniques with the names of what mitigates them, by relationship objects."""
    kind = F.when(F.col("event_id") % 3 == 0, "technique").when(F.col("event_id") % 3 == 1, "mitigation").otherwise("relationship")
    e = q("events")
    one = F.struct(kind.alias("type"), F.concat(F.lit("x--"), F.col("event_id").cast("string")).alias("id"), F.col("event_type").alias("name"), F.when(kind == "relationship", F.concat(F.lit("x--"), (F.col("event_id") - 1).cast("string"))).alias("source_ref"), F.when(kind == "relationship", F.concat(F.lit("x--"), (F.col("event_id") - 2).cast("string"))).alias("target_ref"), (F.col("value") > 90).alias("revoked"))
    bundles = e.groupBy("user_id").agg(F.to_json(F.struct(F.collect_list(one).alias("objects"))).alias("raw"))
    schema = "objects array<struct<type:string,id:string,name:string,source_ref:string,target_ref:string,revoked:boolean>>"
    objects = bundles.select(F.explode(F.from_json("raw", schema)["objects"]).alias("o")).select("o.*").filter(~F.coalesce("revoked", F.lit(False)))
    of = lambda name: objects.filter(F.col("type") == name)
    named = of("relationship").select("source_ref", "target_ref").join(of("mitigation").select(F.col("id").alias("source_ref"), F.col("name").alias("by")), "source_ref").groupBy(F.col("target_ref").alias("id")).agg(listed("by").alias("mitigations"))
    return of("technique").select("id", "name").join(named, "id", "left").select("id", "name", F.coalesce("mitigations", F.lit("")).alias("mitigations"))


def fallback_mapping(q) -> DataFrame:
    """Entities of each group by a published mapping, or else by the one derived through sizes."""
    part = q("part")
    published = part.filter("p_size % 2 = 0 and p_retailprice < 1000").groupBy("p_brand").agg(listed("p_partkey", 5).alias("published"))
    derived = part.groupBy("p_brand").agg(F.min("p_size").alias("p_size")).join(part.select("p_size", "p_partkey"), "p_size").groupBy("p_brand").agg(listed("p_partkey", 5).alias("derived"))
    return derived.join(published, "p_brand", "left").select("p_brand", F.coalesce("published", "derived").alias("parts"), F.when(F.col("published").isNotNull(), "published").otherwise("derived").alias("origin"))


def named_edges(q) -> DataFrame:
    """Edges between nations of a region, with the names of both ends where they are known."""
    n = q("nation")
    edges = n.select(F.col("n_nationkey").alias("src"), ((F.col("n_nationkey") * 7 + 3) % 30).alias("dst"))
    name = lambda end: n.select(F.col("n_nationkey").alias(end), F.col("n_name").alias(end + "_name"))
    return edges.join(name("src"), "src", "left").join(name("dst"), "dst", "left").select("src", "dst", "src_name", F.coalesce("dst_name", F.lit("unknown")).alias("dst_name"))


def id_sets_united(q) -> DataFrame:
    """Ids that a mapping adds are united with those a row has."""
    own = q("lineitem").filter("l_returnflag = 'R'").groupBy("l_suppkey").agg(F.collect_set("l_partkey").alias("own"))
    more = q("lineitem").filter("l_returnflag = 'A'").groupBy("l_suppkey").agg(F.collect_set("l_partkey").alias("more"))
    both = F.array_union(F.coalesce("own", F.array().cast("array<bigint>")), F.coalesce("more", F.array().cast("array<bigint>")))
    return q("supplier").select(F.col("s_suppkey").alias("l_suppkey")).join(own, "l_suppkey", "left").join(more, "l_suppkey", "left").select("l_suppkey", F.size(both).alias("n"), F.array_max(both).alias("last"))


# --- entities and what belongs to them


def entity_profile(q) -> DataFrame:
    """Every entity with its distinct groups, categories and first software; also those that have none."""
    used = q("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.countDistinct("l_suppkey").alias("n_suppliers"), listed("l_returnflag").alias("flags"))
    return q("part").join(used, "p_partkey", "left").select("p_partkey", "p_brand", F.coalesce("n_suppliers", F.lit(0)).alias("n_suppliers"), F.coalesce("flags", F.lit("")).alias("flags"))


def software_of_entity(q) -> DataFrame:
    return used_parts(q).filter("l_partkey = 7").select("l_suppkey").orderBy("l_suppkey").limit(15)


def sampled_subgraph(q) -> DataFrame:
    """The first 30 entities with the edges among their suppliers, if any."""
    first = q("part").orderBy("p_partkey").limit(30).select("p_partkey")
    edges = q("lineitem").filter("l_quantity > 45").join(first.withColumnRenamed("p_partkey", "l_partkey"), "l_partkey", "left_semi").select("l_partkey", "l_suppkey").distinct()
    return first.join(edges, F.col("p_partkey") == F.col("l_partkey"), "left").select("p_partkey", "l_suppkey")


def edge_dump(q) -> DataFrame:
    """All edges of both kinds, best first, 20,000 at most."""
    lines = q("lineitem").select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b"), F.round("l_discount", 2).alias("score"), F.lit("supplies").alias("rel"))
    orders = q("orders").select(F.col("o_custkey").alias("a"), F.col("o_orderkey").alias("b"), F.round(F.col("o_totalprice") / 1e6, 2).alias("score"), F.lit("ordered").alias("rel"))
    return lines.groupBy("a", "b", "rel").agg(F.max("score").alias("score")).unionByName(orders).orderBy(F.desc("score"), "rel", "a", "b").limit(20_000)


def exploit_chain(q) -> DataFrame:
    """Directed steps from one entity's events, strongest first."""
    e = q("events")
    own = W.partitionBy("user_id").orderBy("ts", "event_id")
    steps = e.select("user_id", F.col("event_id").alias("src"), F.lead("event_id").over(own).alias("dst"), F.round("value", 4).alias("score"))
    return steps.filter("dst is not null").filter("user_id = 8").orderBy(F.desc("score"), "src").limit(20)


def either_endpoint(q) -> DataFrame:
    """Pairs that touch a node at either end, by two equality filters instead of one with an or."""
    pairs = q("lineitem").select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b"), "l_discount")
    hits = pairs.filter("a = 7").select(F.col("b").alias("peer"), F.lit("target").alias("end"), "l_discount").unionByName(pairs.filter("b = 7").select(F.col("a").alias("peer"), F.lit("source").alias("end"), "l_discount"))
    return hits.groupBy("peer", "end").agg(F.round(F.max("l_discount"), 2).alias("likelihood"))


def nested_pairs_per_id(q) -> DataFrame:
    """For every part the pairs that hold it, gathered over orders of any size: their number, the last partner, and the orders.

    Orders are joined with themselves, so no order is held in one row, and pairs are summed before they are dealt by part.
    """
    own = dealt(q("lineitem").select("l_orderkey", F.col("l_partkey").alias("id")), p.pair_partitions(q("lineitem")), "l_orderkey").distinct()
    pairs = own.join(own.withColumnRenamed("id", "other"), "l_orderkey").filter("id <> other")
    per = pairs.groupBy("id", "l_orderkey").agg(F.count("*").alias("n"), F.max(F.greatest("id", "other")).alias("b"))
    return per.groupBy("id").agg(F.sum("n").cast("int").alias("n_pairs"), F.max("b").alias("last_b"), F.count("*").alias("n_orders"))


def kb_sample(q) -> DataFrame:
    """At most 25 parts of each brand that the knowledge base has, drawn by hash."""
    kb = q("part").select("p_brand").distinct().filter("p_brand like 'Brand#1%'")
    own = q("part").join(kb, "p_brand", "left_semi").select("p_brand", "p_partkey", F.md5(F.col("p_partkey").cast("string")).alias("h"))
    return rec.quota(own, "p_brand", ["h", "p_partkey"], 25).select("p_brand", "p_partkey")


def tied_sets(q) -> DataFrame:
    """Customers whose chain of order priorities overlaps with the tied priorities of their segment's rule."""
    chain = q("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_set("o_orderpriority").alias("chain"))
    ties = F.when(F.col("c_mktsegment") == "MACHINERY", F.array(F.lit("1-URGENT"), F.lit("2-HIGH"))).otherwise(F.array(F.lit("5-LOW")))
    return q("customer").join(chain, "c_custkey").filter(F.arrays_overlap("chain", ties)).select("c_custkey", F.array_join(F.array_sort(F.array_intersect("chain", ties)), ",").alias("tied"))


def profiles_containing(q) -> DataFrame:
    """Which orders, as profiles with positions, hold a given part."""
    lines = q("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_partkey")).alias("members"))
    return lines.select("l_orderkey", F.size("members").alias("n"), F.posexplode("members").alias("position", "member")).filter("member = 7").select("l_orderkey", "position", "n")


def flagged_within(q) -> DataFrame:
    """The three dearest flagged parts of each brand; flagged means returned in a large quantity."""
    flagged = q("lineitem").filter("l_returnflag = 'R' and l_quantity >= 40").select(F.col("l_partkey").alias("p_partkey"))
    own = q("part").join(flagged, "p_partkey", "left_semi")
    return own.withColumn("rank", F.row_number().over(W.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey"))).filter("rank <= 3").select("p_brand", "rank", "p_partkey")


def uncovered_groups(q) -> DataFrame:
    """Groups of three or more with two or more members in no profile, whose name no indicator contains."""
    covered = q("lineitem").filter("l_quantity = 50").select(F.col("l_partkey").alias("p_partkey")).distinct().withColumn("covered", F.lit(1))
    indicators = F.array(F.lit("brand#1"), F.lit("#20"))
    groups = q("part").join(covered, "p_partkey", "left").groupBy("p_brand").agg(F.count("*").alias("n"), F.count_if(F.col("covered").isNull()).alias("open"))
    return groups.filter((F.col("n") >= 3) & (F.col("open") >= 2) & ~F.exists(indicators, lambda i: F.lower("p_brand").contains(i)))


def top_relations(q) -> DataFrame:
    """At most four relations of each entity with a score of .6 or more."""
    scored = q("lineitem").groupBy("l_suppkey", "l_partkey").agg(F.round(F.max("l_discount") * 10, 2).alias("score")).filter("score >= 0.6")
    return scored.withColumn("rank", F.row_number().over(W.partitionBy("l_suppkey").orderBy(F.desc("score"), "l_partkey"))).filter("rank <= 4").select("l_suppkey", "l_partkey", "score", "rank")


def meaningful_rules(q) -> DataFrame:
    """Pairs of brand and type with a probability of .15 or more, and support of three or none known."""
    n = q("part").groupBy("p_brand", "p_type").agg(F.count("*").alias("support"))
    shares = n.withColumn("probability", F.round(F.col("support") / F.sum("support").over(W.partitionBy("p_brand")), 6)).withColumn("known", F.when(F.col("support") % 7 > 0, F.col("support")))
    return shares.filter((F.col("probability") >= 0.15) & (F.col("known").isNull() | (F.col("known") >= 3))).select("p_brand", "p_type", "probability")


def layer_rows(q) -> DataFrame:
    """Rows of the wanted layers, and what share of all each layer has."""
    wanted = q("orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return wanted.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.round(F.avg((F.col("o_orderstatus") == "F").cast("int")), 6).alias("flag_share"))


# --- merges, weeks, profiles, rules


def merged_evidence(q) -> DataFrame:
    """Evidence of a pair merged by noisy-or onto its most certain row, with the number of sources in the reason."""
    lines = q("lineitem")
    rows = lines.select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b"), F.round(F.lit(0.3) + F.col("l_discount") * 4, 2).alias("confidence"), F.col("l_returnflag").alias("source"), F.concat(F.lit("line "), F.col("l_orderkey").cast("string"), F.lit("."), F.col("l_linenumber").cast("string")).alias("reason"))
    merged = F.round(F.least(F.lit(1.0) - F.product(F.lit(1.0) - F.col("confidence")), F.lit(0.99)), 3)
    best = F.max_by(F.struct("confidence", "reason"), F.struct("confidence", "reason"))
    out = rows.groupBy("a", "b").agg(F.count("*").alias("n_rows"), listed("source").alias("sources"), F.countDistinct("source").alias("n_sources"), merged.alias("merged"), best.alias("base"))
    many = F.col("n_rows") > 1
    return out.select("a", "b", F.when(many, F.col("merged")).otherwise(F.col("base.confidence")).alias("confidence"), "sources", F.when(many, F.concat(F.col("base.reason"), F.lit(" [+"), (F.col("n_sources") - 1).cast("string"), F.lit(" sources]"))).otherwise(F.col("base.reason")).alias("reason"))


def week_members(q) -> DataFrame:
    """Users of each ISO week, as sorted lists; weeks of two or more."""
    weeks = q("events").filter("event_type = 'purchase'").select(t.iso_week("ts").alias("week"), "user_id").distinct()
    return weeks.groupBy("week").agg(F.count("*").alias("n"), listed("user_id").alias("members")).filter("n >= 2")


def relabelled(q) -> DataFrame:
    """Sources under their public names; of equal pairs the first name stays."""
    names = F.create_map(*(F.lit(x) for x in ("A", "chain", "N", "campaign", "R", "chain")))
    rows = q("lineitem").select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b"), F.coalesce(F.element_at(names, F.col("l_returnflag")), F.lit("other")).alias("source"))
    return p.first_writer(rows.distinct(), ["a", "b"], ["source"])


def negative_rules(q) -> DataFrame:
    """Rules as rows: what is absent under a rule's key, and what must be assessed still; rules with an empty list keep a row."""
    rules = q("region").select("r_name", F.col("r_regionkey").alias("rule"), F.when(F.col("r_regionkey") % 2 == 0, F.array(F.col("r_regionkey"), F.col("r_regionkey") + 10)).otherwise(F.array().cast("array<int>")).alias("absent"))
    return rules.select("rule", "r_name", F.explode_outer("absent").alias("absent_key"))


def profile_confidence(q) -> DataFrame:
    """Members of each profile with their best confidence and roles."""
    lines = q("lineitem").select(F.col("l_suppkey").alias("profile"), F.explode(F.array(F.struct(F.col("l_partkey").alias("member"), F.col("l_discount").alias("confidence"), F.lit("chain").alias("role")), F.struct(F.col("l_orderkey").alias("member"), (F.col("l_discount") / 2).alias("confidence"), F.lit("tie").alias("role")))).alias("m"))
    return lines.groupBy("profile", "m.member").agg(F.round(F.max("m.confidence"), 4).alias("confidence"), listed("m.role").alias("roles"))


def new_sources(q) -> DataFrame:
    """Further sources are added where their address is new."""
    known = q("pages").filter("page_id % 2 = 0").select("url", F.lit(0).alias("prio"), F.col("page_id").alias("id"))
    found = q("pages").filter("page_id % 3 = 0").select("url", F.lit(1).alias("prio"), F.col("page_id").alias("id"))
    return p.first_writer(known.unionByName(found), ["url"], ["prio", "id"]).select("url", "prio", "id")


def top_before_explode(q) -> DataFrame:
    """The links of the twenty dearest orders only: the cut comes before the lists are opened."""
    top = q("orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey")
    return q("lineitem").join(F.broadcast(top), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select("l_orderkey", "l_linenumber", "l_partkey").distinct()


def numeric_map(q) -> DataFrame:
    """A stored map of keys and values: keys in capitals, values that are no numbers left out, the last one kept."""
    rows = q("events").select(F.upper("event_type").alias("key"), F.when(F.col("event_id") % 5 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).try_cast("double").alias("number"), "event_id").filter("number is not null")
    return p.last_writer(rows, ["key"], ["event_id"]).select("key", F.round("number", 4).alias("number"))


def node_first_top(q) -> DataFrame:
    """Suppliers of a part's suppliers' parts: two hops from one node, each hop reached by a semi-join with the hop before."""
    return g.hops_from(q("lineitem").select(F.col("l_suppkey").alias("left"), F.col("l_partkey").alias("right")), 7).select("target", "n_paths").orderBy(F.desc("n_paths"), "target").limit(50)


QUERIES = [bundle_mitigations, fallback_mapping, named_edges, id_sets_united, entity_profile, software_of_entity, sampled_subgraph, edge_dump, exploit_chain, either_endpoint, nested_pairs_per_id, kb_sample, tied_sets, profiles_containing, flagged_within, uncovered_groups, top_relations, meaningful_rules, layer_rows, merged_evidence, week_members, relabelled, negative_rules, profile_confidence, new_sources, top_before_explode, numeric_map, node_first_top]

LIST = "array_to_string(list_sort(list(DISTINCT {})), ',')"
ORACLES = {
    "bundle_mitigations": f"""WITH o AS (SELECT *, event_id % 3 AS k FROM events WHERE NOT coalesce(value > 90, false))
SELECT 'x--' || t.event_id AS id, t.event_type AS name, coalesce({LIST.format('m.event_type')}, '') AS mitigations FROM o t LEFT JOIN o r ON r.k = 2 AND r.event_id - 2 = t.event_id LEFT JOIN o m ON m.k = 1 AND m.event_id = r.event_id - 1 WHERE t.k = 0 GROUP BY t.event_id, t.event_type""",
    "fallback_mapping": "WITH s AS (SELECT p_brand, min(p_size) AS p_size FROM part GROUP BY 1), d AS (SELECT s.p_brand, array_to_string(list_sort(list(DISTINCT p_partkey))[1:5], ',') AS derived FROM s JOIN part USING (p_size) GROUP BY 1), u AS (SELECT p_brand, array_to_string(list_sort(list(DISTINCT p_partkey))[1:5], ',') AS published FROM part WHERE p_size % 2 = 0 AND p_retailprice < 1000 GROUP BY 1) SELECT p_brand, coalesce(published, derived) AS parts, CASE WHEN published IS NULL THEN 'derived' ELSE 'published' END AS origin FROM d LEFT JOIN u USING (p_brand)",
    "named_edges": "SELECT e.src, e.dst, s.n_name AS src_name, coalesce(d.n_name, 'unknown') AS dst_name FROM (SELECT n_nationkey AS src, (n_nationkey * 7 + 3) % 30 AS dst FROM nation) e LEFT JOIN nation s ON s.n_nationkey = e.src LEFT JOIN nation d ON d.n_nationkey = e.dst",
    "id_sets_united": "SELECT s_suppkey AS l_suppkey, count(DISTINCT l_partkey)::int AS n, max(l_partkey) AS last FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey AND l_returnflag IN ('R', 'A') GROUP BY 1",
    "entity_profile": f"SELECT p_partkey, p_brand, count(DISTINCT l_suppkey) AS n_suppliers, coalesce({LIST.format('l_returnflag')}, '') AS flags FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1, 2",
    "software_of_entity": "SELECT DISTINCT l_suppkey FROM lineitem WHERE l_partkey = 7 ORDER BY 1 LIMIT 15",
    "sampled_subgraph": "SELECT DISTINCT p_partkey, l_suppkey FROM (SELECT p_partkey FROM part ORDER BY 1 LIMIT 30) LEFT JOIN lineitem ON l_partkey = p_partkey AND l_quantity > 45",
    "edge_dump": "WITH e AS (SELECT l_suppkey AS a, l_partkey AS b, 'supplies' AS rel, max(round(l_discount, 2)) AS score FROM lineitem GROUP BY 1, 2, 3 UNION ALL SELECT o_custkey, o_orderkey, 'ordered', round(o_totalprice / 1e6, 2) FROM orders) SELECT * FROM e ORDER BY score DESC, rel, a, b LIMIT 20000",
    "exploit_chain": "WITH s AS (SELECT user_id, event_id AS src, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dst, round(value, 4) AS score FROM events) SELECT * FROM s WHERE dst IS NOT NULL AND user_id = 8 ORDER BY score DESC, src LIMIT 20",
    "either_endpoint": """SELECT CASE WHEN e = 'target' THEN l_partkey ELSE l_suppkey END AS peer, e AS "end", round(max(l_discount), 2) AS likelihood FROM lineitem, (VALUES ('target'), ('source')) v(e) WHERE (e = 'target' AND l_suppkey = 7) OR (e = 'source' AND l_partkey = 7) GROUP BY 1, 2""",
    "nested_pairs_per_id": "WITH d AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem), k AS (SELECT l_orderkey FROM d GROUP BY 1 HAVING count(*) >= 2), m AS (SELECT * FROM d SEMI JOIN k USING (l_orderkey)), j AS (SELECT x.l_orderkey, x.l_partkey AS id, greatest(x.l_partkey, y.l_partkey) AS b FROM m x JOIN m y ON x.l_orderkey = y.l_orderkey AND x.l_partkey <> y.l_partkey) SELECT id, count(*)::int AS n_pairs, max(b) AS last_b, count(DISTINCT l_orderkey) AS n_orders FROM j GROUP BY 1",
    "kb_sample": "SELECT p_brand, p_partkey FROM part WHERE p_brand LIKE 'Brand#1%' QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY md5(p_partkey::varchar), p_partkey) <= 25",
    "tied_sets": f"SELECT c_custkey, {LIST.format('o_orderpriority')} AS tied FROM customer JOIN orders ON o_custkey = c_custkey WHERE list_contains(CASE WHEN c_mktsegment = 'MACHINERY' THEN ['1-URGENT', '2-HIGH'] ELSE ['5-LOW'] END, o_orderpriority) GROUP BY 1",
    "profiles_containing": "WITH d AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem), r AS (SELECT *, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) - 1)::int AS position, (count(*) OVER (PARTITION BY l_orderkey))::int AS n FROM d) SELECT l_orderkey, position, n FROM r WHERE l_partkey = 7",
    "flagged_within": "SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank, p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 40) QUALIFY rank <= 3",
    "uncovered_groups": "SELECT p_brand, count(*) AS n, count(*) FILTER (WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)) AS open FROM part WHERE NOT contains(lower(p_brand), 'brand#1') AND NOT contains(lower(p_brand), '#20') GROUP BY 1 HAVING count(*) >= 3 AND open >= 2",
    "top_relations": "WITH s AS (SELECT l_suppkey, l_partkey, round(max(l_discount) * 10, 2) AS score FROM lineitem GROUP BY 1, 2) SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY score DESC, l_partkey) AS rank FROM s WHERE score >= 0.6 QUALIFY rank <= 4",
    "meaningful_rules": "WITH n AS (SELECT p_brand, p_type, count(*) AS support FROM part GROUP BY 1, 2), s AS (SELECT *, round(support / sum(support) OVER (PARTITION BY p_brand), 6) AS probability FROM n) SELECT p_brand, p_type, probability FROM s WHERE probability >= 0.15 AND (support % 7 = 0 OR support >= 3)",
    "layer_rows": "SELECT o_orderpriority, count(*) AS n, round(avg((o_orderstatus = 'F')::int), 6) AS flag_share FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1",
    "merged_evidence": f"""WITH r AS (SELECT l_suppkey AS a, l_partkey AS b, round(0.3::double + l_discount * 4, 2) AS confidence, l_returnflag AS source, 'line ' || l_orderkey || '.' || l_linenumber AS reason FROM lineitem)
SELECT a, b, CASE WHEN count(*) > 1 THEN round(least(1 - product(1 - confidence), 0.99::double), 3) ELSE max(confidence) END AS confidence, {LIST.format('source')} AS sources,
max_by(reason, (confidence, reason)) || CASE WHEN count(*) > 1 THEN ' [+' || (count(DISTINCT source) - 1) || ' sources]' ELSE '' END AS reason FROM r GROUP BY 1, 2""",
    "week_members": "WITH u AS (SELECT DISTINCT isoyear(ts) || '-W' || lpad(week(ts)::varchar, 2, '0') AS week, user_id FROM events WHERE event_type = 'purchase') SELECT week, count(*) AS n, array_to_string(list_sort(list(user_id)), ',') AS members FROM u GROUP BY 1 HAVING count(*) >= 2",
    "relabelled": "SELECT l_suppkey AS a, l_partkey AS b, min(CASE l_returnflag WHEN 'A' THEN 'chain' WHEN 'N' THEN 'campaign' WHEN 'R' THEN 'chain' ELSE 'other' END) AS source FROM lineitem GROUP BY 1, 2",
    "negative_rules": "SELECT r_regionkey AS rule, r_name, unnest(CASE WHEN r_regionkey % 2 = 0 THEN [r_regionkey, r_regionkey + 10] ELSE [NULL] END) AS absent_key FROM region",
    "profile_confidence": f"WITH m AS (SELECT l_suppkey AS profile, l_partkey AS member, l_discount AS confidence, 'chain' AS role FROM lineitem UNION ALL SELECT l_suppkey, l_orderkey, l_discount / 2, 'tie' FROM lineitem) SELECT profile, member, round(max(confidence), 4) AS confidence, {LIST.format('role')} AS roles FROM m GROUP BY 1, 2",
    "new_sources": "WITH u AS (SELECT url, 0 AS prio, page_id AS id FROM pages WHERE page_id % 2 = 0 UNION ALL SELECT url, 1, page_id FROM pages WHERE page_id % 3 = 0) SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY url ORDER BY prio, id) = 1",
    "top_before_explode": "SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20)",
    "numeric_map": "SELECT upper(event_type) AS key, round(value, 4) AS number FROM events WHERE event_id % 5 <> 0 QUALIFY row_number() OVER (PARTITION BY key ORDER BY event_id DESC) = 1",
    "node_first_top": "WITH e AS (SELECT DISTINCT l_suppkey AS l, l_partkey AS r FROM lineitem), a AS (SELECT r FROM e WHERE l = 7) SELECT e.l AS target, count(*) AS n_paths FROM e SEMI JOIN a USING (r) WHERE e.l <> 7 GROUP BY 1 ORDER BY n_paths DESC, target LIMIT 50",
}
