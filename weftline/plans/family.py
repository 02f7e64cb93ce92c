"""Lookups that return rows: siblings, a weakness and what belongs to it, paths between groups, ids in free text. Registered by `catalogue`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.functions import text as tx
from weftline.operators import pairs as p
from weftline.operators.retrieval import entity_of
from weftline.operators.sampling import uniform

# sizes stand for weaknesses, spans of five sizes for clusters of them, types for categories


def sibling_rows(q) -> DataFrame:
    """The ten dearest other parts of each part's brand and size.

    Only the eleven dearest of a group can be among anyone's ten, so a group
    joins its members with eleven rows.
    """
    part = q("part").select("p_brand", "p_size", "p_partkey", "p_retailprice")
    rank = F.row_number().over(W.partitionBy("p_brand", "p_size").orderBy(F.desc("p_retailprice"), "p_partkey"))
    first = part.withColumn("r", rank).filter("r <= 11").select("p_brand", "p_size", F.col("p_partkey").alias("sibling"), "r")
    own = first.select("p_brand", "p_size", F.col("sibling").alias("p_partkey"), F.col("r").alias("mine"))
    both = part.select("p_brand", "p_size", "p_partkey").join(first, ["p_brand", "p_size"]).join(own.drop("p_brand", "p_size"), "p_partkey", "left").filter("sibling <> p_partkey")
    # who stands before a row without counting oneself
    place = F.col("r") - F.when(F.col("mine") < F.col("r"), 1).otherwise(0)
    return both.withColumn("rank", place).filter("rank <= 10").select("p_partkey", "sibling", "rank")


ASKED = 7


def cluster_peers(q) -> DataFrame:
    """Parts of other sizes of the cluster that an asked part's size is in, the dearest 20, with the cluster and the size they share it by."""
    part = q("part")
    me = part.filter(F.col("p_partkey") == ASKED).select(F.floor(F.col("p_size") / 5).alias("cluster"), F.col("p_size").alias("shared_size"))
    peers = part.withColumn("cluster", F.floor(F.col("p_size") / 5)).join(F.broadcast(me), "cluster").filter((F.col("p_partkey") != ASKED) & (F.col("p_size") != F.col("shared_size")))
    return peers.select(F.col("p_partkey").alias("sibling"), "cluster", "shared_size", "p_retailprice").orderBy(F.desc("p_retailprice"), "sibling").limit(20)


def category_peers(q) -> DataFrame:
    """For every hundredth part the dozen dearest others of its type."""
    part = q("part")
    rank = F.row_number().over(W.partitionBy("p_type").orderBy(F.desc("p_retailprice"), "p_partkey"))
    first = part.withColumn("r", rank).filter("r <= 13").select("p_type", F.col("p_partkey").alias("peer"), "r")
    both = part.filter("p_partkey % 100 = 0").select("p_type", "p_partkey").join(first, "p_type").filter("peer <> p_partkey")
    return both.withColumn("rank", F.row_number().over(W.partitionBy("p_partkey").orderBy("r"))).filter("rank <= 12").select("p_partkey", "peer", "rank")


def weakness_first(q) -> DataFrame:
    """What is known of each asked weakness: its dearest 20 parts with their category where they have one, ten other sizes of its cluster; or why it was refused.

    An id may come without its prefix and in any case; anything else is an error row.
    """
    part = q("part")
    number = F.col("p_size").cast("string")
    form = F.when(F.col("p_size") % 4 == 0, F.concat(F.lit("Size-"), number)).when(F.col("p_size") % 4 == 1, F.concat(F.lit(" "), number)).when(F.col("p_size") % 4 == 2, F.concat(F.lit("SIZE-"), number, F.lit("x"))).otherwise("")
    asks = part.filter("p_size % 3 = 0").select(form.alias("asked"), "p_size").distinct()
    upper = F.upper(F.trim("asked"))
    full = F.when(upper.startswith("SIZE-"), upper).otherwise(F.concat(F.lit("SIZE-"), upper))
    asks = asks.withColumn("id", F.when(full.rlike(r"^SIZE-[0-9]+$"), full)).withColumn("size", F.regexp_extract("id", "([0-9]+)", 1).try_cast("int"))
    wrong = asks.filter("id is null").select("asked", F.lit("error").alias("kind"), F.lit(1).alias("rank"), F.concat(F.lit("not a size: "), F.trim("asked")).alias("found"), F.lit(None).cast("string").alias("category")).distinct()
    good = asks.filter("id is not null").select("asked", "size")
    dear = F.row_number().over(W.partitionBy("p_size").orderBy(F.desc("p_retailprice"), "p_partkey"))
    named = part.withColumn("rank", dear).filter("rank <= 20").join(good, F.col("p_size") == F.col("size"))
    parts = named.select("asked", F.lit("part").alias("kind"), "rank", F.col("p_partkey").cast("string").alias("found"), F.when(F.col("p_partkey") % 3 > 0, F.col("p_type")).alias("category"))
    sizes = part.select(F.col("p_size").alias("other")).distinct()
    near = good.join(sizes, F.floor(F.col("size") / 5) == F.floor(F.col("other") / 5)).filter("other <> size")
    near = near.withColumn("rank", F.row_number().over(W.partitionBy("asked").orderBy("other"))).filter("rank <= 10").select("asked", F.lit("sibling"), "rank", F.concat(F.lit("SIZE-"), F.col("other").cast("string")), F.lit(None).cast("string"))
    return parts.union(near).union(wrong)


def chain_by_paths(q) -> DataFrame:
    """Parts related by a path of one or two steps between their sizes: the cheapest part at the end of each path, in the same brand."""
    part = q("part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    steps = part.select(F.col("p_size").cast("string").alias("src")).distinct().withColumn("dst", ((F.col("src").cast("int") * 3 + 1) % 50 + 1).cast("string")).withColumn("confidence", F.round(0.5 + F.col("src").cast("int") % 5 / 10, 2)).filter("src <> dst")
    ends = part.groupBy("p_brand", F.col("p_size").cast("string").alias("dst")).agg(F.min(F.struct("p_retailprice", "p_partkey")).alias("m")).select("p_brand", "dst", F.col("m.p_partkey").alias("related"))
    joined = part.withColumn("src", F.col("p_size").cast("string")).join(p.path_closure(steps), "src").join(ends, ["p_brand", "dst"]).filter("related <> p_partkey")
    return p.first_writer(joined, ["p_partkey", "related"], ["hops", F.desc("confidence"), F.col("mid").asc_nulls_first()]).select(F.col("p_partkey").alias("trigger_key"), "related", "mid", "hops", "confidence")


# --- ids in free text

#: fixed values: the notations of ids
NOTATIONS = {
    "vulnerabilities": r"(?i)CVE-[0-9]{4}-[0-9]+",
    "weaknesses": r"(?i)CWE-[0-9]+",
    "categories": r"A[0-9]{2}:20[0-9]{2}",
    "scores": r"(?i)CVSS[v23\s:]+[0-9.]+",
    "techniques": r"T[0-9]{4}(?:\.[0-9]{3})?",
}
#: kinds whose letters' case does not tell them apart
UPPER = ("vulnerabilities", "weaknesses", "scores")


def advisory_text() -> Column:
    """The advisory made of an order: ids in several notations, in paragraphs parted by an empty line."""
    k = F.col("o_orderkey")
    year = F.year("o_orderdate").cast("string")
    first = F.concat(F.when(k % 2 == 0, "cve-").otherwise("CVE-"), year, F.lit("-"), F.lpad((k + 1000).cast("string"), 5, "0"))
    second = F.concat(F.lit("CVE-"), year, F.lit("-"), F.lpad((k % 700 + 1000).cast("string"), 4, "0"))
    return F.concat(first, F.lit(" and "), second, F.lit(" are fixed ("), F.when(k % 3 == 0, "Cwe-").otherwise("CWE-"), (F.col("o_custkey") % 900).cast("string"), F.lit(").\n\nSee T"), (k % 600 + 1000).cast("string"), F.when(k % 4 == 0, F.concat(F.lit(".00"), (k % 9).cast("string"))).otherwise(""), F.lit(", A0"), (k % 9 + 1).cast("string"), F.lit(":2021; CVSS v3: "), F.round(k % 100 / 10, 1).cast("string"), F.lit("; also "), F.lower(second), F.lit(", CVE-1999-0"), (k % 50).cast("string"))


def advisory_texts(q) -> DataFrame:
    """Advisories made of orders."""
    return q("orders").select(F.col("o_orderkey").alias("page"), advisory_text().alias("text"))


def ids_of_pages(q) -> DataFrame:
    """Distinct ids of each notation in each advisory."""
    text = F.col("text")
    found = {name: F.regexp_extract_all(F.upper(text) if name in UPPER else text, F.lit(x), F.lit(0)) for name, x in NOTATIONS.items()}
    return advisory_texts(q).select("page", *(F.array_join(F.array_sort(F.array_distinct(x)), "|").alias(name) for name, x in found.items()))


def asked_entities(q) -> DataFrame:
    """Type and id of what a question is on: as given, or else the first vulnerability, or weakness, that its text names; unknown otherwise."""
    t = advisory_texts(q)
    given = F.when(F.col("page") % 5 == 0, F.lit(" Cwe "))
    given_id = F.when(F.col("page") % 5 == 0, F.concat(F.lit("cwe-"), F.col("page").cast("string"))).when(F.col("page") % 5 == 1, F.lit("lost"))
    text = F.when(F.col("page") % 5 == 2, F.regexp_replace("text", "(?i)cve", "none")).when(F.col("page") % 5 == 3, F.lit("no id at all")).otherwise(F.col("text"))
    found = entity_of(text, given, given_id, NOTATIONS["vulnerabilities"], NOTATIONS["weaknesses"])
    return t.select("page", found.alias("x")).select("page", "x.*")


def blank_line_pairs(q) -> DataFrame:
    """Pairs of vulnerabilities that one paragraph names, with the number of pages; paragraphs end at an empty line."""
    parts = advisory_texts(q).select("page", F.posexplode(F.split("text", r"\n\n")).alias("pos", "part"))
    ids = parts.select("page", "pos", F.explode(tx.find_all(F.upper("part"), NOTATIONS["vulnerabilities"])).alias("a"))
    pairs = ids.join(ids.withColumnRenamed("a", "b"), ["page", "pos"]).filter("a < b")
    return pairs.groupBy("a", "b").agg(F.countDistinct("page").alias("n_pages"))


# --- rules and directions


def uneven_reverse_pairs(q) -> DataFrame:
    """Both directions of supplied pairs; the way back has its own factor between .75 and 1.15, drawn by hash, and lies between .1 and .95."""
    rows = q("lineitem").groupBy(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b")).agg(F.round(F.max("l_discount") * 10, 2).alias("confidence")).filter("confidence >= 0.5")
    factor = 0.75 + 0.4 * uniform("back", "a", "b") / F.lit(2.0**32)
    back = rows.select(F.col("b").alias("a"), F.col("a").alias("b"), F.round(F.greatest(F.lit(0.1), F.least(F.lit(0.95), F.col("confidence") * factor)), 3).alias("confidence"), F.lit("back").alias("way"))
    return rows.select("a", "b", "confidence", F.lit("forth").alias("way")).unionByName(back)


def negative_edges(q) -> DataFrame:
    """Edges of both kinds from rules: what is absent under a rule, and what must be assessed still; both lists may be empty."""
    n = q("nation")
    rules = n.select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, F.array("n_regionkey", F.col("n_regionkey") + 10)).otherwise(F.array().cast("array<int>")).alias("absent"), F.when(F.col("n_nationkey") % 3 == 0, F.array(F.col("n_nationkey") + 100)).alias("still"))
    edges = F.concat(F.transform("absent", lambda x: F.struct(F.lit("ABSENT").alias("rel"), x.alias("target"))), F.transform(F.coalesce("still", F.array().cast("array<int>")), lambda x: F.struct(F.lit("STILL_ASSESS").alias("rel"), x.alias("target"))))
    return rules.select(F.col("n_nationkey").alias("rule"), F.explode(edges).alias("e")).select("rule", "e.*")


def null_and_repeated_keys(q) -> DataFrame:
    """Rows without a key, and keys of several rows, per table; one pass over each, counts first."""
    e = q("events")
    tables = {"purchases": e.select(F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("k")), "users": e.select(F.col("user_id").alias("k")), "turns": q("conversations").select(F.col("conv_id").alias("k")), "parts": q("part").select(F.col("p_partkey").alias("k"))}
    out = None
    for name, rows in tables.items():
        one = rows.groupBy("k").agg(F.count("*").alias("c")).agg(F.lit(name).alias("name"), F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("c"))), F.lit(0)).alias("nulls"), F.count_if(F.col("k").isNotNull() & (F.col("c") > 1)).alias("repeated"))
        out = one if out is None else out.unionByName(one)
    return out


# --- records in three passes


def dataset_in_passes(q) -> DataFrame:
    """Records of three passes: parts with a text of 16 characters, with what is known of them; flagged parts that are not among these; advisories on neither.

    A part is flagged if it came back in a quantity of 40 or more.  Advisories
    are on parts that were ordered late; a short one (under 12 characters) is left out.
    """
    part, lines = q("part"), q("lineitem")
    text = F.concat_ws(" ", "p_name", "p_type")
    sold = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n_lines"), F.round(F.max("l_discount"), 2).alias("score"), F.max(((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 40)).cast("int")).alias("flag"), F.max("l_orderkey").alias("last_order"))
    known = part.join(sold, "p_partkey", "left")
    base = known.filter(F.length(text) >= 16).select("p_partkey", F.lit(1).alias("pass"), text.alias("description"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"), "score", F.coalesce("flag", F.lit(0)).alias("flag"))
    rest = known.join(base.select("p_partkey"), "p_partkey", "left_anti")
    flagged = rest.filter("flag = 1").select("p_partkey", F.lit(2), F.concat(F.lit("Flagged: "), "p_name"), "n_lines", "score", "flag")
    told = rest.filter("coalesce(flag, 0) = 0 and last_order % 2 = 0").filter(F.length(text) >= 12).select("p_partkey", F.lit(3), text, F.lit(0).cast("long"), F.lit(None).cast("double"), F.lit(0))
    return base.union(flagged).union(told)


QUERIES = [dataset_in_passes, sibling_rows, cluster_peers, category_peers, weakness_first, chain_by_paths, ids_of_pages, asked_entities, blank_line_pairs, uneven_reverse_pairs, negative_edges, null_and_repeated_keys]

ADVISORY = """t AS (SELECT o_orderkey AS page, CASE WHEN o_orderkey % 2 = 0 THEN 'cve-' ELSE 'CVE-' END || year(o_orderdate) || '-' || lpad((o_orderkey + 1000)::varchar, 5, '0') || ' and ' || s || ' are fixed (' || CASE WHEN o_orderkey % 3 = 0 THEN 'Cwe-' ELSE 'CWE-' END || o_custkey % 900 || ').' || chr(10) || chr(10) || 'See T' || (o_orderkey % 600 + 1000) || CASE WHEN o_orderkey % 4 = 0 THEN '.00' || o_orderkey % 9 ELSE '' END || ', A0' || (o_orderkey % 9 + 1) || ':2021; CVSS v3: ' || round((o_orderkey % 100) / 10, 1) || '; also ' || lower(s) || ', CVE-1999-0' || o_orderkey % 50 AS text
FROM (SELECT *, 'CVE-' || year(o_orderdate) || '-' || lpad((o_orderkey % 700 + 1000)::varchar, 4, '0') AS s FROM orders))"""
ORACLES = {
    "dataset_in_passes": """WITH s AS (SELECT l_partkey AS p_partkey, count(*) AS n_lines, round(max(l_discount), 2) AS score, max((l_returnflag = 'R' AND l_quantity >= 40)::int) AS flag, max(l_orderkey) AS last_order FROM lineitem GROUP BY 1),
k AS (SELECT *, p_name || ' ' || p_type AS t FROM part LEFT JOIN s USING (p_partkey))
SELECT p_partkey, CASE WHEN length(t) >= 16 THEN 1 WHEN flag = 1 THEN 2 ELSE 3 END AS pass, CASE WHEN length(t) < 16 AND flag = 1 THEN 'Flagged: ' || p_name ELSE t END AS description, CASE WHEN length(t) >= 16 THEN coalesce(n_lines, 0) WHEN flag = 1 THEN n_lines ELSE 0 END AS n_lines, CASE WHEN length(t) >= 16 OR flag = 1 THEN score END AS score, coalesce(flag, 0) AS flag
FROM k WHERE length(t) >= 16 OR flag = 1 OR (last_order % 2 = 0 AND length(t) >= 12)""",
    "sibling_rows": "SELECT x.p_partkey, y.p_partkey AS sibling, row_number() OVER (PARTITION BY x.p_partkey ORDER BY y.p_retailprice DESC, y.p_partkey) AS rank FROM part x JOIN part y ON x.p_brand = y.p_brand AND x.p_size = y.p_size AND x.p_partkey <> y.p_partkey QUALIFY rank <= 10",
    "cluster_peers": f"SELECT y.p_partkey AS sibling, x.p_size // 5 AS cluster, x.p_size AS shared_size, y.p_retailprice FROM part x JOIN part y ON x.p_partkey = {ASKED} AND y.p_partkey <> {ASKED} AND x.p_size // 5 = y.p_size // 5 AND x.p_size <> y.p_size ORDER BY y.p_retailprice DESC, 1 LIMIT 20",
    "category_peers": "SELECT x.p_partkey, y.p_partkey AS peer, row_number() OVER (PARTITION BY x.p_partkey ORDER BY y.p_retailprice DESC, y.p_partkey) AS rank FROM part x JOIN part y ON x.p_type = y.p_type AND x.p_partkey <> y.p_partkey WHERE x.p_partkey % 100 = 0 QUALIFY rank <= 12",
    "weakness_first": """WITH a AS (SELECT DISTINCT p_size, CASE p_size % 4 WHEN 0 THEN 'Size-' || p_size WHEN 1 THEN ' ' || p_size WHEN 2 THEN 'SIZE-' || p_size || 'x' ELSE '' END AS asked FROM part WHERE p_size % 3 = 0)
SELECT asked, 'part' AS kind, row_number() OVER (PARTITION BY asked ORDER BY p_retailprice DESC, p_partkey) AS rank, p_partkey::varchar AS found, CASE WHEN p_partkey % 3 > 0 THEN p_type END AS category FROM a JOIN part USING (p_size) WHERE p_size % 4 < 2 QUALIFY rank <= 20
UNION ALL SELECT asked, 'sibling', row_number() OVER (PARTITION BY asked ORDER BY b.p_size) AS rank, 'SIZE-' || b.p_size, NULL FROM a JOIN (SELECT DISTINCT p_size FROM part) b ON a.p_size // 5 = b.p_size // 5 AND a.p_size <> b.p_size WHERE a.p_size % 4 < 2 QUALIFY rank <= 10
UNION ALL SELECT DISTINCT asked, 'error', 1, 'not a size: ' || asked, NULL FROM a WHERE p_size % 4 >= 2""",
    "chain_by_paths": """WITH e AS (SELECT DISTINCT p_size AS src, (p_size * 3 + 1) % 50 + 1 AS dst, round(0.5::double + (p_size % 5) / 10::double, 2) AS confidence FROM part WHERE p_size <> (p_size * 3 + 1) % 50 + 1),
paths AS (SELECT src, NULL::int AS mid, dst, confidence, 1 AS hops FROM e UNION ALL SELECT a.src, a.dst, b.dst, round(a.confidence * b.confidence, 3), 2 FROM e a JOIN e b ON a.dst = b.src WHERE b.dst <> a.src),
ends AS (SELECT p_brand, p_size AS dst, p_partkey AS related FROM part QUALIFY row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_retailprice, p_partkey) = 1)
SELECT p_partkey AS trigger_key, related, mid::varchar AS mid, hops, confidence FROM part JOIN paths ON p_size = src JOIN ends USING (p_brand, dst) WHERE related <> p_partkey QUALIFY row_number() OVER (PARTITION BY p_partkey, related ORDER BY hops, confidence DESC, mid NULLS FIRST) = 1""",
    "ids_of_pages": f"WITH {ADVISORY} SELECT page, " + ", ".join(f"array_to_string(list_sort(list_distinct(regexp_extract_all({'upper(text)' if n in UPPER else 'text'}, '{x}'))), '|') AS {n}" for n, x in NOTATIONS.items()) + " FROM t",
    "asked_entities": f"""WITH {ADVISORY}, x AS (SELECT page, CASE page % 5 WHEN 2 THEN regexp_replace(text, '(?i)cve', 'none', 'g') WHEN 3 THEN 'no id at all' ELSE text END AS text FROM t),
y AS (SELECT page, upper(regexp_extract(text, '{NOTATIONS["vulnerabilities"]}')) AS v, upper(regexp_extract(text, '{NOTATIONS["weaknesses"]}')) AS w FROM x)
SELECT page, CASE WHEN page % 5 = 0 THEN 'cwe' WHEN v <> '' THEN 'cve' WHEN w <> '' THEN 'cwe' ELSE 'unknown' END AS type, CASE WHEN page % 5 = 0 THEN 'CWE-' || page WHEN v <> '' THEN v ELSE w END AS id FROM y""",
    "blank_line_pairs": f"""WITH {ADVISORY}, i AS (SELECT DISTINCT page, pos, unnest(regexp_extract_all(upper(part), '{NOTATIONS["vulnerabilities"]}')) AS id FROM (SELECT page, unnest(string_split(text, chr(10) || chr(10))) AS part, generate_subscripts(string_split(text, chr(10) || chr(10)), 1) AS pos FROM t))
SELECT x.id AS a, y.id AS b, count(DISTINCT x.page) AS n_pages FROM i x JOIN i y ON x.page = y.page AND x.pos = y.pos AND x.id < y.id GROUP BY 1, 2""",
    "uneven_reverse_pairs": "WITH r AS (SELECT l_suppkey AS a, l_partkey AS b, round(max(l_discount) * 10, 2) AS confidence FROM lineitem GROUP BY 1, 2 HAVING round(max(l_discount) * 10, 2) >= 0.5) SELECT a, b, confidence, 'forth' AS way FROM r UNION ALL SELECT b, a, round(greatest(0.1::double, least(0.95::double, confidence * (0.75::double + 0.4::double * ('0x' || md5('back|' || a || '|' || b)[1:8])::bigint / 4294967296::double))), 3), 'back' FROM r",
    "negative_edges": "SELECT n_nationkey AS rule, 'ABSENT' AS rel, unnest([n_regionkey, n_regionkey + 10]) AS target FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT n_nationkey, 'STILL_ASSESS', n_nationkey + 100 FROM nation WHERE n_nationkey % 3 = 0",
    "null_and_repeated_keys": " UNION ALL ".join(f"SELECT '{n}' AS name, coalesce(sum(c) FILTER (WHERE k IS NULL), 0)::bigint AS nulls, count(*) FILTER (WHERE k IS NOT NULL AND c > 1) AS repeated FROM (SELECT k, count(*) AS c FROM ({s}) GROUP BY 1)" for n, s in (("purchases", "SELECT CASE WHEN event_type = 'purchase' THEN event_id END AS k FROM events"), ("users", "SELECT user_id AS k FROM events"), ("turns", "SELECT conv_id AS k FROM conversations"), ("parts", "SELECT p_partkey AS k FROM part"))),
}
