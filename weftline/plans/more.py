"""Further queries: clusters, negatives, sampling, inversions, labels, checks. Registered by `catalogue`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.functions import text as tx
from weftline.operators import pairs as p
from weftline.operators import records as rec

KEYS = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "documents": "doc_id", "embeddings": "vec_id", "pages": "page_id", "events": "event_id"}


#: members of a cluster that are paired
CLUSTER_CAP = 600


def cluster_pairs(q) -> DataFrame:
    """Pairs within clusters of suppliers, of which the first members count; the first kind of cluster that has a pair names it."""
    s = q("supplier")
    flagged = F.row_number().over(W.partitionBy("flag").orderBy("s_suppkey"))
    band = s.select(F.lit("band").alias("source"), F.concat(F.lit("b"), F.floor(F.col("s_acctbal") / 1000).cast("string")).alias("key"), "s_suppkey", F.lit(0.7).alias("confidence"), F.lit(1).alias("prio"))
    flag = s.withColumn("flag", F.col("s_acctbal") < 0).filter("flag").withColumn("_r", flagged).filter("_r <= 200").select(F.lit("flag"), F.lit("negative"), "s_suppkey", F.lit(0.65), F.lit(2)).toDF(*band.columns)
    nation = s.select(F.lit("nation"), F.col("s_nationkey").cast("string"), "s_suppkey", F.lit(0.6), F.lit(3)).toDF(*band.columns)
    members = p.capped(band.unionByName(flag).unionByName(nation), ["source", "key"], "s_suppkey", CLUSTER_CAP)
    pairs = p.shared_pairs(members, ["source", "key", "confidence", "prio"], "s_suppkey").filter("a < b")
    return p.first_writer(pairs, ["a", "b"], ["prio"]).select("a", "b", "source", "confidence")


def reverse_pairs(q) -> DataFrame:
    """Both directions of a pair; the way back is a little weaker."""
    pairs = cluster_pairs(q)
    back = pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "source", F.round(F.greatest(F.lit(0.1), F.least(F.lit(0.99), F.col("confidence") * 0.95)), 2).alias("confidence"))
    return pairs.unionByName(back)


def profile_mining(q) -> DataFrame:
    """Brands with three parts or more: their number, and the five dearest."""
    part = q("part")
    top = F.row_number().over(W.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey"))
    ranked = part.withColumn("_r", top)
    return ranked.groupBy("p_brand").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_r") <= 5, F.struct("_r", "p_partkey")))), lambda x: x["p_partkey"].cast("string")), ",").alias("dearest")).filter("n >= 3")


def cross_cluster_negatives(q) -> DataFrame:
    """Up to three pairs for each two brands: members of equal rank, so each part meets each brand once."""
    ranked = q("part").withColumn("rank", F.row_number().over(W.partitionBy("p_brand").orderBy("p_partkey"))).filter("rank <= 3").select("p_brand", "p_partkey", "rank")
    other = ranked.select(F.col("p_brand").alias("brand_b"), F.col("p_partkey").alias("b"), "rank")
    return ranked.join(other, "rank").filter("p_brand < brand_b").select(F.col("p_partkey").alias("a"), "b")


def prefix_union_distinct(q) -> DataFrame:
    head = F.substring(F.lower(F.trim("text")), 1, 80).alias("head")
    docs = q("documents").select(F.lit(1).alias("prio"), F.col("doc_id").alias("id"), head)
    items = q("benchmark").select(F.lit(2).alias("prio"), F.col("item_id").alias("id"), head)
    return p.first_writer(docs.unionByName(items), ["head"], ["prio", "id"]).select("prio", "id")


def train_eval_overlap(q) -> DataFrame:
    """Opening words of user turns that stand on both sides of the split of whole conversations, of those on any."""
    c = q("conversations")
    split = rec.running_split(c.groupBy("conv_id").agg(F.count("*").alias("n")), "conv_id", "n", 0.1)
    said = c.filter("role = 'user' and text is not null").select("conv_id", F.split_part("text", F.lit(" "), F.lit(1)).alias("opening")).join(split.select("conv_id", "side"), "conv_id")
    per = said.groupBy("opening").agg(F.countDistinct("side").alias("sides"))
    return per.agg(F.count_if(F.col("sides") == 2).alias("overlap"), F.count("*").alias("openings"))


def node_degrees(q) -> DataFrame:
    pairs = p.co_mentions(q("lineitem"), "l_orderkey", "l_partkey")
    both = pairs.select("a", "n").unionByName(pairs.select(F.col("b").alias("a"), "n"))
    return both.groupBy("a").agg(F.count("*").alias("degree"), F.sum("n").alias("strength"))


def array_union_capped(q) -> DataFrame:
    found = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array("o_orderpriority", "o_orderstatus"))))), 1, 4)
    return q("orders").groupBy("o_custkey").agg(F.array_join(found, ",").alias("labels"))


def seeded_sample(q) -> DataFrame:
    """Three documents of each source, drawn by a hash."""
    return rec.quota(q("documents").select("doc_id", "source", F.md5(F.col("doc_id").cast("string")).alias("h")), "source", ["h", "doc_id"], 3).select("doc_id", "source")


def byte_target_sample(q) -> DataFrame:
    """Sources, in the order of a hash, until their bytes reach 60 hundredths of all; the sum is over one row per source."""
    sizes = q("documents").groupBy("source").agg(F.sum(F.octet_length("text")).alias("n"))
    return rec.running_split(sizes, "source", "n", 0.6)


def concat_per_key(q) -> DataFrame:
    """Lines of an order as one text, in their order."""
    line = F.concat(F.col("l_partkey").cast("string"), F.lit("x"), F.col("l_quantity").cast("int").cast("string"))
    return q("lineitem").groupBy("l_orderkey").agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", line.alias("line")))), lambda x: x["line"]), "; ")).alias("lines_md5"))


def first_duplicate(q) -> DataFrame:
    first = F.min("doc_id").over(W.partitionBy(F.substring("text", 1, 100)))
    return q("documents").select("doc_id", first.alias("first_id")).filter("doc_id > first_id")


def rule_cascade(q) -> DataFrame:
    kind = F.when(F.col("text").isNull(), "none").when(F.col("text").contains("?"), "question").when(F.length("text") < 80, "short").when(F.col("role") == "assistant", "answer").otherwise("other")
    return q("conversations").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def multimap_inversion(q) -> DataFrame:
    used = q("lineitem").select("l_suppkey", "l_partkey").distinct()
    return used.groupBy("l_partkey").agg(F.count("*").alias("n"), F.array_join(F.slice(F.array_sort(F.collect_list("l_suppkey")), 1, 3), ",").alias("first_suppliers"))


def percent_mentions(q) -> DataFrame:
    hits = q("documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"([0-9]{1,3})%"), F.lit(1))).alias("x"))
    return hits.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(F.col("x").cast("int")).alias("most"))


def quality_labels(q) -> DataFrame:
    mean = F.avg("l_discount") * 10
    label = F.when(mean >= 0.6, "high").when(mean >= 0.35, "medium").otherwise("low")
    return q("lineitem").groupBy("l_suppkey").agg(label.alias("label"), F.count("*").alias("n"))


def attribute_lookup(q) -> DataFrame:
    """Parts of one size, dearest first."""
    return q("part").filter("p_size = 7").select("p_partkey", "p_retailprice", "p_brand").orderBy(F.desc("p_retailprice"), "p_brand", "p_partkey").limit(20)


def missing_keys(q) -> DataFrame:
    """Which documents have no label yet."""
    return q("documents").select("doc_id").join(q("labels").select("doc_id"), "doc_id", "left_anti")


def table_stats(q) -> DataFrame:
    out = None
    for name in KEYS:
        one = q(name).agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


def uniqueness_checks(q) -> DataFrame:
    out = None
    for name, key in KEYS.items():
        one = q(name).groupBy(key).agg(F.count("*").alias("c")).agg(F.lit(name).alias("name"), F.count_if(F.col("c") > 1).alias("repeated"))
        out = one if out is None else out.unionByName(one)
    return out


def rank_functions(q) -> DataFrame:
    own = W.partitionBy("p_brand").orderBy("p_retailprice", "p_partkey")
    return q("part").select("p_partkey", F.ntile(4).over(own).alias("quarter"), F.round(F.percent_rank().over(own), 6).alias("percent"), F.round(F.cume_dist().over(own), 6).alias("cume"), F.lag("p_partkey").over(own).alias("before_key"))


def prompt_assembly(q) -> DataFrame:
    c = q("conversations")
    body = F.concat(F.lit("### "), F.initcap("role"), F.lit(":\n"), F.coalesce("text", F.lit("")))
    return c.select("conv_id", "turn", F.md5(body).alias("prompt_md5"), F.ceil(F.length(body) / 2.7).alias("tokens"))


def numeric_castable(q) -> DataFrame:
    words = q("documents").select(F.explode(F.split("text", " ")).alias("w"))
    return words.agg(F.count_if(F.col("w").rlike(r"^[0-9]+(\.[0-9]+)?$")).alias("numeric"), F.count("*").alias("n"))


def evidence_breakdown(q) -> DataFrame:
    counts = q("events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("event_type", "n"))), lambda x: F.concat(x["event_type"], F.lit("="), x["n"].cast("string")))
    return counts.groupBy("user_id").agg(F.array_join(parts, ",").alias("breakdown"))


def score_probes(q) -> DataFrame:
    """Recall of flagged labels by a rule, and false alarms, by language."""
    marked = q("documents").join(q("labels").filter("quality is not null"), "doc_id")
    rule = F.length(F.regexp_replace("text", r"[^#*$%&|<>]", "")) * 20 > F.length("text")
    return marked.groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg(F.when(F.col("quality") == 0, rule.cast("int"))), 6).alias("recall"), F.round(F.avg(F.when(F.col("quality") == 1, rule.cast("int"))), 6).alias("false_alarms"))


def short_ids_of_pages(q) -> DataFrame:
    return q("pages").select("page_id", tx.short_id(F.col("url")).alias("url_id"))


QUERIES = [f for f in list(globals().values()) if callable(f) and getattr(f, "__module__", "") == __name__]

CLUSTERS = """members AS (SELECT * FROM (SELECT 'band' AS source, 'b' || floor(s_acctbal / 1000)::bigint::varchar AS key, s_suppkey, 0.7::double AS confidence, 1 AS prio FROM supplier
UNION ALL SELECT 'flag', 'negative', s_suppkey, 0.65::double, 2 FROM (SELECT * FROM supplier WHERE s_acctbal < 0 ORDER BY s_suppkey LIMIT 200)
UNION ALL SELECT 'nation', s_nationkey::varchar, s_suppkey, 0.6::double, 3 FROM supplier) QUALIFY row_number() OVER (PARTITION BY source, key ORDER BY s_suppkey) <= 600),
pairs AS (SELECT x.s_suppkey AS a, y.s_suppkey AS b, source, x.confidence, x.prio FROM members x JOIN members y USING (source, key) WHERE x.s_suppkey < y.s_suppkey QUALIFY row_number() OVER (PARTITION BY x.s_suppkey, y.s_suppkey ORDER BY x.prio) = 1)"""
SPLIT = "s AS (SELECT {key}, {n} AS n FROM {table} GROUP BY 1), r AS (SELECT *, sum(n) OVER (ORDER BY md5({key}::varchar), {key} ROWS UNBOUNDED PRECEDING) - n AS before, sum(n) OVER () AS total FROM s), split AS (SELECT {key}, n::bigint AS n, CASE WHEN before < total * {share}::double THEN 'eval' ELSE 'train' END AS side FROM r)"

ORACLES = {
    "cluster_pairs": f"WITH {CLUSTERS} SELECT a, b, source, confidence FROM pairs",
    "reverse_pairs": f"WITH {CLUSTERS} SELECT a, b, source, confidence FROM pairs UNION ALL SELECT b, a, source, round(greatest(0.1::double, least(0.99::double, confidence * 0.95::double)), 2) FROM pairs",
    "profile_mining": "WITH r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS r FROM part) SELECT p_brand, count(*) AS n, string_agg(p_partkey::varchar, ',' ORDER BY r) FILTER (WHERE r <= 5) AS dearest FROM r GROUP BY 1 HAVING count(*) >= 3",
    "cross_cluster_negatives": "WITH r AS (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rank FROM part QUALIFY rank <= 3) SELECT x.p_partkey AS a, y.p_partkey AS b FROM r x JOIN r y USING (rank) WHERE x.p_brand < y.p_brand",
    "prefix_union_distinct": "WITH u AS (SELECT 1 AS prio, doc_id AS id, substring(lower(trim(text)), 1, 80) AS head FROM documents UNION ALL SELECT 2, item_id, substring(lower(trim(text)), 1, 80) FROM benchmark) SELECT prio, id FROM u QUALIFY row_number() OVER (PARTITION BY head ORDER BY prio, id) = 1",
    "train_eval_overlap": f"WITH {SPLIT.format(key='conv_id', n='count(*)', table='conversations', share=0.1)} SELECT count(*) FILTER (WHERE sides = 2) AS overlap, count(*) AS openings FROM (SELECT split_part(text, ' ', 1) AS opening, count(DISTINCT side) AS sides FROM conversations JOIN split USING (conv_id) WHERE role = 'user' AND text IS NOT NULL GROUP BY 1)",
    "node_degrees": "WITH b AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem), co AS (SELECT x.l_partkey AS a, y.l_partkey AS b, count(*) AS n FROM b x JOIN b y ON x.l_orderkey = y.l_orderkey AND x.l_partkey <> y.l_partkey GROUP BY 1, 2) SELECT a, count(*) AS degree, sum(n)::bigint AS strength FROM co GROUP BY 1",
    "array_union_capped": "WITH u AS (SELECT o_custkey, o_orderpriority AS x FROM orders UNION SELECT o_custkey, o_orderstatus FROM orders) SELECT o_custkey, array_to_string(list_sort(list(x))[1:4], ',') AS labels FROM u GROUP BY 1",
    "seeded_sample": "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::varchar), doc_id) <= 3",
    "byte_target_sample": f"WITH {SPLIT.format(key='source', n='sum(strlen(text))', table='documents', share=0.6)} SELECT * FROM split",
    "concat_per_key": "SELECT l_orderkey, md5(string_agg(l_partkey::varchar || 'x' || l_quantity::int::varchar, '; ' ORDER BY l_linenumber, l_partkey, l_partkey::varchar || 'x' || l_quantity::int::varchar)) AS lines_md5 FROM lineitem GROUP BY 1",
    "first_duplicate": "SELECT * FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY substring(text, 1, 100)) AS first_id FROM documents) WHERE doc_id > first_id",
    "rule_cascade": "SELECT CASE WHEN text IS NULL THEN 'none' WHEN contains(text, '?') THEN 'question' WHEN length(text) < 80 THEN 'short' WHEN role = 'assistant' THEN 'answer' ELSE 'other' END AS kind, count(*) AS n FROM conversations GROUP BY 1",
    "multimap_inversion": "WITH u AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) SELECT l_partkey, count(*) AS n, array_to_string(list_sort(list(l_suppkey))[1:3], ',') AS first_suppliers FROM u GROUP BY 1",
    "percent_mentions": "WITH h AS (SELECT doc_id, unnest(regexp_extract_all(text, '([0-9]{1,3})%', 1)) AS x FROM documents) SELECT doc_id, count(*) AS n, max(x::int) AS most FROM h GROUP BY 1",
    "quality_labels": "SELECT l_suppkey, CASE WHEN avg(l_discount) * 10 >= 0.6 THEN 'high' WHEN avg(l_discount) * 10 >= 0.35 THEN 'medium' ELSE 'low' END AS label, count(*) AS n FROM lineitem GROUP BY 1",
    "attribute_lookup": "SELECT p_partkey, p_retailprice, p_brand FROM part WHERE p_size = 7 ORDER BY p_retailprice DESC, p_brand, p_partkey LIMIT 20",
    "missing_keys": "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "table_stats": " UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n FROM {name}" for name in KEYS),
    "uniqueness_checks": " UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS repeated FROM (SELECT {key} FROM {name} GROUP BY 1 HAVING count(*) > 1)" for name, key in KEYS.items()),
    "rank_functions": "SELECT p_partkey, ntile(4) OVER w AS quarter, round(percent_rank() OVER w, 6) AS percent, round(cume_dist() OVER w, 6) AS cume, lag(p_partkey) OVER w AS before_key FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey)",
    "prompt_assembly": "WITH b AS (SELECT conv_id, turn, '### ' || upper(role[1]) || lower(role[2:]) || ':' || chr(10) || coalesce(text, '') AS body FROM conversations) SELECT conv_id, turn, md5(body) AS prompt_md5, ceil(length(body) / 2.7::double)::bigint AS tokens FROM b",
    "numeric_castable": r"WITH w AS (SELECT unnest(string_split(text, ' ')) AS w FROM documents) SELECT count(*) FILTER (WHERE regexp_matches(w, '^[0-9]+(\.[0-9]+)?$')) AS numeric, count(*) AS n FROM w",
    "evidence_breakdown": "WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS breakdown FROM c GROUP BY 1",
    "score_probes": "WITH m AS (SELECT lang, quality, (length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) * 20 > length(text))::int AS hit FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL) SELECT lang, count(*) AS n, round(avg(hit) FILTER (WHERE quality = 0), 6) AS recall, round(avg(hit) FILTER (WHERE quality = 1), 6) AS false_alarms FROM m GROUP BY 1",
    "short_ids_of_pages": "SELECT page_id, substring(sha1(url), 1, 20) AS url_id FROM pages",
}
