"""Text pairs of pages, of triggers in several forms, of remedies and of contexts of execution. Registered by `catalogue`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.operators import pairs as p
from weftline.operators.dealing import dealt
from weftline.plans import texts
from weftline.sources.folders import stored

#: instruction and output of each kind; a row whose template has a null makes no pair
texts.LAYERS.update(
    {
        "page_pairs": [("Which parts are named beside part {key}?", "{quality} evidence: part {key} stands beside {count} others.\n{lines}")],
        "page_chains": [("What follows part {key} in a chain?", "Pages chain part {key} with {count} others.\n{lines}")],
        "page_campaigns": [("Was part {key} seen in a campaign?", "Yes: {lines}")],
        "remedy_of_part": [
            ("How is the fault of part {key} mended?", "Exchange it for another of {brand}; {count} came back."),
            ("Why does part {key} fail?", "Its kind, {kind}, is under strain at size {size}."),
            ("How is the exchange of part {key} checked?", "No return may come within {days} days."),
            ("How urgent is part {key}?", "With {count} returns it must be handled within {days} days; it costs {price}."),
        ],
        "remedy_of_kind": [("What is the rule for parts of the kind {key}?", "Exchange them after {count} returns, {most} at most of one part."), ("How are faults of the kind {key} found?", "Look at {members} first.")],
        "context_of_kind": [
            ("Which tools fit a {key} event?", "Look at users {members}."),
            ("What is common in {key} events?", "Values near {value}, from {count} users."),
            ("What are the risks of {key} events?", "They come {times} times, most from user {first}."),
            ("What shows a {key} event?", "A value of {value} or more by one of {members}."),
        ],
        "context_of_event": [("How is event {key} tried out for user {user}?", "Repeat its {kind} with value {value}.")],
    }
)


def mentioned_beside(q) -> DataFrame:
    """(key, other, signal, confidence): the strongest signal between two parts of an order, which stands for a page.

    Lines that follow each other share a paragraph; if the first has a quantity of 45 or more, they are a chain.
    """
    n = p.pair_partitions(q("lineitem"))
    own = dealt(q("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), n, "l_orderkey")
    nxt = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_quantity")
    steps = own.select(F.col("l_partkey").alias("a"), F.lead("l_partkey").over(nxt).alias("b"), "l_quantity").filter("b is not null and a <> b")
    near = steps.select("a", "b", F.when(F.col("l_quantity") >= 45, 0.8).otherwise(0.45).alias("confidence"))
    ids = own.select("l_orderkey", F.col("l_partkey").alias("a")).distinct()
    page = ids.join(ids.withColumnRenamed("a", "b"), "l_orderkey").filter("a < b").select("a", "b", F.lit(0.25).alias("confidence"))
    rows = dealt(near.unionByName(page).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "confidence"), n, "a", "b").groupBy("a", "b").agg(F.max("confidence").alias("confidence"))
    both = rows.unionByName(rows.select(F.col("b").alias("a"), F.col("a").alias("b"), "confidence"))
    signal = F.when(F.col("confidence") == 0.8, "chain").when(F.col("confidence") == 0.45, "paragraph").otherwise("page")
    return both.select(F.col("a").alias("key"), F.col("b").alias("other"), signal.alias("signal"), "confidence")


def first_lines(rows: DataFrame, most: int, line) -> DataFrame:
    """(key, count, mean, lines): the strongest others of each key as lines, their mean confidence, and the number of all."""
    ranked = rows.withColumn("r", F.row_number().over(W.partitionBy("key").orderBy(F.desc("confidence"), "other"))).filter(F.col("r") <= most)
    counts = rows.groupBy("key").agg(F.count("*").alias("count"))
    made = ranked.groupBy("key").agg(F.avg("confidence").alias("mean"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", line.alias("line")))), lambda x: x["line"]), "\n").alias("lines"))
    return counts.join(made, "key")


def page_layer(q) -> DataFrame:
    """What stands beside a part, with which it is chained, and in which campaigns it was seen; the last from returns in large quantities."""
    # read four times
    beside = stored(mentioned_beside(q), "beside")
    line = F.format_string("- %d (%s, %.2f)", F.col("other"), F.col("signal"), F.col("confidence"))
    pairs = first_lines(beside, 8, line).withColumn("quality", F.when(F.col("mean") >= 0.6, "Strong").when(F.col("mean") >= 0.35, "Fair").otherwise("Weak"))
    chains = first_lines(beside.filter("signal = 'chain'"), 6, F.format_string("- %d", F.col("other")))
    seen = q("lineitem").filter("l_returnflag = 'R' and l_quantity >= 48").select(F.col("l_partkey").alias("key"), "l_orderkey").distinct()
    first = seen.withColumn("r", F.row_number().over(W.partitionBy("key").orderBy("l_orderkey"))).filter("r <= 3")
    campaigns = first.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list("l_orderkey")), lambda x: F.concat(F.lit("order "), x.cast("string"))), " | ").alias("lines"))
    return texts.pairs_of("page_pairs", pairs, "key").unionByName(texts.pairs_of("page_chains", chains, "key")).unionByName(texts.pairs_of("page_campaigns", campaigns, "key"))


FORMS = ["Part {k} was found faulty. What else?", "We confirmed part {k}. Which parts are likely?", "Scan: part {k}. Name what goes with it.", "After part {k}, what comes next?", "Alert on part {k}: which others first?", "Part {k} is in stock. What is beside it?"]


def hashed(*what) -> F.Column:
    return F.md5(F.concat_ws("|", *(w.cast("string") if not isinstance(w, str) else F.lit(w) for w in what)))


def positive_texts(q) -> DataFrame:
    """Up to four pairs of each trigger: another question, another slice and order of what is related, another form of answer, all drawn by hash."""
    beside = mentioned_beside(q).filter("key % 4 = 0")
    top = beside.withColumn("r", F.row_number().over(W.partitionBy("key").orderBy(F.desc("confidence"), "other"))).filter("r <= 8")
    related = top.groupBy("key").agg(F.collect_list(F.struct("other", "confidence")).alias("rel"), F.array_join(F.array_sort(F.collect_set("signal")), ", ").alias("signals"))
    key = F.col("key")
    forms = F.array_sort(F.array(*(F.struct(hashed(key, f"form {i}").alias("h"), F.concat(F.lit(f.split("{k}")[0]), key.cast("string"), F.lit(f.split("{k}")[1])).alias("text")) for i, f in enumerate(FORMS))))
    rows = related.withColumn("forms", forms).select("key", "rel", "signals", "forms", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("variant"))
    size = F.conv(F.substring(hashed(key, F.col("variant"), "slice"), 1, 8), 16, 10).cast("long") % 3 + 3
    order = F.array_sort(F.transform("rel", lambda x: F.struct(hashed(key, F.col("variant"), x["other"]).alias("h"), x["other"].alias("other"), x["confidence"].alias("confidence"))))
    rows = rows.select("key", "variant", "signals", F.element_at("forms", F.col("variant") + 1)["text"].alias("instruction"), F.slice(order, F.lit(1), size.cast("int")).alias("some"))
    label = lambda c: F.when(c >= 0.8, "HIGH").when(c >= 0.65, "MEDIUM").otherwise("LOW")
    joined = lambda f, by: F.array_join(F.transform("some", f), by)
    full = F.concat(F.lit("Related:\n"), joined(lambda x: F.concat(x["other"].cast("string"), F.lit(" ("), label(x["confidence"]), F.lit(")")), "\n"), F.lit("\nSignals: "), F.col("signals"))
    short = F.concat(F.lit("Check "), joined(lambda x: x["other"].cast("string"), ", "), F.lit("."))
    odds = joined(lambda x: F.concat(x["other"].cast("string"), F.lit(": "), F.round(x["confidence"] * 100).cast("long").cast("string"), F.lit("%")), "; ")
    steps = F.concat(F.lit("Steps:"), F.array_join(F.transform("some", lambda x, i: F.concat(F.lit("\n"), (i + 1).cast("string"), F.lit(". "), x["other"].cast("string"))), ""))
    output = F.when(F.col("variant") == 0, full).when(F.col("variant") == 1, short).when(F.col("variant") == 2, odds).otherwise(steps)
    return rows.select("key", "variant", "instruction", output.alias("output"), F.size("some").alias("n_related"))


def remedy_layer(q) -> DataFrame:
    """Four kinds of pairs on each part that came back, two on its type."""
    back = q("lineitem").filter("l_returnflag = 'R'").groupBy("l_partkey").agg(F.count("*").alias("count"))
    rows = back.join(q("part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), F.col("p_size").alias("size"), "count", F.when(F.col("count") >= 8, 1).when(F.col("count") >= 5, 7).otherwise(30).alias("days"), F.when(F.col("p_partkey") % 6 > 0, F.round("p_retailprice").cast("long")).alias("price"))
    ranked = rows.withColumn("r", F.row_number().over(W.partitionBy("kind").orderBy(F.desc("count"), "key"))).filter("r <= 4")
    members = ranked.groupBy("kind").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "key"))), lambda x: x["key"].cast("string")), ", ").alias("members"))
    kinds = rows.groupBy("kind").agg(F.sum("count").alias("count"), F.max("count").alias("most")).join(members, "kind").withColumnRenamed("kind", "key")
    return texts.pairs_of("remedy_of_part", rows, "key").unionByName(texts.pairs_of("remedy_of_kind", kinds, "key"))


def execution_layer(q) -> DataFrame:
    """Four kinds of pairs on each type of event, one on each purchase."""
    e = q("events")
    users = e.groupBy("event_type", "user_id").agg(F.count("*").alias("c"))
    ranked = users.withColumn("r", F.row_number().over(W.partitionBy("event_type").orderBy(F.desc("c"), "user_id"))).filter("r <= 5")
    members = ranked.groupBy("event_type").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "user_id"))), lambda x: x["user_id"].cast("string")), ", ").alias("members"), F.min(F.when(F.col("r") == 1, F.col("user_id"))).alias("first"))
    kinds = e.groupBy("event_type").agg(F.count("*").alias("times"), F.countDistinct("user_id").alias("count"), F.floor(F.max("value")).alias("value")).join(members, "event_type").withColumnRenamed("event_type", "key")
    events = e.filter("event_type = 'purchase'").select(F.col("event_id").alias("key"), F.when(F.col("user_id") % 10 > 0, F.col("user_id")).alias("user"), F.col("event_type").alias("kind"), F.floor("value").alias("value"))
    return texts.pairs_of("context_of_kind", kinds, "key").unionByName(texts.pairs_of("context_of_event", events, "key"))


QUERIES = [page_layer, positive_texts, remedy_layer, execution_layer]

BESIDE = """l AS (SELECT l_partkey AS a, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS b, l_quantity FROM lineitem),
ids AS (SELECT DISTINCT l_orderkey, l_partkey AS a FROM lineitem),
best AS (SELECT least(a, b) AS a, greatest(a, b) AS b, max(c) AS confidence FROM (SELECT a, b, CASE WHEN l_quantity >= 45 THEN 0.8::double ELSE 0.45::double END AS c FROM l WHERE a <> b UNION ALL SELECT x.a, y.a, 0.25::double FROM ids x JOIN ids y ON x.l_orderkey = y.l_orderkey AND x.a < y.a) GROUP BY 1, 2),
beside AS (SELECT key, other, confidence, CASE confidence WHEN 0.8 THEN 'chain' WHEN 0.45 THEN 'paragraph' ELSE 'page' END AS signal FROM (SELECT a AS key, b AS other, confidence FROM best UNION ALL SELECT b, a, confidence FROM best))"""


def _sql_pairs(layer: str, rows: str) -> str:
    return f"SELECT * FROM ({texts.sql_pairs(layer, rows, 'key')})"


def _lines(where: str, most: int, line: str) -> str:
    return f"SELECT key, any_value(n) AS count, avg(confidence) AS mean, string_agg({line}, chr(10) ORDER BY r) AS lines FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY confidence DESC, other) AS r, count(*) OVER (PARTITION BY key) AS n FROM beside WHERE {where}) WHERE r <= {most} GROUP BY key"


_PAGE = _lines("true", 8, "'- ' || other || ' (' || signal || ', ' || printf('%.2f', confidence) || ')'")
_FORMS = ", ".join(f"{{'h': md5(key || '|form {i}'), 't': '{f.split('{k}')[0]}' || key || '{f.split('{k}')[1]}'}}" for i, f in enumerate(FORMS))
_RETURNED = "SELECT p_partkey AS key, p_brand AS brand, p_type AS kind, p_size AS size, c AS count, CASE WHEN c >= 8 THEN 1 WHEN c >= 5 THEN 7 ELSE 30 END AS days, CASE WHEN p_partkey % 6 > 0 THEN round(p_retailprice)::bigint END AS price FROM part JOIN (SELECT l_partkey, count(*) AS c FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON l_partkey = p_partkey"
ORACLES = {
    "page_layer": f"WITH {BESIDE} "
    + _sql_pairs("page_pairs", f"SELECT *, CASE WHEN mean >= 0.6 THEN 'Strong' WHEN mean >= 0.35 THEN 'Fair' ELSE 'Weak' END AS quality FROM ({_PAGE})")
    + " UNION ALL "
    + _sql_pairs("page_chains", _lines("signal = 'chain'", 6, "'- ' || other"))
    + " UNION ALL "
    + _sql_pairs("page_campaigns", "SELECT key, string_agg('order ' || o, ' | ' ORDER BY o) AS lines FROM (SELECT DISTINCT l_partkey AS key, l_orderkey AS o FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 48 QUALIFY dense_rank() OVER (PARTITION BY l_partkey ORDER BY l_orderkey) <= 3) GROUP BY 1"),
    "positive_texts": f"""WITH {BESIDE}, top AS (SELECT * FROM beside WHERE key % 4 = 0 QUALIFY row_number() OVER (PARTITION BY key ORDER BY confidence DESC, other) <= 8),
v AS (SELECT t.*, i::int AS variant, row_number() OVER (PARTITION BY key, i ORDER BY md5(key || '|' || i || '|' || other)) AS r FROM top t, range(4) x(i)),
s AS (SELECT key, string_agg(DISTINCT signal, ', ' ORDER BY signal) AS signals, list_sort([{_FORMS}]) AS forms FROM top GROUP BY key),
k AS (SELECT * FROM v WHERE r <= ('0x' || md5(key || '|' || variant || '|slice')[1:8])::bigint % 3 + 3)
SELECT key, variant, any_value(forms)[variant + 1].t AS instruction, CASE variant WHEN 0 THEN 'Related:' || chr(10) || string_agg(other || ' (' || CASE WHEN confidence >= 0.8 THEN 'HIGH' WHEN confidence >= 0.65 THEN 'MEDIUM' ELSE 'LOW' END || ')', chr(10) ORDER BY r) || chr(10) || 'Signals: ' || any_value(signals)
WHEN 1 THEN 'Check ' || string_agg(other::varchar, ', ' ORDER BY r) || '.' WHEN 2 THEN string_agg(other || ': ' || round(confidence * 100)::bigint || '%', '; ' ORDER BY r) ELSE 'Steps:' || string_agg(chr(10) || r || '. ' || other, '' ORDER BY r) END AS output, count(*)::int AS n_related FROM k JOIN s USING (key) GROUP BY key, variant""",
    "remedy_layer": _sql_pairs("remedy_of_part", _RETURNED) + " UNION ALL " + _sql_pairs("remedy_of_kind", f"SELECT kind AS key, sum(count)::bigint AS count, max(count) AS most, string_agg(key::varchar, ', ' ORDER BY r) FILTER (WHERE r <= 4) AS members FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY count DESC, key) AS r FROM ({_RETURNED})) GROUP BY 1"),
    "execution_layer": _sql_pairs("context_of_kind", "SELECT * FROM (SELECT event_type AS key, count(*) AS times, count(DISTINCT user_id) AS count, floor(max(value))::bigint AS value FROM events GROUP BY 1) JOIN (SELECT event_type AS key, string_agg(user_id::varchar, ', ' ORDER BY r) AS members, min(user_id) FILTER (WHERE r = 1) AS first FROM (SELECT event_type, user_id, row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, user_id) AS r FROM events GROUP BY 1, 2) WHERE r <= 5 GROUP BY 1) USING (key)")
    + " UNION ALL "
    + _sql_pairs("context_of_event", "SELECT event_id AS key, CASE WHEN user_id % 10 > 0 THEN user_id END AS user, event_type AS kind, floor(value)::bigint AS value FROM events WHERE event_type = 'purchase'"),
}
