"""Queries on what pages say of ids, contexts built from it, and a profile of text pairs. Registered by `catalogue`."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.operators import gathered as ga
from weftline.operators import pairs as p
from weftline.operators import records as rec
from weftline.operators.dealing import dealt, partitions
from weftline.plans import family, layers, texts

#: items of a kind that are gathered, letters of a page, of a context's page text, products of a record
MOST, LEAD, SHOWN, PRODUCTS = 4, 60, 150, 6
#: pages of a partition if all that they say is gathered, and if some of it is; lines of a partition; ids up to which what pages say of them is broadcast
FULL_ROWS, PAGE_ROWS, LINE_ROWS, BROADCAST_IDS = 1 << 16, 1 << 18, 1 << 20, 1 << 16


def said_pages(q, each: int) -> DataFrame:
    """Advisories as pages: ids in order of the text, pairs of neighbours, chains from the first to the last, campaigns, weaknesses and products on some."""
    o = q("orders")
    n = partitions(o.sparkSession, o.count(), each)
    of_text = dealt(o.select("o_orderkey", "o_custkey", "o_orderdate"), n, "o_orderkey")
    of_page = dealt(o.select(F.col("o_orderkey").alias("page"), F.col("o_custkey").alias("customer"), "o_orderpriority"), n, "page")
    # texts are made behind the join, and not exchanged
    pages = of_text.join(of_page, F.col("o_orderkey") == F.col("page")).withColumn("text", family.advisory_text()).withColumn("ids", F.array_distinct(F.regexp_extract_all(F.upper("text"), F.lit(family.NOTATIONS["vulnerabilities"]), F.lit(0))))
    pair = lambda a, b, signal, c: F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), F.lit(signal).alias("signal"), F.lit(c).alias("confidence"))
    near = F.transform(F.slice("ids", 2, 100), lambda x, i: pair(F.get("ids", i), x, "page", 0.25))
    chain = F.when((F.col("page") % 3 == 0) & (F.size("ids") > 1), F.array(pair(F.get("ids", F.lit(0)), F.element_at("ids", -1), "chain", 0.8)))
    products = F.when(F.col("page") % 5 > 0, F.array(F.concat(F.lit("product "), (F.col("customer") % 40).cast("string")), F.lower(F.substring("o_orderpriority", 3, 20))))
    return pages.select("page", F.concat(F.lit("https://pages.example/"), F.col("page").cast("string")).alias("url"), "text", "ids", near.alias("pairs"), chain.alias("chains"), F.when(F.col("page") % 4 == 0, F.array(F.concat(F.lit("wave "), (F.col("page") % 10).cast("string")))).alias("campaigns"), F.regexp_extract_all(F.upper("text"), F.lit(family.NOTATIONS["weaknesses"]), F.lit(0)).alias("weaknesses"), products.alias("products"))


def pages_gathered(q) -> DataFrame:
    """For every id what pages say of it: the first items of each kind, and how many there are."""
    rows = ga.gathered(said_pages(q, FULL_ROWS), MOST, LEAD)
    pairs = [F.array_join(F.transform(c, lambda p: F.concat_ws("~", p["a"], p["b"], p["signal"])), "|").alias(c) for c in ga.OF_PAIRS]
    return rows.select("id", "n_pages", *(f"n_{c}" for c in ("pairs", "chains", "campaigns", "weaknesses", "products")), *pairs, *(F.array_join(c, "|").alias(c) for c in ("urls", "campaigns", "weaknesses", "products")), F.md5(F.array_join("texts", ga.SEPARATOR)).alias("texts_md5"))


def context_blocks(q) -> DataFrame:
    """Records of orders with a context of titled blocks: pages, tries, confirmation and advisories, each where there is any; the weakness and the products that pages name fill gaps.

    Lines stand for advisories and tries: the first five and three of an order are shown.
    """
    base = q("orders").select(F.col("o_orderkey").alias("order"), F.year("o_orderdate").alias("year"), "o_custkey")
    one = F.concat(F.lit("CVE-"), F.col("year").cast("string"), F.lit("-"), F.lpad((F.col("order") % 700 + 1000).cast("string"), 4, "0")).alias("id")
    own_weakness = F.when(F.col("order") % 2 == 0, F.concat(F.lit("CWE-"), (F.col("o_custkey") % 90).cast("string")))
    own = F.array(F.concat(F.lit("product "), (F.col("order") % 40).cast("string")), F.lit("core"))
    n = partitions(base.sparkSession, q("lineitem").count(), LINE_ROWS)
    lines = dealt(q("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"), n, "l_orderkey")
    package, way = F.col("l_partkey").cast("string"), F.col("l_linenumber") % 4
    source = F.when(way == 1, F.concat(F.lit("Air: packages="), package)).when(way == 2, F.concat(F.lit("Rail: fixed in "), F.col("l_suppkey").cast("string"))).when(way == 3, F.concat(F.lit("Ship "), package, F.lit(": see there")))
    tried = F.col("l_returnflag") == "R"
    listed = lambda x: F.transform(F.array_sort(F.collect_list(x)), lambda r: r["t"])
    # both numbers come from one order of the lines
    in_order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_quantity").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = lines.select("*", F.row_number().over(in_order).alias("place"), F.when(tried, F.count(F.when(tried, 1)).over(in_order)).alias("try"))
    of_lines = placed.groupBy(F.col("l_orderkey").alias("order")).agg(listed(F.when((F.col("place") <= 5) & source.isNotNull(), F.struct("place", source.alias("t")))).alias("advisories"), listed(F.when(F.col("try") <= 3, F.struct("place", F.concat(F.lit("part "), package).alias("t")))).alias("titles"), F.count("try").alias("tries"), F.max(F.when(tried & (F.col("l_quantity") >= 45), F.col("l_quantity").cast("int"))).alias("most"))
    # pages are asked for ids of records only; what they say comes last and is cut to what is shown, so that no record is exchanged with it
    known = base.select(one).distinct()
    beside = F.broadcast if known.count() <= BROADCAST_IDS else lambda rows: rows
    firsts = ga.firsts(said_pages(q, PAGE_ROWS), MOST, LEAD, ("texts", "weaknesses", "products"), of=beside(known))
    said = firsts.select("id", F.get("weaknesses", F.lit(0)).alias("weakness"), F.slice("products", 1, 3).alias("products"), F.substring(F.array_join("texts", ga.SEPARATOR), 1, SHOWN).alias("pages"))
    wide = dealt(base, n, "order").join(of_lines, "order", "left").withColumn("id", one).join(beside(said), "id", "left")
    context = ga.blocks(
        pages=F.col("pages"),
        tries=F.when(F.col("tries") > 0, F.concat(F.col("tries").cast("string"), F.lit(" in all, "), F.array_join("titles", ", "))),
        confirmed=F.when(F.col("most").isNotNull(), F.concat(F.lit("in the open, "), F.col("most").cast("string"), F.lit(" at once"))),
        advisories=F.array_join(F.transform("advisories", lambda x: F.concat(F.lit("- "), x)), "\n"),
    )
    products = F.slice(F.array_distinct(F.concat(own, F.coalesce("products", F.array().cast("array<string>")))), 1, PRODUCTS)
    return wide.select("order", "id", F.coalesce(own_weakness, "weakness", F.lit("")).alias("weakness"), F.array_join(products, "|").alias("products"), F.md5(context).alias("context_md5"), F.length(context).alias("n_chars"))


#: layers of pairs that the profile reads
PROFILED = {"standard_pairs": texts, "raw_pair_texts": texts, "remedy_pairs": texts, "conditional_pairs": texts, "remedy_layer": layers, "execution_layer": layers}


def pairs_profile(q) -> DataFrame:
    """Profile of all text pairs in rows (section, name, n, value): pairs and their percentage by layer, lengths of outputs, empty fields, repeats by prefixes."""
    pairs = reduce(DataFrame.unionByName, (getattr(m, name)(q).select("layer", "instruction", "output") for name, m in PROFILED.items()))
    return rec.profile(pairs, "layer", ["instruction", "output"], "output", parts=p.pair_partitions(q("lineitem")))


QUERIES = [pages_gathered, context_blocks, pairs_profile]

PAGES = family.ADVISORY + f""", named AS (SELECT page, text, list_filter(x, lambda w, i: list_position(x, w) = i) AS ids FROM (SELECT page, text, regexp_extract_all(upper(text), '{family.NOTATIONS["vulnerabilities"]}') AS x FROM t)),
pg AS (SELECT page, 'https://pages.example/' || page AS url, text, ids, CASE WHEN page % 3 = 0 AND len(ids) > 1 THEN 1 ELSE 0 END AS chained, CASE WHEN page % 4 = 0 THEN ['wave ' || page % 10] ELSE [] END AS campaigns, regexp_extract_all(upper(text), '{family.NOTATIONS["weaknesses"]}') AS weaknesses, CASE WHEN page % 5 > 0 THEN ['product ' || o_custkey % 40, lower(substring(o_orderpriority, 3, 20))] ELSE [] END AS products FROM named JOIN orders ON o_orderkey = page),
prs AS (SELECT page, i AS pos, 'pairs' AS kind, least(ids[i], ids[i + 1]) AS a, greatest(ids[i], ids[i + 1]) AS b, 'page' AS signal FROM (SELECT page, ids, unnest(range(1, len(ids))) AS i FROM pg) UNION ALL SELECT page, 1, 'chains', least(ids[1], ids[-1]), greatest(ids[1], ids[-1]), 'chain' FROM pg WHERE chained = 1),
per AS (SELECT page, url, text, unnest(ids) AS id, campaigns, weaknesses, products FROM pg),
said AS (SELECT a AS id, kind, page, pos, a || '~' || b || '~' || signal AS v FROM prs UNION ALL SELECT b, kind, page, pos, a || '~' || b || '~' || signal FROM prs WHERE a <> b
UNION ALL SELECT id, 'urls', page, 1, url FROM per UNION ALL SELECT id, 'texts', page, 1, 'Source: ' || url || chr(10) || chr(10) || substring(text, 1, {LEAD}) FROM per
UNION ALL SELECT id, 'campaigns', page, unnest(range(1, len(campaigns) + 1)), unnest(campaigns) FROM per UNION ALL SELECT id, 'weaknesses', page, unnest(range(1, len(weaknesses) + 1)), unnest(weaknesses) FROM per UNION ALL SELECT id, 'products', page, unnest(range(1, len(products) + 1)), unnest(products) FROM per),
firsts AS (SELECT * FROM said QUALIFY row_number() OVER (PARTITION BY id, kind ORDER BY page, pos) <= {MOST}),
ga AS (SELECT id, n_pages, n_pairs, n_chains, n_campaigns, n_weaknesses, n_products, pairs, chains, urls, campaigns, weaknesses, products, texts FROM (SELECT id, """ + ", ".join(f"count(*) FILTER (WHERE kind = '{c}') AS n_{'pages' if c == 'urls' else c}" for c in ("urls", "pairs", "chains", "campaigns", "weaknesses", "products")) + " FROM said GROUP BY 1) JOIN (SELECT id, " + ", ".join(f"string_agg(v, {'chr(10) || chr(10) || ' + repr('---') + ' || chr(10) || chr(10)' if c == 'texts' else repr('|')} ORDER BY page, pos) FILTER (WHERE kind = '{c}') AS {c}" for c in ("pairs", "chains", "urls", "campaigns", "weaknesses", "products", "texts")) + " FROM firsts GROUP BY 1) USING (id))"
_TITLED = "CASE WHEN {1} <> '' THEN '{0}:' || chr(10) || {1} END"
_PROFILED = " UNION ALL ".join(f"SELECT layer, instruction, output FROM ({m.ORACLES[name]})" for name, m in PROFILED.items())
ORACLES = {
    "pages_gathered": f"WITH {PAGES} SELECT id, n_pages, n_pairs, n_chains, n_campaigns, n_weaknesses, n_products, {', '.join(f'''coalesce({c}, '') AS {c}''' for c in ('pairs', 'chains', 'urls', 'campaigns', 'weaknesses', 'products'))}, md5(texts) AS texts_md5 FROM ga",
    "context_blocks": f"""WITH {PAGES}, base AS (SELECT o_orderkey AS o, 'CVE-' || year(o_orderdate) || '-' || lpad((o_orderkey % 700 + 1000)::varchar, 4, '0') AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'CWE-' || o_custkey % 90 END AS own_weakness, ['product ' || o_orderkey % 40, 'core'] AS own FROM orders),
l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS place FROM lineitem), l2 AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN row_number() OVER (PARTITION BY l_orderkey, l_returnflag = 'R' ORDER BY place) END AS try, CASE l_linenumber % 4 WHEN 1 THEN 'Air: packages=' || l_partkey WHEN 2 THEN 'Rail: fixed in ' || l_suppkey WHEN 3 THEN 'Ship ' || l_partkey || ': see there' END AS adv FROM l),
ol AS (SELECT l_orderkey AS o, string_agg('- ' || adv, chr(10) ORDER BY place) FILTER (WHERE place <= 5 AND adv IS NOT NULL) AS advisories, string_agg('part ' || l_partkey, ', ' ORDER BY place) FILTER (WHERE try <= 3) AS titles, count(try) AS tries, max(l_quantity::int) FILTER (WHERE l_returnflag = 'R' AND l_quantity >= 45) AS most FROM l2 GROUP BY 1),
w AS (SELECT *, concat_ws(chr(10) || chr(10), {_TITLED.format('Pages', f'substring(texts, 1, {SHOWN})')}, CASE WHEN tries > 0 THEN 'Tries:' || chr(10) || tries || ' in all, ' || titles END, CASE WHEN most IS NOT NULL THEN 'Confirmed:' || chr(10) || 'in the open, ' || most || ' at once' END, {_TITLED.format('Advisories', 'advisories')}) AS context, list_concat(own, CASE WHEN coalesce(products, '') = '' THEN []::varchar[] ELSE string_split(products, '|')[1:3] END) AS p FROM base LEFT JOIN ga USING (id) LEFT JOIN ol USING (o))
SELECT o AS "order", id, coalesce(own_weakness, string_split(weaknesses, '|')[1], '') AS weakness, array_to_string(list_filter(p, lambda x, i: list_position(p, x) = i)[1:{PRODUCTS}], '|') AS products, md5(context) AS context_md5, length(context)::int AS n_chars FROM w""",
    "pairs_profile": f"""WITH p AS ({_PROFILED}), n AS (SELECT count(*) AS n FROM p)
SELECT 'layer' AS section, layer AS name, count(*) AS n, round(100 * count(*) / (SELECT n FROM n)::double, 4) AS value FROM p GROUP BY layer
UNION ALL SELECT 'length', 'least', count(*), min(length(output))::double FROM p UNION ALL SELECT 'length', 'most', count(*), max(length(output))::double FROM p UNION ALL SELECT 'length', 'mean', count(*), round(avg(length(output)), 4) FROM p
UNION ALL SELECT 'empty', 'instruction', count(*) FILTER (WHERE trim(instruction) = ''), NULL FROM p UNION ALL SELECT 'empty', 'output', count(*) FILTER (WHERE trim(output) = ''), NULL FROM p
UNION ALL SELECT 'repeated', 'prefix', coalesce(sum(c - 1), 0)::bigint, NULL FROM (SELECT count(*) AS c FROM p GROUP BY substring(instruction, 1, 120), substring(output, 1, 120))""",
}
