"""Queries on archives, arrays in files, and nested values with unknown keys; and draws by bytes. Registered by `catalogue`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators import sampling
from weftline.sources import archives, readers
from weftline.sources.folders import new_folder

#: members that are read of an archive; bytes to draw
MEMBERS, TARGET = 60, 400_000


def archived_pages(q) -> DataFrame:
    """Pages as JSON documents in archives, the first of each read back."""
    pages = q("pages")
    folder = new_folder(pages.sparkSession, "archives")
    rows = pages.select(F.concat(F.lit("pages-"), F.col("page_id") % 3).alias("archive"), F.concat(F.lpad(F.col("page_id").cast("string"), 9, "0"), F.lit(".json")).alias("member"), F.to_json(F.struct("page_id", "url", F.length("html").alias("n"))).alias("content"))
    archives.write_zips(rows, folder)
    back = archives.zip_members(pages.sparkSession, folder, MEMBERS, 25)
    return back.select("archive", "member", F.from_json(F.col("content").cast("string"), "page_id long, url string, n int").alias("r")).select("archive", "member", "r.*")


def zipped_catalogue(q) -> DataFrame:
    """A catalogue in XML, one document a region, within archives: nations and their suppliers' names."""
    n, s = q("nation"), q("supplier")
    one = F.concat(F.lit('<item id="'), F.col("s_suppkey").cast("string"), F.lit('"><name>'), F.col("s_name"), F.lit("</name></item>"))
    docs = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey", "n_name").agg(F.concat(F.lit("<catalogue>"), F.array_join(F.collect_list(one), ""), F.lit("</catalogue>")).alias("content"))
    folder = new_folder(s.sparkSession, "archives")
    archives.write_zips(docs.select(F.concat(F.lit("region-"), F.col("n_regionkey")).alias("archive"), F.concat("n_name", F.lit(".xml")).alias("member"), "content"), folder)
    back = archives.zip_members(s.sparkSession, folder)
    items = back.select("archive", "member", F.explode(F.from_xml(F.col("content").cast("string"), "item array<struct<_id: long, name: string>>")["item"]).alias("x"))
    return items.select("archive", "member", F.col("x._id").alias("s_suppkey"), F.col("x.name").alias("s_name"))


def json_array_written(q) -> DataFrame:
    """All parts in one JSON array, written by many tasks, replaced once, and read back."""
    part = q("part").select("p_partkey", "p_name", "p_retailprice")
    path = new_folder(part.sparkSession, "array") + ".json"
    archives.write_json_array(part.limit(3), path)
    archives.write_json_array(part.repartition(7), path)
    return readers.json_array(part.sparkSession, path, readers.schema_of("p_partkey long, p_name string, p_retailprice double"))


def drawn_to_bytes(q) -> DataFrame:
    """Documents drawn with replacement until 400,000 bytes, 85 % of draws from three tenths of them."""
    docs = q("documents").select("doc_id", F.octet_length("text").alias("size"), "source")
    return sampling.byte_target(docs, "doc_id", "size", F.col("doc_id") % 10 < 3, TARGET)


def as_text(rows: DataFrame, name: str) -> DataFrame:
    """JSON documents written as text files and read again as VARIANT values."""
    folder = new_folder(rows.sparkSession, name)
    rows.write.text(folder)
    return rows.sparkSession.read.text(folder).select(F.parse_json("value").alias("v"))


def tracker_rows(q) -> DataFrame:
    """A map of maps with unknown keys: supplier -> part -> states of its lines, as rows with the states parted."""
    lines = q("lineitem").filter("l_quantity >= 30")
    states = lines.groupBy("l_suppkey", "l_partkey").agg(F.map_from_entries(F.array_sort(F.array_distinct(F.collect_list(F.struct("l_returnflag", F.struct(F.when(F.col("l_returnflag") == "R", "resolved").otherwise("open").alias("status"))))))).alias("releases"))
    states = states.groupBy("l_suppkey").agg(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("PART-"), F.col("l_partkey")), F.struct("releases")))).alias("ids"))
    files = states.select(F.to_json(F.create_map(F.concat(F.lit("supplier-"), F.col("l_suppkey")), F.col("ids"))).alias("value"))
    as_text(files, "tracker").createOrReplaceTempView("weftline_tracker")
    found = files.sparkSession.sql("""SELECT p.key AS package, i.key AS id, r.key AS release, variant_get(r.value, '$.status', 'string') AS status FROM weftline_tracker t,
LATERAL variant_explode(t.v) p, LATERAL variant_explode(p.value) i, LATERAL variant_explode(variant_get(i.value, '$.releases', 'variant')) r""")
    of = lambda status: F.array_join(F.array_sort(F.collect_set(F.when(F.col("status") == status, F.col("release")))), ",")
    return found.groupBy("package", "id").agg(of("open").alias("affected"), of("resolved").alias("fixed"))


def profile_pairs(q) -> DataFrame:
    """Pairs from profiles, which are nested values: steps of chains, combinations of ties, of certain members, and certain with conditional ones."""
    part = q("part").filter("p_size <= 6")
    ranked = part.select("p_brand", F.struct("p_size", "p_partkey").alias("m")).groupBy("p_brand").agg(F.transform(F.array_sort(F.collect_list("m")), lambda m: m["p_partkey"]).alias("own"))
    item = lambda x: F.struct(x.alias("id"))
    profile = F.struct(
        F.lower("p_brand").alias("name"),
        F.transform(F.slice("own", 1, 4), item).alias("certain"),
        F.create_map(F.lit("a"), F.transform(F.slice("own", 5, 2), item), F.concat(F.lit("b "), F.col("p_brand")), F.transform(F.slice("own", 7, 2), item)).alias("conditional"),
        F.array(F.slice("own", 1, 3), F.slice("own", 4, 2)).alias("chains"),
        F.array(F.struct(F.lit("patch").alias("fix"), F.slice("own", 2, 4).alias("ids"))).alias("ties"),
    )
    profiles = as_text(ranked.select(F.to_json(profile).alias("value")), "profiles")
    ids = lambda path: F.try_variant_get("v", path, "array<struct<id:long>>")
    read = profiles.select(F.variant_get("v", "$.name", "string").alias("profile"), F.transform(ids("$.certain"), lambda x: x["id"]).alias("certain"), F.try_variant_get("v", "$.conditional", "map<string,array<struct<id:long>>>").alias("conditional"), F.try_variant_get("v", "$.chains", "array<array<long>>").alias("chains"), F.try_variant_get("v", "$.ties", "array<struct<fix:string,ids:array<long>>>").alias("ties"))
    pair = lambda a, b: F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    steps = lambda c: F.transform(F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))), lambda x, i: pair(x, F.get(c, i + 1)))
    two = lambda c: F.flatten(F.transform(c, lambda x, i: F.transform(F.slice(c, i + 2, F.size(c)), lambda y: pair(x, y))))
    conditional = F.transform(F.flatten(F.map_values("conditional")), lambda x: x["id"])
    kinds = {
        "chain": F.flatten(F.transform("chains", steps)),
        "tie": F.flatten(F.transform("ties", lambda t: two(t["ids"]))),
        "certain": two(F.col("certain")),
        "conditional": F.flatten(F.transform("certain", lambda x: F.transform(F.filter(conditional, lambda y: y != x), lambda y: pair(x, y)))),
    }
    made = F.flatten(F.array(*(F.transform(c, tagged(name)) for name, c in kinds.items())))
    return read.select("profile", F.explode(made).alias("x")).select("x.source", "x.a", "x.b", "profile").groupBy("source", "a", "b").agg(F.min("profile").alias("profile"))


def tagged(source: str):
    return lambda p: F.struct(F.lit(source).alias("source"), p["a"].alias("a"), p["b"].alias("b"))


QUERIES = [archived_pages, zipped_catalogue, json_array_written, drawn_to_bytes, tracker_rows, profile_pairs]

ORACLES = {
    "archived_pages": f"SELECT 'pages-' || page_id % 3 AS archive, lpad(page_id::varchar, 9, '0') || '.json' AS member, page_id, url, length(html)::int AS n FROM pages QUALIFY row_number() OVER (PARTITION BY page_id % 3 ORDER BY page_id) <= {MEMBERS}",
    "zipped_catalogue": "SELECT 'region-' || n_regionkey AS archive, n_name || '.xml' AS member, s_suppkey, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "json_array_written": "SELECT p_partkey, p_name, p_retailprice FROM part",
    "drawn_to_bytes": f"""WITH d AS (SELECT doc_id, octet_length(encode(text)) AS size, doc_id % 10 < 3 AS p FROM documents WHERE octet_length(encode(text)) > 0),
pools AS (SELECT *, true AS priority, row_number() OVER (ORDER BY doc_id) - 1 AS place, count(*) OVER () AS n FROM d WHERE p UNION ALL SELECT *, false, row_number() OVER (ORDER BY doc_id) - 1, count(*) OVER () FROM d),
draws AS (SELECT i AS draw, ('0x' || md5('draws|' || i || '|pool')[1:8])::bigint < {int(0.85 * 2**32)} AS priority, ('0x' || md5('draws|' || i || '|row')[1:12])::bigint AS u FROM range(1, {TARGET}) t(i)),
made AS (SELECT draw, doc_id, size, draws.priority FROM draws JOIN pools ON pools.priority = draws.priority AND place = u % n)
SELECT draw, doc_id, size, priority FROM (SELECT *, sum(size) OVER (ORDER BY draw) - size AS before FROM made) WHERE before < {TARGET}""",
    "tracker_rows": "SELECT 'supplier-' || l_suppkey AS package, 'PART-' || l_partkey AS id, coalesce(string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) FILTER (WHERE l_returnflag <> 'R'), '') AS affected, coalesce(string_agg(DISTINCT l_returnflag, ',') FILTER (WHERE l_returnflag = 'R'), '') AS fixed FROM lineitem WHERE l_quantity >= 30 GROUP BY 1, 2",
    "profile_pairs": """WITH m AS (SELECT lower(p_brand) AS profile, p_partkey AS k, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS r FROM part WHERE p_size <= 6),
j AS (SELECT x.profile, least(x.k, y.k) AS a, greatest(x.k, y.k) AS b, x.r AS i, y.r AS j FROM m x JOIN m y ON x.profile = y.profile AND x.r < y.r),
u AS (SELECT 'chain' AS source, * FROM j WHERE j = i + 1 AND (j <= 3 OR i = 4) UNION ALL SELECT 'tie', * FROM j WHERE i >= 2 AND j <= 5 UNION ALL SELECT 'certain', * FROM j WHERE j <= 4 UNION ALL SELECT 'conditional', * FROM j WHERE i <= 4 AND j BETWEEN 5 AND 8)
SELECT source, a, b, min(profile) AS profile FROM u GROUP BY 1, 2, 3""",
}
