"""Queries that flatten foreign records: aliases, nested values, dates, lookups. Registered by `catalogue`.

`feed` writes the parts as JSON records of three kinds, as three publishers
would: other field names, other date notations, other wrappings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.functions import fields as fd
from weftline.functions import text as tx
from weftline.operators import pairs as p

RECORD = """cveID string, cve_id string, id string, cve struct<id:string>, dateAdded string, date_added string, published string,
knownRansomwareCampaignUse string, ransomware string, is_ransomware string, vendorProject string, vendor string, vendor_name string,
descriptions array<struct<lang:string,value:string>>, weaknesses array<struct<lang:string,value:string>>,
v31 array<struct<score:double,severity:string>>, v30 array<struct<score:double,severity:string>>, v2 array<struct<score:double,severity:string>>,
cpes array<string>, aliases array<string>, fix string, advice string, status string"""


def feed(q) -> DataFrame:
    """One JSON record per part."""
    k, size, brand = F.col("p_partkey"), F.col("p_size"), F.col("p_brand")
    own = F.concat(F.lit("CVE-"), (F.lit(2000) + size % 25).cast("string"), F.lit("-"), k.cast("string"))
    day = F.date_add(F.lit("2010-01-01").cast("date"), (k % 3650).cast("int"))
    kind, name = k % 3, F.replace(F.lower("p_name"), F.lit(" "), F.lit("_"))
    cpe = lambda part, product: F.concat(F.lit(f"cpe:2.3:{part}:"), F.lower(brand), F.lit(":"), product, F.lit(":1."), size.cast("string"))
    metric = F.array(F.struct((F.col("p_retailprice") % 10).alias("score"), F.upper(F.substring("p_type", 1, 3)).alias("severity")))
    value = lambda lang, x: F.struct(F.lit(lang).alias("lang"), x.alias("value"))
    weak = F.concat(F.lit("CWE-"), (size * 3).cast("string"))
    record = F.struct(
        F.when(kind == 0, own).alias("cveID"),
        F.when(kind == 1, own).alias("cve_id"),
        F.when(kind == 2, F.when(k % 5 == 0, F.lit("unassigned")).otherwise(own)).alias("id"),
        F.when((kind == 2) & (k % 5 == 0), F.struct(own.alias("id"))).alias("cve"),
        F.when(kind == 0, F.date_format(day, "yyyy-MM-dd")).alias("dateAdded"),
        F.when(kind == 1, F.date_format(day, "MM/dd/yyyy")).alias("date_added"),
        F.when(kind == 2, F.when(k % 7 == 0, F.lit("soon")).otherwise(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T06:30:00.000Z")))).alias("published"),
        F.when(kind == 0, F.when(size < 10, "Known").otherwise("Unknown")).alias("knownRansomwareCampaignUse"),
        F.when(kind == 1, F.when(size < 10, "true").otherwise("false")).alias("ransomware"),
        F.when(kind == 2, F.when(size < 10, "YES").otherwise("")).alias("is_ransomware"),
        F.when(kind == 0, brand).alias("vendorProject"),
        F.when(kind == 1, F.concat(F.lit("  "), brand)).alias("vendor"),
        F.when(kind == 2, brand).alias("vendor_name"),
        F.array(value("fr", F.lit("-")), value("en", F.col("p_name"))).alias("descriptions"),
        F.when(size % 4 > 0, F.array(value("es", F.lit("otra")), value("en", weak))).alias("weaknesses"),
        F.when(size % 3 == 0, metric).alias("v31"),
        F.when(size % 3 == 1, metric).alias("v30"),
        F.when(size % 3 < 2, F.array(F.struct(F.lit(1.0).alias("score"), F.lit("OLD").alias("severity")))).otherwise(F.when(size % 2 == 0, metric)).alias("v2"),
        F.array(cpe("a", name), cpe("o", F.lit("*")), cpe("a", F.concat(name, F.lit("_pro"))), cpe("a", name), F.lit("cpe:/short")).alias("cpes"),
        F.array(own, F.when(size % 2 == 0, F.concat(F.lit("GHSA-"), k.cast("string"))), F.lit(""), own).alias("aliases"),
        F.when(size % 5 == 0, F.lit(" ")).when(size % 5 == 1, F.concat(F.lit("Update "), F.col("p_name"))).alias("fix"),
        F.when(size % 2 == 1, F.concat(F.lit("Mandate "), brand)).alias("advice"),
        F.when(size % 6 == 0, "Deprecated").when(size % 6 == 1, "revoked").otherwise("Stable").alias("status"),
    )
    return q("part").select("p_partkey", F.to_json(record).alias("raw"))


def records(q) -> DataFrame:
    return feed(q).select("p_partkey", F.from_json("raw", RECORD).alias("r")).select("p_partkey", "r.*")


def record_id():
    return F.coalesce(fd.first_filled(F.col("cveID"), F.col("cve_id"), F.col("id"), prefix="CVE-"), fd.first_filled(F.col("cve.id"), prefix="CVE-"))


def alias_fields(q) -> DataFrame:
    """Id, date, flag and vendor of records with other field names each; the id may be nested."""
    seen = fd.parsed_time(fd.first_filled(F.col("dateAdded"), F.col("date_added"), F.col("published")))
    flag = fd.tri_state(F.col("knownRansomwareCampaignUse"), F.col("ransomware"), F.col("is_ransomware"))
    vendor = F.lower(fd.first_filled(F.col("vendorProject"), F.col("vendor"), F.col("vendor_name")))
    return records(q).select("p_partkey", record_id().alias("id"), fd.id_year(record_id()).alias("id_year"), F.date_format(seen, "yyyy-MM-dd").alias("day"), flag.alias("flag"), vendor.alias("vendor"))


def latest_day_less_lookback(q) -> DataFrame:
    """Where an incremental read of records with mixed date notations starts: the latest day less three."""
    seen = fd.parsed_time(fd.first_filled(F.col("dateAdded"), F.col("date_added"), F.col("published")))
    return records(q).agg(F.date_sub(F.max(seen).cast("date"), 3).cast("string").alias("start_date"), F.count_if(seen.isNull()).alias("unknown"))


def flat_records(q) -> DataFrame:
    """First English description and weakness, the metric of the newest version, its severity spelt alike."""
    metric = fd.by_precedence(F.col("v31"), F.col("v30"), F.col("v2"))
    return records(q).select("p_partkey", fd.in_language(F.col("descriptions")).alias("description"), fd.in_language(F.col("weaknesses")).alias("weakness"), F.round(metric["score"], 4).alias("score"), F.initcap(metric["severity"]).alias("severity"))


def product_keys(q) -> DataFrame:
    """Products of platform names: distinct components, vendor:product, and the namespaced key."""
    first = F.get(F.col("cpes"), F.lit(0))
    return records(q).select("p_partkey", F.array_join(fd.products_of(F.col("cpes")), ",").alias("products"), fd.product_of(first).alias("vendor_product"), fd.product_of(F.element_at("cpes", -1)).alias("too_short"), fd.namespaced(F.get(F.split(first, ":"), F.lit(4))).alias("software"))


def advisory_flat(q) -> DataFrame:
    """Distinct aliases in order, the text of the fix by fallback, and a line of what is filled."""
    fix = F.coalesce(fd.filled(F.col("fix")), F.concat(F.lit("By order: "), fd.filled(F.col("advice"))), F.lit("No fix is known."))
    ids = fd.merged_ids(F.array(record_id()), F.col("aliases"))
    return records(q).select("p_partkey", F.array_join(ids, ",").alias("ids"), fix.alias("fix_text"), fd.joined(F.col("fix"), F.col("advice"), F.col("status")).alias("line"))


def codes_within_records(q) -> DataFrame:
    """Codes wherever they stand in a record's nested values."""
    found = fd.codes_within(r"CWE-[0-9]+", F.col("weaknesses"), F.col("descriptions"))
    return records(q).select("p_partkey", F.array_join(found, ",").alias("codes")).filter("codes <> ''")


def active_records(q) -> DataFrame:
    """Records whose id has the right prefix and whose status is not withdrawn."""
    return records(q).filter(~F.col("status").isin("Deprecated", "Obsolete", "revoked") & F.col("id").startswith("CVE-")).select("p_partkey", "status")


def id_formats(q) -> DataFrame:
    """Whether a request's id has one of the known forms, and what to answer if not."""
    asked = F.upper(F.trim(F.coalesce("cveID", "cve_id", "id")))
    kind = F.when(asked.rlike(r"^CVE-[0-9]{4}-[0-9]{1,7}$"), "entity").when(asked.rlike(r"^CWE-[0-9]+$"), "weakness").otherwise("error")
    return records(q).groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def graph_rows(q) -> DataFrame:
    """Rows for a property graph: one per entity and product, ids in capitals, numbers cast, text cut."""
    metric = fd.by_precedence(F.col("v31"), F.col("v30"), F.col("v2"))
    rows = records(q).select(F.upper(F.trim(record_id())).alias("id"), F.explode(fd.products_of(F.col("cpes"), 2)).alias("software"), F.substring(fd.in_language(F.col("descriptions")), 1, 5).alias("description"), metric["score"].cast("string").try_cast("double").alias("score"))
    return rows.select("id", F.lower("software").alias("software"), fd.display_name(F.col("software")).alias("name"), "description", F.round("score", 4).alias("score"))


def payloads(q) -> DataFrame:
    """What a vector store keeps of a record: bounded lists, short texts, clamped scores, a name-based UUID."""
    metric = fd.by_precedence(F.col("v31"), F.col("v30"), F.col("v2"))
    ids = fd.merged_ids(F.array(record_id()), F.col("aliases"))
    rows = records(q).select("p_partkey", record_id().alias("id"), F.array_join(fd.bounded_list(ids, 1, 6), ",").alias("ids"), F.substring(F.coalesce(fd.in_language(F.col("descriptions")), F.lit("unknown")), 1, 8).alias("summary"), F.round(fd.clamp(metric["score"] / 10, 0.0, 0.5), 4).alias("likelihood"))
    return rows.withColumn("point", fd.uuid5(F.col("id")))


IMPACTS = {"Brand#1": "payment fraud", "Brand#2": "loss of service", "Brand#3": "theft of records"}
CONTROLS = {"CWE-3": "input checks", "CWE-6": "output encoding", "CWE-9": "session limits"}
PLAYBOOKS = {"Brand#1": ("replay", 2), "Brand#2": ("flood", 1)}


def mapped_texts(q) -> DataFrame:
    """Texts by category, by code or else category, and a plan with its number of steps; each with a default."""
    at = lambda m, key: F.element_at(F.create_map(*(F.lit(x) for pair in m.items() for x in pair)), key)
    weak, brand = fd.in_language(F.col("weaknesses")), fd.first_filled(F.col("vendorProject"), F.col("vendor"), F.col("vendor_name"))
    plan = F.create_map(*(x for k, (name, n) in PLAYBOOKS.items() for x in (F.lit(k), F.struct(F.lit(name).alias("name"), F.lit(n).alias("steps")))))
    return records(q).select("p_partkey", F.coalesce(at(IMPACTS, brand), F.lit("unclear")).alias("impact"), F.coalesce(at(CONTROLS, weak), at(IMPACTS, brand), F.lit("general hardening")).alias("control"), F.coalesce(F.element_at(plan, brand)["name"], F.lit("survey")).alias("plan"), F.coalesce(F.element_at(plan, brand)["steps"], F.lit(0)).alias("steps"))


def alias_lookup(q) -> DataFrame:
    """Of all records that name an id among their aliases, the first with a description wins."""
    size = F.get(F.split(F.get(F.col("cpes"), F.lit(0)), r"\."), F.lit(2))
    ids = fd.merged_ids(F.col("aliases"), F.array(F.concat(F.lit("SIZE-"), size)))
    named = records(q).select("p_partkey", F.explode(ids).alias("alias"), fd.filled(F.col("fix")).alias("fix"))
    return p.first_writer(named.filter("fix is not null"), ["alias"], ["p_partkey"]).select("alias", "p_partkey", "fix")


def years_of_records(q) -> DataFrame:
    year = fd.id_year(record_id())
    return records(q).agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.countDistinct(year).alias("years"))


QUERIES = [alias_fields, latest_day_less_lookback, flat_records, product_keys, advisory_flat, codes_within_records, active_records, id_formats, graph_rows, payloads, mapped_texts, alias_lookup, years_of_records]

#: what the records say, from the parts themselves
BASE = """b AS (SELECT p_partkey, p_partkey % 3 AS kind, p_size AS size, p_brand AS brand, p_name AS name, replace(lower(p_name), ' ', '_') AS product, 'CVE-' || (2000 + p_size % 25) || '-' || p_partkey AS id,
DATE '2010-01-01' + (p_partkey % 3650)::int AS day, CASE WHEN p_size % 4 > 0 THEN 'CWE-' || (p_size * 3) END AS weak,
CASE WHEN p_size % 3 < 2 OR p_size % 2 = 0 THEN round(p_retailprice % 10, 4) END AS score, CASE WHEN p_size % 3 < 2 OR p_size % 2 = 0 THEN upper(p_type[1]) || lower(p_type[2:3]) END AS severity,
CASE WHEN p_size % 5 = 1 THEN 'Update ' || p_name END AS fix, CASE WHEN p_size % 2 = 1 THEN 'Mandate ' || p_brand END AS advice,
CASE WHEN p_size % 6 = 0 THEN 'Deprecated' WHEN p_size % 6 = 1 THEN 'revoked' ELSE 'Stable' END AS status,
CASE WHEN p_size % 2 = 0 THEN 'GHSA-' || p_partkey END AS other FROM part)"""
KNOWN_DAY = "CASE WHEN kind = 2 AND p_partkey % 7 = 0 THEN NULL ELSE day END"


def _case(column: str, m: dict, default: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in m.items()) + f" ELSE {default} END"


_quoted = lambda m: {k: f"'{v}'" for k, v in m.items()}
ORACLES = {
    "alias_fields": f"WITH {BASE} SELECT p_partkey, id, (2000 + size % 25)::int AS id_year, strftime({KNOWN_DAY}, '%Y-%m-%d') AS day, size < 10 AS flag, lower(brand) AS vendor FROM b",
    "latest_day_less_lookback": f"WITH {BASE} SELECT (max({KNOWN_DAY}) - 3)::date::varchar AS start_date, count(*) FILTER (WHERE {KNOWN_DAY} IS NULL) AS unknown FROM b",
    "flat_records": f"WITH {BASE} SELECT p_partkey, name AS description, weak AS weakness, score, severity FROM b",
    "product_keys": f"WITH {BASE} SELECT p_partkey, product || ',' || product || '_pro' AS products, lower(brand) || ':' || product AS vendor_product, NULL::varchar AS too_short, 'sw:' || product AS software FROM b",
    "advisory_flat": f"WITH {BASE} SELECT p_partkey, concat_ws(',', id, other) AS ids, coalesce(fix, 'By order: ' || advice, 'No fix is known.') AS fix_text, concat_ws(' | ', fix, advice, status) AS line FROM b",
    "codes_within_records": f"WITH {BASE} SELECT p_partkey, weak AS codes FROM b WHERE weak IS NOT NULL",
    "active_records": f"WITH {BASE} SELECT p_partkey, status FROM b WHERE status = 'Stable' AND kind = 2 AND p_partkey % 5 <> 0",
    "id_formats": f"WITH {BASE} SELECT CASE WHEN kind = 2 AND p_partkey % 5 = 0 THEN 'error' ELSE 'entity' END AS kind, count(*) AS n FROM b GROUP BY 1",
    "graph_rows": f"WITH {BASE}, s AS (SELECT id, unnest([product, product || '_pro']) AS software, substring(name, 1, 5) AS description, score FROM b) SELECT id, software, list_reduce(list_transform(string_split(replace(software, '_', ' '), ' '), lambda x: upper(x[1]) || lower(x[2:])), lambda x, y: x || ' ' || y) AS name, description, score FROM s",
    "mapped_texts": f"WITH {BASE} SELECT p_partkey, {_case('brand', _quoted(IMPACTS), chr(39) + 'unclear' + chr(39))} AS impact, coalesce({_case('weak', _quoted(CONTROLS), 'NULL')}, {_case('brand', _quoted(IMPACTS), 'NULL')}, 'general hardening') AS control, {_case('brand', {k: repr(v[0]) for k, v in PLAYBOOKS.items()}, chr(39) + 'survey' + chr(39))} AS plan, {_case('brand', {k: v[1] for k, v in PLAYBOOKS.items()}, '0')} AS steps FROM b",
    "alias_lookup": f"WITH {BASE}, n AS (SELECT p_partkey, unnest([id, other, 'SIZE-' || size]) AS alias, fix FROM b WHERE fix IS NOT NULL) SELECT alias, p_partkey, fix FROM n WHERE alias IS NOT NULL QUALIFY row_number() OVER (PARTITION BY alias ORDER BY p_partkey) = 1",
    "years_of_records": f"WITH {BASE} SELECT (2000 + min(size % 25))::int AS first_year, (2000 + max(size % 25))::int AS last_year, count(DISTINCT size % 25) AS years FROM b",
    # the version and variant digits are set on the SHA-1 of the name space and the name
    "payloads": f"""WITH {BASE}, h AS (SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || id::blob) AS d FROM b)
SELECT p_partkey, id, substring(id, 1, 6) AS ids, substring(name, 1, 8) AS summary, round(greatest(0.0::double, least(0.5::double, score / 10)), 4) AS likelihood,
d[1:8] || '-' || d[9:12] || '-5' || d[14:16] || '-' || ['8', '9', 'a', 'b'][('0x' || d[17:17])::int % 4 + 1] || d[18:20] || '-' || d[21:32] AS point FROM h""",
}
