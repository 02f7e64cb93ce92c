"""Queries that write a table in a foreign or stored form and read it again with the readers. Registered by `catalogue`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import fields as fd
from weftline.sources import readers, sinks
from weftline.sources.folders import new_folder
from weftline.streaming import streams


def lines(rows: DataFrame, name: str, per_file: int = 0) -> str:
    """Text rows as files of a new folder, with so many rows a file at most (0: any number)."""
    folder = new_folder(rows.sparkSession, name)
    rows.write.option("maxRecordsPerFile", per_file).text(folder)
    return folder


def json_array_scan(q) -> DataFrame:
    """Suppliers of each nation as one JSON array a file; the numbers come back as they went."""
    s = q("supplier")
    arrays = s.groupBy("s_nationkey").agg(F.to_json(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("value"))
    folder = lines(arrays.select("value"), "arrays")
    return readers.json_lines_of_arrays(s.sparkSession, folder, "s_suppkey long, s_name string")


def json_lines_scan(q) -> DataFrame:
    """Parts as JSON lines, every hundredth of which is broken and dropped."""
    part = q("part")
    good = F.to_json(F.struct("p_partkey", "p_size", "p_brand"))
    folder = lines(part.select(F.when(F.col("p_partkey") % 100 == 0, F.lit('{"p_partkey": broken')).otherwise(good).alias("value")), "lines")
    return readers.json_lines(part.sparkSession, folder, "p_partkey long, p_size int, p_brand string")


def wrapped_json_scan(q) -> DataFrame:
    """Records of a region under one of two wrapping keys."""
    n = q("nation")
    rows = F.collect_list(F.struct("n_nationkey", "n_name"))
    wrapped = n.groupBy("n_regionkey").agg(F.when(F.col("n_regionkey") % 2 == 0, F.to_json(F.struct(rows.alias("items")))).otherwise(F.to_json(F.struct(rows.alias("data")))).alias("value"))
    folder = lines(wrapped.select("value"), "wrapped", 1)  # a file is one object
    return readers.json_within(n.sparkSession, folder, ["items", "data"], readers.schema_of("n_nationkey long, n_name string"))


def csv_codes_scan(q) -> DataFrame:
    """A CSV file with a header and a column of codes, parted by semicolons."""
    o = q("orders").groupBy("o_custkey").agg(F.concat(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ";"), F.lit("; ")).alias("codes"))
    folder = new_folder(o.sparkSession, "csv")
    o.write.option("header", True).csv(folder)
    rows = readers.csv(o.sparkSession, folder, "o_custkey long, codes string", "codes")
    return rows.select("o_custkey", F.array_join("codes", ",").alias("codes"), F.size("codes").alias("n"))


def xml_scan(q) -> DataFrame:
    s = q("supplier").select("s_suppkey", "s_name", "s_acctbal")
    folder = new_folder(s.sparkSession, "xml")
    s.write.option("rowTag", "supplier").option("rootTag", "all").xml(folder)
    return readers.xml(s.sparkSession, folder, "supplier", readers.schema_of("s_suppkey long, s_name string, s_acctbal double"))


def vector_store(q) -> DataFrame:
    """A vector cache as compressed JSON lines, with name-based UUIDs and payloads; rows without an id are left out."""
    e = q("embeddings")
    ident = F.when(F.col("vec_id") % 10 > 0, fd.uuid5(F.concat(F.lit("vec-"), F.col("vec_id").cast("string"))))
    rows = e.select(ident.alias("id"), F.col("embedding").cast("array<double>").alias("values"), F.create_map(F.lit("vec_id"), F.col("vec_id").cast("string"), F.lit("label"), F.col("label").cast("string")).alias("metadata"))
    folder = new_folder(e.sparkSession, "vectors")
    sinks.vector_cache(rows, folder, 64)
    back = readers.vectors(e.sparkSession, folder)
    return back.select("id", F.col("metadata.vec_id").cast("long").alias("vec_id"), F.col("metadata.label").cast("int").alias("label"), F.size("values").alias("n"), F.round(F.get("values", F.lit(0)), 5).alias("first"))


def absent_appended(q) -> DataFrame:
    """Orders by customer and priority: those of a first run, and what a second run adds whose key is new."""
    o = q("orders")
    folder = new_folder(o.sparkSession, "absent")
    run = lambda status: o.filter(F.col("o_orderstatus") == status).groupBy("o_custkey", "o_orderpriority").agg(F.min("o_orderkey").alias("o_orderkey"))
    for status in ("F", "O"):
        sinks.append_absent(run(status), folder, ["o_custkey", "o_orderpriority"])
    return o.sparkSession.read.parquet(folder)


def upserted(q) -> DataFrame:
    """A table of customers' segments in which a later table's rows replace those of their key."""
    c = q("customer").select("c_custkey", "c_mktsegment")
    old, new = new_folder(c.sparkSession, "upsert"), new_folder(c.sparkSession, "upsert")
    sinks.overwrite(c, old)
    later = c.filter("c_custkey % 3 = 0").select((F.col("c_custkey") * 2).alias("c_custkey"), F.lit("MOVED").alias("c_mktsegment"))
    sinks.upsert(later, old, new, ["c_custkey"])
    return c.sparkSession.read.parquet(new)


def stale_tables(q) -> DataFrame:
    """Which users' tables are older than they may be: their last event against a time of reference."""
    last = q("events").groupBy("user_id").agg(F.max("ts").alias("updated_at"))
    manifest = last.select("user_id", F.when(F.col("user_id") % 9 > 0, F.col("updated_at")).alias("updated_at"), (F.col("user_id") % 5 * 6 + 1).alias("max_age_hours"))
    return readers.stale(manifest, "2024-01-30 00:00:00").select("user_id", "stale")


def stream_of_lines(q) -> DataFrame:
    """JSON lines as a stream, read to the end, broken lines dropped; a second run goes on where the first ended."""
    e = q("events").select("event_id", "user_id")
    spark = e.sparkSession
    source, state = new_folder(spark, "in"), new_folder(spark, "out")
    out = None
    for half in (0, 1):
        e.filter(F.col("event_id") % 2 == half).write.mode("append").json(source)
        stream = spark.readStream.schema("event_id long, user_id long").option("mode", "DROPMALFORMED").json(source)
        out = streams.drain(stream, folder=state)
    return out.groupBy("user_id").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("distinct"))


def ordered_fallback(q) -> DataFrame:
    """Nations from the first of four places that has any: one is missing, one broken, one empty, and the last wraps them in an object."""
    n = q("nation")
    spark, rows = n.sparkSession, F.collect_list(F.struct("n_nationkey", "n_name"))
    broken, none = (lines(spark.createDataFrame([(x,)], "value string"), "nations") for x in ('[{"n_nationkey": 1', "[]"))
    good = lines(n.agg(F.to_json(F.struct(rows.alias("data"))).alias("value")), "nations")
    return readers.first_of(spark, [new_folder(spark, "nations"), broken, none, good], ["items", "data"], readers.schema_of("n_nationkey long, n_name string"))


def capped_lines_scan(q) -> DataFrame:
    """The first fifty rows of JSON lines, in the order of the file."""
    part = q("part").filter("p_partkey < 1000")
    folder = lines(part.orderBy("p_partkey").coalesce(1).select(F.to_json(F.struct("p_partkey", "p_brand")).alias("value")), "lines")
    return readers.json_lines(part.sparkSession, folder, "p_partkey long, p_brand string", 50)


QUERIES = [ordered_fallback, capped_lines_scan, json_array_scan, json_lines_scan, wrapped_json_scan, csv_codes_scan, xml_scan, vector_store, absent_appended, upserted, stale_tables, stream_of_lines]

ORACLES = {
    "ordered_fallback": "SELECT n_nationkey::bigint AS n_nationkey, n_name FROM nation",
    "capped_lines_scan": "SELECT p_partkey, p_brand FROM part WHERE p_partkey < 1000 ORDER BY p_partkey LIMIT 50",
    "json_array_scan": "SELECT s_suppkey, s_name FROM supplier",
    "json_lines_scan": "SELECT p_partkey, p_size, p_brand FROM part WHERE p_partkey % 100 <> 0",
    "wrapped_json_scan": "SELECT n_nationkey::bigint AS n_nationkey, n_name FROM nation",
    "csv_codes_scan": "SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS codes, count(DISTINCT o_orderpriority)::int AS n FROM orders GROUP BY 1",
    "xml_scan": "SELECT s_suppkey, s_name, s_acctbal FROM supplier",
    "vector_store": """WITH h AS (SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || ('vec-' || vec_id)::blob) AS d FROM embeddings WHERE vec_id % 10 > 0)
SELECT d[1:8] || '-' || d[9:12] || '-5' || d[14:16] || '-' || ['8', '9', 'a', 'b'][('0x' || d[17:17])::int % 4 + 1] || d[18:20] || '-' || d[21:32] AS id, vec_id, label, len(embedding)::int AS n, round(embedding[1]::double, 5) AS first FROM h""",
    "absent_appended": "WITH r AS (SELECT o_custkey, o_orderpriority, o_orderstatus, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2, 3) SELECT o_custkey, o_orderpriority, o_orderkey FROM r QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderstatus) = 1",
    "upserted": "SELECT c_custkey, c_mktsegment FROM customer WHERE NOT (c_custkey % 6 = 0 AND c_custkey // 2 IN (SELECT c_custkey FROM customer)) UNION ALL SELECT c_custkey * 2, 'MOVED' FROM customer WHERE c_custkey % 3 = 0",
    "stale_tables": "SELECT user_id, user_id % 9 = 0 OR (epoch(TIMESTAMP '2024-01-30 00:00:00') - floor(epoch(max(ts)))) / 3600 > user_id % 5 * 6 + 1 AS stale FROM events GROUP BY 1",
    "stream_of_lines": "SELECT user_id, count(*) AS n, count(DISTINCT event_id) AS \"distinct\" FROM events GROUP BY 1",
}
