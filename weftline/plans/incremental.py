"""Queries that go on where an earlier run has ended: streams with state, and tables of versions. Registered by `catalogue`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans import texts
from weftline.sources import versions
from weftline.sources.folders import new_folder, stored
from weftline.streaming import state, streams

#: chunks a source and in all, in the order of sources
QUOTAS, TOTAL = {"document": 1200, "turns": 60, "relation": 260}, 1500
#: requests in a window, and its seconds
MOST, SECONDS = 3, 2 * 86400
LATE_DAYS, EARLIER = 7, "1996-06-01"


def in_two_runs(rows: DataFrame, first: str, name: str, again: bool = False):
    """A folder that grows in two steps, as a stream: first the rows that meet a condition, then the others (or all, if again)."""
    spark, source = rows.sparkSession, new_folder(rows.sparkSession, name)
    for part in (rows.filter(first), rows if again else rows.filter(f"not ({first})")):
        part.write.mode("append").parquet(source)
        yield spark.readStream.schema(rows.schema).parquet(source)


def evidence_stream(q) -> DataFrame:
    """Evidence emitted in two runs: the second sees all chunks, emits those not seen yet, and reaches quotas and total."""
    rows = stored(texts.evidence_rows(q), "evidence")
    folder, out = new_folder(rows.sparkSession, "emitted"), None
    for stream in in_two_runs(rows, "key % 3 = 0", "chunks", again=True):
        out = state.emit(stream, folder, QUOTAS, TOTAL)
    return out


def rate_limit_stream(q) -> DataFrame:
    """Requests of users in windows that open with their first request, over a stream that is read in two runs."""
    e = q("events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    folder, out = new_folder(e.sparkSession, "limited"), None
    with state.keyed_state(e.sparkSession):
        for stream in in_two_runs(e, "ts < timestamp '2024-01-15 12:00:00'", "requests"):
            out = streams.drain(state.limited(stream, "user_id", "event_id", "ts", MOST, SECONDS), folder=folder)
    return out.select(F.col("request").alias("event_id"), F.col("who").alias("user_id"), "opened", "n", "allowed")


def near_in_time_stream(q) -> DataFrame:
    """Views and purchases of one user within a day of each other, joined as two streams."""
    e = streams.as_stream(q("events"))
    side = lambda kind, name: e.filter(F.col("event_type") == kind).select("user_id", "ts", F.col("event_id").alias(name))
    return streams.drain(streams.co_window(side("view", "view_id"), side("purchase", "purchase_id"), "user_id", 1).select("view_id", "purchase_id"))


def late_rows_merged(q) -> DataFrame:
    """Customers' last orders, merged in two runs and a third that repeats the second; rows a week behind the high-water mark are refused."""
    o = q("orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"), F.lit(1).cast("long").alias("n_merged"))
    table, key, order, rules = new_folder(o.sparkSession, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], {"n_merged": "sum"}
    out = None
    for stream in in_two_runs(o, f"o_orderdate < timestamp '{EARLIER}' and o_orderkey % 4 > 0", "orders"):
        out = versions.merge_stream(stream, table, key, order, rules, LATE_DAYS)
    # the last batch comes again, as after a failure: its number is in the table, so nothing changes
    versions.merge(o, table, key, order, rules, ("stream", 1), LATE_DAYS)
    return out.select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "n_merged")


def graph_upsert(q) -> DataFrame:
    """Edges of suppliers and parts merged into a table in two runs: the best score, all flags, the first order."""
    lines = q("lineitem").select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b"), F.col("l_discount").alias("score"), F.array("l_returnflag").alias("flags"), F.when(F.col("l_linenumber") > 1, F.col("l_orderkey")).alias("first_order"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("place"))
    table, out = new_folder(lines.sparkSession, "edges"), None
    for stream in in_two_runs(lines, "place % 200 < 100", "lines"):
        out = versions.merge_stream(stream, table, ["a", "b"], ["place"], {"score": "max", "flags": "union", "first_order": "first", "place": "min"})
    return out.select("a", "b", "score", F.array_join("flags", ",").alias("flags"), "first_order")


QUERIES = [evidence_stream, rate_limit_stream, near_in_time_stream, late_rows_merged, graph_upsert]

_SEEN = "row_number() OVER (PARTITION BY source_type ORDER BY batch, key, chunk_no)"
ORACLES = {
    "evidence_stream": f"""WITH RECURSIVE {texts.EVIDENCE}, s AS (SELECT *, (key % 3 <> 0)::int AS batch, list_position({list(QUOTAS)}, source_type) AS place FROM rows_),
k AS (SELECT * FROM s QUALIFY {_SEEN} <= {texts.sql_quotas(QUOTAS)})
SELECT source_type, key, chunk_no, chunk_id, n_chars, batch FROM k QUALIFY row_number() OVER (ORDER BY batch, place, key, chunk_no) <= {TOTAL}""",
    "rate_limit_stream": f"""WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events),
n AS (SELECT a.user_id, a.r, a.t, min(b.r) AS nxt FROM e a LEFT JOIN e b ON b.user_id = a.user_id AND b.t > a.t + {SECONDS}::bigint * 1000000 GROUP BY 1, 2, 3),
w(user_id, r, t, nxt) AS (SELECT user_id, r, t, nxt FROM n WHERE r = 1 UNION ALL SELECT n.user_id, n.r, n.t, n.nxt FROM w JOIN n ON n.user_id = w.user_id AND n.r = w.nxt)
SELECT e.event_id, e.user_id, w.t AS opened, e.r - w.r + 1 AS n, e.r - w.r + 1 <= {MOST} AS allowed FROM e JOIN w ON w.user_id = e.user_id AND e.r >= w.r AND (w.nxt IS NULL OR e.r < w.nxt)""",
    "near_in_time_stream": "SELECT v.event_id AS view_id, p.event_id AS purchase_id FROM events v JOIN events p ON v.event_type = 'view' AND p.event_type = 'purchase' AND v.user_id = p.user_id AND p.ts BETWEEN v.ts - INTERVAL 1 DAY AND v.ts + INTERVAL 1 DAY",
    "late_rows_merged": f"""WITH one AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{EARLIER}' AND o_orderkey % 4 > 0), two AS (SELECT * FROM orders WHERE NOT (o_orderdate < TIMESTAMP '{EARLIER}' AND o_orderkey % 4 > 0) AND o_orderdate >= (SELECT max(o_orderdate) - INTERVAL {LATE_DAYS} DAY FROM one)),
u AS (SELECT *, 0 AS run FROM one UNION ALL SELECT *, 1 FROM two)
SELECT o_custkey, max_by(o_orderkey, (run, o_orderdate, o_orderkey)) AS o_orderkey, strftime(max_by(o_orderdate, (run, o_orderdate, o_orderkey)), '%Y-%m-%d') AS o_orderdate, count(*) AS n_merged FROM u GROUP BY 1""",
    "graph_upsert": "SELECT l_suppkey AS a, l_partkey AS b, max(l_discount) AS score, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags, min_by(l_orderkey, (l_orderkey % 2, l_orderkey, l_linenumber)) FILTER (WHERE l_linenumber > 1) AS first_order FROM lineitem GROUP BY 1, 2",
}
