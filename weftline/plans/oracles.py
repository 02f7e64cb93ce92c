"""DuckDB SQL for the rows of each query of the catalogue."""

from __future__ import annotations

MEMBERS = "members AS (SELECT 'brand' AS signal, p_brand AS key, p_partkey AS entity FROM part UNION ALL SELECT 'type', p_type, p_partkey FROM part)"
WEIGHTS = """sizes AS (SELECT signal, key, count(DISTINCT entity) AS n FROM members GROUP BY ALL),
total AS (SELECT count(DISTINCT entity) AS total FROM members),
weights AS (SELECT signal, key, n, CASE WHEN n <= 1 THEN 1.0::double ELSE greatest(0.1::double, least(1.0::double, ln(total / n) / CASE WHEN total > 1 THEN ln(total) ELSE 1.0::double END)) END AS weight FROM sizes, total)"""
COMENTIONS = """baskets AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
co AS (SELECT x.l_partkey AS a, y.l_partkey AS b, count(*) AS n FROM baskets x JOIN baskets y ON x.l_orderkey = y.l_orderkey AND x.l_partkey < y.l_partkey GROUP BY 1, 2)"""
SOURCES = COMENTIONS + """, alike_ AS (SELECT a, b, p.p_brand = r.p_brand AS brand, p.p_size = r.p_size AS size FROM co JOIN part p ON p.p_partkey = a JOIN part r ON r.p_partkey = b),
evidence AS (SELECT a, b, 'order' AS source, 0.45::double AS confidence, 3 AS prio FROM alike_ UNION ALL SELECT a, b, 'brand', 0.6::double, 1 FROM alike_ WHERE brand UNION ALL SELECT a, b, 'size', 0.4::double, 2 FROM alike_ WHERE size)"""
EDGES = COMENTIONS + """, edges AS (SELECT a, b, 'ordered' AS rel, n / (n + 1)::double AS score FROM co
UNION ALL SELECT p.p_partkey, r.p_partkey, 'alike', 0.4::double FROM part p JOIN (SELECT * FROM part QUALIFY row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_partkey) <= 500) r USING (p_brand, p_size) WHERE p.p_partkey < r.p_partkey),
both_ways AS (SELECT a, b, rel, score FROM edges UNION ALL SELECT b, a, rel, score FROM edges)"""
WHOLE_EDGES = COMENTIONS + """, edges AS (SELECT a, b, 'ordered' AS rel, n / (n + 1)::double AS score FROM co
UNION ALL SELECT p.p_partkey, r.p_partkey, 'alike', 0.4::double FROM part p JOIN part r USING (p_brand, p_size) WHERE p.p_partkey < r.p_partkey),
both_ways AS (SELECT a, b, rel, score FROM edges UNION ALL SELECT b, a, rel, score FROM edges)"""
LINE_EDGES = "rows_ AS (SELECT -1 - l_suppkey AS a, l_partkey AS b, l_discount AS score, l_returnflag AS flag, l_orderkey, l_linenumber FROM lineitem)"
PAIRED = "paired AS (SELECT least(a, b) AS x, greatest(a, b) AS y, score, flag, l_orderkey, l_linenumber FROM rows_ WHERE a <> b)"
SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
TURNS = "turns AS (SELECT u.conv_id, a.turn, u.text AS instruction, a.text AS output FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' WHERE u.role = 'user')"
CLEAN = r"trim(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '[^\x00-\x7F]+', '', 'g'))"
NEAREST = """scored AS (SELECT q.vec_id AS query, q.label AS query_label, e.vec_id, e.label, round(list_cosine_similarity(e.embedding::double[], q.embedding::double[]), 6) AS cosine FROM embeddings e JOIN embeddings q ON q.vec_id % 100 = 0 AND e.vec_id <> q.vec_id),
near AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY cosine DESC, vec_id) AS rank FROM scored QUALIFY rank <= 10)"""
RECALLS = NEAREST + ", recalls AS (SELECT query, query_label, " + ", ".join(f"round(count(*) FILTER (WHERE label = query_label AND rank <= {k}) / {k}::double, 6) AS recall_{k}" for k in (3, 5, 10)) + " FROM near GROUP BY 1, 2)"
UNITS = "units AS (SELECT doc_id, generate_subscripts(parts, 1) - 1 AS pos, unnest(parts) AS part FROM (SELECT doc_id, {split} AS parts FROM documents))"
TWO_HOPS = """hop1 AS (SELECT b AS via, max(CASE WHEN score <= 0 THEN 0.0 WHEN score <= 1 THEN score ELSE score / (1 + score) END) AS s1 FROM {edges} WHERE a = 1 GROUP BY 1),
paths AS (SELECT via, e.b AS target, s1 * (CASE WHEN score <= 0 THEN 0.0 WHEN score <= 1 THEN score ELSE score / (1 + score) END) * 0.75::double AS score FROM hop1 JOIN {edges} e ON e.a = via WHERE e.b <> 1 AND e.b NOT IN (SELECT via FROM hop1)),
hop2 AS (SELECT target, via, score FROM paths QUALIFY row_number() OVER (PARTITION BY target ORDER BY score DESC, via) = 1)"""
FUSED = EDGES + ", ordered AS (SELECT * FROM both_ways WHERE rel = 'ordered'), " + TWO_HOPS.format(edges="ordered") + """,
best1 AS (SELECT b, max(score) AS score FROM ordered WHERE a = 1 GROUP BY b ORDER BY 2 DESC, 1 LIMIT 25),
graph AS (SELECT b AS key, round(score, 6) AS graph_score, 1 AS hop FROM best1 UNION ALL SELECT target, round(score, 6), 2 FROM hop2),
vectors AS (SELECT e.vec_id + 1 AS key, greatest(0.0, round(list_cosine_similarity(e.embedding::double[], q.embedding::double[]), 6)) AS vector_score FROM embeddings e JOIN embeddings q ON q.vec_id = 0 AND e.vec_id <> 0 ORDER BY round(list_cosine_similarity(e.embedding::double[], q.embedding::double[]), 6) DESC, e.vec_id LIMIT 20),
fused AS (SELECT coalesce(g.key, v.key) AS key, round(greatest(0.0, least(1.0, coalesce(round(CASE hop WHEN 1 THEN graph_score * 0.88::double WHEN 2 THEN graph_score * 0.55::double END, 3), 0.0) + coalesce(vector_score * 0.35::double, 0.0))), 6) AS likelihood, CASE WHEN hop = 1 THEN 'direct' ELSE 'inferred' END AS evidence FROM graph g FULL JOIN vectors v ON g.key = v.key)"""

ORACLES: dict[str, str] = {
    "shared_signal_topk": f"""WITH {MEMBERS}, {WEIGHTS},
capped AS (SELECT * FROM members QUALIFY row_number() OVER (PARTITION BY signal, key ORDER BY entity) <= 500),
scored AS (SELECT m.entity AS a, c.entity AS b, round(sum(weight), 6) AS score, string_agg(DISTINCT m.signal, ',' ORDER BY m.signal) AS signals FROM members m JOIN capped c USING (signal, key) JOIN weights USING (signal, key) WHERE m.entity <> c.entity GROUP BY 1, 2)
SELECT a, b, score, signals, count(*) OVER (PARTITION BY a) AS candidates, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS rank FROM scored QUALIFY rank <= 20""",
    "idf_weights": f"WITH {MEMBERS}, {WEIGHTS} SELECT signal, key, n, round(weight, 6) AS weight FROM weights",
    "capped_group_members": f"WITH {MEMBERS} SELECT * FROM members QUALIFY row_number() OVER (PARTITION BY signal, key ORDER BY entity) <= CASE WHEN signal = 'brand' THEN 500 ELSE 700 END",
    "recency_decay": "SELECT o_orderkey, CASE WHEN 2000 - year(o_orderdate) <= 1 THEN 1.0::double WHEN 2000 - year(o_orderdate) <= 3 THEN 0.85::double WHEN 2000 - year(o_orderdate) <= 5 THEN 0.65::double ELSE 0.5::double END AS decay FROM orders",
    "supplier_bridge_pairs": """WITH used AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)
SELECT x.l_partkey AS a, y.l_partkey AS b, count(DISTINCT l_suppkey) AS n_suppliers FROM used x JOIN used y USING (l_suppkey) WHERE x.l_partkey < y.l_partkey GROUP BY 1, 2""",
    "group_members_reference_caps": f"WITH {MEMBERS} SELECT * FROM members QUALIFY row_number() OVER (PARTITION BY signal, key ORDER BY entity) <= CASE WHEN signal = 'brand' THEN 500 ELSE 700 END",
    "bridge_pairs_reference_cap": """WITH used AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem), c AS (SELECT * FROM used QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) <= 400)
SELECT x.l_partkey AS a, y.l_partkey AS b, count(DISTINCT l_suppkey) AS n_suppliers FROM c x JOIN c y USING (l_suppkey) WHERE x.l_partkey < y.l_partkey GROUP BY 1, 2""",
    "pairs_per_group_reference_caps": """WITH used AS (SELECT * FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) <= 20),
sizes AS (SELECT l_suppkey, count(*) * (count(*) - 1) // 2 AS n FROM used GROUP BY 1), kept AS (SELECT l_suppkey FROM sizes QUALIFY sum(n) OVER (ORDER BY n DESC, l_suppkey ROWS UNBOUNDED PRECEDING) <= 600000)
SELECT l_suppkey, x.l_partkey AS a, y.l_partkey AS b FROM used x JOIN used y USING (l_suppkey) JOIN kept USING (l_suppkey) WHERE x.l_partkey < y.l_partkey""",
    "source_quota_reference": "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 150000",
    "temporal_pairs_30d": """SELECT x.o_custkey AS "by", x.o_orderkey AS a, y.o_orderkey AS b, abs(date_diff('day', x.o_orderdate::date, y.o_orderdate::date))::int AS days FROM orders x JOIN orders y ON x.o_custkey = y.o_custkey AND x.o_orderkey < y.o_orderkey WHERE abs(date_diff('day', x.o_orderdate::date, y.o_orderdate::date)) <= 30""",
    "sliding_30d_count": "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey ORDER BY date_diff('day', DATE '1970-01-01', o_orderdate::date) RANGE BETWEEN 30 PRECEDING AND 30 FOLLOWING) AS n_near FROM orders",
    "comention_pairs": f"WITH {COMENTIONS} SELECT * FROM co",
    "pair_support_confidence_lift": f"""WITH {COMENTIONS}, single AS (SELECT l_partkey, count(*) AS n FROM baskets GROUP BY 1), total AS (SELECT count(DISTINCT l_orderkey) AS total FROM baskets)
SELECT a, b, co.n, round(co.n / x.n::double, 6) AS confidence, round(co.n * total / (x.n * y.n)::double, 6) AS lift FROM co JOIN single x ON x.l_partkey = a JOIN single y ON y.l_partkey = b, total""",
    "noisy_or_merge": f"WITH {SOURCES} SELECT a, b, CASE WHEN count(*) = 1 THEN max(confidence) ELSE round(least(1 - product(1 - confidence), 0.99::double), 3) END AS confidence, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(*) AS n_rows FROM evidence GROUP BY 1, 2",
    "precedence_first_writer": f"WITH {SOURCES} SELECT a, b, source, round(least(1.0::double, confidence + CASE WHEN source = 'brand' THEN 0.1::double ELSE 0.0::double END), 3) AS confidence FROM evidence QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY prio) = 1",
    "capped_pairs_per_group": """WITH used AS (SELECT * FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) <= 20),
sizes AS (SELECT l_suppkey, count(*) * (count(*) - 1) // 2 AS n FROM used GROUP BY 1), kept AS (SELECT l_suppkey FROM sizes QUALIFY sum(n) OVER (ORDER BY n DESC, l_suppkey ROWS UNBOUNDED PRECEDING) <= 600000)
SELECT l_suppkey, x.l_partkey AS a, y.l_partkey AS b FROM used x JOIN used y USING (l_suppkey) JOIN kept USING (l_suppkey) WHERE x.l_partkey < y.l_partkey""",
    "chain_adjacent_lead": "SELECT o_custkey, o_orderkey, row_number() OVER w AS position, lead(o_orderkey) OVER w AS next_key, count(*) OVER (PARTITION BY o_custkey) AS length FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)",
    "iso_week_buckets": "SELECT isoyear(ts) || '-W' || lpad(week(ts)::varchar, 2, '0') AS week, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1 HAVING count(*) >= 2",
    "flag_bucket": "SELECT 'error' AS bucket, count(*) AS n, count(DISTINCT user_id) AS users, min(event_id) AS first_id FROM events WHERE event_type = 'error'",
    "ordered_rule_bucket": "SELECT CASE WHEN contains(lower(p_type), 'brass') THEN 'brass' WHEN contains(lower(p_type), 'steel') THEN 'steel' WHEN contains(lower(p_type), 'small') THEN 'small' WHEN contains(lower(p_type), 'large') THEN 'large' ELSE 'type_' || substring(replace(lower(p_type), ' ', '_'), 1, 30) END AS bucket, count(*) AS n FROM part GROUP BY 1 HAVING count(*) >= 2",
    "path_two_hop": """WITH e AS (SELECT x.n_nationkey::varchar AS src, y.n_nationkey::varchar AS dst, CASE WHEN x.n_nationkey < y.n_nationkey THEN 0.8::double ELSE 0.85::double END AS confidence FROM nation x JOIN nation y USING (n_regionkey) WHERE x.n_nationkey <> y.n_nationkey AND abs(x.n_nationkey - y.n_nationkey) <= 10)
SELECT src, NULL::varchar AS mid, dst, confidence, 1 AS hops FROM e UNION ALL SELECT a.src, a.dst, b.dst, round(a.confidence * b.confidence, 3), 2 FROM e a JOIN e b ON a.dst = b.src WHERE b.dst <> a.src""",
    "path_two_hop_parts": """WITH l AS (SELECT l_partkey, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS nxt, l_quantity FROM lineitem),
e AS (SELECT l_partkey::varchar AS src, nxt::varchar AS dst, max(CASE WHEN l_quantity = 50 THEN 0.85::double ELSE 0.8::double END) AS confidence FROM l WHERE l_quantity >= 48 AND nxt <> l_partkey GROUP BY 1, 2)
SELECT src, NULL::varchar AS mid, dst, confidence, 1 AS hops FROM e UNION ALL SELECT a.src, a.dst, b.dst, round(a.confidence * b.confidence, 3), 2 FROM e a JOIN e b ON a.dst = b.src WHERE b.dst <> a.src""",
    "chain_join_distinct": "SELECT x.p_partkey AS trigger_key, min(y.p_partkey) AS related, y.p_size AS related_size FROM part x JOIN part y ON x.p_brand = y.p_brand AND y.p_size = x.p_size + 1 GROUP BY 1, 3",
    "wide_enrichment": """WITH spend AS (SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS max_price FROM orders GROUP BY 1), items AS (SELECT o_custkey, count(*) AS n_items, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1)
SELECT c_custkey, n_name, r_name, coalesce(n_orders, 0) AS n_orders, max_price, coalesce(n_items, 0) AS n_items, coalesce(n_returned, 0) AS n_returned, concat_ws(' + ', 'customer', CASE WHEN n_orders IS NOT NULL THEN 'orders' END, CASE WHEN n_items IS NOT NULL THEN 'items' END) AS provenance
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN spend s ON s.o_custkey = c_custkey LEFT JOIN items i ON i.o_custkey = c_custkey""",
    "anti_join_pass": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL)",
    "append_if_absent": "SELECT o_custkey, o_orderpriority, min(o_orderkey) AS o_orderkey FROM orders o WHERE o_orderstatus <> 'F' AND NOT EXISTS (SELECT 1 FROM orders f WHERE f.o_orderstatus = 'F' AND f.o_custkey = o.o_custkey AND f.o_orderpriority = o.o_orderpriority) GROUP BY 1, 2",
    "keyed_upsert_last_wins": "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
    "high_water_mark": "SELECT (max(o_orderdate)::date - 7)::varchar AS start_date FROM orders",
    "band_case": "SELECT CASE WHEN p_retailprice IS NULL THEN 'Unknown' WHEN p_retailprice / 200 >= 9 THEN 'Critical' WHEN p_retailprice / 200 >= 7 THEN 'High' WHEN p_retailprice / 200 >= 4 THEN 'Medium' ELSE 'Low' END AS band, count(*) AS n FROM part GROUP BY 1",
    "code_category_map": "SELECT coalesce(r_name, 'Unknown') AS category, count(*) AS n FROM customer LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey < 3) ON c_nationkey = n_nationkey GROUP BY 1",
    "canonical_edge_max": f"WITH {LINE_EDGES}, {PAIRED} SELECT x AS a, y AS b, max(score) AS score, arg_min(flag, (l_orderkey, l_linenumber)) AS labels FROM paired GROUP BY 1, 2",
    "edge_array_union": f"WITH {LINE_EDGES}, {PAIRED} SELECT x AS a, y AS b, max(score) AS score, string_agg(DISTINCT flag, ',' ORDER BY flag) AS labels FROM paired GROUP BY 1, 2",
    "node_coalesce_first": "SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_type, arg_min(value, (ts, event_id)) FILTER (WHERE event_type = 'purchase') AS first_purchase FROM events GROUP BY 1",
    "graph_neighbors": f"WITH {EDGES} SELECT b, round(raw, 6) AS score, rel FROM (SELECT b, score AS raw, rel FROM both_ways WHERE a = 1 QUALIFY row_number() OVER (PARTITION BY b ORDER BY score DESC, rel DESC) = 1) ORDER BY raw DESC, b LIMIT 25",
    "graph_two_hop": f"WITH {EDGES}, {TWO_HOPS.format(edges='both_ways')} SELECT target, via, round(score, 6) AS score FROM hop2",
    "graph_mixed_topk": f"""WITH {EDGES}, own AS (SELECT b, rel, round(score, 6) AS score FROM both_ways WHERE a = 1),
ranked AS (SELECT *, CASE WHEN rel = 'alike' AND row_number() OVER (PARTITION BY rel ORDER BY score DESC, b) <= 2 THEN 0 ELSE 1 END AS tier FROM own)
SELECT b, rel, score, tier FROM (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY b ORDER BY tier, score DESC, rel) = 1) ORDER BY tier, score DESC, b LIMIT 12""",
    "optional_match_coalesce": f"WITH {WHOLE_EDGES}, best AS (SELECT a, max(round(score, 6)) AS edge_score, count(*) AS degree FROM both_ways GROUP BY 1) SELECT p_partkey, coalesce(edge_score, round(p_size / 100::double, 6), 0.0) AS score, coalesce(degree, 0) AS degree FROM part LEFT JOIN best ON p_partkey = a",
    "tiered_lookup": f"""WITH {EDGES}, me AS (SELECT * FROM part WHERE p_partkey = 7),
t1 AS (SELECT b AS key, round(score, 6) AS likelihood, 1 AS tier FROM both_ways WHERE a = 7 AND rel = 'alike' ORDER BY 2 DESC, 1 LIMIT 12),
t2 AS (SELECT p_partkey AS key, round(least(0.6::double, 2 * (p_retailprice / 10000) + 0.3::double), 6) AS likelihood, 2 AS tier FROM part WHERE p_partkey <> 7 AND p_type IN (SELECT p_type FROM me) ORDER BY 2 DESC, 1 LIMIT 12),
t3 AS (SELECT p_partkey AS key, round(least(0.4::double, p_retailprice / 10000 + 0.2::double), 6) AS likelihood, 3 AS tier FROM part WHERE p_partkey <> 7 AND p_brand IN (SELECT p_brand FROM me) ORDER BY 2 DESC, 1 LIMIT 12),
all_ AS (SELECT * FROM (SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3) QUALIFY row_number() OVER (PARTITION BY key ORDER BY tier) = 1),
two AS (SELECT * FROM all_ WHERE tier <> 2 OR (SELECT count(*) FROM all_ WHERE tier < 2) < 5),
three AS (SELECT * FROM two WHERE tier <> 3 OR (SELECT count(*) FROM two WHERE tier < 3) < 3)
SELECT key, likelihood, tier FROM three ORDER BY tier, likelihood DESC, key LIMIT 12""",
    "cluster_siblings": "SELECT x.p_partkey, count(DISTINCT y.p_partkey) AS siblings, min(y.p_partkey) AS first_sibling FROM part x JOIN part y USING (p_brand, p_size) WHERE x.p_partkey <> y.p_partkey GROUP BY 1",
    "graph_dq_counts": f"WITH {LINE_EDGES}, p AS (SELECT flag AS rel, least(a, b) AS x, greatest(a, b) AS y, count(*) AS n FROM rows_ GROUP BY ALL) SELECT rel, sum(n)::bigint AS edges, sum(CASE WHEN x = y THEN n ELSE 0 END)::bigint AS self_loops, count(*) FILTER (WHERE n > 1) AS repeated_pairs FROM p GROUP BY 1",
    "coverage_ratios": f"WITH {WHOLE_EDGES}, l AS (SELECT a, max((rel = 'ordered')::int) AS o, max((rel = 'alike')::int) AS k FROM both_ways GROUP BY 1) SELECT count(*) AS n, round(avg(coalesce(o, 0)), 6) AS ordered_share, round(avg(coalesce(k, 0)), 6) AS alike_share FROM part LEFT JOIN l ON p_partkey = a",
    "text_search": "SELECT p_partkey, p_name, p_retailprice FROM part WHERE contains(upper(p_name), 'RED') OR contains(upper(p_type), 'BRASS') ORDER BY p_retailprice DESC, p_partkey LIMIT 20",
    "regex_extract_ids": "SELECT doc_id, " + ", ".join(f"coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all(text, '{x}'))), '|'), '') AS {name}" for name, x in {"emails": r"[a-z0-9._]+@[a-z0-9.]+\.com", "urls": r"https?://[a-zA-Z0-9./_-]+", "numbers": r"[0-9]{4,}"}.items()) + " FROM documents",
    "sentence_pairs": "WITH " + UNITS.format(split=r"regexp_split_to_array(text, '[.\n]')") + ", found AS (SELECT doc_id, pos, regexp_extract_all(part, '[0-9]{2,}') AS ids FROM units) SELECT doc_id, pos::int AS pos, ids[1] AS a, list_filter(ids, lambda x: x <> ids[1])[1] AS b FROM found WHERE len(list_distinct(ids)) >= 2",
    "paragraph_pairs": "WITH " + UNITS.format(split=r"string_split(text, chr(10))") + ", ids AS (SELECT DISTINCT doc_id, pos, unnest(regexp_extract_all(part, '[0-9]{2,}')) AS id FROM units) SELECT x.id AS a, y.id AS b, count(DISTINCT x.doc_id) AS n_docs FROM ids x JOIN ids y ON x.doc_id = y.doc_id AND x.pos = y.pos AND x.id < y.id GROUP BY 1, 2",
    "html_strip": r"WITH p AS (SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS plain FROM pages) SELECT page_id, length(plain)::int AS n_chars, md5(plain) AS plain_md5 FROM p",
    "text_clean": f"SELECT doc_id, md5({CLEAN}) AS clean_md5, length({CLEAN})::int AS n_clean FROM documents",
    "fixed_chunks": "WITH c AS (SELECT doc_id, text, unnest(range(0, greatest(length(text), 1), 780)) AS start FROM documents) SELECT doc_id, (start // 780)::int AS chunk_no, md5(substring(text, start::bigint + 1, 900)) AS chunk_md5 FROM c",
    "group_consecutive": "WITH r AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 10 AS group_no FROM documents) SELECT source, group_no, count(*) AS n, sum(n_chars)::bigint AS chars, min(doc_id) AS first_doc FROM r GROUP BY 1, 2",
    "source_quota": "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 150000",
    "sha_id": "SELECT doc_id, substring(sha1(concat_ws('|', source, lang, text)), 1, 20) AS chunk_id FROM documents",
    "vector_topk": f"WITH {NEAREST} SELECT query, vec_id, cosine FROM near",
    "hybrid_fusion": f"WITH {FUSED} SELECT * FROM fused",
    "confidence_top5": f"WITH {FUSED} SELECT round(avg(likelihood), 3) AS confidence FROM (SELECT likelihood FROM fused ORDER BY likelihood DESC, key LIMIT 5)",
    "review_policy": """WITH s AS (SELECT l_suppkey AS entity, count(*) FILTER (WHERE l_returnflag = 'R' AND l_quantity > 45) AS direct, count(*) FILTER (WHERE l_returnflag = 'N' AND l_quantity > 40) AS inferred, round(avg(l_discount) * 9, 3) AS overall, round(max(l_discount) * 6, 3) AS top3,
CASE WHEN count(*) FILTER (WHERE l_quantity > 44) % 2 = 0 THEN 'graph,vector' ELSE 'graph,text' END AS sources, CASE WHEN count(*) FILTER (WHERE l_quantity > 44) % 3 > 0 THEN 'entity' ELSE 'weakness' END AS kind FROM lineitem GROUP BY 1),
r AS (SELECT *, concat_ws(',', CASE WHEN inferred > direct THEN 'inferred_dominates' END, CASE WHEN overall < 0.45 THEN 'low_confidence' END, CASE WHEN sources = 'graph,vector' AND direct = 0 THEN 'sources_disagree' END, CASE WHEN kind = 'entity' AND direct < 2 AND top3 < 0.55 THEN 'weak_support' END) AS reasons FROM s) SELECT *, reasons <> '' AS required FROM r""",
    "template_pairs": "SELECT p_partkey, 'What is known about ' || p_name || '?' AS instruction, 'Brand ' || p_brand || ', type ' || p_type || ', price ' || round(p_retailprice, 0)::bigint::varchar || '.' AS output FROM part",
    "quality_filter": rf"WITH {TURNS} SELECT conv_id, turn FROM turns WHERE length(trim(output)) >= 80 AND output <> instruction AND NOT regexp_matches(output, '^[\sNA/.:-]*$')",
    "dedup_prefix": f"WITH {TURNS} SELECT conv_id, turn FROM turns QUALIFY row_number() OVER (PARTITION BY substring(trim(instruction, {SPACE}), 1, 150), substring(trim(output, {SPACE}), 1, 200) ORDER BY conv_id, turn) = 1",
    "cap_per_output": f"WITH {TURNS} SELECT conv_id, turn FROM turns QUALIFY row_number() OVER (PARTITION BY substring(trim(output, {SPACE}), 1, 300) ORDER BY conv_id, turn) <= 5",
    "dedup_instruction_output": f"WITH {TURNS} SELECT conv_id, turn FROM turns QUALIFY row_number() OVER (PARTITION BY substring(trim(instruction, {SPACE}), 1, 150), substring(trim(output, {SPACE}), 1, 200) ORDER BY conv_id, turn) = 1",
    "cap_per_output_300": f"WITH {TURNS} SELECT conv_id, turn FROM turns QUALIFY row_number() OVER (PARTITION BY substring(trim(output, {SPACE}), 1, 300) ORDER BY conv_id, turn) <= 5",
    "entity_split": "WITH s AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1), r AS (SELECT *, sum(n) OVER (ORDER BY md5(conv_id::varchar), conv_id ROWS UNBOUNDED PRECEDING) - n AS before, sum(n) OVER () AS total FROM s) SELECT conv_id, n, CASE WHEN before < total * 0.1::double THEN 'eval' ELSE 'train' END AS side FROM r",
    "layer_histogram_share": "SELECT source, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share, count(*) < 40 AS thin FROM documents GROUP BY 1",
    "length_stats_p95": "WITH t AS (SELECT ceil(n_chars / 2.7::double)::bigint AS tokens FROM documents), r AS (SELECT tokens, row_number() OVER (ORDER BY tokens) AS i, count(*) OVER () AS n FROM t) SELECT max(n) AS n, round(avg(tokens), 6) AS mean, max(tokens) FILTER (WHERE i = floor(n * 0.95::double) + 1) AS at_share, max(tokens) AS most FROM r",
    "issue_counts": f"""WITH {TURNS}, m AS (SELECT *, row_number() OVER (PARTITION BY substring(instruction, 1, 120), substring(output, 1, 120) ORDER BY conv_id, turn) > 1 AS again, (length(instruction) + length(output)) / 2.7::double AS tokens FROM turns)
SELECT count(*) AS n, count(*) FILTER (WHERE trim(output) = '') AS empty_output, count(*) FILTER (WHERE length(output) < 80) AS short_output, count(*) FILTER (WHERE tokens > 4096) AS over_limit, count(*) FILTER (WHERE tokens > 4096 * 0.9::double) AS near_limit, count(*) FILTER (WHERE again) AS duplicates FROM m""",
    "field_coverage": " UNION ALL ".join(f"SELECT '{c}' AS field, round(avg(CASE WHEN {c} IS NOT NULL AND {c}::varchar <> '' THEN 1.0::double ELSE 0.0::double END), 6) AS covered FROM documents" for c in ("text", "lang", "source", "n_chars")),
    "recall_at_k": f"WITH {RECALLS} SELECT * FROM recalls",
    "eval_grouping_sets": f"WITH {RECALLS} SELECT query_label, count(*) AS n, round(avg(recall_10), 6) AS recall_10, grouping(query_label)::int AS overall FROM recalls GROUP BY ROLLUP (query_label)",
    "decontaminate": f"SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE lower({CLEAN.replace('text', 'b.text')}) = lower({CLEAN.replace('text', 'd.text')}))",
    "json_props": "SELECT event_type, count(*) AS n, sum(json_extract(props, '$.k')::int)::bigint AS sum_k, max(json_extract(props, '$.k')::int) AS max_k FROM events GROUP BY 1",
    "weighted_oversample": "SELECT doc_id, quality, unnest(range(1, CASE WHEN quality = 1 THEN 4 ELSE 2 END))::int AS copy FROM labels WHERE quality IS NOT NULL",
    "tumbling_window": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "session_window": """WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > 3600000000 THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::bigint AS session FROM g) SELECT user_id, session, count(*) AS n, min(event_id) AS least_id FROM s GROUP BY 1, 2""",
    "rate_limit_window": "SELECT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 4",
    "asof_join": "WITH v AS (SELECT user_id, ts, max(event_id) AS view_id FROM events WHERE event_type = 'view' GROUP BY 1, 2) SELECT b.event_id, v.view_id AS as_of_view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') b ASOF LEFT JOIN v ON b.user_id = v.user_id AND b.ts >= v.ts",
    "cube_rollup": "SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(max(o_totalprice), 2) AS top FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)",
    "stream_daily_counts": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "stream_latest_per_user": "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, count(*) AS n FROM events GROUP BY 1",
}
