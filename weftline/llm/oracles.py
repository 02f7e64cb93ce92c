"""DuckDB SQL for the operators that SQL can express, over whole tables and texts.

The others have none: encoding, perfect hashing and packing (1, 7), trained
models (4, 5, 10), label propagation (9) and XXH64 (12), which DuckDB lacks.
Their tests compare with brute force instead.
"""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"'[^\x20\x09-\x0D]+'"
ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP2 = f"""WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({LOWER}, {WORD}) AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0),
sets AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_ FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * both_ >= 85 * (p.n + q.n - both_)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other),
parts AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d JOIN parts USING (doc_id) LEFT JOIN sizes USING (doc_id)"""

OP3 = """WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, (length(hex(encode(coalesce(text, '')))) // 2) AS n FROM documents),
starts AS (SELECT doc_id, h, unnest(range(0, n - 49)) AS p FROM docs WHERE n >= 50),
strings AS (SELECT doc_id, p, substring(h, 2 * p + 1, 100) AS s FROM starts),
least_ AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY 1 HAVING count(*) > 1),
hits AS (SELECT doc_id, p FROM strings JOIN least_ USING (s) WHERE doc_id > first),
spans AS (SELECT *, CASE WHEN p - lag(p) OVER w <= 50 THEN 0 ELSE 1 END AS new FROM hits WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS k FROM spans),
runs AS (SELECT doc_id, k, min(p) AS a, max(p) + 50 AS b FROM numbered GROUP BY 1, 2),
gaps AS (SELECT doc_id, k, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM runs WINDOW w AS (PARTITION BY doc_id ORDER BY k) UNION ALL SELECT doc_id, 1000000000, max(b), 1000000000 FROM runs GROUP BY 1),
kept AS (SELECT doc_id, string_agg(substring(h, 2 * a + 1, 2 * (least(b, n) - a)), '' ORDER BY k) AS kept FROM gaps JOIN docs USING (doc_id) GROUP BY 1),
sums AS (SELECT doc_id, sum(b - a)::bigint AS n_removed, count(*) AS n_spans FROM runs GROUP BY 1)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM docs LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)"""

OP6 = f"""WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORD}) AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM docs WHERE len(w) >= 50),
windows AS (SELECT doc_id, p, array_to_string(list_slice(w, p, p + 49), ' ') AS s FROM starts),
least_ AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY 1 HAVING count(*) > 1),
hits AS (SELECT doc_id, p FROM windows JOIN least_ USING (s) WHERE doc_id > first),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM hits),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM words w WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = w.doc_id AND g.i = w.i) GROUP BY 1)
SELECT doc_id, len(w)::bigint AS n_words, (len(w) - coalesce(n, 0))::bigint AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (doc_id)"""

OP8 = f"""WITH docs AS (SELECT doc_id, regexp_extract_all({LOWER}, {ALNUM}) AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all({LOWER}, {ALNUM}) AS w FROM benchmark),
tests AS (SELECT item_id, i, least(len(w), 10) AS m, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS s FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM tests),
windows AS (SELECT doc_id, p, m, array_to_string(list_slice(w, p, p + m - 1), ' ') AS s FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM docs, sizes WHERE len(w) >= m)),
hits AS (SELECT DISTINCT doc_id, p, m, item_id FROM windows JOIN tests USING (m, s)),
words AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS i FROM hits) GROUP BY 1),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::varchar, ',' ORDER BY item_id::varchar) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1),
pairs AS (SELECT DISTINCT doc_id, p, m, item_id, i FROM windows JOIN tests USING (m, s)),
runs AS (SELECT doc_id, min(p) - 1 AS longest_at, count(*) + min(m) - 1 AS longest_match FROM (SELECT *, p - row_number() OVER (PARTITION BY doc_id, item_id, p - i ORDER BY p) AS island FROM pairs) GROUP BY doc_id, item_id, p - i, island),
longest AS (SELECT doc_id, longest_match, longest_at FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY longest_match DESC, longest_at) = 1)
SELECT doc_id, coalesce(longest_match, 0)::bigint AS longest_match, coalesce(longest_at, -1)::bigint AS longest_at, len(w)::bigint AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN longest USING (doc_id)"""

#: integer inner products of all anchors with all rows
OP11 = """WITH vecs AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::double)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id AS id, list_dot_product(a.v, r.v)::bigint AS score FROM vecs a JOIN vecs r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
negatives AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score FROM positives p JOIN scores s USING (anchor_id) WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id))::int AS rank, negative_id, positive_score, negative_score FROM negatives
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) <= 3"""

#: crc32 bit by bit: DuckDB has no function for it
CRC = "xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)"

OP13 = f"""WITH turns AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT c, list({{'k': sha256(length(role)::varchar || ':' || role || text), 'n': octet_length(encode(text))}} ORDER BY turn NULLS FIRST, sha256(length(role)::varchar || ':' || role || text)) AS t FROM turns GROUP BY c),
heads AS (SELECT c, t, {CRC} % 9 AS h FROM lists),
rebuilt AS (SELECT x.c, list_concat(coalesce(s.t[1:x.h], []), x.t[x.h + 1:]) AS r FROM heads x LEFT JOIN lists s ON s.c = x.c - x.c % 5),
prefixes AS (SELECT c, d, list_transform(r[1:d], lambda x: x.k) AS p, len(r) = d AS whole, coalesce(r[d].n, 0) AS n_bytes FROM (SELECT c, r, unnest(range(0, len(r) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, any_value(n_bytes) AS n_bytes, string_agg(c::varchar, ',' ORDER BY c) FILTER (whole) AS ends FROM prefixes GROUP BY d, p),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
own AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (p)),
sums AS (SELECT p[1:k] AS p, sum((n_children = 0)::int)::bigint AS n_leaves, sum((n_convs - 1) * n_bytes)::bigint AS saved_tokens FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM own) GROUP BY 1)
SELECT o.conv_id, o.d AS depth, u.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves, saved_tokens, sha256(coalesce(o.ends, '')) AS ends_sha256
FROM own o JOIN sums USING (p) LEFT JOIN nodes u ON u.d = o.d - 1 AND u.p = o.p[1:o.d - 1]"""

ORACLES = {"op11_hard_negatives": OP11, "op13_prefix_trie": OP13, "op2_minhash": OP2, "op3_suffix_dedup": OP3, "op6_window_dedup": OP6, "op8_decontamination": OP8}
