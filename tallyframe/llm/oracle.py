"""DuckDB SQL for the queries that SQL can express."""

_OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < 100 OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes < 100 OR page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM r
"""

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_OP6 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
n AS (SELECT item_id, w, least(13, len(w)) AS size FROM b WHERE len(w) > 0),
v AS (SELECT DISTINCT item_id, size, list_aggregate(list_slice(w, i, i + size - 1), 'string_agg', ' ') AS words
      FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM n)),
z AS (SELECT DISTINCT size FROM n),
p AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, z),
o AS (SELECT doc_id, i, size, list_aggregate(list_slice(w, i, i + size - 1), 'string_agg', ' ') AS words FROM p),
m AS (SELECT o.doc_id, o.i, o.size, v.item_id FROM o JOIN v ON o.size = v.size AND o.words = v.words),
h AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS place FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""

_OP7 = """
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(verdict, rule_host, rule_path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
f AS (SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
      FROM h JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
SELECT h.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN f ON h.page_id = f.page_id
"""

_OP8 = """
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_aggregate(list_slice(w, i, i + 3), 'string_agg', ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * o >= 85 * (a.n + b.n - o)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS reached FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.reached = e.x)
SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(reached) AS component_id
FROM r LEFT JOIN n ON r.doc_id = n.doc_id GROUP BY r.doc_id
"""

_OP10 = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM e q JOIN e c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""

# The checksum of a run is the sum (XOR) of a value for each byte, which depends on the byte and its distance from the end, and of one for the length.
_OP12 = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
f AS (SELECT doc_id, unnest(w) AS feature FROM d
      UNION ALL SELECT doc_id, unnest(list_transform(list_zip(w[:-2], w[2:]), lambda x: x[1] || ' ' || x[2])) FROM d WHERE len(w) > 1),
g AS (SELECT unnest(w) AS feature FROM b
      UNION ALL SELECT unnest(list_transform(list_zip(w[:-2], w[2:]), lambda x: x[1] || ' ' || x[2])) FROM b WHERE len(w) > 1),
u AS MATERIALIZED (SELECT feature, hex(encode(feature)) AS h, strlen(feature) AS n FROM (SELECT feature FROM f UNION SELECT feature FROM g)),
start AS MATERIALIZED (
    SELECT b, list_reduce([CAST(b AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT range AS b FROM range(256))),
p(distance, b, c) AS (
    SELECT 0, b, c FROM start
    UNION ALL SELECT distance + 1, p.b, xor(p.c >> 8, s.c) FROM p JOIN start s ON s.b = p.c & 255 WHERE distance + 1 < (SELECT max(n) FROM u)),
z(n, c) AS (SELECT CAST(0 AS BIGINT), 4294967295 UNION ALL SELECT n + 1, xor(z.c >> 8, s.c) FROM z JOIN start s ON s.b = z.c & 255 WHERE n < (SELECT max(n) FROM u)),
i AS (SELECT feature, h, n, unnest(range(0, n)) AS place FROM u),
x AS (SELECT feature, any_value(i.n) AS n, bit_xor(p.c) AS c
      FROM i JOIN p ON p.distance = i.n - 1 - i.place
       AND p.b = 16 * (strpos('0123456789ABCDEF', substr(h, 2 * place + 1, 1)) - 1) + strpos('0123456789ABCDEF', substr(h, 2 * place + 2, 1)) - 1
      GROUP BY feature),
k AS MATERIALIZED (SELECT feature, xor(xor(x.c, z.c), 4294967295) % 10000 AS bucket FROM x JOIN z ON x.n = z.n),
s AS (SELECT bucket, count(*) AS s FROM f JOIN k USING (feature) GROUP BY bucket),
r AS (SELECT bucket, count(*) AS t FROM g JOIN k USING (feature) GROUP BY bucket),
a AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS s_all, (SELECT coalesce(sum(t), 0) FROM r) AS t_all),
gains AS (
    SELECT s.bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain
    FROM s LEFT JOIN r ON s.bucket = r.bucket CROSS JOIN a),
m AS (SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS total FROM f JOIN k USING (feature) JOIN gains USING (bucket) GROUP BY doc_id),
w AS (
    SELECT d.doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
           CAST(coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS BIGINT) AS weight,
           CAST('0x' || substr(sha256('7:' || d.doc_id), 1, 8) AS BIGINT) AS h
    FROM d LEFT JOIN m ON d.doc_id = m.doc_id),
v AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM w),
o AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM v WHERE n_words >= 20)
SELECT v.doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN CAST(place AS BIGINT) END AS rank
FROM v LEFT JOIN o ON v.doc_id = o.doc_id
"""

ORACLE = {"op2_archive": _OP2, "op6_decontamination": _OP6, "op7_url_rules": _OP7, "op8_near_copies": _OP8, "op10_top_vectors": _OP10, "op12_resampling": _OP12}
