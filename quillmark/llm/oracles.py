"""DuckDB SQL for the registered queries that SQL can express; the others are tested against brute force or held-out rows."""

from __future__ import annotations

#: A-Z only; DuckDB's lower() would change other letters.
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
         FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, dwin.n, item_id FROM dwin JOIN win ON dwin.n = win.n AND dwin.s = win.s),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP5 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""

OP7 = rf"""
WITH l AS (SELECT doc_id, i, line, {_LOWER.format("trim(line, E' \\t\\n\\x0b\\f\\r')")} AS k
           FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), E'\n')) AS line, unnest(range(len(string_split(coalesce(text, ''), E'\n')))) AS i FROM documents)),
rep AS (SELECT k, max(doc_id) AS holder FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT l.*, rep.holder IS NULL OR rep.holder = doc_id AS kept FROM l LEFT JOIN rep USING (k))
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (NOT kept) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, E'\n' ORDER BY i) FILTER (kept), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

_HASH = "sha1(coalesce(html, ''))"
#: 160 bits as 32 letters: each five hexadecimal digits make four letters.
_BASE32 = "list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS BIGINT) + 1, 1)), 'string_agg', '')"

OP3 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, {_HASH} AS h, max(page_id) OVER (PARTITION BY {_HASH}) AS keeper FROM pages)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p
"""

OP4 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
links AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
r AS (SELECT doc_id, doc_id AS reach FROM d UNION SELECT r.doc_id, links.b FROM r JOIN links ON r.reach = links.a)
SELECT r.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(reach) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

_ESCAPED = "length({0}) + length(regexp_replace({0}, '[^\\\\<>]', '', 'g'))"

OP9 = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || E'\n' || text || E'\n', '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(16 + {_ESCAPED.format("role")} + {_ESCAPED.format("text")}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

#: CRC-32 of a number's decimal digits: each digit is taken in whole and shifted out bit by bit.
_CRC = "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"

OP11 = rf"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
v AS (SELECT c, {_CRC.format("c")} % 9 AS h, c - c % 5 AS b FROM (SELECT DISTINCT c FROM t)),
base AS (SELECT v.c, t.pos AS i, r, x FROM v JOIN t ON t.c = v.b WHERE t.pos < h),
hb AS (SELECT c, count(*) AS hb FROM base GROUP BY c),
own AS (SELECT v.c, coalesce(hb, 0) + t.pos - h AS i, r, x FROM v JOIN t USING (c) LEFT JOIN hb USING (c) WHERE t.pos >= h),
k AS (SELECT c, i, octet_length(encode(x)) AS b, sha256(string_agg(length(r) || ':' || r || length(x) || ':' || x, '') OVER (PARTITION BY c ORDER BY i)) AS k FROM (FROM base UNION ALL FROM own)),
pre AS (SELECT c, i + 1 AS d, k, lag(k, 1, '') OVER (PARTITION BY c ORDER BY i) AS pk, b FROM k UNION ALL SELECT c, 0, '', NULL, 0 FROM v),
node AS (SELECT d, k, any_value(pk) AS pk, min(c) AS m, count(*) AS n, max(b) AS b FROM pre GROUP BY d, k),
e AS (SELECT d, k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM pre JOIN (SELECT c, max(d) AS d FROM pre GROUP BY c) USING (c, d) GROUP BY d, k),
child AS (SELECT d - 1 AS d, pk AS k, count(*) AS nc FROM node WHERE d > 0 GROUP BY ALL),
own2 AS (SELECT node.*, coalesce(nc, 0) AS nc FROM node LEFT JOIN child USING (d, k)),
sub AS (SELECT a.d, a.k, count(*) FILTER (u.nc = 0) AS leaves, sum((u.n - 1) * u.b) AS saved FROM own2 u JOIN pre a ON a.c = u.m AND a.d <= u.d GROUP BY a.d, a.k)
SELECT o.m AS conv_id, CAST(o.d AS BIGINT) AS depth, p.m AS parent_conv_id, o.n AS n_convs, CAST(o.nc AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM own2 o JOIN sub USING (d, k) LEFT JOIN e USING (d, k) LEFT JOIN node p ON p.d = o.d - 1 AND p.k = o.pk
"""

SQL: dict[str, str] = {"op1_decontaminate": OP1, "op3_warc_index": OP3, "op4_ngram_join": OP4, "op5_topk": OP5, "op7_line_dedup": OP7, "op9_chat": OP9, "op11_prefix_trie": OP11}
