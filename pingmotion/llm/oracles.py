"""DuckDB SQL of the operators that SQL can express, stated from their rules."""

NEAR = r"""
WITH RECURSIVE lists AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS list FROM documents),
words AS (SELECT doc_id, len(list) AS n, unnest(list) AS w, unnest(range(len(list))) AS i FROM lists),
runs AS (
  SELECT doc_id, n, i, concat_ws(' ', w, lead(w, 1) OVER p, lead(w, 2) OVER p, lead(w, 3) OVER p, lead(w, 4) OVER p) AS shingle
  FROM words WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
shingles AS (SELECT DISTINCT doc_id, shingle FROM runs WHERE i = 0 OR i <= n - 5),
sizes AS (SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * n >= 85 * (x.size + y.size - n)),
reach AS (
  SELECT doc_id, doc_id AS seen FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.seen),
named AS (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.size, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN named c USING (doc_id) LEFT JOIN sizes s USING (doc_id)
"""

WARC = r"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
first AS (SELECT html, min(page_id) AS first_id FROM payloads GROUP BY html)
SELECT page_id, strlen(p.html) AS payload_bytes,
  array_to_string(flatten(list_transform(range(8), lambda g: list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((CAST('0x' || substr(hex, CAST(5 * g + 1 AS BIGINT), 5) AS INTEGER) >> s) & 31) + 1)::BIGINT, 1)))), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM payloads p JOIN first f ON f.html = p.html
"""

MERKLE = r"""
WITH RECURSIVE now_text AS (
  SELECT *, CASE WHEN
      xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]),
          lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 2 = 0
    THEN replace(text, chr(10), '') ELSE text END AS now
  FROM documents),
fields AS (
  SELECT doc_id, source, text, now, concat(
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
    coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head
  FROM now_text),
leaf AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(now) || ':' || now, '-')) AS found FROM fields),
placed AS (
  SELECT *, row_number() OVER () AS row, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n FROM leaf),
nodes AS (
  SELECT source, 0 AS level, i, leaf AS h, n FROM placed
  UNION ALL
  SELECT source, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), max((n + 2) // 3) FROM nodes
  WHERE n > 1 GROUP BY source, level, i // 3),
subroots AS (
  SELECT source, h AS subroot, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS j, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
top AS (
  SELECT 0 AS level, j AS i, subroot AS h, n FROM subroots
  UNION ALL
  SELECT level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), max((n + 2) // 3) FROM top WHERE n > 1 GROUP BY level, i // 3),
runs AS (
  SELECT source, level, i // 3 AS run, list(h ORDER BY i) AS hs FROM nodes WHERE n > 1 GROUP BY ALL),
top_runs AS (SELECT level, i // 3 AS run, list(h ORDER BY i) AS hs FROM top WHERE n > 1 GROUP BY ALL),
up AS (
  SELECT row, source, 0 AS level, i, found AS h, '' AS proof FROM placed
  UNION ALL
  SELECT u.row, u.source, u.level + 1, u.i // 3,
    sha256(array_to_string(r.hs[: u.i % 3] || [u.h] || r.hs[u.i % 3 + 2 :], '')),
    u.proof || array_to_string(r.hs[: u.i % 3] || r.hs[u.i % 3 + 2 :], '')
  FROM up u JOIN runs r ON r.source IS NOT DISTINCT FROM u.source AND r.level = u.level AND r.run = u.i // 3),
over AS (
  SELECT u.row, 0 AS level, s.j AS i, u.h, u.proof FROM up u
  JOIN subroots s ON s.source IS NOT DISTINCT FROM u.source AND s.height = u.level
  UNION ALL
  SELECT u.row, u.level + 1, u.i // 3,
    sha256(array_to_string(r.hs[: u.i % 3] || [u.h] || r.hs[u.i % 3 + 2 :], '')),
    u.proof || array_to_string(r.hs[: u.i % 3] || r.hs[u.i % 3 + 2 :], '')
  FROM over u JOIN top_runs r ON r.level = u.level AND r.run = u.i // 3),
root AS (SELECT level, h AS root FROM top WHERE n = 1)
SELECT p.doc_id, p.leaf, s.subroot, r.root, sha256(o.proof) AS proof_sha256, o.h AS folded_root, o.h = r.root AS verified
FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source JOIN over o ON o.row = p.row JOIN root r ON r.level = o.level
"""

PHRASES = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, text FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS text
    FROM documents)),
words AS (
  SELECT lang, piece, unnest(list) AS w1, unnest(range(len(list))) AS i
  FROM (SELECT lang, piece, regexp_extract_all(text, '[^\x20\x09]+') AS list FROM pieces)),
runs AS (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM words
  WINDOW p AS (PARTITION BY piece ORDER BY i)),
f AS (
  SELECT lang, 1 AS m, w1 AS phrase, count(*) AS f FROM runs GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM runs WHERE w3 IS NOT NULL GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 10),
cuts AS (
  SELECT lang, m, phrase, a, 1 AS k, w[1] AS head, array_to_string(w[2:], ' ') AS rest FROM cand
  UNION ALL SELECT lang, m, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM cand WHERE m = 3),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, h.f AS l, r.f AS r,
    CAST((1000000::HUGEINT * c.a * c.a) // (h.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head AND h.m = c.k
  JOIN f r ON r.lang = c.lang AND r.phrase = c.rest AND r.m = c.m - c.k),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS i FROM scored) WHERE i = 1),
inside AS (
  SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM cand WHERE m = 3
  UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM cand WHERE m = 3),
covered AS (
  SELECT DISTINCT c.lang, c.phrase FROM cand c JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase
  WHERE 100 * i.a >= 50 * c.a),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN covered c ON b.lang = c.lang AND b.phrase = c.phrase WHERE c.phrase IS NULL)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

EXACT = r"""
WITH contents AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content FROM documents),
ordered AS (
  SELECT *, count(*) OVER (PARTITION BY content) AS group_size,
    row_number() OVER w AS i, first_value(doc_id) OVER w AS keep_id
  FROM contents WINDOW w AS (PARTITION BY content ORDER BY length(text) DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, i = 1 AS kept, sha256(content) AS text_sha256 FROM ordered
"""
