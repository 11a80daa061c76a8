"""DuckDB text for the queries that SQL expresses over whole tables."""

from __future__ import annotations

from carelens.llm.native import LOWER, UPPER

_LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

OP4 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[j : j + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS j FROM i WHERE len(w) > 0) x),
dw AS (SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p
             FROM d, (SELECT DISTINCT n FROM iw) s WHERE len(w) >= n) x),
h AS (SELECT doc_id, p, n, item_id FROM dw JOIN iw USING (n, win)),
c AS (SELECT doc_id, count(DISTINCT q) AS n_hit
      FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM h) x GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""

OP9 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[j] || ' ' || w[j + 1] END AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 1, 1))) AS j FROM d WHERE len(w) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
-- texts of one set are one node
k AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY n, g) AS node
      FROM (SELECT doc_id, count(*) AS n, sha256(string_agg(g, chr(10) ORDER BY g)) AS g FROM s GROUP BY doc_id) x),
m AS (SELECT s.doc_id, g, n FROM s JOIN n USING (doc_id) WHERE doc_id IN (SELECT node FROM k)),
e AS (SELECT a.doc_id AS x, b.doc_id AS y FROM m a JOIN m b ON a.g = b.g AND a.doc_id < b.doc_id
      AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT node AS x, node AS y FROM (SELECT DISTINCT node FROM k) z
      UNION SELECT r.x, f.y FROM r JOIN (SELECT x, y FROM e UNION ALL SELECT y, x FROM e) f ON r.y = f.x),
c AS (SELECT x AS node, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       coalesce(c.component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN c ON c.node = k.node
"""

#: All strings of 400 bytes (800 hex digits) and all runs of 51 words, by digest.
OP10 = """
WITH d AS (
  SELECT doc_id, hex(coalesce(text, '')) AS x, strlen(coalesce(text, '')) AS n, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
chunks AS (SELECT doc_id, c, substr(x, 2 * c + 1, 1198) AS x, least(200, n - 399 - c) AS m FROM (SELECT doc_id, x, n, unnest(range(0, n - 399, 200)) AS c FROM d WHERE n >= 400) y),
strings AS (SELECT doc_id, c + i AS p, md5(substr(x, 2 * i + 1, 800)) AS g FROM (SELECT doc_id, c, x, unnest(range(m)) AS i FROM chunks) y),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY g) AS c FROM strings) y WHERE c > 1),
spans AS (
  SELECT doc_id, min(p) AS a, max(p) + 400 AS b FROM (
    SELECT *, sum(cut) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS s FROM (
      SELECT *, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 400 THEN 1 ELSE 0 END AS cut FROM again) y) z
  GROUP BY doc_id, s),
pieces AS (
  SELECT doc_id, coalesce(lag(b) OVER o, 0) AS a, a AS b FROM spans WINDOW o AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT s.doc_id, max(s.b), any_value(d.n) FROM spans s JOIN d ON d.doc_id = s.doc_id GROUP BY s.doc_id),
kept AS (SELECT q.doc_id, sha256(unhex(string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a))) AS sha FROM pieces q JOIN d ON d.doc_id = q.doc_id GROUP BY q.doc_id),
gone AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id),
word_runs AS (SELECT doc_id, i, md5(array_to_string(w[i + 1 : i + 51], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(len(w) - 50)) AS i FROM d WHERE len(w) > 50) y),
in_runs AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 51)) AS j FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS c FROM word_runs) y WHERE c > 1) z GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(g.n_removed, 0) AS BIGINT) AS n_removed, coalesce(g.n_spans, 0) AS n_spans,
       coalesce(k.sha, sha256(unhex(d.x))) AS kept_sha256, coalesce(r.n, 0) AS n_passage_words
FROM d LEFT JOIN gone g ON g.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN in_runs r ON r.doc_id = d.doc_id
"""

#: By equal words of a text and their distance; a stretch that a smaller distance covers as well isn't a run of the larger.
OP11 = """
WITH crc AS (
  SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM documents, crc),
p AS (
  SELECT doc_id, w, len(w) AS n, h, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
x AS (
  SELECT doc_id, w, n, unnest(range(n)) AS i, h, a, 1 + (n - a) // (3 + (h // 10) % 8) AS q FROM p WHERE n > 0),
words AS (
  SELECT doc_id, i, w[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % q ELSE i END] AS word FROM x),
islands AS (
  SELECT doc_id, q, min(i) AS s, count(*) + q AS n FROM (
    SELECT a.doc_id, b.i - a.i AS q, a.i, a.i - row_number() OVER (PARTITION BY a.doc_id, b.i - a.i ORDER BY a.i) AS g
    FROM words a JOIN words b ON a.doc_id = b.doc_id AND a.word = b.word AND a.i < b.i) y
  GROUP BY doc_id, q, g HAVING count(*) + q >= greatest(12, 2 * q)),
runs AS (
  SELECT l.* FROM islands l WHERE NOT EXISTS (
    SELECT 1 FROM islands m WHERE m.doc_id = l.doc_id AND m.q < l.q AND m.s <= l.s AND m.s + m.n >= l.s + l.n)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + n)) AS i FROM runs),
kept AS (
  SELECT doc_id, sha256(string_agg(word, ' ' ORDER BY i)) AS sha FROM words WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = words.doc_id AND g.i = words.i)
  GROUP BY doc_id),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, s, q) AS place FROM runs),
listed AS (SELECT doc_id, count(*) AS n_runs, sha256(string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q)) AS sha FROM runs GROUP BY doc_id)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.n AS BIGINT) AS length, CAST(b.q AS BIGINT) AS period,
       CAST(1000 * b.n // b.q AS BIGINT) AS exponent_milli, coalesce(l.sha, sha256('')) AS runs_sha256, coalesce(k.sha, sha256('')) AS collapsed_sha256
FROM d LEFT JOIN listed l ON l.doc_id = d.doc_id LEFT JOIN best b ON b.doc_id = d.doc_id AND b.place = 1 LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

#: One step per row and state, with the cheapest and then least audit to each state (op13 says why that is the whole audit's).
OP13 = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
             lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS h
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed WHERE h <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(role || chr(0) || text), copy) AS i FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' END AS fault
  FROM placed),
follows(s, role, t) AS (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
given(role, name) AS (VALUES ('u', 'user'), ('a', 'assistant')),
one AS (SELECT s, t, name FROM follows JOIN given USING (role)),
inserted AS (
  SELECT s, s AS t, 0 AS cost, '' AS audit, '' AS added FROM (SELECT DISTINCT s FROM follows) x
  UNION ALL SELECT s, t, 3, 'I', chr(10) || name || ':' FROM one
  UNION ALL SELECT a.s, b.t, 6, 'II', chr(10) || a.name || ':' || chr(10) || b.name || ':' FROM one a JOIN one b ON a.t = b.s),
best AS (
  SELECT DISTINCT conv_id, 0 AS i, '' AS s, 0 AS cost, '' AS audit, '' AS made FROM judged
  UNION ALL
  SELECT conv_id, i, s, cost, audit, made FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, s ORDER BY cost, audit) AS place FROM (
      SELECT r.conv_id, CAST(r.i AS INTEGER) AS i, b.s, b.cost + 4 AS cost, b.audit || 'D' AS audit, b.made
      FROM best b JOIN judged r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1
      UNION ALL
      SELECT r.conv_id, CAST(r.i AS INTEGER), f.t, b.cost + n.cost + CASE WHEN r.fault = 'truncated' THEN 3 ELSE 0 END, b.audit || n.audit || 'K',
             b.made || n.added || chr(10) || r.role || ':' || r.text
      FROM best b JOIN judged r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1 JOIN inserted n ON n.s = b.s
      JOIN follows f ON f.s = n.t AND f.role = r.initial WHERE r.fault IS NULL OR r.fault = 'truncated'
      UNION ALL
      SELECT r.conv_id, CAST(r.i AS INTEGER), o.t, b.cost + n.cost + 3 + CASE WHEN r.fault = 'truncated' THEN 3 ELSE 0 END, b.audit || n.audit || 'R',
             b.made || n.added || chr(10) || o.name || ':' || r.text
      FROM best b JOIN judged r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1 JOIN inserted n ON n.s = b.s
      JOIN one o ON o.s = n.t WHERE r.fault IS NULL OR r.fault = 'truncated') x) y
  WHERE place = 1),
counts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) AS n, count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate,
         count_if(fault = 'truncated') AS truncated, count_if(i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
ended AS (
  SELECT b.conv_id, b.cost + n.cost AS cost, b.audit || n.audit AS audit, sha256(substr(b.made || n.added, 2)) AS sha,
         row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + n.cost, b.audit || n.audit) AS place
  FROM best b JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i = c.n JOIN inserted n ON n.s = b.s AND n.t IN ('', 'a'))
SELECT d.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(c.blank, 0) AS BIGINT) AS blank, CAST(coalesce(c.duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(c.truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(c.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(e.cost, 0) AS BIGINT) AS cost,
       coalesce(e.audit, '') AS audit, coalesce(e.sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM d.conv_id AND e.place = 1
"""

ORACLE = {"op4_decontaminate": OP4, "op9_neardup": OP9, "op10_suffixes": OP10, "op11_runs": OP11, "op13_conversations": OP13}
