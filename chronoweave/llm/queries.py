"""The registered queries of this subpackage and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from . import (
    circulant_minhash,
    conversation_repair,
    decontaminate,
    fertility,
    hilbert_shards,
    language_ecoc,
    piece_codec,
    quality_fm,
    suffix_dedup,
    token_align,
    token_counts,
    toxicity,
    warc_salvage,
)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.query,
    "op2_quality_fm": quality_fm.query,
    "op3_token_counts": token_counts.query,
    "op4_warc_salvage": warc_salvage.query,
    "op5_fertility": fertility.query,
    "op6_circulant_minhash": circulant_minhash.query,
    "op7_language_ecoc": language_ecoc.query,
    "op8_hilbert_shards": hilbert_shards.query,
    "op9_piece_codec": piece_codec.query,
    "op10_decontaminate": decontaminate.query,
    "op11_conversation_repair": conversation_repair.query,
    "op12_toxicity": toxicity.query,
    "op13_token_align": token_align.query,
}

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op1_suffix_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT r, i, md5(substr(x, CAST(2 * i + 1 AS BIGINT), 400)) AS s
      FROM (SELECT r, x, unnest(range(0, CAST(length(x) // 2 - 199 AS BIGINT))) AS i FROM d)),
twice AS (SELECT s FROM w GROUP BY s HAVING count(*) > 1),
hit AS (SELECT r, i FROM w WHERE s IN (SELECT s FROM twice)),
edge AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM hit),
run AS (SELECT r, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS k FROM edge),
span AS (SELECT r, k, min(i) AS b, max(i) + 200 AS e FROM run GROUP BY r, k),
kept AS (SELECT r, 0 AS b, min(b) AS e FROM span GROUP BY r
         UNION ALL SELECT r, e, coalesce(lead(b) OVER (PARTITION BY r ORDER BY b), 2000000000) FROM span),
parts AS (SELECT k.r, string_agg(substr(x, CAST(2 * b + 1 AS BIGINT), CAST(2 * (e - b) AS BIGINT)), '' ORDER BY b) AS x FROM kept k JOIN d ON k.r = d.r GROUP BY k.r),
sums AS (SELECT r, sum(e - b) AS n, count(*) AS c FROM span GROUP BY r)
SELECT doc_id, CAST(length(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, CAST(coalesce(c, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(parts.x, d.x))) AS kept_sha256
FROM d LEFT JOIN sums ON d.r = sums.r LEFT JOIN parts ON d.r = parts.r
"""

ORACLE_SQL["op4_warc_salvage"] = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS x FROM pages),
f AS (SELECT x, min(page_id) AS first_id FROM p GROUP BY x),
t AS (SELECT p.*, first_id, list_transform(range(0, 8), lambda i: list_sum(list_transform(range(0, 5),
        lambda j: (strpos('0123456789abcdef', substr(p.x, CAST(5 * i + j + 1 AS BIGINT), 1)) - 1) * (16 ** (4 - j))))) AS v
      FROM p JOIN f ON p.x = f.x)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST(floor(v[k // 4 + 1] / (32 ** (3 - k % 4))) AS BIGINT) % 32, 1)), '') AS payload_digest,
  CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM t
"""

ORACLE_SQL["op6_circulant_minhash"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: list_slice(w, i, i + 2))
                                          WHEN len(w) > 0 THEN [w] ELSE [] END) AS sh FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS reach FROM d UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a),
m AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN m ON d.doc_id = m.node
"""

ORACLE_SQL["op10_decontaminate"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
wins AS (
  SELECT DISTINCT item, len(list_slice(w, i, i + 9)) AS n, list_slice(w, i, i + 9) AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wins),
cand AS (
  SELECT r, i, n, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs), sizes
  WHERE i + n - 1 <= len(w)),
hits AS (SELECT r, i, cand.n, item FROM cand JOIN wins ON cand.n = wins.n AND cand.win = wins.win),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""

ORACLE_SQL["op11_conversation_repair"] = r"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
c AS (
  SELECT conv_id, turn, role, text, xor(4294967295::BIGINT, list_reduce(
    list_transform(range(0, length(s) + 1), lambda i: CASE WHEN i = 0 THEN 4294967295::BIGINT ELSE CAST(ascii(substr(s, i, 1)) AS BIGINT) END),
    lambda x, b: list_reduce(list_transform(range(0, 9), lambda j: CASE WHEN j = 0 THEN xor(x, b) ELSE 0::BIGINT END),
      lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384::BIGINT) ELSE y // 2 END))) % 20 AS kind FROM k),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM c),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS t FROM d),
q AS (
  SELECT *, t = '' AS blank, t <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup,
    substr(role, 1, 1) AS init, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
x AS (SELECT *, NOT blank AND NOT dup AND right(t, 1) NOT IN ('.', '!', '?') AS cut FROM q),
edge(state, letter, init, goes, cost) AS (VALUES
  (0, 'D', NULL, 0, 3), (1, 'D', NULL, 1, 3), (2, 'D', NULL, 2, 3), (3, 'D', NULL, 3, 3),
  (0, 'R', NULL, 2, 2), (1, 'R', NULL, 2, 2), (2, 'R', NULL, 3, 2), (3, 'R', NULL, 2, 2),
  (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (3, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0)),
more(goes, state, letters, cost) AS (VALUES
  (0, 0, '', 0), (1, 1, '', 0), (2, 2, '', 0), (3, 3, '', 0), (0, 2, 'I', 2), (0, 3, 'II', 4), (1, 2, 'I', 2), (1, 3, 'II', 4), (2, 3, 'I', 2), (3, 2, 'I', 2)),
ids AS (SELECT DISTINCT conv_id FROM conversations),
f AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, state, printf('%09d', cost) || letters AS best FROM ids, more WHERE goes = 0
  UNION ALL
  SELECT f.conv_id, x.i, more.state,
    min(printf('%09d', CAST(left(f.best, 9) AS BIGINT) + edge.cost + more.cost + CASE WHEN x.cut AND edge.letter <> 'D' THEN 1 ELSE 0 END)
        || substr(f.best, 10) || edge.letter || more.letters)
  FROM f JOIN x ON x.conv_id IS NOT DISTINCT FROM f.conv_id AND x.i = f.i + 1
    JOIN edge ON edge.state = f.state AND (edge.letter = 'D' OR NOT (x.blank OR x.dup)) AND (edge.init IS NULL OR edge.init = x.init)
    JOIN more ON more.goes = edge.goes
  GROUP BY f.conv_id, x.i, more.state),
n AS (
  SELECT ids.conv_id, count(x.i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || init NOT IN ('su', 'ua', 'au')) AS illegal
  FROM ids LEFT JOIN x ON x.conv_id IS NOT DISTINCT FROM ids.conv_id GROUP BY ids.conv_id),
a AS (
  SELECT n.conv_id, CAST(left(min(best), 9) AS BIGINT) AS cost, substr(min(best), 10) AS audit
  FROM n JOIN f ON f.conv_id IS NOT DISTINCT FROM n.conv_id AND f.i = n.n AND f.state IN (0, 3) GROUP BY n.conv_id),
l AS (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS j FROM a),
m AS (
  SELECT conv_id, j, substr(audit, j, 1) AS letter, length(translate(substr(audit, 1, j), 'I', '')) AS i,
    length(translate(substr(audit, 1, j - 1), 'D', '')) AS kept FROM l),
r AS (
  SELECT m.conv_id, j, letter, kept, x.role, x.text, max(CASE WHEN kept = 0 AND letter = 'K' AND x.init = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY m.conv_id) AS sys
  FROM m LEFT JOIN x ON x.conv_id IS NOT DISTINCT FROM m.conv_id AND x.i = m.i AND letter <> 'I'),
s AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (kept - sys) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY j) AS body
  FROM r WHERE letter <> 'D' GROUP BY conv_id)
SELECT n.conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal, cost, audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM n JOIN a ON a.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM n.conv_id
"""
