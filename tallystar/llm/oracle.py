"""The results that SQL can express, as DuckDB SQL."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Every 50-byte window as hexadecimal text, its smallest document, and the islands of windows seen before.
REPEATED_PASSAGES = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, h, CAST(length(h) // 2 AS BIGINT) AS n FROM texts),
places AS (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM sized WHERE n >= 50),
wins AS (SELECT doc_id, i, substring(h, 2 * i + 1, 100) AS w FROM places),
firsts AS (SELECT w, MIN(doc_id) AS m FROM wins GROUP BY w),
hits AS (SELECT doc_id, i FROM wins JOIN firsts USING (w) WHERE m < doc_id),
steps AS (SELECT doc_id, i, CASE WHEN i <= LAG(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM hits),
numbered AS (SELECT doc_id, i, SUM(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM steps),
islands AS (SELECT doc_id, MIN(i) AS a, MAX(i) + 50 AS b FROM numbered GROUP BY doc_id, island),
gaps AS (
  SELECT doc_id, COALESCE(LAG(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f, a AS t FROM islands
  UNION ALL SELECT sized.doc_id, COALESCE(MAX(b), 0), MAX(n) FROM sized LEFT JOIN islands ON islands.doc_id = sized.doc_id GROUP BY sized.doc_id
),
kept AS (SELECT sized.doc_id, string_agg(substring(h, 2 * f + 1, 2 * (t - f)), '' ORDER BY f) AS k FROM sized JOIN gaps ON gaps.doc_id = sized.doc_id GROUP BY sized.doc_id)
SELECT sized.doc_id, n AS n_bytes, n - CAST(length(k) // 2 AS BIGINT) AS n_removed,
       (SELECT COUNT(*) FROM islands WHERE islands.doc_id = sized.doc_id) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM sized JOIN kept ON kept.doc_id = sized.doc_id
"""

# All pairs that share a shingle, their similarity, and everything reachable over links.
JACCARD_COMPONENTS = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words
),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 75 * (a.n + b.n - COUNT(*))
),
reach AS (SELECT doc_id, doc_id AS r FROM sets UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, c.component_id
FROM sets JOIN (SELECT doc_id, MIN(r) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = sets.doc_id
"""

# Units as a list; hashes as numbers; the output put together from slices of the list.
FILL_IN_MIDDLE = """
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u FROM documents
),
hashed AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM base
),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM hashed
),
parts AS (
  SELECT *, CASE WHEN a > 0 THEN array_to_string(u[1:a], '') ELSE '' END AS p,
         CASE WHEN b > a THEN array_to_string(u[a + 1:b], '') ELSE '' END AS m,
         CASE WHEN n > b THEN array_to_string(u[b + 1:n], '') ELSE '' END AS s FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

# What a conversation says, from the table itself; the template adds its marks and a backslash per control string.
EVENT_CHAT = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized AS (
  SELECT *, 20 + length(role) + length(text) + len(regexp_extract_all(role || chr(10) || text, '[<\\[]\\\\*(?:/?s>|/?INST\\])')) AS written FROM turns
)
SELECT conv_id, COUNT(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(COALESCE(SUM(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(SUM(written) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

# Every kept term in every group, compared term by term.
DIVERGENCE_AUDIT = f"""
WITH texts AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents
),
places AS (SELECT d, lang, source, unnest(w) AS term FROM texts),
kept AS (SELECT lang, term, COUNT(*) AS c FROM places GROUP BY lang, term HAVING COUNT(DISTINCT d) >= 10),
langs AS (SELECT lang, COUNT(*) AS v, CAST(SUM(c) AS BIGINT) AS n FROM kept GROUP BY lang),
found AS (SELECT lang, source, term, COUNT(*) AS c FROM places GROUP BY lang, source, term),
pool AS (SELECT DISTINCT lang, source FROM texts),
cells AS (
  SELECT pool.lang, pool.source, kept.term, COALESCE(found.c, 0) AS c, kept.c AS lang_c
  FROM pool JOIN kept USING (lang) LEFT JOIN found ON (found.lang, found.source, found.term) = (pool.lang, pool.source, kept.term)
),
sums AS (SELECT lang, source, CAST(SUM(c) AS BIGINT) AS n FROM cells GROUP BY lang, source),
probs AS (
  SELECT lang, source, term, c, CAST(1 + (CAST(1000000000 AS HUGEINT) * (c + 2)) // (sums.n + 2 * v) AS BIGINT) AS p,
         CAST(1 + (CAST(1000000000 AS HUGEINT) * (lang_c + 2)) // (langs.n + 2 * v) AS BIGINT) AS q
  FROM cells JOIN sums USING (lang, source) JOIN langs USING (lang)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, SUM(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM probs a JOIN probs b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
),
listed AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(COALESCE(pairs.value, 0) AS BIGINT) AS value
  FROM pool a JOIN pool b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON (pairs.lang, pairs.source, pairs.item) = (a.lang, a.source, b.source)
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM probs WHERE c > 0 AND p > q
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM listed)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
