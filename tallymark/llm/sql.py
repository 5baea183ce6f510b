"""DuckDB SQL for the text operators that SQL can express."""

from __future__ import annotations

# Words as the contracts define them.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP5 = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), g AS (
  SELECT doc_id, unnest(list_transform(range(1, len(ws) - 1), lambda i: [ws[i], ws[i + 1], ws[i + 2]])) AS gram,
         unnest(range(1, len(ws) - 1)) AS i
  FROM w WHERE len(ws) >= 3
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(regexp_extract_all(text, '!!')) AS bangs, text, ws
  FROM w LEFT JOIN covered c ON w.doc_id = c.doc_id
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         10 * n_symbols > n_words
         OR word_chars < 2 * n_words OR word_chars > 20 * n_words
         OR 2 * n_dup_lines > n_lines
         OR 3 * len(list_filter(ws, lambda x: regexp_matches(x, '^[A-Z]{{2,}}[^a-z]*$'))) > n_words
         OR 5 * bangs > n_words AS rejected
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM f"""

OP3 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END) AS g
  FROM w
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), link AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS r FROM documents
  UNION SELECT link.y, reach.r FROM reach JOIN link ON link.x = reach.x WHERE reach.r < link.y
), least AS (SELECT x, min(r) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN least ON least.x = d.doc_id"""

OP4 = rf"""
WITH w AS (
  SELECT doc_id, {_WORDS} AS ws FROM documents
), p AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)
), dup AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS a FROM p) WHERE a < doc_id
), gone AS (
  SELECT DISTINCT doc_id, i + k AS j FROM dup, (SELECT unnest(range(50)) AS k)
), lost AS (
  SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN js IS NULL THEN ws ELSE
         list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda x: NOT list_contains(js, x[2])), lambda x: x[1])
       END, ' ')) AS kept_sha256
FROM w LEFT JOIN lost ON w.doc_id = lost.doc_id"""

_CONTROL = r"\[INST\]|\[/INST\]|</?s>|<</?SYS>>|<<:>>|\\"

OP6 = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), r AS (
  SELECT *, CASE WHEN regexp_matches(text, '{_CONTROL}')
                 THEN length(text) + len(regexp_extract_all(text, '[\\<\[]')) ELSE length(text) END AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 20 + length(role) END)::BIGINT
         AS formatted_chars
FROM r GROUP BY conv_id"""

OP10 = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM p
), r AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < response THEN response END AS refers_to
FROM r"""

# Checksums byte by byte, from a table that is itself made in SQL.
OP11 = r"""
WITH t AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t
), x AS (
  SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), w AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM x
), f AS (
  SELECT side, id, unnest(ws || list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])
    || list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS g FROM w
), n AS MATERIALIZED (SELECT side, id, g, count(*) AS n FROM f GROUP BY ALL
), h AS (
  SELECT g, hex(encode(g)) AS hx FROM (SELECT DISTINCT g FROM n)
), c AS MATERIALIZED (
  SELECT g, xor(4294967295, list_reduce(list_transform(range(1, len(hx), 2), lambda i: ('0x' || substr(hx, i, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) % 10000 AS b
  FROM h, t
), k AS (
  SELECT b, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM n JOIN c ON n.g = c.g GROUP BY b
), z AS (
  SELECT sum(n) FILTER (side = 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t FROM n
), gain AS (
  SELECT b, floor(1000 * ln((coalesce(k.t, 0)::DOUBLE + 1) * (z.s + 10000)
                            / ((coalesce(k.s, 0)::DOUBLE + 1) * (z.t + 10000))))::BIGINT AS gain FROM k, z
), d AS (
  SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM n JOIN c ON n.g = c.g JOIN gain ON gain.b = c.b WHERE side = 0 GROUP BY id
), r AS (
  SELECT w.id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(ws) >= 20 AS fit,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || w.id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                    / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN d ON w.id = d.id WHERE w.side = 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY fit) AS many FROM r
)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= 5 * many // 100 THEN place END AS rank
FROM o"""

OP12 = rf"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents
), lab AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), f AS MATERIALIZED (
  SELECT part, [len(ws) < 50, 100 * len(list_distinct(ws)) < 65 * len(ws),
                100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text), regexp_matches(text, '[#$%&*|]'),
                w.doc_id > min(w.doc_id) OVER (PARTITION BY text)] AS fails,
         coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM w LEFT JOIN lab ON w.doc_id = lab.doc_id
), g AS MATERIALIZED (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL
), l AS (SELECT unnest(range(1, 6)) AS i
), perms AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS p FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), s AS MATERIALIZED (
  SELECT part, array_to_string(list_transform(p, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, k.i AS step, p[k.i] AS letter,
         fails[p[k.i]] AS failing, len(list_filter(p[1:k.i - 1], lambda i: fails[i])) > 0 AS earlier,
         len(list_filter(fails, lambda x: x)) AS many, n, good, toxic
  FROM g, perms, l k
), r AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN NOT failing AND NOT earlier THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN failing AND NOT earlier THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN failing AND earlier THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN failing AND many = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN failing AND NOT earlier THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN failing AND NOT earlier THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM s GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley
FROM r"""

ORACLES: dict[str, str] = {
    "op3_ngram_jaccard_join": OP3,
    "op4_substring_dedup": OP4,
    "op5_quality_rules": OP5,
    "op6_chat_formatting": OP6,
    "op10_warc": OP10,
    "op11_importance_resampling": OP11,
    "op12_filter_audit": OP12,
}
