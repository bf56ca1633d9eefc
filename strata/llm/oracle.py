"""DuckDB SQL of the training-data queries that SQL can state."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

WINNOWING = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
spans AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, w[s : s + least(len(w), 10) - 1] AS span
  FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(s) WHERE len(w) > 0),
places AS (
  SELECT r, p, size, w[p : p + size - 1] AS span
  FROM d, (SELECT DISTINCT size FROM spans), unnest(range(1, len(w) - size + 2)) AS u(p)),
met AS (SELECT r, p, places.size, item_id FROM places JOIN spans USING (span)),
hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM met, unnest(range(p, p + size)) AS u(q) GROUP BY r),
of AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM met) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN of USING (r)
"""

_DIGIT = "lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]"
_CRC = (f"xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(c::VARCHAR, ''), {_DIGIT}))), "
        "lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)")

PREFIX_TRIE = rf"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(struct_pack(role := role, text := text) ORDER BY i) AS turns FROM t GROUP BY c),
heads AS (SELECT c, {_CRC} % 4 AS h, turns FROM own),
conv AS (SELECT a.c, list_concat(coalesce(b.turns[1 : a.h], []), a.turns[a.h + 1 :]) AS turns
         FROM heads a LEFT JOIN own b ON b.c = a.c - a.c % 20),
member AS (SELECT c, len(turns) AS n, d, turns[1 : d] AS path FROM conv, unnest(range(0, len(turns) + 1)) AS u(d)),
node AS (SELECT path, d, min(c) AS conv_id, count(*) AS n_convs,
                coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '') AS ends FROM member GROUP BY path, d),
child AS (SELECT path[1 : d - 1] AS path, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
own_value AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children, n_children IS NULL AS leaf,
         (n_convs - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM node LEFT JOIN child USING (path)),
total AS (SELECT path[1 : k] AS path, sum(leaf::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
          FROM own_value, unnest(range(0, d + 1)) AS u(k) GROUP BY 1)
SELECT v.conv_id, v.d::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, sha256(v.ends) AS ends_sha256
FROM own_value v JOIN total USING (path) LEFT JOIN node p ON v.d > 0 AND p.d = v.d - 1 AND p.path = v.path[1 : v.d - 1]
"""

_TERMS = rf"regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED_SEARCH = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
post AS (SELECT r, translate(term, '{_UPPER}', '{_LOWER}') AS term, count(*) AS tf FROM d, unnest(w) AS u(term) GROUP BY ALL),
stat AS (SELECT count(*) AS nn, sum(len(w))::BIGINT AS ll FROM d WHERE len(w) > 0),
weight AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM post, stat GROUP BY term, nn),
item AS (SELECT item_id, text, translate(term, '{_UPPER}', '{_LOWER}') AS term
         FROM (SELECT DISTINCT item_id, text FROM benchmark), unnest({_TERMS}) AS u(term)),
score AS (
  SELECT item_id, item.text, r, d.doc_id,
         sum(weight.w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(d.w) * nn) // ll))))::BIGINT AS score
  FROM item JOIN post USING (term) JOIN weight USING (term) JOIN d USING (r), stat GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id, r) AS rank FROM score WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE = {"op11_winnowing": WINNOWING, "op12_prefix_trie": PREFIX_TRIE, "op13_blockmax_search": RANKED_SEARCH}
