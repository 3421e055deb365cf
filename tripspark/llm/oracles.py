"""DuckDB SQL for the llm queries that SQL can express, over the whole tables."""

from __future__ import annotations

from tripspark.llm.quality_rules import DUPLICATE, LINES, TOP

#: Rows of documents with their words; a row number tells rows that repeat apart.
_DOCS = r"""d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents)"""

OP3 = rf"""
WITH {_DOCS},
win AS (SELECT r, i, array_to_string(ws[i:i + 34], ' ') AS w FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM d)),
rep AS (SELECT w FROM win GROUP BY w HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS k FROM win SEMI JOIN rep USING (w)),
word AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS k FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY k) AS t FROM word ANTI JOIN gone USING (r, k) GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT r, count(*) AS n FROM gone GROUP BY r) USING (r) LEFT JOIN kept USING (r)
"""

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FOLDED = rf"regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_FOLDED} AS ws FROM documents),
it AS (SELECT CAST(item_id AS VARCHAR) AS item, {_FOLDED} AS ws FROM benchmark),
iw AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS w
       FROM (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM (SELECT *, least(10, len(ws)) AS n FROM it) WHERE n > 0)),
dw AS (SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w
       FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM iw))),
hit AS (SELECT r, i, n, item FROM dw JOIN iw USING (n, w)),
pos AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hit) GROUP BY r),
ids AS (SELECT r, count(item) AS n_items, sha256(coalesce(string_agg(item, ',' ORDER BY item), '')) AS items_sha256
        FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN ids USING (r)
"""

OP9 = rf"""
WITH RECURSIVE {_DOCS},
t AS (SELECT r, doc_id, array_to_string(ws, ' ') AS words, len(ws) AS n,
             list_distinct([array_to_string(ws[i:i + 4], ' ') for i in range(1, greatest(len(ws) - 3, 2))]) AS grams FROM d),
g AS (SELECT r, unnest(grams) AS gram, len(grams) AS n FROM t WHERE n > 0),
link AS (SELECT a.r AS a, b.r AS b FROM g a JOIN g b ON a.gram = b.gram AND a.r <> b.r
         GROUP BY a.r, b.r, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
reach AS (SELECT r AS a, r AS b FROM t UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
class AS (SELECT reach.a AS r, min(t.doc_id) AS class_id FROM reach JOIN t ON t.r = reach.b GROUP BY reach.a),
same AS (SELECT words, min(doc_id) AS text_id FROM t WHERE n > 0 GROUP BY words),
links AS (SELECT link.a AS r, count(*) AS n_links, count(DISTINCT CASE WHEN x.words <> y.words THEN y.words END) AS n_text_links
          FROM link JOIN t x ON x.r = link.a JOIN t y ON y.r = link.b GROUP BY link.a)
SELECT t.doc_id, class_id, CASE WHEN t.n > 0 THEN text_id ELSE t.doc_id END AS text_id,
       coalesce(n_links, 0) AS n_links, coalesce(n_text_links, 0) AS n_text_links
FROM t JOIN class USING (r) LEFT JOIN same USING (words) LEFT JOIN links USING (r)
"""

#: CRC-32 of a decimal number's digits, by the table of its reflected polynomial.
_CRC_TABLE = """crc AS (SELECT list(v ORDER BY b) AS t FROM (SELECT b, list_reduce([b] || range(8),
  lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(b)))"""
_CRC = """xor(list_reduce([4294967295] || list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
  lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295)"""

OP11 = rf"""
WITH {_CRC_TABLE},
said AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, n, c - c % 5 AS base, {_CRC} % 9 AS h FROM (SELECT c, count(*) AS n FROM said GROUP BY c), crc),
conv AS (SELECT own.*, least(own.h, coalesce(b.n, 0)) AS shared FROM own LEFT JOIN (SELECT c AS base, n FROM own) b USING (base)),
turns AS (SELECT conv.c, i AS depth, role, text FROM conv JOIN said ON said.c = conv.base AND i <= shared
          UNION ALL SELECT conv.c, i - h + shared, role, text FROM conv JOIN said ON said.c = conv.c AND i > h),
steps AS (SELECT *, sha256(CAST(to_json(list({{'r': role, 't': text}}) OVER (PARTITION BY c ORDER BY depth)) AS VARCHAR)) AS k FROM turns),
linked AS (SELECT *, coalesce(lag(k) OVER (PARTITION BY c ORDER BY depth), '') AS parent, depth = max(depth) OVER (PARTITION BY c) AS is_end FROM steps),
node AS (SELECT k, depth, parent, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * strlen(any_value(text)) AS saved FROM linked GROUP BY k, depth, parent
         UNION ALL SELECT '', 0, NULL, min(c), count(*), 0 FROM conv HAVING count(*) > 0),
kids AS (SELECT parent AS k, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY parent),
above AS (SELECT node.k, linked.k AS a FROM node JOIN linked ON linked.c = node.conv_id AND linked.depth <= node.depth UNION ALL SELECT k, '' FROM node),
sums AS (SELECT a AS k, count(*) FILTER (n_children IS NULL) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
         FROM above JOIN node USING (k) LEFT JOIN kids USING (k) GROUP BY a),
ended AS (SELECT k, c FROM linked WHERE is_end UNION ALL SELECT '', c FROM conv WHERE c NOT IN (SELECT c FROM turns)),
ends AS (SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends_sha256 FROM ended GROUP BY k)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
       coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM node JOIN sums USING (k) LEFT JOIN kids USING (k) LEFT JOIN ends USING (k) LEFT JOIN (SELECT k AS parent, conv_id FROM node) up ON up.parent = node.parent
"""

_LENGTHS = sorted({3, *TOP, *DUPLICATE})
_SHARE = "least(coalesce({x}, 0) / greatest(word_chars, 1), 1.0)"
_LIMITS = " AND ".join([f"dup_line_chars <= {LINES}", *(f"top_{n}gram <= {x}" for n, x in TOP.items()), *(f"dup_{n}gram <= {x}" for n, x in DUPLICATE.items())])

OP5 = rf"""
WITH {_DOCS},
word AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS k FROM d),
size AS (SELECT r, CAST(sum(length(word)) AS BIGINT) AS word_chars FROM word GROUP BY r),
line AS (SELECT r, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS k FROM d),
again AS (SELECT r, line FROM (SELECT r, line, row_number() OVER (PARTITION BY r, line ORDER BY k) AS nth FROM line
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) WHERE nth > 1),
dup AS (SELECT r, count(*) AS n_dup_lines,
        CAST(sum(length(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ''))) AS BIGINT) AS chars FROM again GROUP BY r),
win AS (SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w FROM
        (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT unnest({_LENGTHS}) AS n))),
seen AS (SELECT r, n, i, length(replace(w, ' ', '')) AS chars, count(*) OVER (PARTITION BY r, n, w) AS times,
         row_number() OVER (PARTITION BY r, n, w ORDER BY i) AS nth, w FROM win),
top AS (SELECT r, n, max(chars) AS chars FROM (SELECT r, n, w, CAST(sum(chars) AS BIGINT) AS chars FROM seen WHERE times > 1 AND n IN {tuple(TOP)} GROUP BY r, n, w) GROUP BY r, n),
cover AS (SELECT r, n, CAST(sum(length(word)) AS BIGINT) AS chars FROM (SELECT DISTINCT r, n, unnest(range(i, i + n)) AS k FROM seen
          WHERE nth > 1 AND n IN {tuple(DUPLICATE)}) JOIN word USING (r, k) GROUP BY r, n),
three AS (SELECT r, count(*) AS n_repeat_words FROM (SELECT DISTINCT r, unnest(range(i, i + 3)) AS k FROM seen WHERE times > 1 AND n = 3) GROUP BY r),
m AS (SELECT r, doc_id, len(ws) AS n_words, coalesce(word_chars, 0) AS word_chars,
      length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
      coalesce(n_repeat_words, 0) AS n_repeat_words, dup.chars AS line_chars
      FROM d LEFT JOIN size USING (r) LEFT JOIN dup USING (r) LEFT JOIN three USING (r)),
s AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {_SHARE.format(x="line_chars")} AS dup_line_chars,
      {", ".join(_SHARE.format(x=f"(SELECT chars FROM top WHERE top.r = m.r AND top.n = {n})") + f" AS top_{n}gram" for n in TOP)},
      {", ".join(_SHARE.format(x=f"(SELECT chars FROM cover WHERE cover.r = m.r AND cover.n = {n})") + f" AS dup_{n}gram" for n in DUPLICATE)},
      n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND {_LIMITS} AS kept FROM s
"""

ORACLES = {"op3_substring_dedup": OP3, "op5_quality_rules": OP5, "op8_decontaminate": OP8, "op9_ngram_join": OP9, "op11_prefix_trie": OP11}
