"""The SQL twins of the training-data queries."""

from __future__ import annotations

OP2 = r"""
WITH c AS (
  SELECT page_id, url, DATE '2024-01-01' + (page_id * 7 % 365)::INT AS day, DATE '2024-01-01' + (page_id * 13 % 365)::INT AS published,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)) AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)', 1), '/'), lambda s: s <> '')[1] AS seg
  FROM pages),
e AS (
  SELECT 'list' || page_id % 3 AS list, page_id AS o, published AS day, CASE WHEN page_id % 5 < 2 THEN 'add' ELSE 'remove' END AS action,
         CASE page_id % 4 WHEN 0 THEN host WHEN 1 THEN concat_ws('/', host, seg)
                          ELSE concat_ws('/', regexp_replace(host, '^[^.]*\.', ''), seg) END AS pattern
  FROM c WHERE host <> ''),
last AS (SELECT list, pattern, day, arg_max(action, o) AS action FROM e GROUP BY 1, 2, 3),
spans AS (SELECT *, lead(day) OVER (PARTITION BY list, pattern ORDER BY day) AS until FROM last),
labels AS (SELECT page_id, day, seg, string_split(host, '.') AS l FROM c WHERE host <> ''),
hosts AS (SELECT page_id, day, seg, array_to_string(l[k:], '.') AS h FROM (SELECT *, unnest(range(1, len(l) + 1)) AS k FROM labels)),
keys AS (SELECT page_id, day, h AS pattern FROM hosts UNION SELECT page_id, day, h || '/' || seg FROM hosts WHERE seg IS NOT NULL),
met AS (
  SELECT k.page_id, count(*) AS n, string_agg(DISTINCT s.list, ',' ORDER BY s.list) AS lists
  FROM keys k JOIN spans s ON k.pattern = s.pattern AND s.action = 'add' AND s.day <= k.day AND (s.until IS NULL OR k.day < s.until)
  GROUP BY 1)
SELECT page_id, strftime(day, '%Y-%m-%d') AS day, coalesce(n, 0)::BIGINT AS n_active, coalesce(lists, '') AS lists,
       coalesce(n, 0) > 0 AS listed
FROM c LEFT JOIN met USING (page_id)"""

OP3 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS n
  FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(n + 26) + 13)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""

#: For the shape of the given pages: one article of headings and paragraphs.
OP6 = r"""
WITH a AS (SELECT page_id, url, unnest(regexp_split_to_array(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '</?(?:p|h1)>')) AS b,
                  generate_subscripts(regexp_split_to_array(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '</?(?:p|h1)>'), 1) AS k
           FROM pages),
t AS (
  SELECT page_id, k, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(b, '<[^>]*>', ' ', 'g'),
         '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '[\s]+', ' ', 'g')) AS x FROM a),
p AS (SELECT page_id, string_agg(x, chr(10) || chr(10) ORDER BY k) AS text FROM t WHERE x <> '' GROUP BY 1)
SELECT page_id, url, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars FROM pages LEFT JOIN p USING (page_id)"""

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP5 = rf"""
WITH split AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, x) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM again) GROUP BY 1),
lines AS (
  SELECT doc_id, count(*) AS n, count(DISTINCT l) AS d FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM split)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY 1),
m AS (
  SELECT s.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(l.n, 0)::BIGINT AS n_lines,
         coalesce(l.n - l.d, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)),
f AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
             + CASE WHEN 20 * n_symbols > word_chars THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
             + CASE WHEN word_chars > 40 * n_words THEN 16 ELSE 0 END)::BIGINT AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & 3 <> 0 AS base_failed,
       failed_bits = 0 AS kept, failed_bits FROM f"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = rf"list_filter(regexp_split_to_array({_FOLDED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP10 = f"""
WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
b AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS x
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS x
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw))),
hits AS (SELECT doc_id, item_id, i, k FROM dw JOIN bw USING (k, x)),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

_LOWER_WORDS = rf"list_filter(regexp_split_to_array({_FOLDED}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP8 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 1], ' ') || CASE WHEN len(w) = 1 THEN '' ELSE ' ' END AS x
  FROM (SELECT *, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
common AS (
  SELECT s.doc_id AS a, t.doc_id AS b, count(*) AS k FROM sets s JOIN sets t ON s.x = t.x AND s.doc_id < t.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id WHERE 100 * k >= 80 * (p.n + q.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, c) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.c FROM reached r JOIN edges e ON e.a = r.doc_id)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(c) AS component_id, doc_id = min(c) AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""

OP11 = f"""
WITH d AS (SELECT doc_id, {_FOLDED} AS t FROM documents),
g AS (
  SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS n,
         row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) AS k FROM d)
SELECT doc_id, keep_id, n::BIGINT AS group_size, k = 1 AS kept, sha256(t) AS text_sha256 FROM g"""


def _crc_of(nibble: int) -> int:
    for _ in range(4):
        nibble = nibble >> 1 ^ (0xEDB88320 if nibble & 1 else 0)
    return nibble


def crc32(text: str) -> str:
    """SQL for the checksum of a text's UTF-8 bytes, half a byte after the other."""
    table, digits = [_crc_of(k) for k in range(16)], f"hex(encode({text}))"
    halves = f"list_transform(range(len({digits})), lambda i: (strpos('0123456789ABCDEF', {digits}[xor(i, 1) + 1]) - 1)::BIGINT)"
    return f"xor(list_reduce({halves}, lambda c, x: xor(({table}::BIGINT[])[(xor(c, x) & 15) + 1], c >> 4), 4294967295::BIGINT), 4294967295::BIGINT)"


OP7 = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, substr(md5(coalesce(text, '')), 1, 16) AS k, (octet_length(encode(coalesce(text, ''))) + 16)::BIGINT AS size
  FROM documents),
c AS (SELECT t, {crc32("t")} AS crc FROM (SELECT DISTINCT t FROM d)),
s AS (
  SELECT *, (sum(size) OVER (ORDER BY k, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size) * 40 // sum(size) OVER () AS shard FROM d)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard::INT AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY k, doc_id NULLS FIRST) - 1)::BIGINT AS slot, NULL::INT AS grown_shard
FROM s JOIN c USING (t)"""

OP12 = f"""
WITH RECURSIVE t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           unhex(sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')))) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {crc32("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
own AS (
  SELECT c.conv_id, t.k, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.k <= h
  UNION ALL SELECT c.conv_id, t.k + 8, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.k > h),
built AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k) AS d FROM own),
p AS (
  SELECT conv_id, 0 AS depth, '' AS node, NULL::VARCHAR AS parent, 0 AS size FROM c
  UNION ALL
  SELECT p.conv_id, p.depth + 1, sha256(p.node || ':' || octet_length(encode(role))::VARCHAR || ':' || role || text), p.node, octet_length(encode(text))
  FROM p JOIN built b ON b.conv_id = p.conv_id AND b.d = p.depth + 1),
m AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM p),
nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n, any_value(size) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n FROM nodes GROUP BY 1),
up AS (
  SELECT node AS top, node AS below, parent FROM nodes
  UNION ALL SELECT n.node, u.below, n.parent FROM up u JOIN nodes n ON n.node = u.parent),
sums AS (
  SELECT top AS node, count(*) FILTER (k.n IS NULL) AS leaves, sum((b.n - 1) * b.size) AS saved
  FROM up u JOIN nodes b ON b.node = u.below LEFT JOIN kids k ON k.node = u.below GROUP BY 1)
SELECT a.conv_id, a.depth::BIGINT AS depth, b.conv_id AS parent_conv_id, a.n::BIGINT AS n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
       s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, a.ends_sha256
FROM nodes a JOIN sums s USING (node) LEFT JOIN nodes b ON b.node = a.parent LEFT JOIN kids k ON k.node = a.node"""

OP13 = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS before, unnest(regexp_extract_all({_FOLDED}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
each AS (SELECT before, run, count(*) AS n FROM runs GROUP BY 1, 2),
h AS (SELECT run, n, {crc32("before || run")} AS h FROM each),
noted AS (
  SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM noted WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
cut AS (
  SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN w b ON a.rest = b.word),
best AS (
  SELECT word, other, n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS k FROM near),
f AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN b.n >= 2 * w.n THEN other END AS form,
         CASE WHEN b.n >= 2 * w.n THEN b.n END AS form_n
  FROM w LEFT JOIN best b ON b.word = w.word AND k = 1),
path AS (
  SELECT word, word AS stop, form AS next FROM f
  UNION ALL SELECT p.word, f.word, f.form FROM path p JOIN f ON f.word = p.next)
SELECT f.word, form, stop AS root, n, n_near, form_n FROM f JOIN path p ON p.word = f.word AND p.next IS NULL"""

SQL = {
    "op7_sharding": OP7,
    "op11_exact_dedup": OP11,
    "op12_prefix_trie": OP12,
    "op13_spelling_variants": OP13,
    "op2_url_filters": OP2,
    "op3_chat_formatting": OP3,
    "op6_html_extraction": OP6,
    "op5_quality_rules": OP5,
    "op8_minhash_near_dedup": OP8,
    "op10_benchmark_decontamination": OP10,
}
