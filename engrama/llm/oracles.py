"""SQL that queries of this subpackage must agree with, where SQL can state them.

Token ids, trained models, page extraction and packing aren't SQL; tests compare
those with brute force, round trips or held-out rows.
"""

from __future__ import annotations

from engrama.llm.chat import END, START
from engrama.llm.line_dedup import MIN_WORDS
from engrama.llm.near_dup import THRESHOLD
from engrama.llm.quality import BASE_RULES, RULES, STOP_WORDS, Rule

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

CHAT = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '{END}{START}assistant ok' UNION ALL SELECT -1, 1, 'assistant', '{END}{START}assistant ok'),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
             length(replace(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'), chr(10), '\\n'))
             + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')) + {len(START) + len(END) + 2} AS chars FROM c),
p AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto,
             i = count(*) OVER (PARTITION BY conv_id) AS is_last FROM n)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR is_last) AS BIGINT) AS formatted_chars,
       count(*) FILTER (role = 'assistant') AS n_examples
FROM p GROUP BY conv_id
"""

NEAR_DUP = f"""
WITH RECURSIVE
t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM t),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(shingle, chr(10) ORDER BY shingle)) AS digest FROM s GROUP BY 1),
c AS (SELECT digest, n, min(doc_id) AS class_id FROM n GROUP BY 1, 2),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= {THRESHOLD} * (x.n + y.n - i)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT b, root FROM r JOIN both_ways ON a = id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(root) AS component_id, min(root) = d.doc_id AS kept,
       coalesce(min(class_id), d.doc_id) AS class_id
FROM documents d JOIN r ON r.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.digest = n.digest AND c.n = n.n
GROUP BY d.doc_id, n.n
"""

LINE_DEDUP = f"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
e AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM d),
w AS (SELECT *, len(list_filter(regexp_split_to_array(line, '[ \\t\\x0B\\f\\r]+'), lambda x: x <> '')) AS words FROM e),
c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM w),
r AS (SELECT a.doc_id, a.i AS s, b.i AS t FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i
      WHERE b.upto - a.upto + a.words >= {MIN_WORDS}
        AND (b.upto - b.words - a.upto + a.words < {MIN_WORDS} OR b.upto - a.upto < {MIN_WORDS})),
k AS (SELECT r.doc_id, s, t, l[s:t] AS run FROM r JOIN d USING (doc_id)),
f AS (SELECT run, min((doc_id, s)) AS original FROM k GROUP BY run),
g AS (SELECT DISTINCT doc_id, unnest(range(s, t + 1)) AS i FROM k JOIN f USING (run) WHERE (doc_id, s) > original),
o AS (SELECT e.doc_id, coalesce(string_agg(line, chr(10) ORDER BY e.i) FILTER (g.i IS NULL), '') AS text,
             count(*) AS n_lines, count(g.i) AS n_removed FROM e LEFT JOIN g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY 1)
SELECT d.doc_id, o.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN o ON o.doc_id = d.doc_id
"""



def _breaks(rule: Rule) -> str:
    bounds = [f"100 * {rule.count} < {rule.least} * {rule.per}"] if rule.least is not None else []
    bounds += [f"100 * {rule.count} > {rule.most} * {rule.per}"] if rule.most is not None else []
    return f"(({' OR '.join(bounds)}){''.join(f' AND NOT {_breaks(r)}' for r in rule.when)})"


_STOPS = ", ".join(f"'{form}'" for w in STOP_WORDS for form in (w, w.capitalize(), w.upper()))
QUALITY = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT r, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
v AS (SELECT r, i, array_to_string(words[i:i + 4], ' ') AS run FROM g),
d AS (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS n FROM v),
c AS (SELECT r, count(DISTINCT i + j) AS n_repeat_words FROM d, range(5) x(j) WHERE n > 1 GROUP BY r),
m AS (SELECT doc_id, 1 AS one, len(words) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
             len(list_filter(words, lambda x: x IN ({_STOPS}))) AS n_stop_words,
             length(text) AS n_chars, octet_length(encode(text)) AS n_bytes,
             len(list_filter(lines, lambda l: regexp_matches(l, '^[\x20\x09-\x0D]*[-*•●‣]'))) AS n_bullet_lines,
             len(list_filter(lines, lambda l: regexp_matches(l, '([.][.][.]|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines
      FROM w LEFT JOIN c USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words,
       {' OR '.join(map(_breaks, BASE_RULES))} AS base_failed,
       NOT ({' OR '.join(map(_breaks, (*BASE_RULES, *RULES)))}) AS kept
FROM m
"""

_CRC32 = """xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda state, byte: list_reduce([xor(state, byte)] || list_transform(range(8), lambda x: CAST(x AS BIGINT)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END)))"""
PREFIX_TRIE = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, count(*) AS own FROM t GROUP BY 1),
h AS (SELECT conv_id, own, {_CRC32} % 9 AS h, conv_id - (conv_id % 5 + 5) % 5 AS first FROM o),
c AS (SELECT h.conv_id, h, h.first, least(h, coalesce(f.own, 0)) AS head, h.own FROM h LEFT JOIN o f ON f.conv_id = h.first),
r AS (SELECT c.conv_id, i AS depth, role, text FROM c JOIN t ON t.conv_id = c.first AND i <= c.head
      UNION ALL SELECT c.conv_id, i - h + head, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND i > h),
p AS (SELECT conv_id, depth, octet_length(encode(text)) AS bytes,
             string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM r
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
e AS (SELECT conv_id, max(depth) AS length FROM p GROUP BY 1),
n AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = length), '')) AS ends_sha256
      FROM p JOIN e USING (conv_id) GROUP BY 1, 2),
k AS (SELECT left(path, 32 * (CAST(depth AS INTEGER) - 1)) AS path, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
a AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (depth, path)),
u AS (SELECT d AS depth, left(path, 32 * CAST(d AS INTEGER)) AS path, n_children, (n_convs - 1) * bytes AS saved FROM a, unnest(range(0, depth + 1)) x(d)),
s AS (SELECT depth, path, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM u GROUP BY 1, 2)
SELECT a.conv_id, a.depth, b.conv_id AS parent_conv_id, a.n_convs, a.n_children, n_leaves, saved_tokens, a.ends_sha256
FROM a JOIN s USING (depth, path) LEFT JOIN n b ON b.depth = a.depth - 1 AND b.path = left(a.path, 32 * (CAST(a.depth AS INTEGER) - 1))
"""

ORACLES = {"op13_prefix_trie": PREFIX_TRIE, "op12_quality_rules": QUALITY, "op1_chat_format": CHAT, "op2_near_dup": NEAR_DUP, "op5_line_dedup": LINE_DEDUP}
