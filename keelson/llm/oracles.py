"""The queries that plain SQL can say, in DuckDB's words."""

from __future__ import annotations

from keelson.llm.quality import INSULTS, RULES, bit, mask, rules_of

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS_SQL = f"SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents"
LOWER_WORDS_SQL = (f"SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
                   f"'{_WORD}') AS ws FROM documents")

OP1 = """
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < first THEN first END AS refers_to, url AS uri
FROM (SELECT *, max(page_id) OVER (PARTITION BY digest) AS first FROM (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages))"""


# Holds for the given pages, whose article is an element of that name; the operator does not rely on it.
OP3 = r"""
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM (SELECT page_id, url,
  trim(regexp_replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1),
      '</?b>', '', 'g'), '</?(p|h1|br)>', ' ', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM pages)"""


def _windows(size: int) -> str:
    return (f"SELECT doc_id, k, md5(array_to_string(ws[k:k + {size - 1}], ' ')) AS h FROM (SELECT doc_id, ws, "
            f"unnest(range(1, len(ws) - {size - 2})) AS k FROM w WHERE len(ws) >= {size})")


OP2 = f"""
WITH w AS ({WORDS_SQL}), h AS ({_windows(35)}),
r AS (SELECT h FROM h GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 35)) AS j FROM h JOIN r USING (h)),
word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w)
SELECT w.doc_id, CAST(len(any_value(ws)) AS BIGINT) AS n_words, count(g.j) AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY j) FILTER (WHERE g.j IS NULL), '')) AS kept_sha256
FROM w LEFT JOIN word USING (doc_id) LEFT JOIN gone g USING (doc_id, j) GROUP BY w.doc_id"""

OP4 = f"""
WITH w AS ({LOWER_WORDS_SQL}),
t AS (SELECT doc_id, k, w AS w3, lag(w) OVER d AS w2, lag(w, 2) OVER d AS w1
  FROM (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS k FROM w)
  WINDOW d AS (PARTITION BY doc_id ORDER BY k)),
c1 AS (SELECT w3, count(*) AS n FROM t GROUP BY 1),
c2 AS (SELECT w2, w3, count(*) AS n FROM t WHERE w2 IS NOT NULL GROUP BY 1, 2),
c3 AS (SELECT w1, w2, w3, count(*) AS n FROM t WHERE w1 IS NOT NULL GROUP BY 1, 2, 3),
s AS (SELECT t.doc_id, CASE WHEN c3.n >= 1 THEN ln(c3.n / h2.n)
    WHEN c2.n >= 1 THEN CASE WHEN k >= 3 THEN ln(0.4E0) ELSE 0 END + ln(c2.n / h1.n)
    ELSE CASE WHEN k >= 3 THEN 2 WHEN k = 2 THEN 1 ELSE 0 END * ln(0.4E0) + ln(c1.n / (SELECT count(*) FROM t)) END AS s
  FROM t JOIN c1 ON t.w3 = c1.w3
  LEFT JOIN c2 ON t.w2 = c2.w2 AND t.w3 = c2.w3
  LEFT JOIN c3 ON t.w1 = c3.w1 AND t.w2 = c3.w2 AND t.w3 = c3.w3
  LEFT JOIN c1 h1 ON t.w2 = h1.w3
  LEFT JOIN c2 h2 ON t.w1 = h2.w2 AND t.w2 = h2.w3)
SELECT w.doc_id, CAST(len(any_value(ws)) AS BIGINT) AS n_words, round(coalesce(sum(s), 0), 4) AS log_score,
  round(sum(s) / nullif(len(any_value(ws)), 0), 4) AS mean_log_score
FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id"""

_SOLID = r"0-9A-Za-z\x{80}-\x{10FFFF}"
_FAILED = " + ".join(f"CASE WHEN {rule} THEN {1 << k} ELSE 0 END" for k, (_, rule) in enumerate(RULES))
OP5 = rf"""
WITH w AS ({WORDS_SQL}), h AS ({_windows(8)}),
r AS (SELECT doc_id, h FROM h GROUP BY 1, 2 HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (
  SELECT doc_id, unnest(range(k, k + 8)) AS j FROM h JOIN r USING (doc_id, h)) GROUP BY 1),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS repeated FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '{_WORD}') GROUP BY 1),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  coalesce(lines.n, 0) AS n_lines, coalesce(lines.repeated, 0) AS n_dup_lines,
  coalesce(covered.n, 0) AS n_repeat_words,
  CAST(length(regexp_replace(text, '[^A-Za-z\x{{C0}}-\x{{10FFFF}}]', '', 'g')) AS BIGINT) AS n_letters,
  CAST(length(regexp_replace(text, '[^A-Z\x{{C0}}-\x{{D6}}\x{{D8}}-\x{{DE}}]', '', 'g')) AS BIGINT) AS n_upper,
  CAST(len(list_filter(ws, lambda x: ends_with(x, '!'))) AS BIGINT) AS n_shouted,
  CAST(len(list_filter(ws, lambda x: translate(regexp_replace(x, '^[^{_SOLID}]+|[^{_SOLID}]+$', '', 'g'),
    '{_UPPER}', '{_LOWER}') IN ({", ".join(f"'{x}'" for x in INSULTS)}))) AS BIGINT) AS n_insults
  FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT *, (failed & {mask("base")}) <> 0 AS base_failed, (failed & {mask("full")}) = 0 AS kept,
  CASE failed & {mask("full")} {" ".join(f"WHEN {bit(r)} THEN '{r}'" for r in rules_of("full"))} END AS sole_failure
FROM (SELECT *, CAST({_FAILED} AS BIGINT) AS failed FROM m)"""

OP9 = f"""
WITH RECURSIVE w AS ({LOWER_WORDS_SQL}),
s AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, array_to_string(ws[k:k + 3], ' ') AS s FROM (
    SELECT doc_id, ws, unnest(range(1, len(ws) - 2)) AS k FROM w WHERE len(ws) >= 4)
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 3)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y
    ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.n + nb.n - i)),
reach(doc_id, least) AS (SELECT doc_id, doc_id FROM w UNION SELECT b, least FROM reach JOIN links ON doc_id = a)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.least) AS component_id
FROM w JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY w.doc_id"""

# The checksum of an id's digits, bit by bit.
_CRC = ("xor(list_reduce(list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda c, x: "
        "list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda b, k: xor(b >> 1, (b & 1) * 3988292384), xor(c, x)), "
        "4294967295), 4294967295)")
OP13 = f"""
WITH c AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS ts,
  {_CRC.format("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
r AS (SELECT c.conv_id, list_concat(coalesce(b.ts[:c.h], []), c.ts[c.h + 1:]) AS ts
  FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 20),
p AS (SELECT conv_id, depth, len(ts) = depth AS ends, md5(to_json(ts[:depth])::VARCHAR) AS node,
  CASE WHEN depth > 0 THEN md5(to_json(ts[:depth - 1])::VARCHAR) END AS up,
  CASE WHEN depth > 0 THEN len(regexp_extract_all(ts[depth].text, '{_WORD}')) ELSE 0 END AS words
  FROM (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS depth FROM r)),
n AS (SELECT depth, node, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM p GROUP BY 1, 2),
k AS (SELECT depth - 1 AS depth, up AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
t AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (depth, node)),
below AS (SELECT p.depth, p.node, sum(CAST(t.n_children = 0 AS BIGINT)) AS n_leaves, sum((t.n_convs - 1) * t.words) AS saved
  FROM t JOIN p ON p.conv_id = t.conv_id AND p.depth <= t.depth GROUP BY 1, 2)
SELECT t.conv_id, t.depth, q.conv_id AS parent_conv_id, t.n_convs, t.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, t.ends_sha256
FROM t JOIN below USING (depth, node) LEFT JOIN t q ON q.depth = t.depth - 1 AND q.node = t.up"""

SQL = {"op1_warc_revisits": OP1, "op2_substring_dedup": OP2, "op3_html_main_text": OP3,
       "op4_stupid_backoff": OP4, "op5_quality_rules": OP5,
       "op9_jaccard_join": OP9, "op13_conversation_trie": OP13}
