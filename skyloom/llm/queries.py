"""The registered queries of this package and, where SQL can express them, their oracles."""

from __future__ import annotations

import public_tokenizers

from . import bpe, chat, decontaminate, divergence, fim, line_dedup, lm_score, near_dup, quality, repeats, token_files, url_filter, warc
from .common import table

_WORDS = r"[^\x20\x09-\x0D]+"
_ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_lm_score(spark, sf_dir):
    return lm_score.score(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_line_dedup(spark, sf_dir):
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op3_chat_format(spark, sf_dir):
    return chat.digest(chat.with_probe(table(spark, sf_dir, "conversations")))


def op4_ngram_jaccard(spark, sf_dir):
    return near_dup.digest(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark, sf_dir):
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_repeated_bytes(spark, sf_dir):
    return repeats.digest(table(spark, sf_dir, "documents"))


def op7_arc_to_warc(spark, sf_dir):
    return warc.digest(table(spark, sf_dir, "pages"))


def op8_token_files(spark, sf_dir):
    return token_files.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_quality_rules(spark, sf_dir):
    return quality.digest(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark, sf_dir):
    return bpe.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_url_filter(spark, sf_dir):
    return url_filter.digest(table(spark, sf_dir, "pages"))


def op12_source_divergence(spark, sf_dir):
    return divergence.digest(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark, sf_dir):
    return fim.digest(table(spark, sf_dir, "documents"))


def quality_ablations(spark, sf_dir):
    return quality.ablations(table(spark, sf_dir, "documents"))


QUERIES = (op1_lm_score, op2_line_dedup, op3_chat_format, op4_ngram_jaccard, op5_decontaminate, op6_repeated_bytes, op7_arc_to_warc, op8_token_files, op9_quality_rules, op10_byte_bpe, op11_url_filter, op12_source_divergence, op13_fill_in_middle, quality_ablations)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


_LEDGER = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_WORDS}') GROUP BY doc_id),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS p FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
again AS (SELECT doc_id, count(DISTINCT pos) AS n_repeat_words FROM (
  SELECT doc_id, unnest(range(i, i + 8)) AS pos FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, p) AS times FROM win) WHERE times > 1) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
  CAST(len(regexp_extract_all(t, '[A-Z]')) AS BIGINT) AS n_upper, CAST(len(regexp_extract_all(t, '[A-Za-z]')) AS BIGINT) AS n_letters
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN again USING (doc_id)),
r AS (SELECT *, CAST(n_words < 20 AS BIGINT) + 2 * CAST(100 * n_repeat_words > 30 * n_words AS BIGINT) + 4 * CAST(100 * n_symbols > 50 * n_words AS BIGINT)
  + 8 * CAST(n_words > 0 AND NOT (2 * n_words <= word_chars AND word_chars <= 15 * n_words) AS BIGINT)
  + 16 * CAST(100 * n_dup_lines > 50 * n_lines AS BIGINT) + 32 * CAST(100 * n_upper > 50 * n_letters AS BIGINT) AS fail_bits FROM m)"""

ORACLES = {
    "op2_line_dedup": f"""
WITH l AS (
  SELECT doc_id, u.i, u.line, {_LOWER.format("trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k
  FROM documents, unnest(string_split(coalesce(text, ''), chr(10))) WITH ORDINALITY AS u(line, i)),
f AS (SELECT k FROM l WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
  sha256(coalesce(string_agg(CASE WHEN f.k IS NULL THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM l LEFT JOIN f ON l.k = f.k GROUP BY doc_id""",
    "op3_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
t AS (SELECT *, length(text) + CASE WHEN regexp_matches(text, '<\\+\|') OR contains(text || '<|im_end|>' || chr(10), '<|im_end|>' || chr(10) || '<|im_end|>')
    OR contains(text, '<|im_end|>' || chr(10)) THEN len(regexp_extract_all(text, '<\\*\|')) ELSE 0 END AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + n) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
    "op5_decontaminate": f"""
WITH b AS (SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '{_ITEM_WORDS}') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, len(p) AS m, array_to_string(p, ' ') AS p FROM (
  SELECT item_id, w[i : i + 9] AS p FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0))),
d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ITEM_WORDS}') AS w FROM documents),
sizes AS (SELECT DISTINCT m FROM win),
spots AS (SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS p FROM (
  SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)),
hits AS (SELECT doc_id, i, spots.m, item_id FROM spots JOIN win ON spots.p = win.p AND spots.m = win.m),
words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS pos FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_arc_to_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, h, octet_length(h) AS n, sha1(h) AS sha, max(page_id) OVER (PARTITION BY h) AS keeper FROM p),
b AS (SELECT *, (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(list_sum([CAST(substr(bits, g * 5 + k, 1) AS INTEGER) << (5 - k) for k in [1, 2, 3, 4, 5]]) AS BIGINT) + 1, 1), '' ORDER BY g)
    FROM range(32) r(g)) AS digest
  FROM (SELECT *, array_to_string([lpad(bin(CAST(('0x' || substr(sha, i, 1)) AS INTEGER)), 4, '0') for i in range(1, 41)], '') AS bits FROM d))
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to FROM b""",
    "op9_quality_rules": f"""{_LEDGER}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept,
  CAST(fail_bits AS BIGINT) AS fail_bits, n_lines, n_upper, n_letters, 'v2' AS policy,
  (fail_bits & 3) = 0 AS kept_base, (fail_bits & 15) = 0 AS kept_v1, fail_bits = 0 AS kept_v2 FROM r""",
    "quality_ablations": f"""{_LEDGER},
p AS (SELECT * FROM (VALUES ('base', 3), ('v1', 15), ('v2', 63)) AS t(policy, bits)),
u AS (SELECT * FROM (VALUES ('few_words', 1), ('repeated_windows', 2), ('symbols', 4), ('word_length', 8), ('repeated_lines', 16), ('capitals', 32)) AS t(rule, bit))
SELECT policy, rule, CAST(sum(CASE WHEN (fail_bits & bit) <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS failed,
  CAST(sum(CASE WHEN (fail_bits & bits) = bit THEN 1 ELSE 0 END) AS BIGINT) AS only_this
FROM r, p, u WHERE (bits & bit) <> 0 GROUP BY policy, rule""",
}

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_filter.RULES)
_HOST = _LOWER.format("regexp_extract({0}, '://([^/?#]*)', 1)")
_PATH = "regexp_extract({0}, '://[^/?#]*([^?#]*)', 1)"
_ADDRESS = f"({_HOST} || CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END || regexp_extract({{0}}, '://[^/?#]*[^?#]*([?][^#]*)', 1))"
_OWN = "(SELECT max(struct_pack(n := length(h || p), allow := v = 'allow', rule := h || p)) FROM rules WHERE ({host} = h OR ends_with({host}, '.' || h)) AND starts_with({path}, p))"

ORACLES["op11_url_filter"] = rf"""
WITH RECURSIVE rules(h, p, v) AS (VALUES {_RULES}),
u AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
tags AS (SELECT url, list_filter(regexp_extract_all(html, '(?i)<link\b[^>]*>'), lambda t: regexp_matches(t, '(?i)\brel\s*=\s*["'']?canonical\b'))[1] AS c,
  list_filter(regexp_extract_all(html, '(?i)<meta\b[^>]*>'), lambda t: regexp_matches(t, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b'))[1] AS r FROM u WHERE contains(url, '://')),
found AS (SELECT DISTINCT url, trim(replace(l, '&amp;', '&')) AS l FROM (
  SELECT url, coalesce(nullif(regexp_extract(c, '(?i)\bhref\s*=\s*"([^"]*)"', 1), ''), nullif(regexp_extract(c, '(?i)\bhref\s*=\s*''([^'']*)''', 1), ''), regexp_extract(c, '(?i)\bhref\s*=\s*([^\s"''>]+)', 1)) AS l FROM tags
  UNION ALL SELECT url, coalesce(nullif(regexp_extract(r, '(?i)\bcontent\s*=\s*"[^"]*?url\s*=\s*''?([^"'']*)', 1), ''), regexp_extract(r, '(?i)\bcontent\s*=\s*''[^'']*?url\s*=\s*([^'']*)', 1)) FROM tags) WHERE trim(l) <> ''),
links AS (SELECT url AS s, CASE WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN l WHEN starts_with(l, '//') THEN 'http:' || l WHEN starts_with(l, '/') THEN 'http://' || {_HOST.format("url")} || l
  WHEN starts_with(l, '#') OR regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN starts_with(l, '?') THEN 'http://' || {_HOST.format("url")} || {_PATH.format("url")} || l
  ELSE 'http://' || {_HOST.format("url")} || coalesce(nullif(regexp_extract({_PATH.format("url")}, '^(.*/)[^/]*$', 1), ''), '/') || l END AS t FROM found),
ends AS (SELECT {_ADDRESS.format("s")} AS a, {_ADDRESS.format("t")} AS b, {_HOST.format("s")} AS ah, {_PATH.format("s")} AS ap, {_HOST.format("t")} AS bh, {_PATH.format("t")} AS bp FROM links WHERE contains(t, '://')),
edges AS (SELECT a, b FROM ends UNION SELECT b, a FROM ends),
blocked AS (SELECT a FROM (SELECT a, {_OWN.format(host="ah", path="ap")} AS own FROM ends UNION ALL SELECT b, {_OWN.format(host="bh", path="bp")} FROM ends) WHERE own IS NOT NULL AND NOT own.allow
  UNION SELECT b FROM blocked JOIN edges USING (a)),
judged AS (SELECT page_id, {_HOST.format("url")} AS host, {_PATH.format("url")} AS path, CASE WHEN contains(url, '://') THEN {_ADDRESS.format("url")} END AS address FROM u),
own AS (SELECT *, {_OWN.format(host="host", path="path")} AS own FROM judged)
SELECT page_id, host, path, own.rule AS rule, CASE WHEN own.allow THEN 'allow' WHEN NOT own.allow THEN 'block' WHEN b.a IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  own IS NULL AND b.a IS NOT NULL AS by_alias FROM own LEFT JOIN blocked b ON b.a = address"""

_SHARE = "(1 + 1000000000 * ({c}::HUGEINT + 2) // ({n} + 2 * v))"
ORACLES["op12_source_divergence"] = rf"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWER.format("coalesce(text, '')")} AS t FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT g.lang, g.source, coalesce(n, 0)::HUGEINT AS n, coalesce(v, 0)::HUGEINT AS v, (sum(coalesce(n, 0)) OVER (PARTITION BY g.lang))::HUGEINT AS whole FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) s ON s.lang = g.lang AND s.source = g.source LEFT JOIN (SELECT lang, count(*) AS v FROM kept GROUP BY lang) k ON k.lang = g.lang),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS c, {_SHARE.format(c="coalesce(c.n, 0)", n="g.n")} AS p FROM g JOIN kept ON kept.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term WHERE a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
q AS (SELECT c.lang, term, {_SHARE.format(c="sum(n)", n="whole")} AS q FROM c JOIN (SELECT DISTINCT lang, v, whole FROM g) x ON x.lang = c.lang GROUP BY c.lang, term, v, whole),
terms AS (SELECT p.lang, source, 'term' AS part, p.term AS item, (p - q) * (p - q) // (p + q) AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)) WHERE part = 'pair' OR rank <= 10"""

ORACLES["op13_fill_in_middle"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
h AS (SELECT *, len(l) AS n, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2, ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
x AS (SELECT *, array_to_string(l[1:a], '') AS p, array_to_string(l[a + 1:b], '') AS m, array_to_string(l[b + 1:], '') AS z FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || z || '<M>' || m ELSE '<S>' || z || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM x"""


def oracle_sql() -> dict:
    return dict(ORACLES)
