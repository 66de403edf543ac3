"""SQL of the queries that SQL can express, for DuckDB: the same rows by another way.

Hashes give way to the strings themselves, signatures and buckets to joins on equal shingles,
and radix passes to windows over all rows.
"""

from __future__ import annotations

from . import license_scan as L
from . import mixing, neardup, quality, suffix_dedup

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def license_scan() -> str:
    templates = [(i, label, i < len(L.BASE), text, L._telling(text, label)) for i, (text, label) in enumerate([*L.BASE, *L.NOTICES])]
    values = ", ".join(f"({i}, '{label}', {base}, '{text}', {bits})" for i, label, base, text, bits in templates)
    k = L.K
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
ws AS (SELECT r, doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM d),
g AS (SELECT r, unnest(list_transform(range(0, len(w) - {k - 1}), lambda i: {{'place': i, 'gram': array_to_string(w[i + 1 : i + {k}], ' ')}}), recursive := true) FROM ws WHERE len(w) >= {k}),
tw AS (SELECT tpl, label, is_base, bits, string_split(text, ' ') AS w FROM (VALUES {values}) AS t (tpl, label, is_base, text, bits)),
tg AS (SELECT tpl, label, is_base, len(w) AS n_tpl, list_reduce(bits, lambda a, b: a | b) AS all_tells, unnest(list_transform(range(0, len(w) - {k - 1}), lambda i: {{'pos': i, 'gram': array_to_string(w[i + 1 : i + {k}], ' '), 'tells': bits[i + 1]}}), recursive := true) FROM tw),
t AS (SELECT *, len(list_distinct(list(gram) OVER (PARTITION BY tpl))) AS n_grams FROM tg),
votes AS (SELECT r, tpl, any_value(label) AS label, any_value(is_base) AS is_base, any_value(n_tpl) AS n_tpl, any_value(n_grams) AS n_grams, any_value(all_tells) AS all_tells, place - pos AS diagonal,
    list_distinct(list(gram)) AS grams, bit_or(tells) AS tells, min(place) AS lo, max(place) + {k - 1} AS hi, min(pos) AS head, max(pos) AS tail
  FROM g JOIN t USING (gram) GROUP BY r, tpl, place - pos),
base AS (SELECT r, count(*) AS n_base, min(lo) AS first_word, max(lo) AS last_word, list(DISTINCT label) AS base_set FROM votes WHERE is_base AND len(grams) = n_grams AND hi - lo + 1 = n_tpl GROUP BY r),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY r, tpl ORDER BY diagonal) AS run FROM (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, tpl ORDER BY diagonal) <= {L.GAP} THEN 0 ELSE 1 END AS fresh FROM votes WHERE NOT is_base)),
spans AS (SELECT r, any_value(label) AS label, bit_or(tells) AS tells, any_value(all_tells) AS all_tells, len(list_distinct(flatten(list(grams)))) / any_value(n_grams) AS coverage, min(lo) AS lo, max(hi) AS hi, min(head) AS head, max(tail) AS tail, any_value(n_tpl) AS n_tpl
  FROM runs GROUP BY r, tpl, run),
method AS (SELECT r, list(DISTINCT label) AS own_set, max(coverage) AS best FROM spans
  WHERE (n_tpl > {L.FEW} OR (head = 0 AND tail = n_tpl - {k})) AND tells = all_tells AND coverage >= {L.COVER} AND hi - lo + 1 <= {L.STRETCH} * n_tpl GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  array_to_string(list_sort(coalesce(base_set, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base_set, []), coalesce(own_set, [])))), ',') AS labels,
  CASE WHEN len(coalesce(base_set, [])) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM ws LEFT JOIN base USING (r) LEFT JOIN method USING (r)"""


def quality_rules() -> str:
    q = quality
    rules = list(q.RULES)
    grid = ", ".join(f"CASE WHEN {b} > 0 THEN least({q.GRID}, ({t} * {k}) // {b}) ELSE 0 END AS v_{r}" for r, (t, b, k) in q.RULES.items())
    at = lambda r, step: f"{q.GRID} - ({q.GRID} - fit_{r}) * {step} // {q.STEPS}"
    rejected = " OR ".join(f"coalesce(v_{r} > {at(r, 'i')}, false)" for r in rules)
    log_term = f"lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({q.ALPHA}) + (n - i) * ln(1 - {q.ALPHA})"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
g AS (SELECT r, unnest(list_transform(range(1, len(w) - 1), lambda i: {{'p': i, 'gram': w[i : i + 2]}}), recursive := true) FROM w WHERE len(w) > 2),
again AS (SELECT r, p FROM g QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
covered AS (SELECT r, count(DISTINCT p + j) AS n FROM again, (VALUES (0), (1), (2)) AS t (j) GROUP BY r),
c AS (SELECT r, doc_id, lang, len(w) AS n_words, list_sum(list_transform(w, lambda x: length(x))) AS chars, len(text) - len(translate(text, '#*$%&|<>', '')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
    len(text) - len(replace(text, '!', '')) AS n_bangs, length(regexp_replace(text, '[^A-Z\\x{{C0}}-\\x{{D6}}\\x{{D8}}-\\x{{DE}}]', '', 'g')) AS n_capitals FROM w),
k AS (SELECT c.* EXCLUDE (chars), coalesce(chars, 0) AS word_chars, coalesce(n, 0) AS n_repeat_words FROM c LEFT JOIN covered USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {grid} FROM k),
lab AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
x AS (SELECT f.*, good, ('0x' || substr(md5(f.doc_id::VARCHAR), 1, 8))::BIGINT % {q.FIT_PART} = 0 AS fit FROM f JOIN lab ON f.doc_id = lab.doc_id WHERE NOT base_failed),
gains AS (SELECT lang, rule, value, sum(CASE WHEN good THEN -{q.LOSS} ELSE 1 END) AS gain FROM (UNPIVOT (SELECT lang, good, {", ".join(f"v_{r}::BIGINT AS {r}" for r in rules)} FROM x WHERE fit) ON {", ".join(rules)} INTO NAME rule VALUE value) WHERE value > 0 GROUP BY ALL),
sums AS (SELECT lang, rule, value, sum(gain) OVER (PARTITION BY lang, rule ORDER BY value DESC) AS gain FROM gains),
best AS (SELECT lang, rule, max({{'gain': gain, 'value': value}}).value - 1 AS cut FROM sums WHERE gain > 0 GROUP BY lang, rule),
path AS (SELECT lang AS s, {", ".join(f"max(CASE WHEN rule = '{r}' THEN cut END)::BIGINT AS fit_{r}" for r in rules)} FROM best GROUP BY lang),
held AS (SELECT lang, (SELECT coalesce(min(i), {q.STEPS + 1}) FROM range(1, {q.STEPS + 1}) AS t (i) WHERE {rejected}) AS step FROM x JOIN path ON lang IS NOT DISTINCT FROM s WHERE NOT fit AND good),
totals AS (SELECT lang, count(*) AS n FROM held GROUP BY lang),
tried AS (SELECT totals.lang, n, i AS step, (SELECT count(*) FROM held WHERE held.lang IS NOT DISTINCT FROM totals.lang AND held.step <= t.i) AS lost FROM totals, range(1, {q.STEPS + 1}) AS t (i)),
tails AS (SELECT lang, step, lost < {q.ALPHA} * n AND (SELECT sum(exp({log_term})) FROM range(0, lost + 1) AS u (i)) <= {q.DELTA} / (SELECT count(*) FROM (SELECT DISTINCT lang FROM x)) AS ok FROM tried),
passed AS (SELECT lang, max(step) AS step FROM (SELECT lang, step, bool_and(ok) OVER (PARTITION BY lang ORDER BY step) AS ok FROM tails) WHERE ok GROUP BY lang),
cuts AS (SELECT s, {", ".join(f"{at(r, 'step')} AS cut_{r}" for r in rules)} FROM path JOIN passed ON s IS NOT DISTINCT FROM lang),
v AS (SELECT f.*, list_filter([{", ".join(f"CASE WHEN v_{r} > cut_{r} THEN '{r}' END" for r in rules)}], lambda x: x IS NOT NULL) AS failed FROM f LEFT JOIN cuts ON lang IS NOT DISTINCT FROM s)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND len(failed) = 0 AS kept, array_to_string(failed, ',') AS failed_rules FROM v"""


def mixing_of_sources() -> str:
    m = mixing
    return f"""
WITH c AS (SELECT doc_id, source, coalesce(text, '') AS text, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
k AS (SELECT doc_id, source, size, -ln((('0x' || substr(md5(concat_ws('|', {m.SEED}, doc_id)), 1, 13))::BIGINT + 0.5::DOUBLE) / {float(1 << 52)}::DOUBLE)
    / greatest(0.05::DOUBLE, 1.0::DOUBLE - (length(text) - length(translate(text, '#*$%&|<>!', '')))::DOUBLE / greatest(size, 1)) AS key FROM c),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (SELECT *, ({list(m.WEIGHTS)})[1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(m.WEIGHTS)}]::DOUBLE AS weight, source_size * {float(m.MAX_EPOCHS)}::DOUBLE AS cap FROM s),
o AS (SELECT *, sum(source_size) OVER () * {m.SHARE_PERCENT / 100}::DOUBLE AS budget, coalesce(sum(cap) OVER b, 0) AS caps_before, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS weight_left
  FROM w WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT first((budget - caps_before) / weight_left ORDER BY cap / weight, source NULLS LAST) AS level FROM o WHERE (budget - caps_before) / weight_left * weight < cap),
t AS (SELECT source, source_size, coalesce(least(cap, level * weight), cap) AS target FROM w, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
p AS (SELECT doc_id, size, source_size, target, epochs, greatest(0, round(target)::BIGINT - epochs * source_size) AS rest,
    coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM p"""


def near_dedup() -> str:
    n = neardup
    k, s = n.SHINGLE, n.SIMILARITY
    capitals = "".join(chr(c) for c in range(0xC0, 0xDF) if c != 0xD7)
    small = "".join(chr(c + 32) for c in range(0xC0, 0xDF) if c != 0xD7)
    return f"""
WITH RECURSIVE t AS (SELECT text, min(doc_id) AS rep, row_number() OVER (ORDER BY min(doc_id), text) AS node FROM documents WHERE doc_id IS NOT NULL GROUP BY text),
w AS (SELECT node, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}{capitals}', '{_LOWER}{small}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM t),
g AS (SELECT node, unnest(CASE WHEN len(w) >= {k} THEN list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i : i + {k - 1}], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS gram FROM w),
b AS (SELECT node, gram, count(*) AS n FROM g GROUP BY node, gram),
size AS (SELECT node, sum(n) AS size FROM b GROUP BY node),
p AS (SELECT x.node AS a, y.node AS b, sum(least(x.n, y.n)) AS shared FROM b x JOIN b y ON x.gram = y.gram AND x.node < y.node GROUP BY x.node, y.node),
l AS (SELECT a, b FROM p JOIN size s ON s.node = a JOIN size u ON u.node = b WHERE shared / (s.size + u.size - shared) >= {s}),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT node, node AS label FROM t UNION SELECT e.b, r.label FROM r JOIN e ON e.a = r.node WHERE r.label < e.b),
c AS (SELECT node, min(label) AS label FROM r GROUP BY node),
m AS (SELECT label, min(rep) AS class_id FROM c JOIN t USING (node) GROUP BY label)
SELECT doc_id, CASE WHEN doc_id IS NULL THEN NULL WHEN length(coalesce(d.text, '')) = 0 THEN doc_id ELSE class_id END AS class_id FROM documents d LEFT JOIN t ON d.text IS NOT DISTINCT FROM t.text LEFT JOIN c USING (node) LEFT JOIN m USING (label)"""


def suffix_dedup_of_texts() -> str:
    n = suffix_dedup.LENGTH
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT r, doc_id, unnest(range(0, len(h) // 2 - {n - 1})) AS p FROM d WHERE len(h) >= {2 * n}),
k AS (SELECT s.r, s.doc_id, p, md5_number(substr(h, 2 * p + 1, {2 * n})) AS k FROM s JOIN d USING (r)),
g AS (SELECT r, p FROM k QUALIFY coalesce(doc_id, {(1 << 63) - 1}) > min(coalesce(doc_id, {(1 << 63) - 1})) OVER (PARTITION BY k) OR p > min(p) OVER (PARTITION BY k, r)),
i AS (SELECT r, p, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS span FROM (SELECT r, p, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= {n} THEN 0 ELSE 1 END AS fresh FROM g)),
x AS (SELECT r, min(p) AS lo, max(p) + {n} AS hi FROM i GROUP BY r, span),
e AS (SELECT r, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY r ORDER BY lo) AS start FROM x),
t AS (SELECT r, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS last FROM x GROUP BY r),
b AS (SELECT e.r, string_agg(substr(h, 2 * start + 1, 2 * (lo - start)), '' ORDER BY lo) AS body FROM e JOIN d USING (r) GROUP BY e.r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(body, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (r) LEFT JOIN b USING (r)"""
