"""DuckDB SQL for the queries that SQL can express."""

_WHITE = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cut AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
real AS (SELECT doc_id, line, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM cut WHERE regexp_matches(line, '{_WHITE}')),
gone AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY line ORDER BY doc_id, k) AS copy FROM real) WHERE copy > 1),
kept AS (
  SELECT c.doc_id, string_agg(c.line, chr(10) ORDER BY c.i) FILTER (WHERE g.i IS NULL) AS text, count(g.i) AS n_removed
  FROM cut c LEFT JOIN gone g ON c.doc_id = g.doc_id AND c.i = g.i GROUP BY c.doc_id),
lines AS (SELECT doc_id, count(*) AS n FROM real GROUP BY doc_id)
SELECT d.doc_id, coalesce(l.n, 0)::BIGINT AS n_lines, k.n_removed::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM d JOIN kept k ON d.doc_id = k.doc_id LEFT JOIN lines l ON d.doc_id = l.doc_id
"""

DECONTAMINATION = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS phrase
  FROM bw, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM phrases),
windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM dw, sizes, unnest(generate_series(1, len(w) - n + 1)) AS t(i) WHERE len(w) >= n),
found AS (SELECT v.doc_id, v.n, v.i, p.item_id FROM windows v JOIN phrases p ON v.n = p.n AND v.phrase = p.phrase),
cover AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS j FROM found),
islands AS (SELECT doc_id, j, CASE WHEN lag(j) OVER (PARTITION BY doc_id ORDER BY j) = j - 1 THEN 0 ELSE 1 END AS new FROM cover),
hits AS (SELECT doc_id, count(*) AS n_hit, sum(new) AS n_spans FROM islands GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM dw),
remaining AS (SELECT o.doc_id, string_agg(o.word, ' ' ORDER BY o.j) AS text FROM words o ANTI JOIN cover c ON o.doc_id = c.doc_id AND o.j = c.j GROUP BY o.doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(coalesce(remaining.text, '')) AS left_sha256
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN remaining USING (doc_id)
"""

SUBSTRING_DEDUP = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WHITE}') AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS v FROM dw, unnest(generate_series(1, len(w) - 34)) AS t(i) WHERE len(w) >= 35),
often AS (SELECT v FROM windows GROUP BY v HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS j FROM windows JOIN often USING (v)),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM dw),
kept AS (
  SELECT w.doc_id, count(g.j) AS n_removed, string_agg(w.word, ' ' ORDER BY w.j) FILTER (WHERE g.j IS NULL) AS text
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.j = g.j GROUP BY w.doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM dw LEFT JOIN kept USING (doc_id)
"""

QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WHITE}') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS v FROM d, unnest(generate_series(1, len(w) - 4)) AS t(i) WHERE len(w) >= 5),
often AS (SELECT doc_id, v FROM windows GROUP BY doc_id, v HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 4)) AS j FROM windows JOIN often USING (doc_id, v)) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_WHITE}') GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(lines.dup, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(lines.n, 0)::BIGINT AS n_lines,
    length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)),
f AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END + CASE WHEN n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN n_words > 0 AND word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 25 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_upper > 50 * word_chars THEN 64 ELSE 0 END + CASE WHEN n_words = 0 THEN 128 ELSE 0 END)::BIGINT AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failures & 3) <> 0 AS base_failed, failures = 0 AS kept, n_lines, n_upper, failures FROM f
"""

ORACLES = {"op1_line_dedup": LINE_DEDUP, "op4_decontamination": DECONTAMINATION, "op7_substring_dedup": SUBSTRING_DEDUP, "op10_quality_rules": QUALITY_RULES}
