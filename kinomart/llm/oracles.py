"""The queries of this package that SQL can express, as plain SQL for DuckDB."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH d AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d"""

URL_FILTER = r"""
WITH rules(rule_host, rule_path, says) AS (VALUES
        ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
        ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (
    SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS p FROM pages),
h AS (
    SELECT page_id, CASE WHEN p > 0 THEN substr(url, p + 3) ELSE '' END AS rest FROM u),
s AS (
    SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS raw,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM h),
l AS (
    SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path
    FROM s),
fit AS (
    SELECT l.*, rule_host || rule_path AS rule, says
    FROM l LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
best AS (
    SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(says, length(rule)) AS says
    FROM fit GROUP BY page_id, host, path)
SELECT page_id, host, path, rule,
       coalesce(says, CASE WHEN host IN ('cheap-pills.example.com', 'spam-farm.example.org')
                             OR ends_with(host, '.cheap-pills.example.com')
                             OR ends_with(host, '.spam-farm.example.org') THEN 'block' ELSE 'allow' END) AS verdict
FROM best"""

QUALITY_RULES = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
    SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM d),
pos AS (
    SELECT r, unnest(generate_series(1, len(words) - 2)) AS i, words FROM w WHERE len(words) >= 3),
win AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM pos),
cover AS (
    SELECT r, count(DISTINCT i + k) AS n
    FROM win, (VALUES (0), (1), (2)) AS o(k) WHERE n > 1 GROUP BY r),
m AS (
    SELECT w.r, doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(cover.n, 0) AS n_repeat_words,
           len(lines) AS n_lines, length(t) - length(replace(t, '!', '')) AS n_exclamations,
           len(list_filter(words, lambda x: lower(x) IN (
               'the', 'of', 'and', 'to', 'in', 'is', 'that', 'for', 'on', 'be', 'with', 'it', 'was', 'are', 'by', 'at',
               'der', 'die', 'das', 'und', 'ein', 'ist', 'von', 'zu', 'im', 'mit', 'den', 'auf', 'für', 'nicht', 'als',
               'le', 'la', 'les', 'de', 'des', 'du', 'et', 'un', 'une', 'que', 'qui', 'par', 'pour', 'est', 'pas',
               'el', 'los', 'las', 'en', 'y', 'por', 'con', 'del', 'se', 'al', 'lo', 'no'))) AS n_stop_words
    FROM w LEFT JOIN cover USING (r)),
f AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, greatest(n_words, 1) AS w1 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words BETWEEN 50 AND 100000000 AND word_chars / w1 BETWEEN 2 AND 15
       AND n_symbols / w1 <= 0.1 AND n_exclamations / w1 <= 0.3 AND n_stop_words / w1 >= 0.02
       AND n_dup_lines / greatest(n_lines, 1) <= 0.5 AND n_repeat_words / w1 <= 0.5 AS kept
FROM f"""

MIXING = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, coalesce(source, '') AS label, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS o,
           len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n
    FROM documents),
t AS (SELECT label, CAST(sum(n) AS BIGINT) AS t FROM d GROUP BY label HAVING sum(n) > 0),
s AS (SELECT label, t, t / (SELECT CAST(sum(t) AS DOUBLE) FROM t) AS share FROM t),
bisect(step, low, high) AS (
    SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
    UNION ALL
    SELECT step + 1, CASE WHEN over THEN (low + high) / 2 ELSE low END, CASE WHEN over THEN high ELSE (low + high) / 2 END
    FROM (SELECT step, low, high,
                 max(pow(share, (low + high) / 2) / share) / sum(pow(share, (low + high) / 2)) > 1.25 AS over
          FROM bisect, s WHERE step < 30 GROUP BY step, low, high)),
w AS (
    SELECT label, t, CAST(ceil(t / 1000000) AS BIGINT) AS n_blocks,
           CAST(floor(pow(share, high) / sum(pow(share, high)) OVER () * (SELECT sum(t) FROM t)) AS BIGINT) AS quota
    FROM s, bisect WHERE step = 30),
p AS (
    SELECT d.doc_id, d.source, d.label, d.n, d.o, w.quota // w.t AS passes, w.quota % w.t AS rest,
           CAST(floor(CAST('0x' || substr(d.o, 1, 8) AS BIGINT) / 4294967296.0 * w.n_blocks) AS BIGINT) AS block
    FROM d JOIN w USING (label)),
used AS (
    SELECT *, rest > 0 AND sum(n) OVER (PARTITION BY label ORDER BY o, doc_id ROWS UNBOUNDED PRECEDING) <= rest AS cut
    FROM p),
e AS (SELECT doc_id, source, label, unnest(generate_series(0, passes + CAST(cut AS BIGINT) - 1)) AS epoch, block FROM used)
SELECT doc_id, source, epoch, block,
       row_number() OVER (
           PARTITION BY label, epoch
           ORDER BY md5('17:' || epoch || ':' || label || ':' || block),
                    md5('17:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) AS place
FROM e"""

LINE_DEDUP = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
l AS (
    SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
           unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS i
    FROM d WHERE text IS NOT NULL),
h AS (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM l),
c AS (
    SELECT *, (h + 131 * coalesce(lag(h) OVER (PARTITION BY r ORDER BY i), 0)) % 2147483647 % 2 AS class FROM h),
k AS (
    SELECT r, doc_id, line, i, k, sum(CASE WHEN class = k THEN 1 ELSE 0 END)
               OVER (PARTITION BY r, k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cuts
    FROM c, (VALUES (0), (1)) AS o(k)),
chunks AS (
    SELECT r, doc_id, k, coalesce(cuts, 0) AS cuts, min(i) AS low, max(i) AS high, string_agg(line, chr(10) ORDER BY i) AS body
    FROM k GROUP BY r, doc_id, k, coalesce(cuts, 0)
    HAVING count(*) > 1 AND count(*) FILTER (regexp_matches(line, '\S')) > 1),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, low, high) AS nr FROM chunks),
gone AS (
    SELECT DISTINCT r, unnest(generate_series(low, high)) AS i FROM ranked WHERE nr > 1),
body AS (
    SELECT l.r, string_agg(line, chr(10) ORDER BY l.i) FILTER (gone.i IS NULL) AS text,
           count(*) AS n_lines, count(gone.i) AS n_removed
    FROM l LEFT JOIN gone ON l.r = gone.r AND l.i = gone.i GROUP BY l.r)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(body.text, '') END AS text,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM d LEFT JOIN body USING (r)"""


HARD_NEGATIVES = r"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other_id,
           CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
    SELECT * FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (
    SELECT p.anchor_id, p.other_id AS positive_id, p.score AS positive_score, s.other_id AS negative_id,
           s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS rank
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    WHERE 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mixing": MIXING,
        "op2_exact_dedup": EXACT_DEDUP,
        "op5_quality_rules": QUALITY_RULES,
        "op6_line_dedup": LINE_DEDUP,
        "op7_url_filter": URL_FILTER,
        "op13_hard_negatives": HARD_NEGATIVES,
    }
