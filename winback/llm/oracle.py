"""SQL for DuckDB with the same rows as the queries that SQL can express."""

from __future__ import annotations

OP2 = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest
), parts AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM split
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (page_id)
"""

OP5 = r"""
WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM digests WINDOW same AS (PARTITION BY text_sha256)
"""

OP11 = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS row, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), sets AS (
  SELECT row, doc_id, list_sort(list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END)) AS grams
  FROM texts
), classes AS (
  SELECT min(row) AS rep, grams, len(grams) AS n FROM sets WHERE len(grams) > 0 GROUP BY grams
), held AS (
  SELECT rep, n, unnest(grams) AS gram FROM classes
), links AS MATERIALIZED (
  SELECT a.rep AS a, b.rep AS b FROM held a JOIN held b ON a.gram = b.gram AND a.rep <> b.rep
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached AS (
  SELECT rep AS node, rep AS other FROM classes
  UNION
  SELECT reached.node, links.b FROM reached JOIN links ON reached.other = links.a
), members AS (
  SELECT sets.row, sets.doc_id, classes.rep, classes.n FROM sets LEFT JOIN classes USING (grams)
), firsts AS (
  SELECT reached.node, min(members.doc_id) AS component_id FROM reached JOIN members ON reached.other = members.rep GROUP BY reached.node
)
SELECT members.doc_id, coalesce(members.n, 0)::BIGINT AS n_shingles,
  CASE WHEN members.rep IS NULL THEN members.doc_id ELSE firsts.component_id END AS component_id
FROM members LEFT JOIN firsts ON members.rep = firsts.node
"""

OP12 = r"""
WITH lists AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), docs AS (
  SELECT row, doc_id, terms, len(terms) AS n FROM lists WHERE len(terms) > 0
), totals AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM docs
), counts AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) GROUP BY row, term
), items AS (
  SELECT item, item_id, term, count(*) AS repeats FROM (
    SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item, item_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, totals GROUP BY term, docs
), parts AS (
  SELECT item, item_id, doc_id, row,
    sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * totals.docs) // totals.terms))))::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN counts USING (term) JOIN docs USING (row), totals
  GROUP BY item, item_id, doc_id, row
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
  FROM parts WHERE score > 0)
WHERE rank <= 10
"""

ORACLE = {"op2_url_filter": OP2, "op5_exact_dedup": OP5, "op11_ngram_join": OP11, "op12_ranked_search": OP12}
