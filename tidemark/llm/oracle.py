"""DuckDB SQL for the queries that SQL can express."""

_AZ = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, {_WORDS.format(_AZ.format("text"))} AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM w WHERE len(w) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b
  WHERE 100 * c >= 80 * (na.n + nb.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM comp LEFT JOIN n USING (doc_id)
"""

QUALITY = rf"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("text")} AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
g AS MATERIALIZED (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) > 2)
), r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
rep AS (SELECT doc_id, count(*) AS n FROM (
  SELECT doc_id, i FROM r UNION SELECT doc_id, i + 1 FROM r UNION SELECT doc_id, i + 2 FROM r) GROUP BY doc_id),
f AS (
  SELECT doc_id, t, w, l, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT n_symbols * 10 > n_words
  AND NOT len(regexp_extract_all(t, '!!')) * 10 > n_words
  AND NOT len(regexp_extract_all(t, '\p{{Lu}}')) * 2 > word_chars
  AND NOT 2 * n_dup_lines > len(l)
  AND NOT word_chars > 15 * n_words AND NOT word_chars < 2 * n_words
  AND NOT 5 * len(list_filter(generate_series(2, len(w)), lambda i: w[i] = w[i - 1])) > n_words AS kept
FROM b
"""

# The pages declare no canonical links or redirects with a target elsewhere
# that SQL would have to follow: classes are the spellings of one page.
URLS = r"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail FROM pages
), h AS (
  SELECT page_id, url, regexp_extract(tail, '^([^/?#]*)', 1) AS raw_host,
    regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(tail, '^[^?#]*\?([^#]*)', 1) AS query FROM u
), p AS (
  SELECT page_id, url, path, query,
    translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM h
), rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fit AS (
  SELECT page_id, max_by(rules.host || rules.path, length(rules.host || rules.path)) AS rule,
    max_by(rules.verdict, length(rules.host || rules.path)) AS verdict
  FROM p JOIN rules ON (p.host = rules.host OR p.host LIKE '%.' || rules.host) AND starts_with(p.path, rules.path)
  GROUP BY page_id
), q AS (
  SELECT p.page_id, p.host, p.path, fit.rule, fit.verdict,
    regexp_replace(p.host, ':(80|443)$', '') || regexp_replace(p.path, '/+$', '') || '?' ||
    array_to_string(list_filter(string_split(p.query, '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|gclid|fbclid)(=|$)')), '&') AS node
  FROM p LEFT JOIN fit USING (page_id)
), c AS (
  SELECT node, bool_or(verdict = 'block') AND NOT bool_or(verdict = 'allow') AS blocked FROM q WHERE verdict IS NOT NULL GROUP BY node
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN c.blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM q LEFT JOIN c USING (node)
"""

_TOKENS = r"regexp_extract_all(" + _AZ.format("coalesce({0}, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CONTAMINATION = f"""
WITH items AS MATERIALIZED (SELECT item_id, {_TOKENS.format("text")} AS w FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM items WHERE len(w) > 0)
), docs AS MATERIALIZED (SELECT doc_id, {_TOKENS.format("text")} AS w FROM documents),
lengths AS (SELECT DISTINCT k FROM windows),
grams AS (
  SELECT doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM docs, lengths WHERE len(w) >= k)
), hits AS MATERIALIZED (SELECT doc_id, i, k, item_id FROM grams JOIN windows USING (k, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hits)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

COLLOCATIONS = rf"""
WITH p AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
    regexp_split_to_array({_AZ.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]') AS p FROM documents
), q AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(p) AS piece FROM p)
), s AS (SELECT lang, unnest(w) AS x, unnest(w[2:]) AS y, unnest(w[3:]) AS z FROM q WHERE len(w) > 0),
f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM (
    SELECT lang, 1 AS k, x AS phrase FROM s
    UNION ALL SELECT lang, 2, x || ' ' || y FROM s WHERE y IS NOT NULL
    UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z FROM s WHERE z IS NOT NULL)
  GROUP BY ALL HAVING count(*) >= 10
), n AS (SELECT lang, count(*)::BIGINT AS n FROM s GROUP BY lang),
c AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (
  SELECT lang, phrase, f, 1 AS cut, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM c
  UNION ALL SELECT lang, phrase, f, 2, w[1] || ' ' || w[2], w[3] FROM c WHERE k = 3
), half AS MATERIALIZED (
  SELECT a.lang, a.phrase, a.f AS a, cut, y, l.f AS l FROM cuts a JOIN f l ON l.lang = a.lang AND l.phrase = a.x
), scored AS (
  SELECT h.lang, h.phrase, a, cut, l, r.f AS r, (1000000::HUGEINT * a * a) // (l * r.f) AS score
  FROM half h JOIN f r ON r.lang = h.lang AND r.phrase = h.y
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, f FROM c WHERE k = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], f FROM c WHERE k = 3) GROUP BY ALL
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE inside.f IS NULL OR 100 * inside.f < 50 * a
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
