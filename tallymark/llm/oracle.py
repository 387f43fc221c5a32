"""SQL with the same rows as the queries, where SQL can express them (DuckDB)."""

import re

from tallymark.llm.quality_rules import OWN_STOP_WORD, STOP_WORDS, UNSPACED

_WORDS = r"[^\x20\x09-\x0D]+"
_BLANK = r"[\x20\x09-\x0D]"
_UNSPACED = re.sub(r"\\p\{Is(\w+)\}", r"\\p{\1}", UNSPACED)[1:-1]
_UNSPACED = re.sub(r"\\u(\w{4})", r"\\x{\1}", _UNSPACED)
_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

ORACLE: dict[str, str] = {}

ORACLE["op6_fair_mix"] = rf"""
WITH docs AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS k
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3)::DOUBLE AS weight
  FROM docs GROUP BY source
), levels AS (
  SELECT *, 3 * source_size / weight AS level, sum(source_size) OVER () AS budget,
         sum(weight) OVER () AS all_weight,
         sum(source_size) OVER (ORDER BY 3 * source_size / weight) AS size_upto,
         sum(weight) OVER (ORDER BY 3 * source_size / weight) AS weight_upto
  FROM sources
), filled AS (
  SELECT *, level = 0 OR budget - 3 * size_upto >= level * (all_weight - weight_upto) AS is_full FROM levels
), targets AS (
  SELECT source, source_size, weight, budget,
         CASE WHEN is_full THEN (3 * source_size)::DOUBLE
              ELSE least((3 * source_size)::DOUBLE,
                   (budget - sum(CASE WHEN is_full THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE
                     * weight / sum(CASE WHEN is_full THEN 0.0::DOUBLE ELSE weight END) OVER ()) END AS target
  FROM filled
), places AS (
  SELECT source, k, sum(size)::BIGINT AS place_size,
         sum(sum(size)) OVER (PARTITION BY source ORDER BY k) AS upto
  FROM docs WHERE size > 0 GROUP BY source, k
), turns AS (
  SELECT p.source, p.k, pass, place_size, budget,
         (pass * source_size + upto)::DOUBLE / weight AS finish
  FROM places p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source, range(3) r(pass)
), taken AS (
  SELECT source, k, pass, budget,
         sum(place_size) OVER (ORDER BY finish, source NULLS FIRST, k, pass) AS total
  FROM turns
), times AS (
  SELECT source, k, count(*) AS n FROM taken WHERE total <= budget GROUP BY source, k
)
SELECT d.doc_id, d.size, t.source_size, t.target,
       (CASE WHEN d.size > 0 THEN coalesce(n, 0) ELSE 0 END * d.size)::BIGINT AS taken
FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
LEFT JOIN times x ON d.source IS NOT DISTINCT FROM x.source AND d.k = x.k
"""

# Captures are made from the pages as rows; the query makes, writes and parses record texts.
ORACLE["op2_warc_revisits"] = r"""
WITH p AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS h, strlen(coalesce(html, '')) AS n,
         TIMESTAMP '2024-01-01' + to_minutes(page_id) AS t
  FROM pages
), made AS (
  SELECT page_id, 1 AS visit, 'response' AS kind, t AS at, url, 'md5:' || h AS digest,
         ['cache-control: max-age=60', 'content-length: ' || n, 'content-type: text/html',
          'etag: "' || h[:16] || '"', 'last-modified: ' || strftime(t - INTERVAL 7 DAY, '%Y-%m-%dT%H:%M:%SZ'),
          'set-cookie: a=1, b=2'] AS fields FROM p
  UNION ALL
  SELECT page_id, 2, 'revisit', t + INTERVAL 1 DAY, url, 'md5:' || h,
         ['cache-control: max-age=120', 'date: ' || strftime(t + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%SZ'),
          'etag: W/"' || h[:16] || '"'] FROM p
  UNION ALL
  SELECT page_id, 3, 'response', t + INTERVAL 2 DAY, url, 'md5:' || md5('v2' || h),
         ['content-type: text/html', 'etag: "v2-' || h[:8] || '"'] FROM p WHERE page_id % 3 = 0
  UNION ALL
  SELECT page_id, 4, 'revisit', t + INTERVAL 3 DAY, url, CASE WHEN page_id % 4 = 2 THEN 'md5:' || h END,
         list_filter(['age: 5', CASE WHEN page_id % 4 = 0 THEN 'etag: "' || h[:16] || '"' END,
           CASE WHEN page_id % 4 = 1 THEN
             'last-modified: ' || strftime(t - INTERVAL 7 DAY, '%Y-%m-%dT%H:%M:%SZ') END],
           lambda x: x IS NOT NULL) FROM p
  UNION ALL
  SELECT page_id, 5, 'revisit', t - INTERVAL 1 DAY, url, NULL, ['etag: "' || h[:16] || '"']
  FROM p WHERE page_id % 10 = 0
), plain AS (
  SELECT *, page_id || '-' || visit AS id, regexp_replace(url, '^[a-z]+://|#.*$', '', 'g') AS u FROM made
), named AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^[^/?]*')), '^www\.', ''),
                           '\.?(:80|:443)?$', '')
         || regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS base,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '^[^?]*\?(.*)$', 1), '&'),
           lambda x: x != '' AND NOT starts_with(lower(x), 'utm_') AND lower(regexp_extract(x, '^[^=]*'))
             NOT IN ('ref', 'sessionid', 'phpsessid', 'jsessionid', 'fbclid', 'gclid'))), '&') AS q
  FROM plain
), keyed AS (
  SELECT *, base || CASE WHEN q != '' THEN '?' || q ELSE '' END AS k,
         regexp_replace(list_filter(fields, lambda x: starts_with(x, 'etag'))[1], '^etag: (W/)?', '') AS tag,
         list_filter(fields, lambda x: starts_with(x, 'last-modified'))[1] AS since
  FROM named
), latest AS (
  SELECT r.page_id, r.visit, arg_max(s, (s.at, s.id)) AS s
  FROM keyed r JOIN keyed s ON r.k = s.k AND s.kind = 'response' AND s.at < r.at
  WHERE r.kind = 'revisit' GROUP BY r.page_id, r.visit
), judged AS (
  SELECT r.*, l.s AS s, CASE
    WHEN l.s IS NULL THEN 'no_response'
    WHEN r.tag IS NOT NULL THEN CASE WHEN r.tag = l.s.tag THEN 'resolved' ELSE 'mismatch' END
    WHEN r.since IS NOT NULL THEN CASE WHEN r.since = l.s.since THEN 'resolved' ELSE 'mismatch' END
    WHEN r.digest IS NOT NULL THEN CASE WHEN r.digest = l.s.digest THEN 'resolved' ELSE 'mismatch' END
    ELSE 'no_validator' END AS verdict
  FROM keyed r LEFT JOIN latest l USING (page_id, visit) WHERE r.kind = 'revisit'
)
SELECT page_id, visit, k AS canonical_url, verdict, s.id AS response_id, s.digest AS digest,
       CASE WHEN verdict = 'resolved' THEN array_to_string(list_sort(list_concat(fields,
         list_filter(s.fields, lambda x: NOT list_contains(
           list_transform(fields, lambda y: split_part(y, ':', 1)), split_part(x, ':', 1))))), chr(10)) END AS headers
FROM judged
"""

ORACLE["op7_bit_sliced_top_k"] = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 5
"""

ORACLE["op10_quality_rules"] = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '{_WORDS}')) AS l
  FROM documents
), grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i+4], ' ')) AS n
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM t)
), repeats AS (
  SELECT doc_id, sum(least(5, coalesce(i - before, 5)))::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM grams WHERE n > 1)
  GROUP BY doc_id
), counted AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '[!?][!?]$'))) AS shouts,
         len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS stops,
         length(regexp_replace(text, '[^{_UNSPACED}]', '', 'g')) AS unspaced,
         length(regexp_replace(text, '[^\p{{L}}]', '', 'g')) AS letters,
         length(regexp_replace(regexp_replace(text, '[^\p{{L}}]', '', 'g'), '[^\p{{Latin}}]', '', 'g')) AS latin,
         list_filter(list_transform(w, lambda x:
           regexp_replace(lower(x), '^[^\p{{L}}\p{{M}}]+|[^\p{{L}}\p{{M}}]+$', '', 'g')), lambda x: x != '') AS bare,
         len(list_filter(l, lambda x: regexp_matches(x, '^{_BLANK}*[-*•‣◦]'))) AS bullets,
         len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…){_BLANK}*$'))) AS dots
  FROM t LEFT JOIN repeats USING (doc_id)
), commonest AS (
  SELECT *, CASE WHEN n_words >= 200 AND stops / n_words < 0.005 THEN list_mode(bare) END AS own FROM counted
), shares AS (
  SELECT *, CASE WHEN own IS NULL THEN 0 ELSE len(list_filter(bare, lambda x: x = own)) END AS own_n FROM commonest
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR word_chars < 1.5 * n_words
            OR word_chars - unspaced > 40 * n_words OR n_symbols / n_words > 0.4 OR shouts / n_words > 0.4
            OR (n_words >= 200 AND stops / n_words < 0.005 AND 2 * latin >= letters
                AND own_n < {OWN_STOP_WORD} * n_words) OR n_dup_lines / n_lines > 0.5
            OR bullets / n_lines > 0.9 OR dots / n_lines > 0.5) AS kept
FROM shares
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op12_benchmark_decontamination"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents
), items AS (
  SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, {_TERMS} AS w FROM benchmark
  WHERE len({_TERMS}) > 0
), cuts AS (
  SELECT DISTINCT item, w[s:s + least(10, len(w)) - 1] AS g
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM items)
), grams AS (
  SELECT r, s, size, w[s:s + size - 1] AS g
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS s
        FROM d, (SELECT DISTINCT len(g) AS size FROM cuts))
), hits AS (
  SELECT r, s, size, item FROM grams JOIN cuts USING (g)
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + size)) AS p FROM hits) GROUP BY r
), owners AS (
  SELECT r, count(DISTINCT item) AS n_items, list_sort(list(DISTINCT item)) AS items FROM hits GROUP BY r
), tokens AS (
  SELECT r, unnest(w) AS t, generate_subscripts(w, 1) AS p FROM d
), rare AS (
  SELECT item, w, t, n, row_number() OVER (PARTITION BY item, w ORDER BY n, encode(t)) AS place
  FROM (SELECT DISTINCT item, w, unnest(w) AS t FROM items)
  JOIN (SELECT t, count(x.t) AS n FROM (SELECT DISTINCT unnest(w) AS t FROM items) LEFT JOIN tokens x USING (t)
        GROUP BY t) USING (t)
  QUALIFY place <= 3
), places AS (
  SELECT r, item, w, t, p, (SELECT count(*) FROM rare y WHERE y.item = x.item AND y.w = x.w) AS wanted
  FROM rare x JOIN tokens USING (t)
), ends AS (
  SELECT r, item, wanted, list(t) OVER (PARTITION BY r, item, w ORDER BY p RANGE BETWEEN 9 PRECEDING AND CURRENT ROW) AS held
  FROM places
), near AS (
  SELECT r, count(DISTINCT item) AS n_near FROM ends WHERE len(list_distinct(held)) = wanted GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(array_to_string(coalesce(items, []), ',')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN words USING (r) LEFT JOIN owners USING (r) LEFT JOIN near USING (r)
"""

ORACLE["op11_phrase_collocations"] = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), lists AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), sizes AS (
  SELECT lang, sum(len(w)) AS n FROM lists GROUP BY lang
), f AS (
  SELECT lang, g, count(*) AS f
  FROM (SELECT lang, w[i:i + k - 1] AS g
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lists, range(1, 6) x(k)))
  GROUP BY lang, g HAVING count(*) >= 100
), candidates AS (
  SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1
), cuts AS (
  SELECT c.lang, c.g, c.a, c.k, x.f AS l, y.f AS r, n,
         (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
  FROM candidates c JOIN sizes USING (lang)
  JOIN f x ON x.lang = c.lang AND x.g = c.g[1:c.k]
  JOIN f y ON y.lang = c.lang AND y.g = c.g[c.k + 1:]
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.g ORDER BY score, c.k) = 1
), inner_phrases AS (
  SELECT DISTINCT lang, g[i:i + k - 1] AS g, a
  FROM (SELECT lang, g, a, k, unnest(range(1, len(g) - k + 2)) AS i
        FROM (SELECT lang, g, f AS a, unnest(range(2, len(g))) AS k FROM f WHERE len(g) > 2))
), covered AS (
  SELECT lang, g, max(a) AS most FROM inner_phrases GROUP BY lang, g
), ranked AS (
  SELECT cuts.lang, array_to_string(g, ' ') AS phrase, cuts.a, l, r, n, score,
         row_number() OVER (PARTITION BY cuts.lang
           ORDER BY score DESC, cuts.a DESC, encode(array_to_string(g, ' '))) AS rank
  FROM cuts LEFT JOIN covered USING (lang, g)
  WHERE most IS NULL OR 100 * most < 100 * cuts.a
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
