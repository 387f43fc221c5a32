"""The same queries in SQL, for an independent check on the same tables."""

from __future__ import annotations

from tallymark.plans.tables import STOPWORDS


def _avg(value: str) -> str:
    """An exact mean of values of at most two decimals; the query fails on others."""
    return f"CAST(sum(CAST({value} AS DECIMAL(18,2))) AS DOUBLE) / count({value})"


_STOP = ", ".join(f"('{w}')" for w in STOPWORDS)
_K = "json_extract_string(props, '$.k')"

_USER_RATINGS = """
  SELECT o_custkey AS user_id, l_partkey AS movie_id, l_quantity AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
_USERS = """
  SELECT c_custkey AS user_id, c_mktsegment AS gender, c_nationkey AS occupation,
         CAST(floor(c_acctbal / 100) AS INTEGER) AS age FROM customer"""
_FOUR = """CASE WHEN age < 0 THEN NULL WHEN age <= 18 THEN '0-18' WHEN age <= 35 THEN '18-35'
  WHEN age <= 50 THEN '35-50' WHEN age > 50 THEN '50+' END"""
_FIVE = """CASE WHEN age < 18 THEN 'Under 18' WHEN age <= 30 THEN '18-30'
  WHEN age <= 40 THEN '31-40' WHEN age <= 50 THEN '41-50' WHEN age > 50 THEN '51+' END"""
_EVENT_RATINGS = f"SELECT CAST({_K} AS INTEGER) AS movie_id, value AS rating FROM events"

_SENTIMENT = """CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive'
  ELSE 'neutral' END"""
_WORDS = """
  SELECT id, word, aspect, category, sentiment FROM (
    SELECT id, aspect, category, sentiment, unnest(string_split_regex(
      lower(regexp_replace(review, '[?!;,.]', '', 'g')), '[ ",()*\\n\\t\\r]+')) AS word
    FROM ({reviews})) WHERE word <> ''"""
_REVIEWS = """SELECT doc_id AS id, text AS review, source AS aspect, lang AS category,
  'neutral' AS sentiment FROM documents"""
_FELT = f"""SELECT doc_id AS id, text AS review, source AS aspect, lang AS category,
  {_SENTIMENT} AS sentiment FROM documents JOIN labels USING (doc_id)"""
_CLEAN = f"""SELECT * FROM ({_WORDS.format(reviews=_REVIEWS)})
  WHERE word NOT IN (SELECT * FROM (VALUES {_STOP}))"""
_FELT_CLEAN = f"""SELECT * FROM ({_WORDS.format(reviews=_FELT)})
  WHERE word NOT IN (SELECT * FROM (VALUES {_STOP}))"""


def _top_words(clean: str, where: str = "true") -> str:
    return f"""
SELECT category, word, frequency FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY frequency DESC, word) AS rn
  FROM (SELECT category, word, count(id) AS frequency FROM ({clean}) WHERE {where}
        GROUP BY category, word)) WHERE rn <= 5"""


def _leading(sentiment: str) -> str:
    return f"""
SELECT aspect, sentiment, count(id) AS frequency FROM ({_FELT})
WHERE sentiment = '{sentiment}' GROUP BY aspect, sentiment
ORDER BY frequency DESC, aspect LIMIT 1"""


def _wide(label: str, test: str) -> str:
    value = f"CASE WHEN {test} THEN rating END"
    return f'{_avg(value)} AS "{label}"'


_FOUR_WIDE = ", ".join(_wide(b, f"band = '{b}'") for b in ("0-18", "18-35", "35-50", "50+"))
_GENRES = f"""
SELECT genre, {_avg("l_quantity")} AS avg, count(l_quantity) AS n
FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS genre FROM part)
JOIN lineitem ON p_partkey = l_partkey GROUP BY genre"""
_GENDER_LONG = f"""
SELECT movie_id, gender, avg, n, p_name AS title FROM (
  SELECT movie_id, gender, {_avg("rating")} AS avg, count(rating) AS n
  FROM ({_USER_RATINGS}) JOIN ({_USERS}) USING (user_id) GROUP BY movie_id, gender)
JOIN part ON movie_id = p_partkey"""
_BAND_LONG = f"""
SELECT movie_id, band, avg, n, p_name AS title FROM (
  SELECT movie_id, band, {_avg("rating")} AS avg, count(rating) AS n
  FROM ({_USER_RATINGS}) JOIN (SELECT user_id, {_FIVE} AS band FROM ({_USERS})) USING (user_id)
  GROUP BY movie_id, band)
JOIN part ON movie_id = p_partkey"""
_ITEM_MEANS = f"""
SELECT l_partkey AS movie_id, {_avg("l_quantity")} AS avg, count(l_quantity) AS n
FROM lineitem GROUP BY l_partkey"""
_ITEM_SUMMARY = f"""
SELECT movie_id, avg, n, coalesce(p_name, 'Unknown') AS title
FROM ({_ITEM_MEANS}) LEFT JOIN part ON movie_id = p_partkey"""
_CODES = f"""
SELECT occupation, {_avg("rating")} AS avg, count(rating) AS n
FROM ({_USER_RATINGS}) JOIN ({_USERS}) USING (user_id) GROUP BY occupation"""
_SCORES = f"""
SELECT user_id AS order_id, {_K} AS review_score,
       CASE WHEN regexp_full_match({_K}, '[0-9]+') THEN CAST({_K} AS INTEGER) END AS score
FROM events"""
_SHIP = "CAST(epoch(l_shipdate) AS BIGINT)"
_TOP_BY_CATEGORY = _top_words(_CLEAN)

_FOUR_LABELS = ("0-18", "18-35", "35-50", "50+")


def _two(column: str, missing: str) -> str:
    """Two decimals, ties up in the shortest decimal form."""
    rounded = f'round(CAST(CAST("{column}" AS VARCHAR) AS DECIMAL(38,18)), 2)'
    return f"coalesce(CAST(CAST({rounded} AS DECIMAL(38,2)) AS VARCHAR), '{missing}')"


def _place(order: str) -> str:
    return f"CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS place"


_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders"""
_EVENTS = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value, props
FROM events"""
_EVENTS_AND_REJECTS = f"""
SELECT *, CAST(NULL AS VARCHAR) AS reject FROM ({_EVENTS}) WHERE event_type <> 'error'
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, '{{"event_id":' || event_id || ',"user_id":'
FROM events WHERE event_type = 'error'"""
_PAIR = f"""
SELECT movie_id, male, female, coalesce(p_name, 'Unknown') AS title FROM (
  SELECT movie_id, {_wide("male", "upper(gender) = 'MACHINERY'")},
         {_wide("female", "upper(gender) = 'FURNITURE'")}
  FROM ({_USER_RATINGS}) JOIN ({_USERS}) USING (user_id)
  WHERE upper(gender) IN ('MACHINERY', 'FURNITURE') GROUP BY movie_id)
LEFT JOIN part ON movie_id = p_partkey"""
_UNRATED = f"""
SELECT c_custkey AS movie_id, c_name AS title, "0-18", "18-35", "35-50", "50+" FROM customer
LEFT JOIN (
  SELECT movie_id, {_FOUR_WIDE} FROM (
    SELECT movie_id, rating, {_FOUR} AS band FROM (
      SELECT user_id AS movie_id, value AS rating, CAST({_K} AS INTEGER) AS age FROM events))
  GROUP BY movie_id) ON c_custkey = movie_id"""
_EVENT_KNOWN = f"""
SELECT movie_id, avg, n, n_name AS title FROM (
  SELECT movie_id, {_avg("rating")} AS avg, count(rating) AS n
  FROM ({_EVENT_RATINGS}) GROUP BY movie_id)
JOIN nation ON movie_id = n_nationkey"""
_YEARS = f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {_avg("o_totalprice")} AS avg,
       count(o_totalprice) AS n FROM orders GROUP BY 1"""
_MONTHS = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
       CAST(month(o_orderdate) AS INTEGER) AS order_month, count(*) AS n
FROM orders GROUP BY 1, 2"""
_COUNTRIES = """
SELECT n_name AS customer_country, count(*) AS n FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name"""
_CATEGORY = """
SELECT p_type AS product_category_name,
       round(sum(l_extendedprice + l_tax), 2) AS total_revenue
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
WHERE year(o_orderdate) = 1997 GROUP BY p_type"""
_FIRST_GENDERS = f"""
SELECT *, {_place("movie_id, marked")} FROM (
  SELECT *, CASE WHEN gender = 'MACHINERY' THEN 'Male' ELSE 'Female' END AS label,
         encode(CASE WHEN gender = 'MACHINERY' THEN 'M' ELSE gender END) AS marked
  FROM ({_GENDER_LONG}))
ORDER BY movie_id, marked LIMIT 20"""

ORACLE: dict[str, str] = {
    "rating_summary": _ITEM_SUMMARY,
    "rating_summary_unmatched": f"""
SELECT movie_id, avg, n, coalesce(n_name, 'Unknown') AS title FROM (
  SELECT movie_id, {_avg("rating")} AS avg, count(rating) AS n
  FROM ({_EVENT_RATINGS}) GROUP BY movie_id)
LEFT JOIN nation ON movie_id = n_nationkey""",
    "best_with_min_support": f"""
SELECT * FROM ({_ITEM_SUMMARY}) WHERE n >= 5 ORDER BY avg DESC, movie_id LIMIT 1""",
    "avg_by_multivalue": _GENRES,
    "conditional_avg_pair": _PAIR,
    "bucketed_avg_wide": f"""
SELECT p_partkey AS movie_id, p_name AS title, "0-18", "18-35", "35-50", "50+" FROM part
LEFT JOIN (
  SELECT movie_id, {_FOUR_WIDE}
  FROM ({_USER_RATINGS}) JOIN (SELECT user_id, {_FOUR} AS band FROM ({_USERS})) USING (user_id)
  GROUP BY movie_id) ON p_partkey = movie_id""",
    "bucketed_avg_unrated": _UNRATED,
    "summary_agg_then_join": _EVENT_KNOWN,
    "avg_by_item_and_group": _GENDER_LONG,
    "relabelled_groups": """
SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Male' ELSE 'Female' END AS gender,
       count(*) AS n FROM customer GROUP BY 1""",
    "report_lines": f"""
SELECT movie_id, rpad(title, 30, ' ') || ' | ' ||
       CASE WHEN length(gender) < 7 THEN rpad(gender, 7, ' ') ELSE gender END || ' | ' ||
       printf('%.2f', avg) AS line FROM ({_GENDER_LONG})""",
    "first_report_rows": f"""
SELECT movie_id, rpad(rpad(title, 33, ' '), 35, ' ') || ' | ' || rpad(band, 12, ' ') || ' | ' ||
       printf('%.2f', avg) AS line
FROM (SELECT * FROM ({_BAND_LONG}) ORDER BY movie_id, band LIMIT 20)""",
    "avg_by_item_and_band": _BAND_LONG,
    "users_by_band": f"""
SELECT {_FOUR} AS four, {_FIVE} AS five, count(*) AS n FROM ({_USERS}) GROUP BY 1, 2""",
    "summary_by_code": _CODES,
    "summary_by_code_name": f"""
SELECT occupation, avg, n, n_name AS name FROM ({_CODES})
LEFT JOIN nation ON occupation = n_nationkey""",
    "lookup_unmatched": f"""
SELECT movie_id, rating, n_name AS title FROM ({_EVENT_RATINGS})
LEFT JOIN nation ON movie_id = n_nationkey""",
    "summary_by_epoch_year": _YEARS,
    "clean_tokens": f"SELECT id, aspect, category, sentiment, word FROM ({_CLEAN})",
    "clean_tokens_stopword_table": f"""
SELECT id, aspect, category, sentiment, word FROM ({_WORDS.format(reviews=_REVIEWS)})
WHERE word NOT IN (SELECT unnest(string_split(p_name, ' ')) FROM part)""",
    "word_counts": f"SELECT word, count(id) AS frequency FROM ({_CLEAN}) GROUP BY word",
    "word_counts_stopword_table": f"""
SELECT word, count(id) AS frequency FROM ({_WORDS.format(reviews=_REVIEWS)})
WHERE word NOT IN (SELECT unnest(string_split(p_name, ' ')) FROM part) GROUP BY word""",
    "top_words": f"""
SELECT word, count(id) AS frequency FROM ({_CLEAN}) GROUP BY word
ORDER BY frequency DESC, word LIMIT 5""",
    "count_by_category": """
SELECT lang AS category, count(doc_id) AS num_comments FROM documents GROUP BY lang""",
    "count_by_aspect": """
SELECT source AS aspect, count(doc_id) AS num_comments FROM documents GROUP BY source""",
    "top_negative_aspect": _leading("negative"),
    "top_positive_aspect": _leading("positive"),
    "top_positive_words_by_category": _top_words(_FELT_CLEAN, "sentiment = 'positive'"),
    "top_negative_words_by_category": _top_words(_FELT_CLEAN, "sentiment = 'negative'"),
    "top_words_by_category": _TOP_BY_CATEGORY,
    "totals": """
SELECT 'total_orders' AS metric, count(*) AS total FROM orders
UNION ALL SELECT 'total_customers', count(*) FROM (SELECT DISTINCT o_custkey FROM orders)
UNION ALL SELECT 'total_sellers', count(*) FROM (SELECT DISTINCT l_suppkey FROM lineitem)""",
    "orders_by_country": _COUNTRIES,
    "orders_by_month": _MONTHS,
    "score_distribution": f"""
SELECT score, count(*) AS n FROM ({_SCORES}) WHERE score BETWEEN 1 AND 5 GROUP BY score""",
    "average_score": f"""
SELECT CAST(sum(score) AS DOUBLE) / count(score) AS avg, count(score) AS n
FROM ({_SCORES}) WHERE score BETWEEN 1 AND 5""",
    "score_report": f"""
SELECT line, CAST(row_number() OVER (ORDER BY place) AS INTEGER) AS place FROM (
  SELECT printf('Score %d: %d reviews', score, count(*)) AS line, score AS place
  FROM ({_SCORES}) WHERE score BETWEEN 1 AND 5 GROUP BY score
  UNION ALL
  SELECT 'Average Review Score: ' || printf('%.2f', CAST(sum(score) AS DOUBLE) / count(score)), 0
  FROM ({_SCORES}) WHERE score BETWEEN 1 AND 5 HAVING count(*) > 0)""",
    "category_revenue_in_year": _CATEGORY,
    # The mean is rounded half up in whole numbers: no double is rounded.
    "fanout_pair_stats": f"""
SELECT product_id, total_sold, CAST((200 * s + c) // (2 * c) AS DOUBLE) / 100 AS average_score
FROM (
  SELECT l_partkey AS product_id, count(l_partkey) AS total_sold,
         CAST(sum(score) AS BIGINT) AS s, count(score) AS c
  FROM lineitem JOIN ({_SCORES}) ON l_suppkey = order_id GROUP BY l_partkey)""",
    "seller_stats": """
SELECT l_suppkey AS seller_id,
       round(sum(l_extendedprice + l_tax), 2) AS total_revenue,
       count(DISTINCT l_orderkey) AS total_orders
FROM lineitem GROUP BY l_suppkey""",
    "delimited_lenient": """
SELECT CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS movie_id,
       l_quantity AS rating FROM lineitem WHERE l_linenumber NOT IN (6, 7)""",
    "delimited_trimmed": f"""
SELECT CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS movie_id,
       CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END AS rating,
       {_SHIP} AS ts FROM lineitem WHERE l_linenumber <> 6""",
    "delimited_strict": f"""
SELECT l_orderkey AS user_id, l_partkey AS movie_id, l_quantity AS rating, {_SHIP} AS ts
FROM lineitem""",
    "delimited_rejects": f"""
SELECT CASE WHEN l_linenumber = 6 THEN l_orderkey || ',' || l_partkey
            ELSE l_orderkey || ',' || l_partkey || ',n/a,' || {_SHIP} END AS value,
       CASE WHEN l_linenumber = 6 THEN 'short' ELSE 'bad' END AS reason
FROM lineitem WHERE l_linenumber IN (6, 7)""",
    "delimited_declared": f"""
SELECT TRY_CAST(f[1] AS INTEGER) AS id, f[2] AS review, f[3] AS aspect, f[4] AS category,
       f[5] AS sentiment
FROM (SELECT list_transform(string_split(
        CASE WHEN doc_id % 7 = 3 THEN '' ELSE CAST(doc_id AS VARCHAR) END || ';' ||
        coalesce(translate(text, chr(13) || chr(10), '  '), '') || ';' || coalesce(source, '')
        || ';' || coalesce(lang, '') || ';' ||
        coalesce(['positive', 'negative', 'neutral', 'mixed'][n_chars % 4 + 1], ''), ';'),
        lambda x: nullif(x, '')) AS f
      FROM documents)
WHERE f[1] <> 'id' AND f[5] IN ('positive', 'negative', 'neutral')""",
    "union_inputs": _ITEM_SUMMARY,
    "ratings_from_files": f"""
SELECT CAST(movie_id AS VARCHAR) AS movie_id, avg, n, p_name AS title
FROM ({_ITEM_MEANS}) JOIN part ON movie_id = p_partkey""",
    "csv_with_header": _ORDERS,
    "csv_with_schema": _ORDERS,
    "csv_columns_by_name": f"""
SELECT o_orderkey, o_totalprice, o_orderdate FROM ({_ORDERS})""",
    "text_sink": f"""
SELECT genre || chr(9) || 'Avg: ' || CAST(CAST(round(CAST(avg AS DECIMAL(18,6)), 2)
         AS DECIMAL(18,2)) AS VARCHAR) || ', Count: ' || n AS value FROM ({_GENRES})""",
    "delimited_sink": f"""
SELECT category || ';' || word || ';' || frequency AS value FROM ({_TOP_BY_CATEGORY})""",
    "delimited_encode": """
SELECT coalesce(CAST(o_orderkey AS VARCHAR), '') || ';' ||
       coalesce(CAST(o_custkey AS VARCHAR), '') || ';' || coalesce(o_orderstatus, '') || ';' ||
       coalesce(CAST(o_totalprice AS VARCHAR), '') || ';' ||
       coalesce(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '') || ';' ||
       coalesce(o_orderpriority, '') AS value
FROM orders""",
    "ndjson_parse": f"""
SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record FROM ({_EVENTS})""",
    "ndjson_rejects": _EVENTS_AND_REJECTS,
    "ndjson_stream": f"""
SELECT *, CASE WHEN reject IS NULL THEN 'good' ELSE 'bad' END AS kind
FROM ({_EVENTS_AND_REJECTS})""",
    "revenue_many_decimals": """
SELECT l_suppkey AS seller_id, CAST(round(sum(
         CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))
         + CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2))), 2) AS DOUBLE)
         AS total_revenue,
       count(DISTINCT l_orderkey) AS total_orders
FROM lineitem GROUP BY l_suppkey""",
    "movie_average_report": f"""
SELECT title, 'Average rating: ' || avg || ' (Total ratings: ' || n || ')' AS line
FROM ({_ITEM_SUMMARY})""",
    "best_movie_report": f"""
SELECT title, 'is the highest rated movie with an average rating of ' || avg ||
       ' among movies with at least 5 ratings.' AS line
FROM (SELECT * FROM ({_ITEM_SUMMARY}) WHERE n >= 5 ORDER BY avg DESC, movie_id LIMIT 1)""",
    "gender_wide_report": f"""
SELECT title, '  Male: ' || {_two("male", "0.00")} || ', Female: ' || {_two("female", "0.00")} AS line
FROM ({_PAIR})""",
    "age_band_wide_report": f"""
SELECT title, {" || '  ' || ".join(f"'{b}: ' || {_two(b, 'NA')}" for b in _FOUR_LABELS)} AS line
FROM ({_UNRATED})""",
    "movie_average_blocks": f"""
SELECT title || ': ' || chr(10) || chr(9) || '+Avg, rating: ' || avg || chr(10) || chr(9) ||
       '+Times of rating: ' || n AS line FROM ({_EVENT_KNOWN})""",
    "gender_blocks": f"""
SELECT 'Movie: ' || title || ' ' || chr(10) || chr(9) || '+Gender: ' || label || chr(10) ||
       chr(9) || '+Avg rating: ' || printf('%.2f', avg) AS line, place FROM ({_FIRST_GENDERS})""",
    "gender_report_first": f"""
SELECT rpad(title, 30, ' ') || ' | ' || rpad(label, 7, ' ') || ' | ' || printf('%.2f', avg) AS line,
       place FROM ({_FIRST_GENDERS})""",
    "genre_report": f"""
SELECT genre, 'Avg: ' || {_two("avg", "")} || ', Count: ' || n AS line,
       {_place("encode(genre)")} FROM ({_GENRES})""",
    "occupation_report": f"""
SELECT rpad(CAST(occupation AS VARCHAR), 20, ' ') || ' | ' || printf('%.2f', avg) || '        | '
       || n AS line, {_place("n DESC, occupation")} FROM ({_CODES})""",
    "year_report": f"""
SELECT rpad(CAST(year AS VARCHAR), 10, ' ') || ' | ' || printf('%.2f', avg) || '        | ' || n
       AS line, {_place("year")} FROM ({_YEARS})""",
    "orders_by_month_ordered": f"""
SELECT *, {_place("order_year, order_month DESC")} FROM ({_MONTHS})""",
    "orders_by_country_ordered": f"""
SELECT *, {_place("n DESC, encode(customer_country)")} FROM ({_COUNTRIES})""",
    "category_revenue_ordered": f"""
SELECT *, {_place("total_revenue DESC, encode(product_category_name)")} FROM ({_CATEGORY})""",
}

# The same rows by other plans.
ORACLE["lookup_isolated"] = ORACLE["lookup_unmatched"]
ORACLE["conditional_avg_isolated"] = ORACLE["conditional_avg_pair"]
ORACLE["bucketed_avg_isolated"] = ORACLE["bucketed_avg_wide"]
ORACLE["clean_tokens_filtered"] = ORACLE["clean_tokens_stopword_table"]
ORACLE["category_revenue_colocated"] = ORACLE["category_revenue_in_year"]
ORACLE["category_revenue_isolated"] = ORACLE["category_revenue_in_year"]
ORACLE["top_words_cut"] = ORACLE["top_words"]
ORACLE["seller_stats_text_orders"] = ORACLE["seller_stats"]

ORACLE["csv_mixed_headers"] = f"""
SELECT o_orderkey, o_orderdate, o_custkey, o_orderstatus, o_totalprice FROM ({_ORDERS})"""
ORACLE["seller_stats_ordered"] = f"""
SELECT *, {_place("total_revenue DESC, total_orders DESC, seller_id")} FROM ({ORACLE["seller_stats"]})"""
ORACLE["movie_average_report_ordered"] = f"""
SELECT title, 'Average rating: ' || avg || ' (Total ratings: ' || n || ')' AS line,
       {_place("encode(CAST(movie_id AS VARCHAR))")} FROM ({_ITEM_SUMMARY})"""
ORACLE["distinct_in_one_scan"] = """
SELECT unnest(['rows', 'customers', 'days', 'orders']) AS metric,
       unnest([count(*), count(DISTINCT o_custkey), count(DISTINCT CAST(o_orderdate AS DATE)),
               count(DISTINCT o_orderkey)]) AS total
FROM orders"""
ORACLE["incremental_means"] = f"SELECT movie_id::VARCHAR AS movie_id, avg, n FROM ({_ITEM_MEANS})"
ORACLE["orders_by_month_clustered"] = f"SELECT * FROM ({_MONTHS}) WHERE order_year = 1997"
ORACLE["top_words_by_category_cut"] = f"""
SELECT category, word, count(id) AS frequency
FROM ({_WORDS.format(reviews=_REVIEWS)})
WHERE word NOT IN (SELECT unnest(string_split(p_name, ' ')) FROM part)
GROUP BY category, word
QUALIFY row_number() OVER (PARTITION BY category ORDER BY frequency DESC, encode(word)) <= 5"""
ORACLE["ndjson_sinks"] = """
SELECT CASE WHEN event_type = 'error' THEN 'bad' ELSE 'good' END AS sink, event_id FROM events
UNION ALL SELECT 'good rows', count(*) FROM events WHERE event_type IS DISTINCT FROM 'error'
UNION ALL SELECT 'bad rows', count(*) FROM events WHERE event_type = 'error'"""
