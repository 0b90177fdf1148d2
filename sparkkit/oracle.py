"""The registered queries in ANSI SQL, for an independent engine on the same tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# --- shared parts ----------------------------------------------------------

TRIPS = """
raw AS (
  SELECT l_suppkey AS medallion, o_custkey AS hack_license,
         (l_linenumber * 5 + CAST(l_quantity AS INTEGER)) % 24 AS hour,
         CASE WHEN l_linenumber = 7 THEN 0 ELSE l_quantity * 60 END AS secs,
         CASE WHEN l_discount = 0 THEN 0 WHEN l_discount = 0.01 THEN NULL ELSE l_quantity + 0.5 END AS miles,
         CASE l_returnflag WHEN 'A' THEN 'CSH' WHEN 'R' THEN 'CRD' ELSE 'UNK' END AS payment_type,
         l_extendedprice / 1000 AS fare, l_tax * 10 AS surcharge, l_tax = 0.08 AS incomplete,
         l_extendedprice * l_tax / 100 AS tip, l_discount * 100 AS tolls,
         l_extendedprice / 900 AS total
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
valid AS (SELECT * FROM raw WHERE miles <> 0 AND fare <> 0 AND NOT incomplete),
timed AS (SELECT * FROM valid WHERE secs <> 0),
bounded AS (
  SELECT * FROM raw
  WHERE secs BETWEEN 120 AND 3600 AND fare BETWEEN 3 AND 200 AND miles BETWEEN 1 AND 50 AND tolls >= 3
)
"""

STAR = """
bought AS (
  SELECT o_custkey AS custkey, l_partkey AS partkey, l_suppkey AS suppkey, l_quantity AS quantity
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
)
"""

FLIGHTS = """
flights AS (
  SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day,
         isodow(o_orderdate) AS day_of_week, o_orderpriority AS airline, l_suppkey AS origin_airport,
         o_custkey AS destination_airport,
         date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS delay,
         l_returnflag = 'R' AS cancelled
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
airports AS (
  SELECT c_custkey AS iata_code, n_name AS state FROM customer JOIN nation ON c_nationkey = n_nationkey
)
"""

WORDS = """
docs AS (
  SELECT doc_id, lang, source, text, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS label FROM documents
),
toks AS (
  SELECT * FROM (
    SELECT doc_id, lang, label,
           unnest(string_split(lower(regexp_replace(text, '[^a-zA-Z]+', ' ', 'g')), ' ')) AS word
    FROM docs)
  WHERE word <> ''
),
counted AS (SELECT word, count(*) AS cnt FROM toks GROUP BY word),
dict AS (
  SELECT word, cnt, row_number() OVER (ORDER BY cnt DESC, word) - 1 AS pos
  FROM (SELECT * FROM counted ORDER BY cnt DESC, word LIMIT 20000)
),
terms AS (
  SELECT doc_id, lang, label, pos, count(*) AS cnt FROM toks JOIN dict USING (word) GROUP BY ALL
),
tfs AS (
  SELECT *, CAST(cnt AS DOUBLE) / sum(cnt) OVER (PARTITION BY doc_id) AS tf FROM terms
),
idfs AS (
  SELECT pos, count(*) AS df, ln(CAST((SELECT count(*) FROM docs) AS DOUBLE) / count(*)) AS idf
  FROM terms GROUP BY pos
),
vectors AS (SELECT doc_id, lang, label, pos, cnt, tf, tf * idf AS tfidf FROM tfs JOIN idfs USING (pos))
"""

WHITE = r"[\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
PUNCT = """!"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"""

POSTS = f"""
posts AS (
  SELECT 'corpus/' || lang || '/' || CAST(doc_id AS VARCHAR) AS doc_id, lang,
         regexp_replace(text, '[\\r\\n]', ' ', 'g') AS text
  FROM documents
),
trimmed AS (
  SELECT doc_id, trim(w, '.,<>()-[]:;?!') AS word
  FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '{WHITE}')) AS w FROM posts)
),
trimmed_count AS (SELECT word, count(*) AS cnt FROM trimmed WHERE length(word) > 1 GROUP BY word),
strict AS (
  SELECT doc_id, word FROM (
    SELECT doc_id, trim(lower(w), '{PUNCT}') AS word
    FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM posts)
    WHERE regexp_matches(w, '[A-Za-z][\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}]+'))
  WHERE length(word) > 2
),
post_dict AS (
  SELECT word, row_number() OVER (ORDER BY cnt DESC, word) - 1 AS pos
  FROM (SELECT * FROM trimmed_count ORDER BY cnt DESC, word LIMIT 20000)
)
"""

SCORES = f"""{WORDS},
coefs AS (SELECT pos, ((pos * 7919 % 101) - 50) / 50.0::DOUBLE AS coefficient FROM dict),
scores AS (
  SELECT doc_id, label, coalesce(z, 0) AS z
  FROM docs LEFT JOIN (SELECT doc_id, sum(tfidf * coefficient) AS z FROM vectors JOIN coefs USING (pos) GROUP BY doc_id) USING (doc_id)
),
predicted AS (SELECT *, 1 / (1 + exp(-z)) AS chance, CASE WHEN z >= 0 THEN 1 ELSE 0 END AS predicted FROM scores)
"""


def add(name: str, body: str, *parts: str) -> None:
    heads = ",".join(part.strip() for part in parts)
    ORACLE[name] = (f"WITH {heads}\n" if heads else "") + body.strip()


# --- sources ---------------------------------------------------------------

add("delimited_roundtrip", """
SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_orderstatus AS status, o_totalprice AS price,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE 'none' END AS priority
FROM orders""")
add("positional_fields", """
SELECT l_returnflag AS flag, l_orderkey AS orderkey, CAST(l_linenumber AS BIGINT) AS line FROM lineitem""")
add("category_links", """
SELECT doc_id, source || ', of corpus' AS category, lang FROM documents
UNION ALL SELECT doc_id, lang || ', of corpus', lang FROM documents""")
add("tagged_header", """
SELECT 'corpus/' || lang || '/' || CAST(doc_id AS VARCHAR) AS doc_id, 'http://e/' || CAST(doc_id AS VARCHAR) AS url,
       source AS title, lang AS category, length(text) AS chars FROM documents""")
add("header_tags", """
SELECT 'corpus/' || lang || '/' || CAST(doc_id AS VARCHAR) AS doc_id, lang AS category,
       '<doc id="corpus/' || lang || '/' || CAST(doc_id AS VARCHAR) || '" url="http://e/' || CAST(doc_id AS VARCHAR)
       || '" title="' || source || '">' AS header FROM documents""")
add("trip_lines", """
SELECT count(*) AS lines, count(miles) AS numeric, count_if(incomplete)::BIGINT AS incomplete FROM raw""", TRIPS)
add("flight_lines", """
SELECT airline, count(*) AS flights, CAST(sum(CASE WHEN cancelled THEN 0 ELSE delay END) AS BIGINT) AS delay,
       CAST(count_if(cancelled) AS BIGINT) AS cancelled FROM flights GROUP BY airline""", FLIGHTS)
add("report_lines", """
SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS num FROM lineitem GROUP BY ALL""")

# --- trips -----------------------------------------------------------------

add("valid_rows", """
SELECT payment_type, count(*) AS num, 'distance and fare' AS rule FROM valid GROUP BY payment_type
UNION ALL SELECT payment_type, count(*), 'and time' FROM timed GROUP BY payment_type""", TRIPS)
add("range_filter", """
SELECT count(*) AS trips, min(miles) AS least_miles, max(fare) AS most_fare FROM bounded""", TRIPS)
add("taxis_by_drivers", """
SELECT CAST(medallion AS VARCHAR) AS medallion, count(DISTINCT hack_license) AS drivers FROM valid
GROUP BY medallion ORDER BY drivers DESC, CAST(medallion AS VARCHAR) LIMIT 10""", TRIPS)
add("drivers_by_money_per_minute", """
SELECT CAST(hack_license AS VARCHAR) AS hack_license, round(sum(total) / sum(secs / 60), 6) AS per_minute FROM timed
GROUP BY hack_license ORDER BY sum(total) / sum(secs / 60) DESC, 1 LIMIT 10""", TRIPS)
add("surcharge_by_hour", """
SELECT CAST(hour AS BIGINT) AS hour, round(sum(surcharge) / sum(miles), 6) AS per_mile FROM valid GROUP BY hour""",
    TRIPS)
add("payment_shares", """
SELECT round(100.0::DOUBLE * count_if(payment_type = 'CSH') / count(*), 6) AS cash,
       round(100.0::DOUBLE * count_if(payment_type = 'CRD') / count(*), 6) AS card FROM timed""", TRIPS)
add("card_share_by_hour", """
SELECT CAST(hour AS BIGINT) AS hour, round(count_if(payment_type = 'CRD')::DOUBLE / count(*) * 100, 6) AS share
FROM timed GROUP BY hour""", TRIPS)
add("drivers_by_money_per_mile", """
SELECT CAST(hack_license AS VARCHAR) AS hack_license, round(sum(total) / sum(miles), 6) AS per_mile FROM timed
GROUP BY hack_license ORDER BY sum(total) / sum(miles) DESC, 1 LIMIT 10""", TRIPS)
add("tip_quartiles", """
SELECT round(quantile_cont(tip, 0.25), 6) AS q1, round(quantile_cont(tip, 0.75), 6) AS q3 FROM timed""", TRIPS)
add("tip_outliers", """
SELECT round(tip, 6) AS tip, round(CASE WHEN tip < low THEN low - tip ELSE tip - high END, 6) AS gap
FROM timed CROSS JOIN (
  SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high
  FROM (SELECT quantile_cont(tip, 0.25) AS q1, quantile_cont(tip, 0.75) AS q3 FROM timed))
WHERE timed.tip < low OR timed.tip > high ORDER BY CASE WHEN timed.tip < low THEN low - timed.tip ELSE timed.tip - high END DESC, timed.tip LIMIT 10""", TRIPS)
add("value_centre", """
SELECT round(avg(value), 6) AS mean, round(median(value), 6) AS median FROM events""")
add("value_quartiles", """
SELECT round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.75), 6) AS q3 FROM events""")
add("value_outliers", """
SELECT event_id, value, round(CASE WHEN value < low THEN low - value ELSE value - high END, 6) AS gap
FROM events CROSS JOIN (
  SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high
  FROM (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events))
WHERE value < low OR value > high ORDER BY 3 DESC, event_id LIMIT 10""")
add("ratio_by_hour", """
SELECT hour(ts) AS hour,
       round(CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE)
             / CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 6) AS part
FROM events GROUP BY 1""")
add("type_share", """
SELECT round(100.0::DOUBLE * count_if(event_type = 'error') / count(*), 6) AS errors FROM events""")
add("type_share_by_hour", """
SELECT hour(ts) AS hour, round(count_if(event_type = 'error')::DOUBLE / count(*), 6) AS errors FROM events GROUP BY 1""")
add("ols", """
SELECT count(*) AS n, round(regr_slope(fare, miles), 6) AS slope, round(regr_intercept(fare, miles), 6) AS intercept
FROM bounded""", TRIPS)
add("squared_error", """
SELECT round(sum(pow(fare - (miles * 1.5 + 2), 2)), 3) AS sse FROM bounded""", TRIPS)


def descent_sql(features: list[str], target: str, start: float, rate: float, rounds: int) -> str:
    """Gradient descent on the sums of products, as a recursive query."""
    columns = ["1.0::DOUBLE", *features, target]
    size = len(columns) - 1
    sums = ", ".join(
        f"round(sum({columns[i]} * {columns[j]}), 2) AS s{i}_{j}" for i in range(size + 1) for j in range(i, size + 1)
    )

    def s(i: int, j: int) -> str:
        return f"s{min(i, j)}_{max(i, j)}"

    pulls = [f"({s(i, size)} - " + " - ".join(f"w{j} * {s(i, j)}" for j in range(size)) + ")" for i in range(size)]
    residual = f"({s(size, size)} - " + " - ".join(f"w{j} * {s(size, j)}" for j in range(size)) + ")"
    cost = f"({residual} - " + " - ".join(f"w{j} * {pulls[j]}" for j in range(size)) + ")"
    names = ", ".join(f"w{j}" for j in range(size))
    begin = ", ".join(f"{start}::DOUBLE AS w{j}" for j in range(size))
    update = ", ".join(f"w{j} + rate * 2.0 / s0_0 * {pulls[j]} AS w{j}" for j in range(size))
    next_rate = f"rate * CASE WHEN round = 0 THEN 1 WHEN {cost} < cost THEN 1.05 WHEN {cost} > cost THEN 0.5 ELSE 1 END"
    return f"""
WITH RECURSIVE {TRIPS.strip()},
sums AS (SELECT {sums} FROM bounded),
steps(round, cost, rate, {names}) AS (
  SELECT 0::BIGINT AS round, 0::DOUBLE AS cost, {rate}::DOUBLE AS rate, {begin}
  UNION ALL
  SELECT round + 1, {cost}, ({next_rate})::DOUBLE, {update} FROM steps CROSS JOIN sums WHERE round < {rounds}
)
SELECT round, round(cost, 2) AS cost, round(rate, 8) AS rate,
       {", ".join(f"round(w{j}, 8) AS w{j}" for j in range(size))}
FROM steps WHERE round > 0"""


ORACLE["gd_simple"] = descent_sql(["miles"], "fare", 0.1, 1e-4, 100)
ORACLE["gd_multi"] = descent_sql(["(secs / 60)", "miles", "fare", "surcharge"], "total", 0.1, 1e-3, 100)

# --- orders ----------------------------------------------------------------

add("top_parts", """
SELECT l_partkey AS partkey, count(*) AS num FROM lineitem GROUP BY 1 ORDER BY num DESC, partkey LIMIT 10""")
add("top_customers", """
SELECT custkey, CAST(sum(quantity) AS BIGINT) AS num FROM bought GROUP BY 1 ORDER BY num DESC, custkey LIMIT 10""", STAR)
add("top_customer_suppliers", """
SELECT custkey, suppkey, count(*) AS num FROM bought GROUP BY 1, 2 ORDER BY num DESC, custkey, suppkey LIMIT 10""", STAR)
add("foreign_only_customers", """
SELECT DISTINCT custkey FROM bought
WHERE custkey NOT IN (
  SELECT custkey FROM bought JOIN customer ON custkey = c_custkey JOIN supplier ON suppkey = s_suppkey
  WHERE c_nationkey = s_nationkey)""", STAR)
add("top_nations", """
SELECT s_nationkey AS nationkey, count(*) AS num FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
GROUP BY 1 ORDER BY num DESC, nationkey LIMIT 3""")
add("similar_customers", """
SELECT a, b, round(common::DOUBLE / (na.n + nb.n - common), 9) AS jaccard
FROM (SELECT x.custkey AS a, y.custkey AS b, count(*) AS common
      FROM kept x JOIN kept y ON x.partkey = y.partkey AND x.custkey < y.custkey GROUP BY 1, 2) p
JOIN sizes na ON na.custkey = a JOIN sizes nb ON nb.custkey = b
ORDER BY common::DOUBLE / (na.n + nb.n - common) DESC, a, b LIMIT 10""", STAR, """
sets AS (SELECT DISTINCT custkey, partkey FROM bought),
sizes AS (SELECT custkey, count(*) AS n FROM sets GROUP BY 1 HAVING count(*) >= 10),
kept AS (SELECT custkey, partkey FROM sets JOIN sizes USING (custkey))""")
add("co_bought_parts", """
SELECT x.partkey AS a, y.partkey AS b, count(*) AS num
FROM bought x JOIN bought y ON x.custkey = y.custkey AND x.partkey < y.partkey
GROUP BY 1, 2 ORDER BY num DESC, a, b LIMIT 10""", STAR)
add("co_bought_parts_once", """
SELECT x.partkey AS a, y.partkey AS b, count(*) AS num
FROM once x JOIN once y ON x.custkey = y.custkey AND x.partkey < y.partkey
GROUP BY 1, 2 ORDER BY num DESC, a, b LIMIT 10""", STAR, "once AS (SELECT DISTINCT custkey, partkey FROM bought)")
add("full_order_lines", """
SELECT coalesce(o_orderkey, l_orderkey) AS orderkey, CASE WHEN o_orderkey IS NULL THEN 0 ELSE 1 END::BIGINT AS known,
       coalesce(n, 0)::BIGINT AS lines
FROM orders FULL JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")

add("status_share", """
SELECT l_returnflag, l_linestatus, count(*) AS num,
       count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY l_returnflag) AS share
FROM lineitem GROUP BY 1, 2""")

# --- flights ---------------------------------------------------------------

add("origins", "SELECT DISTINCT origin_airport FROM flights", FLIGHTS)
add("routes", "SELECT DISTINCT origin_airport, destination_airport FROM flights", FLIGHTS)
add("worst_delay_january", """
SELECT origin_airport, delay AS departure_delay FROM flights WHERE month = 1
ORDER BY delay DESC, origin_airport LIMIT 1""", FLIGHTS)
add("worst_delay_weekend", """
SELECT airline, delay AS departure_delay FROM flights WHERE day_of_week IN (6, 7)
ORDER BY delay DESC, airline LIMIT 1""", FLIGHTS)
add("most_cancelled", """
SELECT origin_airport, count(*) AS num FROM flights WHERE cancelled
GROUP BY 1 ORDER BY num DESC, origin_airport LIMIT 1""", FLIGHTS)
add("cancel_ratio", """
SELECT airline, count_if(cancelled)::DOUBLE / count(*) AS ratio FROM flights GROUP BY 1""", FLIGHTS)
add("max_delay", "SELECT airline, max(delay) AS max_delay FROM flights GROUP BY 1", FLIGHTS)
add("max_delay_month", "SELECT airline, month, max(delay) AS max_delay FROM flights GROUP BY 1, 2", FLIGHTS)
add("avg_delay", "SELECT airline, sum(delay)::DOUBLE / count(*) AS avg_delay FROM flights GROUP BY 1", FLIGHTS)
add("avg_delay_month", """
SELECT airline, month, sum(delay)::DOUBLE / count(*) AS avg_delay FROM flights GROUP BY 1, 2""", FLIGHTS)
add("avg_delay_known", """
SELECT airline, sum(delay)::DOUBLE / count(*) AS avg_delay FROM flights WHERE NOT cancelled GROUP BY 1""", FLIGHTS)
add("worst_cancel_date", """
SELECT year, month, day, count_if(cancelled)::DOUBLE / count(*) AS rate FROM flights
GROUP BY 1, 2, 3 ORDER BY rate DESC, year, month, day LIMIT 1""", FLIGHTS)
add("flights_by_state_carrier", """
SELECT state, airline, count(*) AS num FROM flights JOIN airports ON destination_airport = iata_code
GROUP BY 1, 2""", FLIGHTS)
add("state_delays", """
SELECT state, sum(delay)::DOUBLE / count(*) AS avg_delay, count_if(delay = 1)::DOUBLE / count(*) AS share_delay_eq_1
FROM flights JOIN airports ON destination_airport = iata_code GROUP BY 1""", FLIGHTS)
add("worst_state", """
SELECT state, sum(delay)::DOUBLE / count(*) AS avg_delay, count_if(delay = 1)::DOUBLE / count(*) AS share_delay_eq_1
FROM flights JOIN airports ON destination_airport = iata_code GROUP BY 1 ORDER BY avg_delay DESC, state LIMIT 1""", FLIGHTS)

# --- documents -------------------------------------------------------------

add("word_count", "SELECT word, cnt FROM counted", WORDS)
add("dictionary", "SELECT word, cnt, pos FROM dict", WORDS)
add("doc_freq", "SELECT pos, df FROM idfs", WORDS)
add("tf", "SELECT doc_id, pos, cnt, tf FROM tfs", WORDS)
add("idf", "SELECT pos, round(idf, 9) AS idf FROM idfs", WORDS)
add("tfidf", "SELECT doc_id, pos, round(tfidf, 9) AS tfidf FROM vectors", WORDS)
add("avg_tf_by_class", """
SELECT c.lang, w.word, round(coalesce(sum_tf, 0) / n_docs, 9) AS avg_tf
FROM (SELECT lang, count(DISTINCT doc_id) AS n_docs FROM terms GROUP BY 1) c
CROSS JOIN (SELECT unnest(['the', 'and', 'des', 'und', 'los']) AS word) w
LEFT JOIN (SELECT lang, word, sum(tf) AS sum_tf FROM tfs JOIN dict USING (pos) GROUP BY 1, 2) s
  ON s.lang = c.lang AND s.word = w.word""", WORDS)

add("court_averages", """
SELECT CAST(c.label AS BIGINT) AS label, w.word, round(coalesce(sum_tf, 0) / n_docs, 9) AS avg_tf
FROM (SELECT label, count(DISTINCT doc_id) AS n_docs FROM terms GROUP BY 1) c
CROSS JOIN (SELECT unnest(['applicant', 'and', 'attack', 'protein', 'court']) AS word) w
LEFT JOIN (SELECT label, word, sum(tf) AS sum_tf FROM tfs JOIN dict USING (pos) GROUP BY 1, 2) s
  ON s.label = c.label AND s.word = w.word""", WORDS)
add("first_words", "SELECT word, cnt FROM counted ORDER BY word LIMIT 100", WORDS)

QUERY = """
query_words AS (
  SELECT item_id AS query, unnest(string_split(lower(regexp_replace(text, '[^a-zA-Z]+', ' ', 'g')), ' ')) AS word FROM benchmark
),
query_counts AS (SELECT query, pos, count(*) AS n FROM query_words JOIN dict USING (word) GROUP BY 1, 2),
weights AS (
  SELECT query, pos, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY query) * idf AS weight FROM query_counts JOIN idfs USING (pos)
),
lengths AS (SELECT query, sqrt(sum(weight * weight)) AS length FROM weights GROUP BY 1),
products AS (SELECT query, doc_id, sum(tfidf * weight) AS dot FROM vectors JOIN weights USING (pos) GROUP BY 1, 2),
norms AS (SELECT doc_id, sqrt(sum(tfidf * tfidf)) AS norm FROM vectors GROUP BY 1),
dots AS (
  SELECT l.query, n.doc_id, coalesce(dot, 0) AS dot, coalesce(dot / nullif(norm * length, 0), 0) AS cosine
  FROM lengths l CROSS JOIN norms n LEFT JOIN products p ON p.query = l.query AND p.doc_id = n.doc_id
),
links AS (SELECT doc_id, source AS category FROM documents UNION ALL SELECT doc_id, lang FROM documents)
"""


def vote_sql(score: str) -> str:
    return f"""
SELECT query, category, num
FROM (SELECT query, category, num, row_number() OVER (PARTITION BY query ORDER BY num DESC, category) AS place
      FROM (SELECT query, category, count(*) AS num
            FROM (SELECT query, category,
                         row_number() OVER (PARTITION BY query ORDER BY round({score}, 9) DESC, doc_id, category) AS place
                  FROM dots JOIN links USING (doc_id))
            WHERE place <= 10 GROUP BY 1, 2))
WHERE place <= 10"""


add("knn_vote", vote_sql("dot"), WORDS, QUERY)
add("knn_vote_cosine", vote_sql("cosine"), WORDS, QUERY)
add("labelled_docs", """
SELECT doc_id, lang, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS label FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels)""")
add("doc_union", """
SELECT CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'train' ELSE 'test' END AS split,
       CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS label, count(*) AS num
FROM documents GROUP BY 1, 2""")

# --- posts -----------------------------------------------------------------

add("tokens_trimmed", "SELECT word, cnt FROM trimmed_count", POSTS)
add("tokens_strict", "SELECT word, count(*) AS cnt FROM strict GROUP BY word", POSTS)
add("sparse_counts", """
SELECT doc_id, coalesce(string_agg(CAST(pos AS VARCHAR) || ':' || CAST(cnt AS VARCHAR), ',' ORDER BY pos)
                        FILTER (pos < 100), '') AS counts
FROM posts LEFT JOIN (SELECT doc_id, pos, count(*) AS cnt FROM strict JOIN post_dict USING (word) GROUP BY 1, 2) USING (doc_id)
GROUP BY doc_id""", POSTS)
LANGUAGES = """
per_word AS (SELECT lang, pos, sum(cnt) AS n FROM terms GROUP BY 1, 2),
totals AS (SELECT lang, sum(n) AS total FROM per_word GROUP BY 1),
priors AS (SELECT lang, ln(count(*)::DOUBLE / (SELECT count(*) FROM docs)) AS log_pi FROM docs GROUP BY 1),
log_mu AS (
  SELECT t.lang AS cluster, d.pos,
         ln((coalesce(n, 0) + 0.1::DOUBLE) / (total + 0.1::DOUBLE * (SELECT count(*) FROM dict))) AS log_mu
  FROM totals t CROSS JOIN dict d LEFT JOIN per_word p ON p.lang = t.lang AND p.pos = d.pos),
logs AS (
  SELECT docs.doc_id, priors.lang AS cluster, coalesce(s, 0) + log_pi AS l
  FROM docs CROSS JOIN priors LEFT JOIN (
    SELECT doc_id, cluster, sum(cnt * log_mu) AS s FROM terms JOIN log_mu USING (pos) GROUP BY ALL
  ) w ON w.doc_id = docs.doc_id AND w.cluster = priors.lang),
posteriors AS (
  SELECT doc_id, cluster, exp(l - biggest) / sum(exp(l - biggest)) OVER (PARTITION BY doc_id) AS p
  FROM (SELECT *, max(l) OVER (PARTITION BY doc_id) AS biggest FROM logs))
"""
DRAWN = """
edges AS (
  SELECT doc_id, sum(p) OVER (PARTITION BY doc_id ORDER BY cluster ROWS UNBOUNDED PRECEDING) AS edge,
         row_number() OVER (PARTITION BY doc_id ORDER BY cluster DESC) AS from_last,
         CAST('0x' || substr(md5('7:1:' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM posteriors),
drawn AS (SELECT doc_id, count(*) FILTER (from_last > 1 AND u >= edge) AS cluster FROM edges GROUP BY doc_id)
"""
add("mixture_posterior", "SELECT doc_id, cluster, round(p, 6) AS p FROM posteriors", WORDS, LANGUAGES)
add("mixture_draw", "SELECT doc_id, cluster FROM drawn", WORDS, LANGUAGES, DRAWN)
add("mixture_sweep", """
SELECT cluster, pos, CAST(sum(cnt) AS BIGINT) AS n FROM terms JOIN drawn USING (doc_id) GROUP BY 1, 2
UNION ALL SELECT cluster, -1, count(*) FROM drawn GROUP BY 1""", WORDS, LANGUAGES, DRAWN)



def weights_sql(number: int) -> str:
    """CTEs from ``shapes`` (``cluster, pos, a``) to the weights of that round: the first of 16 proposals that is not rejected."""
    digits = ", ".join(
        f"(CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS u{i}" for i in range(4)
    )
    return f"""
digests AS (SELECT cluster, pos, a, k, md5(concat_ws(':', '7', '{number}', cluster, pos, k)) AS h FROM shapes, range(16) AS t(k)),
units AS (SELECT cluster, pos, a, k, a + 2::DOUBLE / 3 AS d, {digits} FROM digests),
normals AS (SELECT *, sqrt(-2 * ln(u0)) * cos(2 * pi() * u1) AS x FROM units),
cubes AS (SELECT *, pow(1 + x / sqrt(9 * d), 3) AS v FROM normals),
proposals AS (
  SELECT cluster, pos, k, d, CASE WHEN v > 0 AND ln(u2) < 0.5::DOUBLE * x * x + d - d * v + d * ln(CASE WHEN v > 0 THEN v END)
                                  THEN ln(d * CASE WHEN v > 0 THEN v END) + ln(u3) / a END AS g
  FROM cubes),
gammas AS (SELECT cluster, pos, coalesce(arg_min(g, k) FILTER (g IS NOT NULL), ln(any_value(d))) AS g FROM proposals GROUP BY 1, 2),
parts AS (SELECT *, CASE WHEN pos < 0 THEN -1 ELSE cluster END AS draw FROM gammas),
drawn_weights AS (
  SELECT cluster, pos, exp(g - most) / sum(exp(g - most)) OVER (PARTITION BY draw) AS weight
  FROM (SELECT *, max(g) OVER (PARTITION BY draw) AS most FROM parts))
"""


WEIGHTS = "SELECT CAST(cluster AS BIGINT) AS cluster, CAST(pos AS BIGINT) AS pos, round(weight, 9) AS weight FROM drawn_weights"
add("mixture_start", WEIGHTS, WORDS, """
places AS (SELECT pos FROM dict UNION ALL SELECT -1),
shapes AS (SELECT cluster, pos, 0.1::DOUBLE AS a FROM places, range(20) AS c(cluster))
""", weights_sql(0))
add("mixture_weights", WEIGHTS, WORDS, LANGUAGES, DRAWN, """
swept AS (
  SELECT cluster, pos, sum(cnt) AS n FROM terms JOIN drawn USING (doc_id) GROUP BY 1, 2
  UNION ALL SELECT cluster, -1, count(*) FROM drawn GROUP BY 1),
places AS (SELECT pos FROM dict UNION ALL SELECT -1),
cells AS (SELECT cluster, pos FROM places, range((SELECT count(DISTINCT lang) FROM docs)) AS c(cluster)),
shapes AS (SELECT cluster, pos, 0.1::DOUBLE + coalesce(n, 0)::DOUBLE AS a FROM cells LEFT JOIN swept USING (cluster, pos))
""", weights_sql(1))
add("language_words", """
SELECT cluster, word, round(exp(log_mu), 9) AS mu, CAST(rank AS INTEGER) AS rank
FROM (SELECT cluster, word, log_mu,
             row_number() OVER (PARTITION BY cluster ORDER BY coalesce(n, 0) DESC, word) AS rank
      FROM log_mu JOIN dict USING (pos) LEFT JOIN per_word p ON p.lang = cluster AND p.pos = log_mu.pos)
WHERE rank <= 50""", WORDS, LANGUAGES)
add("drawn_categories", """
SELECT cluster, lang, share, CAST(rank AS INTEGER) AS rank
FROM (SELECT cluster, lang, n::DOUBLE / sum(n) OVER (PARTITION BY cluster) AS share,
             row_number() OVER (PARTITION BY cluster ORDER BY n DESC, lang) AS rank
      FROM (SELECT cluster, lang, count(*) AS n FROM drawn JOIN docs USING (doc_id) GROUP BY 1, 2))
WHERE rank <= 3""", WORDS, LANGUAGES, DRAWN)

# --- classification --------------------------------------------------------

add("logit_predict", "SELECT doc_id, round(chance, 9) AS chance, CAST(predicted AS BIGINT) AS predicted FROM predicted",
    SCORES)
add("logit_loss", """
SELECT round(sum(greatest(z, 0) + ln(1 + exp(-abs(z))) - label * z), 6) AS loss FROM scores""", SCORES)
add("logit_eval", """
SELECT tp, tn, fp, fn, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(2 * precision * recall / (precision + recall), 9) AS f1
FROM (
  SELECT *, tp::DOUBLE / nullif(tp + fp, 0) AS precision, tp::DOUBLE / nullif(tp + fn, 0) AS recall
  FROM (SELECT count_if(label = 1 AND predicted = 1)::BIGINT AS tp, count_if(label = 0 AND predicted = 0)::BIGINT AS tn,
               count_if(label = 0 AND predicted = 1)::BIGINT AS fp, count_if(label = 1 AND predicted = 0)::BIGINT AS fn
        FROM predicted))""", SCORES)
add("logit_false_positives", """
SELECT doc_id, 'http://e/' || CAST(doc_id AS VARCHAR) AS url FROM predicted WHERE label = 0 AND predicted = 1""", SCORES)


def fit_parts(rounds: int, where: str) -> str:
    """Gradient descent unrolled: ``w{r}``, ``rate{r}`` and ``loss{r}`` after every round."""
    rows = f"train AS MATERIALIZED (SELECT doc_id, label, pos, tfidf FROM vectors WHERE {where})"
    parts = [rows, "w0 AS MATERIALIZED (SELECT pos, 0.01::DOUBLE AS w FROM (SELECT DISTINCT pos FROM dict))"]
    for r in range(1, rounds + 1):
        parts.append(
            f"z{r} AS MATERIALIZED (SELECT doc_id, any_value(label) AS label, sum(tfidf * w) AS z "
            f"FROM train JOIN w{r - 1} USING (pos) GROUP BY doc_id)"
        )
        weights = f"(SELECT sqrt(sum(w * w) + (20000 - count(*)) * 0.0001) FROM w{r - 1})"
        parts.append(
            f"loss{r} AS MATERIALIZED (SELECT sum(greatest(z, 0) + ln(1 + exp(-abs(z))) - label * z) + {weights} AS loss FROM z{r})"
        )
        before = "SELECT 0.1::DOUBLE AS rate" if r == 1 else (
            f"SELECT rate * CASE WHEN {r - 1} = 1 THEN 1 "
            f"WHEN (SELECT loss FROM loss{r - 1}) < (SELECT loss FROM loss{max(r - 2, 1)}) THEN 1.05 ELSE 0.5 END AS rate "
            f"FROM rate{r - 1}"
        )
        parts.append(f"rate{r} AS MATERIALIZED ({before})")
        parts.append(
            f"w{r} AS MATERIALIZED (SELECT pos, w - (SELECT rate FROM rate{r}) * coalesce(g, 0) AS w FROM w{r - 1} "
            f"LEFT JOIN (SELECT pos, sum(tfidf * (1 / (1 + exp(-z)) - train.label)) AS g "
            f"FROM train JOIN z{r} USING (doc_id) GROUP BY pos) USING (pos))"
        )
    return ",\n".join(parts)


ROUNDS = 8
FITTED = fit_parts(ROUNDS, "TRUE")
add("logit_two_rounds", "SELECT word, round(w, 9) AS coefficient FROM w2 JOIN dict USING (pos)", WORDS,
    fit_parts(2, "TRUE"))
add("logit_trace", " UNION ALL ".join(
    f"SELECT {r}::BIGINT AS round, round((SELECT loss FROM loss{r}), 6) AS loss, round((SELECT rate FROM rate{r + 1}), 6) AS rate, "
    f"round(sqrt(sum((a.w - b.w) * (a.w - b.w))), 6) AS step FROM w{r} a JOIN w{r - 1} b USING (pos)"
    for r in range(1, ROUNDS + 1)), WORDS, fit_parts(ROUNDS + 1, "TRUE"))
add("logit_top_words", f"""
SELECT word, round(w, 6) AS coefficient FROM w{ROUNDS} JOIN dict USING (pos) ORDER BY w DESC, pos LIMIT 5""", WORDS, FITTED)
add("logit_split_eval", f"""
SELECT tp, tn, fp, fn, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(2 * precision * recall / (precision + recall), 9) AS f1
FROM (
  SELECT *, tp::DOUBLE / nullif(tp + fp, 0) AS precision, tp::DOUBLE / nullif(tp + fn, 0) AS recall
  FROM (SELECT count_if(label = 1 AND z >= 0)::BIGINT AS tp, count_if(label = 0 AND z < 0)::BIGINT AS tn,
               count_if(label = 0 AND z >= 0)::BIGINT AS fp, count_if(label = 1 AND z < 0)::BIGINT AS fn
        FROM (SELECT label, coalesce(z, 0) AS z
              FROM docs LEFT JOIN (SELECT doc_id, sum(tfidf * w) AS z FROM vectors JOIN w{ROUNDS} USING (pos) GROUP BY doc_id) USING (doc_id)
              WHERE doc_id NOT IN (SELECT doc_id FROM labels))))""", WORDS,
    fit_parts(ROUNDS, "doc_id IN (SELECT doc_id FROM labels)"))
