"""The registered queries as DuckDB SQL over the given tables."""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

RATING_TOP = """
SELECT l_suppkey AS movie_id, avg(l_quantity) AS mean_rating, count(l_quantity) AS ratings
FROM lineitem GROUP BY l_suppkey HAVING count(l_quantity) > 200
ORDER BY mean_rating DESC, movie_id LIMIT 10"""

NAMED = """
SELECT 'film ' || l_suppkey AS movie_id, avg(l_quantity) AS mean_rating, count(l_quantity) AS ratings
FROM lineitem WHERE l_discount <= 0.03 GROUP BY l_suppkey"""

WORDS = "regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{N}]+')"
DOCUMENT_WORDS = f"SELECT 0 AS user_id, unnest({WORDS}) AS word FROM documents"
USER_WORDS = f"SELECT conv_id AS user_id, unnest({WORDS}) AS word FROM conversations WHERE role = 'user'"
SYLLABLES = ("SELECT unnest(['en', 'er', 'es', 'eau', 'eaux', 'ent', 'entier', 'ier', 'in', 'ing', 'on', 'ou', 're', "
             "'st', 'the', 'th', 'tion', 'wh']) AS piece, 1000 AS cost")
SHORT_TERMS = f"""
SELECT word AS piece, greatest(CAST(round(-1000 * ln(n / (SELECT count(*) FROM ({USER_WORDS}) WHERE length(word) <= 6))) AS BIGINT), 1) AS cost
FROM (SELECT word, count(*) AS n FROM ({USER_WORDS}) WHERE length(word) <= 6 GROUP BY word)"""


def segments(rows: str, dictionary: str, loose: str) -> str:
    """(user_id, term, searches): best paths through the words of `rows` (user_id, word).

    Costs of suffixes are built from each word's end, one place a round; then the words are walked
    from the left, by the longest edge that is on a cheapest path. `loose`: the size of a loose edge.
    """
    return f"""
WITH RECURSIVE counted AS (SELECT user_id, word, count(*) AS n FROM ({rows}) GROUP BY user_id, word),
dictionary AS ({dictionary}),
places AS (SELECT word, unnest(range(1, length(word) + 1)) AS place FROM (SELECT DISTINCT word FROM counted)),
found AS (
  SELECT word, place, size, cost
  FROM (SELECT word, place, unnest(range(1, least(length(word) - place + 1, (SELECT max(length(piece)) FROM dictionary)) + 1)) AS size
        FROM places) JOIN dictionary ON substr(word, place, size) = piece
  UNION ALL SELECT word, place, {loose} AS size, 20000 * ({loose}) AS cost FROM places),
edges AS (SELECT word, place, list({{'size': size, 'cost': cost}}) AS ways FROM found GROUP BY word, place),
suffixes AS (
  SELECT DISTINCT word, length(word) + 1 AS place, [CAST(0 AS BIGINT)] AS best FROM counted
  UNION ALL
  SELECT s.word, e.place, list_prepend(list_min([CAST(x.cost + best[x.size] AS BIGINT) FOR x IN ways]), best)
  FROM suffixes AS s JOIN edges AS e ON e.word = s.word AND e.place = s.place - 1),
steps AS (
  SELECT e.word, e.place,
         list_max([x.size FOR x IN ways IF x.cost + best[e.place + x.size] = best[e.place]]) AS size
  FROM edges AS e JOIN (SELECT word, best FROM suffixes WHERE place = 1) AS s ON s.word = e.word),
walk AS (
  SELECT word, place, size FROM steps WHERE place = 1
  UNION ALL
  SELECT t.word, t.place, t.size FROM walk AS w JOIN steps AS t ON t.word = w.word AND t.place = w.place + w.size)
SELECT user_id, substr(walk.word, place, size) AS term, CAST(sum(n) AS BIGINT) AS searches
FROM walk JOIN counted ON counted.word = walk.word GROUP BY ALL"""


EACH, REST = "1", "length(word) - place + 1"


def top_terms(counted: str, columns: str = "term") -> str:
    return f"SELECT {columns}, searches FROM ({counted}) ORDER BY searches DESC, {columns} LIMIT 10"


DOCUMENT_TERMS = f"SELECT word AS term, count(*) AS searches FROM ({DOCUMENT_WORDS}) GROUP BY word"
USER_TERMS = f"SELECT user_id, word AS term, count(*) AS searches FROM ({USER_WORDS}) GROUP BY user_id, word"


def windows(size: str, slide: str, ratio: int, where: str = "") -> str:
    """Every window that holds a row, by counting back from the newest one."""
    return f"""
SELECT window_start, window_start + INTERVAL {size} AS window_end, event_type, count(*) AS n
FROM (SELECT time_bucket(INTERVAL {slide}, ts, TIMESTAMP '1970-01-01')
             - back.i * INTERVAL {slide} AS window_start, event_type
      FROM events, (SELECT unnest(range({ratio})) AS i) AS back)
GROUP BY window_start, event_type {where}"""


TAIL = "HAVING window_start + INTERVAL {size} <= (SELECT max(ts) - INTERVAL '10 minutes' FROM events)"


def window_top(counted: str) -> str:
    return f"""
SELECT window_start, window_end, event_type, n, place
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY n DESC, event_type) AS INTEGER) AS place
      FROM ({counted}))
WHERE place <= 3"""


# Batches as `standins.arrivals` deals them, and the limit of each: the newest of earlier ones less seven days.
ARRIVED = """
WITH timed AS (SELECT *, epoch_us(ts) AS us FROM events),
arrived AS (SELECT *, CAST((us - (SELECT min(us) FROM timed)) * 6 // (SELECT max(us) - min(us) + 1 FROM timed) AS BIGINT)
                      + CASE WHEN event_id % 97 = 5 THEN 2 ELSE 0 END AS batch_id FROM timed),
limits AS (SELECT batch_id, max(max(us)) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                            - 7 * 86400000000 AS limit_micros FROM arrived GROUP BY batch_id),
judged AS (SELECT *, coalesce(us < limit_micros, false) AS late FROM arrived JOIN limits USING (batch_id))
"""

DEVICES = f"""
(SELECT event_id, ts, user_id AS device, event_type AS device_type, CAST({K} AS DOUBLE) AS signal FROM events)"""
STRONG = f"SELECT event_id, device, device_type, signal FROM {DEVICES} WHERE signal > 30"
DEVICE_STATS = f"""
SELECT device_type, count(*) AS devices, avg(signal) AS mean_signal
FROM {DEVICES} WHERE signal > 30 GROUP BY device_type"""

DEVICES_BY_TYPE = f"SELECT device_type, count(*) AS devices FROM {DEVICES} GROUP BY device_type"
DISTINCT_DEVICES = f"""
SELECT device_type, count(DISTINCT device) AS devices FROM {DEVICES} GROUP BY device_type"""
MEAN_SIGNAL = f"SELECT device_type, avg(signal) AS mean_signal FROM {DEVICES} GROUP BY device_type"

ANSWERS = f"""
(SELECT CAST(user_id AS VARCHAR) AS student_id,
        event_type || '-' || CAST({K} AS VARCHAR) AS question_id,
        event_type AS subject, CAST(user_id % 6 + 1 AS VARCHAR) AS grade,
        value AS score, CASE WHEN value > 50 THEN 0 ELSE 1 END AS correct, ts
 FROM events)"""


def answer_stats(by: str) -> str:
    return f"""
SELECT {by}, count(*) AS answers, CAST(sum(1 - correct) AS BIGINT) AS wrong,
       sum(1 - correct) / CAST(count(*) AS DOUBLE) AS wrong_rate
FROM {ANSWERS} GROUP BY {by}"""


REPORT = f"""
SELECT student_id, subject, count(*) AS answers, CAST(sum(1 - correct) AS BIGINT) AS wrong,
       count(DISTINCT question_id) AS questions, min(ts) AS first_answer, max(ts) AS last_answer,
       sum(1 - correct) / CAST(count(*) AS DOUBLE) AS wrong_rate
FROM {ANSWERS} GROUP BY student_id, subject"""


def shape(ids: str) -> str:
    return f"""
SELECT id, CAST(5 AS BIGINT) AS recommendations, CAST(5 AS BIGINT) AS distinct_ids,
       CAST(5 AS BIGINT) AS last_place, true AS best_first
FROM (SELECT DISTINCT {ids})"""


ORDERED = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"

PLANTED = """
WITH planted AS (
  SELECT user, item, CASE WHEN (user + item) % 3 = 0 THEN 5.0 ELSE 1.0 END::DOUBLE + (item % 4) / 8 AS rating,
         ((user % 1000003) * 31 + item % 1000003) % 5 = 0 AS test
  FROM (SELECT DISTINCT o_custkey AS user, l_partkey AS item FROM lineitem JOIN orders ON l_orderkey = o_orderkey)),
means AS (SELECT item, avg(rating) AS score FROM planted WHERE NOT test GROUP BY item)"""
RANKING = f"""{PLANTED},
placed AS (SELECT user, rating >= 5 AS liked, row_number() OVER (PARTITION BY user ORDER BY score DESC NULLS LAST, item) AS place
           FROM planted LEFT JOIN means USING (item) WHERE test),
judged AS (SELECT user, count(*) FILTER (liked AND place <= 3) AS hits, count(*) FILTER (liked) AS relevant,
                  coalesce(sum(1 / log2(place + 1)) FILTER (liked AND place <= 3), 0) AS gain FROM placed GROUP BY user)
SELECT user, hits, relevant, hits / 3 AS precision, hits / relevant AS recall,
       gain / (CASE least(relevant, 3) WHEN 1 THEN 1 WHEN 2 THEN 1 + 1 / log2(3) ELSE 1 + 1 / log2(3) + 0.5 END) AS ndcg
FROM judged WHERE relevant > 0"""

SQL: dict[str, str] = {
    "rating_top10": RATING_TOP,
    "rating_top10_sql": RATING_TOP,
    "rating_top10_named": f"SELECT * FROM ({NAMED}) WHERE ratings > 200 ORDER BY mean_rating DESC, movie_id LIMIT 10",
    "rated_often_named": f"SELECT * FROM ({NAMED}) WHERE ratings > 200",
    "mean_ratings": """
SELECT l_suppkey AS movie_id, avg(l_quantity) AS mean_rating, count(l_quantity) AS ratings
FROM lineitem GROUP BY l_suppkey""",
    "hot_keywords_top10": top_terms(DOCUMENT_TERMS),
    "hot_segments_top10": top_terms(segments(DOCUMENT_WORDS, SYLLABLES, EACH)),
    "hot_segments_top10_lookup": top_terms(segments(DOCUMENT_WORDS, SHORT_TERMS, REST)),
    "segment_counts": f"SELECT term, searches FROM ({segments(DOCUMENT_WORDS, SHORT_TERMS, REST)})",
    "user_segments_top10": top_terms(segments(USER_WORDS, SYLLABLES, EACH), "user_id, term"),
    "keyword_counts": DOCUMENT_TERMS,
    "user_hot_terms_top10": top_terms(USER_TERMS, "user_id, term"),
    "user_top_terms": f"""
SELECT user_id, term, searches, place
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY searches DESC, term) AS INTEGER) AS place
      FROM ({USER_TERMS}))
WHERE place <= 3""",
    "user_keywords_top10": f"""
SELECT term, CAST(sum(searches) AS BIGINT) AS searches FROM ({USER_TERMS})
GROUP BY term ORDER BY searches DESC, term LIMIT 10""",
    "search_heat_by_hour": """
SELECT CAST(hour(ts) AS INTEGER) AS period, count(*) AS searches FROM events GROUP BY 1""",
    "search_heat_by_day": """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS period, count(*) AS searches FROM events GROUP BY 1""",
    "search_log_scan": f"""
SELECT date_trunc('second', ts) AS ts, CAST(user_id AS VARCHAR) AS user_id, event_type AS query, {K} AS result_rank,
       CAST(event_id % 10 AS INTEGER) AS click_seq, 'example/' || event_id AS url FROM events""",
    "search_log_report": """
SELECT user_id, term, searches, place
FROM (SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS term, count(*) AS searches,
             CAST(row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS INTEGER) AS place
      FROM events GROUP BY user_id, event_type)
WHERE place <= 2""",
    "tumbling_counts": windows("'1 hour'", "'1 hour'", 1),
    "sliding_counts": windows("'1 hour'", "'20 minutes'", 3),
    "sliding_counts_by_panes": windows("'1 day'", "'1 hour'", 24),
    "sliding_top3": window_top(windows("'2 days'", "'1 day'", 2)),
    # Windows that the watermark has not passed when the input ends stay in state.
    "tumbling_counts_stream": windows("'1 hour'", "'1 hour'", 1, TAIL.format(size="'1 hour'")),
    "sliding_top3_stream": window_top(windows("'2 days'", "'1 day'", 2, TAIL.format(size="'2 days'"))),
    "sliding_top3_live": window_top(windows("'2 days'", "'1 day'", 2)),
    "sliding_top3_live_panes": window_top(windows("'2 days'", "'1 day'", 2)),
    # A pane waits for its last window, so windows close five hours later than their own watermark.
    "sliding_counts_chained_stream": windows("'6 hours'", "'1 hour'", 6, """
HAVING window_start + INTERVAL '6 hours' <= (SELECT max(ts) - INTERVAL '10 minutes' - INTERVAL '5 hours' FROM events)"""),
    "late_rows_stream": f"{ARRIVED} SELECT event_id, event_type, us AS micros, limit_micros, batch_id FROM judged WHERE late",
    "on_time_counts_stream": f"""{ARRIVED}
SELECT time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS window_start, window_start + INTERVAL '1 hour' AS window_end,
       event_type, count(*) AS n
FROM judged WHERE NOT late GROUP BY ALL""",
    "late_totals_stream": f"{ARRIVED} SELECT max(us) AS newest_micros, count(*) AS rows, count(*) FILTER (late) AS late FROM judged",
    "signal_over_30": STRONG,
    "signal_over_30_sql": STRONG,
    "devices_by_type": DEVICES_BY_TYPE,
    "devices_by_type_sql": DEVICES_BY_TYPE,
    "distinct_devices_by_type": DISTINCT_DEVICES,
    "distinct_devices_stream": DISTINCT_DEVICES,
    "distinct_devices_sketched": f"SELECT DISTINCT device_type, true AS close FROM {DEVICES}",
    "mean_signal_by_type": MEAN_SIGNAL,
    "mean_signal_by_type_sql": MEAN_SIGNAL,
    "device_stats": DEVICE_STATS,
    "device_stats_sql": DEVICE_STATS,
    "device_stats_stream": DEVICE_STATS,
    "all_device_stats_stream": f"""
SELECT device_type, count(*) AS devices, avg(signal) AS mean_signal FROM {DEVICES} GROUP BY device_type""",
    "device_stats_stream_sql": DEVICE_STATS,
    "signal_over_30_stream": f"""
SELECT CAST(device AS VARCHAR) AS device, device_type, signal, epoch_us(ts) // 1000 AS millis
FROM {DEVICES} WHERE signal > 30""",
    "station_etl": f"""
SELECT CAST(user_id AS VARCHAR) AS station_id, 'out-' || event_id AS call_out,
       'in-' || event_id AS call_in, event_type AS status, ts AS call_time,
       CAST({K} AS BIGINT) AS duration
FROM events WHERE event_type <> 'error' AND {K} >= 10""",
    "answer_stats": answer_stats("question_id"),
    "answer_stats_by_grade": answer_stats("subject, grade"),
    "error_prone_top": f"""
SELECT * FROM ({answer_stats('question_id')}) WHERE answers >= 10
ORDER BY wrong_rate DESC, question_id LIMIT 10""",
    "learning_report": REPORT,
    "answer_stats_stream": answer_stats("question_id"),
    "learning_report_stored": REPORT,
    "als_user_recs_shape": shape(f"o_custkey AS id {ORDERED}"),
    "als_item_recs_shape": shape(f"l_partkey AS id {ORDERED}"),
    "als_subset_user_recs_shape": shape(f"""o_custkey AS id {ORDERED}
      JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'"""),
    "als_subset_item_recs_shape": shape(f"""l_partkey AS id {ORDERED}
      JOIN part ON p_partkey = l_partkey WHERE p_type = 'ECONOMY'"""),
    "baseline_ranking_by_user": RANKING,
    "baseline_ranking": f"""
SELECT count(*) AS users, avg(precision) AS precision, avg(recall) AS recall, avg(ndcg) AS ndcg FROM ({RANKING})""",
    "baseline_errors": f"""{PLANTED}
SELECT count(*) AS rows, sqrt(avg((rating - score) ** 2)) AS rmse_of_item_mean,
       sqrt(avg((rating - (SELECT avg(rating) FROM planted WHERE NOT test)) ** 2)) AS rmse_of_mean
FROM planted JOIN means USING (item) WHERE test""",
    # Held-out pairs of a user and an item that both have other pairs.
    "als_ranking": f"""{PLANTED},
tested AS (SELECT * FROM planted WHERE test AND user IN (SELECT user FROM planted WHERE NOT test)
           AND item IN (SELECT item FROM planted WHERE NOT test))
SELECT count(*) AS test_rows, count(DISTINCT user) FILTER (rating >= 5) AS users, true AS ranks_better, true AS half_the_error
FROM tested""",
    "ml_held_out": """
SELECT CAST(embedding[1] + embedding[2] > 0 AS INTEGER) AS side, count(*) AS rows, true AS mostly_right
FROM embeddings WHERE vec_id % 5 = 0 GROUP BY side""",
    "difficulty_ratings": f"""
SELECT student_id, question_id, CAST(sum(1 - correct) / CAST(count(*) AS DOUBLE) AS FLOAT) AS rating
FROM {ANSWERS} GROUP BY student_id, question_id""",
    "live_recs_shape": f"""
SELECT DISTINCT student_id, CAST(1 AS BIGINT) AS model_version, CAST(2 AS INTEGER) AS questions,
       CAST(2 AS INTEGER) AS distinct_questions FROM {ANSWERS}""",
    "answers_with_recs": f"""
SELECT student_id, question_id, subject, correct, CAST(2 AS INTEGER) AS questions FROM {ANSWERS}""",
    "ml_cleaning": f"""
WITH kept AS (SELECT event_id, device_type, CASE WHEN signal >= 5 THEN signal END AS signal
              FROM {DEVICES} WHERE device_type <> 'error'),
     types AS (SELECT device_type, row_number() OVER (ORDER BY count(*) DESC, device_type) - 1 AS type_index
               FROM kept GROUP BY device_type)
SELECT event_id, device_type, coalesce(signal, (SELECT avg(signal) FROM kept)) AS signal_filled,
       type_index
FROM kept JOIN types USING (device_type)""",
}
