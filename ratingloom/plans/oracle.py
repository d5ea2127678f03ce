"""DuckDB SQL for the queries of the registry: what each of them has to return.

Every entry is complete SQL over the tables. Common table expressions shared by
several entries are written once below and put in front of the final SELECT.
"""

from __future__ import annotations

# --- inputs ------------------------------------------------------------------

CTES: dict[str, str] = {
    "ratings": """
        SELECT CAST(o_custkey AS INTEGER) AS userId, CAST(l_partkey AS INTEGER) AS movieId,
               CAST(least(5.0, greatest(0.5, ceil(l_quantity / 5) * 0.5)) AS DOUBLE) AS rating,
               CAST(epoch(l_shipdate) AS BIGINT) AS timestamp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "movies": """
        SELECT CAST(p_partkey AS INTEGER) AS movieId,
               CASE WHEN p_partkey % 10 = 0 THEN p_name
                    ELSE p_name || ' (' || CAST(1950 + p_partkey % 75 AS VARCHAR) || ')' END AS title,
               p_type AS genres
        FROM part""",
    "links": """
        SELECT CAST(p_partkey AS INTEGER) AS movieId, CAST(p_partkey * 7 AS VARCHAR) AS tmdbId
        FROM part WHERE p_partkey % 13 <> 0""",
    "item_factors": """
        SELECT CAST(vec_id AS INTEGER) AS movieId, CAST(embedding AS DOUBLE[]) AS features FROM embeddings""",
    "messages": """
        SELECT event_id,
               CASE event_type WHEN 'error' THEN concat_ws(',', u, m)
                               WHEN 'signup' THEN concat_ws(',', u, m, 'NA')
                               ELSE concat_ws(',', u, m, r) END AS value
        FROM (SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS u,
                     CAST(10 * CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) AS m,
                     CAST(CAST(least(5.0, greatest(0.5, ceil(value / 10) * 0.5)) AS DOUBLE) AS VARCHAR) AS r
              FROM events)""",
    "parsed": """
        SELECT event_id, value,
               TRY_CAST(split_part(value, ',', 1) AS INTEGER) AS userId,
               TRY_CAST(split_part(value, ',', 2) AS INTEGER) AS movieId,
               TRY_CAST(split_part(value, ',', 3) AS FLOAT) AS rating
        FROM messages""",
    "fresh": """
        SELECT userId, movieId, rating FROM parsed
        WHERE userId IS NOT NULL AND movieId IS NOT NULL AND rating IS NOT NULL""",
    # --- preparation ---------------------------------------------------------
    "active": """
        SELECT * FROM ratings
        WHERE userId IN (SELECT userId FROM ratings GROUP BY userId HAVING count(*) >= 5)
          AND movieId IN (SELECT movieId FROM ratings GROUP BY movieId HAVING count(*) >= 30)""",
    "split": """
        SELECT min(timestamp) AS p
        FROM (SELECT timestamp, cume_dist() OVER (ORDER BY timestamp) AS share FROM active)
        WHERE share >= 0.8""",
    "train": "SELECT active.* FROM active, split WHERE timestamp <= p",
    "test": "SELECT active.* FROM active, split WHERE timestamp > p",
    "user_ids": """
        SELECT userId, CAST(row_number() OVER (ORDER BY userId) - 1 AS INTEGER) AS new_userId
        FROM (SELECT DISTINCT userId FROM active)""",
    "movie_ids": """
        SELECT movieId, CAST(row_number() OVER (ORDER BY movieId) - 1 AS INTEGER) AS new_movieId
        FROM (SELECT DISTINCT movieId FROM active)""",
    # --- evaluation ----------------------------------------------------------
    "predictions": """
        SELECT test.*, prediction
        FROM test JOIN (SELECT movieId, avg(rating) AS prediction FROM train GROUP BY movieId) USING (movieId)""",
    "ranked": """
        SELECT * FROM (
            SELECT userId, movieId, CAST(CASE WHEN rating >= 3.5 THEN 1 ELSE 0 END AS INTEGER) AS is_good_item,
                   prediction,
                   CAST(rank() OVER (PARTITION BY userId ORDER BY prediction DESC) AS INTEGER) AS rank
            FROM predictions)
        WHERE rank <= 10""",
    "hits": """
        SELECT userId, max(is_good_item) AS has_hit, sum(is_good_item / log2(rank + 1)) AS dcg
        FROM ranked GROUP BY userId""",
    "goods": "SELECT userId, count(*) AS num_good_items FROM test WHERE rating >= 3.5 GROUP BY userId",
    "user_scores": """
        SELECT userId, dcg, ideal_dcg, dcg / ideal_dcg AS ndcg
        FROM (SELECT userId, dcg,
                     list_sum(list_transform(range(1, least(num_good_items, 10) + 1),
                                             lambda i: 1.0 / log2(i + 1))) AS ideal_dcg
              FROM hits JOIN goods USING (userId))""",
    # --- fold-in -------------------------------------------------------------
    "pairs": "SELECT userId, movieId, count(*) AS n, sum(CAST(rating AS DOUBLE)) AS total FROM fresh GROUP BY userId, movieId",
    "history": """
        SELECT userId, movieId, 1 AS n, CAST(max(rating) AS DOUBLE) AS total FROM fresh GROUP BY userId, movieId""",
    # --- exploration ---------------------------------------------------------
    "movie_counts": "SELECT movieId, count(*) AS count FROM ratings GROUP BY movieId",
    "user_counts": "SELECT userId, count(*) AS count FROM ratings GROUP BY userId",
    "dated": """
        SELECT movieId, title, TRY_CAST(regexp_extract(title, '\\((\\d{4})\\)', 1) AS INTEGER) AS ReleaseYear
        FROM movies""",
    "rated_by_year": """
        SELECT ReleaseYear, count AS rating_count
        FROM movie_counts JOIN dated USING (movieId) WHERE ReleaseYear IS NOT NULL""",
    "tail": """
        SELECT movieId, count, row_number() OVER (ORDER BY count DESC, movieId) AS position FROM movie_counts""",
    # --- serving -------------------------------------------------------------
    "favourites": """
        SELECT userId, movieId, place FROM (
            SELECT userId, movieId, row_number() OVER (PARTITION BY userId ORDER BY mean DESC, movieId) AS place
            FROM (SELECT userId, movieId, avg(rating) AS mean FROM ratings GROUP BY userId, movieId))
        WHERE place <= 10""",
    "low_favourites": """
        SELECT userId, movieId, place FROM (
            SELECT userId, movieId, row_number() OVER (PARTITION BY userId ORDER BY mean DESC, movieId) AS place
            FROM (SELECT userId, movieId, avg(rating) AS mean FROM ratings WHERE rating < 3
                  GROUP BY userId, movieId))
        WHERE place <= 10""",
    "fresh_favourites": """
        SELECT userId, movieId, place FROM (
            SELECT userId, movieId, row_number() OVER (PARTITION BY userId ORDER BY mean DESC, movieId) AS place
            FROM (SELECT userId, movieId, avg(CAST(rating AS DOUBLE)) AS mean FROM fresh GROUP BY userId, movieId))
        WHERE place <= 10""",
    "served": """
        SELECT userId, movieId, place, 'online' AS source, 4294967297 AS version FROM fresh_favourites
        UNION ALL
        SELECT userId, movieId, place, 'batch', 4294967296 FROM favourites
        WHERE userId NOT IN (SELECT userId FROM fresh_favourites)""",
    "served_lists": """
        SELECT CAST(userId AS VARCHAR) AS user_id,
               string_agg(CAST(movieId AS VARCHAR), '|' ORDER BY place) AS top_10, source, version
        FROM served GROUP BY userId, source, version""",
    "catalogue": "SELECT movieId, title, genres, tmdbId FROM movies JOIN links USING (movieId)",
    "titled": """
        SELECT CAST(userId AS VARCHAR) AS user_id, movieId, title,
               CAST(row_number() OVER (PARTITION BY userId ORDER BY place) - 1 AS INTEGER) AS place,
               count(*) OVER (PARTITION BY userId) AS entries
        FROM served JOIN catalogue USING (movieId)
        WHERE movieId % 17 <> 0 AND movieId % 19 <> 0""",
}

DEPENDS = {
    "parsed": ["messages"],
    "fresh": ["parsed"],
    "active": ["ratings"],
    "split": ["active"],
    "train": ["active", "split"],
    "test": ["active", "split"],
    "user_ids": ["active"],
    "movie_ids": ["active"],
    "predictions": ["train", "test"],
    "ranked": ["predictions"],
    "hits": ["ranked"],
    "goods": ["test"],
    "user_scores": ["hits", "goods"],
    "pairs": ["fresh"],
    "history": ["fresh"],
    "movie_counts": ["ratings"],
    "user_counts": ["ratings"],
    "dated": ["movies"],
    "rated_by_year": ["movie_counts", "dated"],
    "tail": ["movie_counts"],
    "favourites": ["ratings"],
    "low_favourites": ["ratings"],
    "fresh_favourites": ["fresh"],
    "served": ["favourites", "fresh_favourites"],
    "served_lists": ["served"],
    "catalogue": ["movies", "links"],
    "titled": ["served", "catalogue"],
}


def _needed(names: list[str]) -> list[str]:
    """The named CTEs after everything they read."""
    ordered: list[str] = []
    for name in names:
        for other in [*_needed(DEPENDS.get(name, [])), name]:
            if other not in ordered:
                ordered.append(other)
    return ordered


def _sql(select: str, *names: str, extra: list[str] | None = None, recursive: bool = False) -> str:
    parts = [f"{name} AS ({CTES[name]})" for name in _needed(list(names))] + (extra or [])
    head = f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) if parts else ""
    return f"{head}\n{select}"


def _histogram(source: str) -> str:
    return _sql(
        """
        SELECT CAST(b AS INTEGER) AS bin,
               round(low + b * CAST(high - low AS DOUBLE) / 100, 6) AS lower,
               round(low + (b + 1) * CAST(high - low AS DOUBLE) / 100, 6) AS upper,
               CAST(coalesce(n, 0) AS BIGINT) AS rows
        FROM range(100) AS bins(b), limits
        LEFT JOIN (SELECT least(99, (count - low) * 100 // (high - low)) AS slot, count(*) AS n
                   FROM """ + source + """, limits GROUP BY slot) filled ON slot = b""",
        source,
        extra=[f"limits AS (SELECT min(count) AS low, max(count) AS high FROM {source})"],
    )


# --- ridge solve by Gauss-Jordan elimination, all users at once ----------------


def _solved(pairs: str) -> list[str]:
    """CTEs ending in ``solved(userId, n_items, features)`` for the given pairs."""
    return [
        f"""known AS (SELECT userId, n, total, features AS x FROM {pairs} JOIN item_factors USING (movieId))""",
        "width AS (SELECT max(len(features)) AS w FROM item_factors)",
        "dims AS (SELECT CAST(unnest(range(1, w + 1)) AS INTEGER) AS d FROM width)",
        """system AS (
            SELECT userId, i.d AS i, list(entry ORDER BY j) AS line
            FROM (SELECT userId, i, j, sum(n * x[i] * x[j]) + CASE WHEN i = j THEN 0.1 ELSE 0.0 END AS entry
                  FROM known, (SELECT a.d AS i, b.d AS j FROM dims a, dims b) GROUP BY userId, i, j
                  UNION ALL
                  SELECT userId, d, (SELECT w FROM width) + 1, sum(total * x[d]) FROM known, dims GROUP BY userId, d) cells
            JOIN dims i ON i.d = cells.i GROUP BY userId, i.d)""",
        """elimination(k, userId, i, line) AS (
            SELECT 0, userId, i, line FROM system
            UNION ALL
            SELECT k + 1, userId, i,
                   CASE WHEN i = k + 1 THEN list_transform(head, lambda p: p / head[k + 1])
                        ELSE list_transform(line, lambda v, c: v - line[k + 1] * head[c] / head[k + 1]) END
            FROM (SELECT k, userId, i, line,
                         max(CASE WHEN i = k + 1 THEN line END) OVER (PARTITION BY userId) AS head
                  FROM elimination WHERE k < (SELECT w FROM width)))""",
        f"""solved AS (
            SELECT userId, n_items, list(line[len(line)] ORDER BY i) AS features
            FROM elimination JOIN (SELECT userId, count(*) AS n_items FROM {pairs} JOIN item_factors USING (movieId)
                                   GROUP BY userId) sizes USING (userId)
            WHERE k = (SELECT w FROM width) GROUP BY userId, n_items)""",
    ]


def _best(users: str, k: int, exclude: str | None = None) -> str:
    """A CTE ``best``: the k best items per row of ``users``."""
    allowed = "" if exclude is None else f"""
        WHERE NOT EXISTS (SELECT 1 FROM {exclude} e WHERE e.userId = u.userId AND e.movieId = i.movieId)"""
    return f"""best AS (
        SELECT userId, movieId, score, CAST(place AS INTEGER) AS rank FROM (
            SELECT userId, movieId, score,
                   row_number() OVER (PARTITION BY userId ORDER BY score DESC, movieId DESC) AS place
            FROM (SELECT u.userId, i.movieId, list_inner_product(i.features, u.features) AS score
                  FROM {users} u, item_factors i {allowed}))
        WHERE place <= {k})"""


_VECTOR_USERS = "vector_users AS (SELECT movieId AS userId, features FROM item_factors)"
_BEST_ROWS = "SELECT userId, movieId, round(score, 6) AS score, rank FROM best"
_BEST_LISTS = "SELECT userId, string_agg(CAST(movieId AS VARCHAR), '|' ORDER BY rank) AS movies FROM best GROUP BY userId"
_BEST_SERVED = """
    SELECT CAST(userId AS VARCHAR) AS user_id, string_agg(CAST(movieId AS VARCHAR), '|' ORDER BY rank) AS top_10,
           'online' AS source
    FROM best GROUP BY userId
    UNION ALL
    SELECT CAST(userId AS VARCHAR), string_agg(CAST(movieId AS VARCHAR), '|' ORDER BY rank), 'fallback'
    FROM stored GROUP BY userId"""


def _stored(users: str) -> list[str]:
    """CTEs ending in ``stored``: lists from stored vectors for users without an online one."""
    return [
        _VECTOR_USERS,
        f"""rest AS (SELECT * FROM vector_users WHERE userId IN (SELECT userId FROM fresh)
                     AND userId NOT IN (SELECT userId FROM {users}))""",
        _best("rest", 30).replace("best AS", "stored AS", 1),
    ]


_SPREAD_ITEMS = ("CAST(vec_id AS INTEGER) AS movieId", "CAST(vec_id * 150 AS INTEGER) AS movieId")
_ALL_USERS = """vector_users AS (
    SELECT CAST(vec_id AS INTEGER) AS userId, CAST(embedding AS DOUBLE[]) AS features FROM embeddings)"""
_REWRITTEN = (
    "CAST(embedding AS DOUBLE[]) AS features",
    "CASE WHEN vec_id % 3 = 0 THEN list_reverse(CAST(embedding AS DOUBLE[])) ELSE CAST(embedding AS DOUBLE[]) END AS features",
)
_PATHS = "(VALUES ('packed'), ('joined')) paths(path)"
# Messages with the number of the part in which they were sent.
_PART = "event_id * {} // ((SELECT max(event_id) FROM events) + 1)"
_LATEST = f"""
    SELECT userId, movieId, arg_max(rating, (part, rating)) AS rating
    FROM (SELECT *, {_PART.format(3)} AS part FROM parsed
          WHERE userId IS NOT NULL AND movieId IS NOT NULL AND rating IS NOT NULL)
    GROUP BY userId, movieId"""
_HISTORY = f"history AS (SELECT userId, movieId, 1 AS n, CAST(rating AS DOUBLE) AS total FROM ({_LATEST}))"
_TOPPED = """CAST(userId AS VARCHAR) AS user_id, string_agg(CAST(movieId AS VARCHAR), '|' ORDER BY rank) AS top_10"""
_COMPLETE_LISTS = """SELECT userId, n AS length, TRUE AS ordered, TRUE AS complete
    FROM ({}), (SELECT least(30, count(DISTINCT movieId)) AS n FROM train)"""

ORACLES: dict[str, str] = {
    # --- exploration ---------------------------------------------------------
    "rating_distribution": _sql("SELECT rating, count(*) AS count FROM ratings GROUP BY rating", "ratings"),
    "ratings_per_year": _sql(
        "SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS count FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"
    ),
    "movies_per_release_year": _sql(
        "SELECT ReleaseYear, count(*) AS count FROM dated WHERE ReleaseYear IS NOT NULL GROUP BY ReleaseYear", "dated"
    ),
    "release_years": _sql("SELECT movieId, ReleaseYear FROM dated", "dated"),
    "dataset_totals": _sql(
        """SELECT count(*) AS ratings, (SELECT count(*) FROM movies) AS movies, count(DISTINCT userId) AS users
           FROM ratings""",
        "ratings",
        "movies",
    ),
    "matrix_sparsity": _sql(
        """SELECT ratings, users, movies, round((1.0 - CAST(ratings AS DOUBLE) / (users * movies)) * 100, 6) AS sparsity_percent
           FROM (SELECT count(*) AS ratings, count(DISTINCT userId) AS users, count(DISTINCT movieId) AS movies
                 FROM ratings)""",
        "ratings",
    ),
    "movie_count_histogram": _histogram("movie_counts"),
    "user_count_histogram": _histogram("user_counts"),
    "top_movies": _sql(
        """SELECT movieId, title, count FROM movie_counts JOIN movies USING (movieId)
           ORDER BY count DESC, movieId LIMIT 10""",
        "movie_counts",
        "movies",
    ),
    "top_users": _sql(
        "SELECT CAST(userId AS VARCHAR) AS userId, count FROM user_counts ORDER BY count DESC, user_counts.userId LIMIT 10",
        "user_counts",
    ),
    "ratings_by_release_year": _sql(
        "SELECT ReleaseYear, CAST(sum(rating_count) AS BIGINT) AS total_ratings FROM rated_by_year GROUP BY ReleaseYear",
        "rated_by_year",
    ),
    "avg_ratings_by_release_year": _sql(
        "SELECT ReleaseYear, round(avg(rating_count), 6) AS avg_ratings_per_movie FROM rated_by_year GROUP BY ReleaseYear",
        "rated_by_year",
    ),
    "release_year_summary": _sql(
        """SELECT round(avg(mean), 6) AS mean_of_years, arg_max(ReleaseYear, (mean, -ReleaseYear)) AS peak_year,
                  round(max(mean), 6) AS peak_value
           FROM (SELECT ReleaseYear, avg(rating_count) AS mean FROM rated_by_year GROUP BY ReleaseYear)""",
        "rated_by_year",
    ),
    "long_tail_rank": _sql("SELECT movieId, count, position FROM tail", "tail"),
    "head_share": _sql(
        """SELECT head_size, CAST(sum(CASE WHEN position <= head_size THEN count ELSE 0 END) AS BIGINT) AS head_ratings,
                  CAST(sum(count) AS BIGINT) AS total_ratings,
                  round(sum(CASE WHEN position <= head_size THEN count ELSE 0 END) / CAST(sum(count) AS DOUBLE) * 100, 6)
                      AS head_percent
           FROM tail, (SELECT CAST(floor(count(*) * 0.2) AS BIGINT) AS head_size FROM tail) GROUP BY head_size""",
        "tail",
    ),
    "ratings_per_user": _sql("SELECT userId, count FROM user_counts", "user_counts"),
    # --- files ---------------------------------------------------------------
    "csv_ratings": _sql("SELECT userId, movieId, CAST(rating AS FLOAT) AS rating, timestamp FROM ratings", "ratings"),
    "csv_movies": _sql("SELECT movieId, title, genres FROM movies", "movies"),
    "csv_links": _sql("SELECT movieId, tmdbId FROM links", "links"),
    "landed_ratings": """
        SELECT CAST(o_custkey AS INTEGER) AS userId, CAST(l_partkey AS INTEGER) AS movieId,
               CAST(l_quantity AS FLOAT) AS rating, CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS timestamp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber <> 7""",
    "rejected_ratings": """
        SELECT CAST(o_custkey AS VARCHAR) AS userId, CAST(l_partkey AS VARCHAR) AS movieId,
               CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS rating, 'soon' AS timestamp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 7""",
    "csv_reordered_header": _sql(
        "SELECT userId, movieId, CAST(rating AS FLOAT) AS rating, timestamp FROM ratings", "ratings"
    ),
    "landed_extra_fields": """
        SELECT CAST(o_custkey AS INTEGER) AS userId, CAST(l_partkey AS INTEGER) AS movieId,
               CAST(l_quantity AS FLOAT) AS rating, CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS timestamp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber NOT IN (3, 5)""",
    "rejected_extra_fields": """
        SELECT o_custkey || '::' || l_partkey || '::' || CAST(l_quantity AS INTEGER)
               || CASE l_linenumber WHEN 3 THEN '::' || strftime(l_shipdate, '%Y%m%d') || '::junk' ELSE '' END AS line
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber IN (3, 5)""",
    "stored_factors": _sql(
        "SELECT movieId, CAST(len(features) AS INTEGER) AS width, round(features[1], 6) AS first FROM item_factors",
        "item_factors",
    ),
    # --- preparation ---------------------------------------------------------
    "clean_ratings": """
        SELECT CAST(o_custkey AS INTEGER) AS userId, CAST(l_partkey AS INTEGER) AS movieId,
               CAST(l_quantity / 10 AS FLOAT) AS rating, CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS timestamp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber NOT IN (5, 6, 7)""",
    "activity_filter": _sql("SELECT userId, movieId, rating, timestamp FROM active", "active"),
    "dense_user_ids": _sql("SELECT userId, new_userId FROM user_ids", "user_ids"),
    "dense_movie_ids": _sql("SELECT movieId, new_movieId FROM movie_ids", "movie_ids"),
    "rekeyed_ratings": _sql(
        """SELECT new_userId AS userId, new_movieId AS movieId, rating, timestamp
           FROM active JOIN user_ids USING (userId) JOIN movie_ids USING (movieId)""",
        "user_ids",
        "movie_ids",
    ),
    "restored_ids": _sql("SELECT userId, movieId, rating, timestamp FROM active", "active"),
    "stored_mappings": _sql(
        """SELECT 'user' AS kind, userId AS id, new_userId AS new_id FROM user_ids
           UNION ALL SELECT 'movie', movieId, new_movieId FROM movie_ids""",
        "user_ids",
        "movie_ids",
    ),
    "time_split_counts": _sql(
        """SELECT (SELECT p FROM split) AS split_point, (SELECT count(*) FROM train) AS train_rows,
                  (SELECT count(*) FROM test) AS test_rows""",
        "train",
        "test",
    ),
    "approximate_split": _sql(
        # The sketch promises a point within 1/1000 of the 0.8 quantile, and the exact one lies there.
        """SELECT avg(CASE WHEN timestamp < p THEN 1.0 ELSE 0.0 END) - 0.001 <= 0.8
                  AND avg(CASE WHEN timestamp <= p THEN 1.0 ELSE 0.0 END) + 0.001 >= 0.8 AS within_error
           FROM active, split""",
        "active",
        "split",
    ),
    # --- evaluation ----------------------------------------------------------
    "relevance_labels": _sql(
        """SELECT userId, movieId, rating, CAST(CASE WHEN rating >= 3.5 THEN 1 ELSE 0 END AS INTEGER) AS is_good_item
           FROM test""",
        "test",
    ),
    "topk_per_user": _sql(
        "SELECT userId, movieId, is_good_item, round(prediction, 6) AS prediction, rank FROM ranked", "ranked"
    ),
    "topk_without_ties": _sql(
        """SELECT userId, movieId, round(mean, 6) AS prediction, CAST(place AS INTEGER) AS rank FROM (
               SELECT userId, movieId, mean,
                      row_number() OVER (PARTITION BY userId ORDER BY mean DESC, movieId) AS place
               FROM (SELECT userId, movieId, avg(rating) AS mean FROM ratings GROUP BY userId, movieId))
           WHERE place <= 10""",
        "ratings",
    ),
    "user_hits_and_dcg": _sql("SELECT userId, has_hit, round(dcg, 6) AS dcg FROM hits", "hits"),
    "good_items_per_user": _sql("SELECT userId, num_good_items FROM goods", "goods"),
    "ideal_dcg_per_user": _sql(
        """SELECT userId, good AS num_good_items,
                  round(coalesce(list_sum(list_transform(range(1, least(good, 10) + 1), lambda i: 1.0 / log2(i + 1))), 0.0), 6)
                      AS ideal_dcg
           FROM (SELECT userId, count(*) FILTER (WHERE rating >= 3.5) AS good FROM ratings GROUP BY userId)""",
        "ratings",
    ),
    "guarded_good_share": _sql(
        """SELECT CAST(c_custkey * 2 AS INTEGER) AS userId, round(coalesce(share, 0.0), 6) AS share
           FROM customer LEFT JOIN (
               SELECT userId, avg(CASE WHEN rating >= 3.5 THEN 1.0 ELSE 0.0 END) AS share
               FROM ratings GROUP BY userId) ON userId = c_custkey * 2""",
        "ratings",
    ),
    "baseline_rmse": _sql(
        "SELECT round(sqrt(avg(power(prediction - rating, 2))), 6) AS rmse, count(*) AS scored FROM predictions",
        "predictions",
    ),
    "hit_rate_at_10": _sql(
        """SELECT round(avg(has_hit), 6) AS hit_rate, count(*) AS ranked_users, test_users,
                  round(sum(has_hit) / CAST(test_users AS DOUBLE), 6) AS hit_rate_all_users
           FROM hits, (SELECT count(DISTINCT userId) AS test_users FROM test) GROUP BY test_users""",
        "hits",
        "test",
    ),
    "ndcg_at_10": _sql("SELECT round(avg(ndcg), 6) AS ndcg, count(*) AS users FROM user_scores", "user_scores"),
    "ndcg_per_user": _sql(
        "SELECT userId, round(dcg, 6) AS dcg, round(ideal_dcg, 6) AS ideal_dcg, round(ndcg, 6) AS ndcg FROM user_scores",
        "user_scores",
    ),
    "evaluation_summary": _sql(
        """SELECT (SELECT round(sqrt(avg(power(prediction - rating, 2))), 6) FROM predictions) AS rmse,
                  (SELECT count(*) FROM predictions) AS scored,
                  (SELECT round(avg(has_hit), 6) FROM hits) AS hit_rate,
                  (SELECT round(avg(ndcg), 6) FROM user_scores) AS ndcg""",
        "user_scores",
    ),
    # --- messages ------------------------------------------------------------
    "encode_messages": _sql("SELECT concat_ws(',', userId, movieId, rating) AS value FROM ratings", "ratings"),
    "published_messages": _sql("SELECT concat_ws(',', userId, movieId, rating) AS value FROM ratings", "ratings"),
    "replay_messages": _sql(
        "SELECT value FROM messages WHERE len(string_split(value, ',')) >= 3", "messages"
    ),
    "replay_ratings_file": _sql("SELECT concat_ws(',', userId, movieId, rating) AS value FROM ratings", "ratings"),
    "parse_messages": _sql(
        "SELECT event_id, userId, movieId, rating FROM parsed WHERE rating IS NOT NULL AND userId IS NOT NULL AND movieId IS NOT NULL",
        "parsed",
    ),
    "malformed_messages": _sql(
        "SELECT event_id, value FROM parsed WHERE rating IS NULL OR userId IS NULL OR movieId IS NULL", "parsed"
    ),
    "factor_probe": _sql(
        """SELECT userId, count(*) FILTER (WHERE movieId IN (SELECT movieId FROM item_factors)) AS matched,
                  count(*) FILTER (WHERE movieId NOT IN (SELECT movieId FROM item_factors)) AS unmatched
           FROM fresh GROUP BY userId""",
        "fresh",
        "item_factors",
    ),
    "events_per_user": _sql("SELECT userId, movieId, n, total FROM pairs", "pairs"),
    # --- fold-in and scoring -------------------------------------------------
    "gram_and_moments": _sql(
        "SELECT userId, "
        + ", ".join(
            f"round(sum(n * features[{i + 1}] * features[{j + 1}]), 6) AS a{i}{j}" for i in range(3) for j in range(i, 3)
        )
        + ", "
        + ", ".join(f"round(sum(total * features[{i + 1}]), 6) AS b{i}" for i in range(3))
        + " FROM pairs JOIN item_factors USING (movieId) GROUP BY userId",
        "pairs",
        "item_factors",
    ),
    "fold_in_rank2": _sql(
        """SELECT userId, round((d * p - b * q) / (a * d - b * b), 6) AS u0, round((a * q - b * p) / (a * d - b * b), 6) AS u1
           FROM (SELECT userId, sum(n * features[1] * features[1]) + 0.1 AS a, sum(n * features[1] * features[2]) AS b,
                        sum(n * features[2] * features[2]) + 0.1 AS d, sum(total * features[1]) AS p,
                        sum(total * features[2]) AS q
                 FROM pairs JOIN item_factors USING (movieId) GROUP BY userId)""",
        "pairs",
        "item_factors",
    ),
    "fold_in_full": _sql(
        """SELECT userId, n_items, CAST(place - 1 AS INTEGER) AS place, round(features[place], 6) AS component
           FROM (SELECT userId, n_items, features, unnest(range(1, len(features) + 1)) AS place FROM solved)""",
        "pairs",
        "item_factors",
        extra=_solved("pairs"),
        recursive=True,
    ),
    "fold_in_duplicate_factors": _sql(
        f"""SELECT path, userId, n_items, CAST(place - 1 AS INTEGER) AS place, round(features[place], 6) AS component
            FROM (SELECT userId, n_items, features, unnest(range(1, len(features) + 1)) AS place FROM solved), {_PATHS}""",
        "pairs",
        "item_factors",
        extra=_solved("pairs"),
        recursive=True,
    ).replace(*_REWRITTEN, 1),
    "score_duplicate_factors": _sql(
        f"SELECT path, userId, movieId, round(score, 6) AS score, rank FROM best, {_PATHS}",
        "item_factors",
        extra=[_ALL_USERS, _best("vector_users", 10)],
    ).replace(*_REWRITTEN, 1),
    "vector_products": _sql(
        """SELECT p.userId, p.movieId, round(list_inner_product(i.features, u.features), 6) AS product
           FROM (SELECT DISTINCT userId, movieId FROM fresh) p
           JOIN item_factors i ON i.movieId = p.movieId JOIN item_factors u ON u.movieId = p.userId""",
        "fresh",
        "item_factors",
    ),
    "score_topk_from_vectors": _sql(
        _BEST_ROWS, "item_factors", extra=[_VECTOR_USERS, _best("vector_users", 10)]
    ),
    "score_topk_excluding": _sql(
        _BEST_ROWS, "item_factors", "ratings", extra=[_VECTOR_USERS, _best("vector_users", 10, "ratings")]
    ),
    "score_topk_in_blocks": _sql(
        _BEST_ROWS, "item_factors", "ratings", extra=[_VECTOR_USERS, _best("vector_users", 10, "ratings")]
    ),
    "fold_in_recommend": _sql(
        _BEST_LISTS,
        "pairs",
        "item_factors",
        extra=[*_solved("pairs"), _best("solved", 30, "fresh")],
        recursive=True,
    ),
    "fallback_users": _sql(
        """SELECT DISTINCT userId, 'unknown_movie' AS cause FROM fresh
           WHERE movieId NOT IN (SELECT movieId FROM item_factors)
           UNION ALL
           SELECT DISTINCT userId, 'no_list' FROM fresh
           WHERE userId NOT IN (SELECT userId FROM fresh JOIN item_factors USING (movieId))""",
        "fresh",
        "item_factors",
    ),
    "fallback_recommend": _sql(
        _BEST_LISTS,
        "fresh",
        "item_factors",
        extra=[
            _VECTOR_USERS,
            """unsure AS (SELECT * FROM vector_users WHERE userId IN (
                   SELECT userId FROM fresh WHERE movieId NOT IN (SELECT movieId FROM item_factors)))""",
            _best("unsure", 30),
        ],
    ),
    "fallback_causes_mixed": _sql(
        """SELECT DISTINCT userId, 'unknown_movie' AS cause FROM fresh
           WHERE movieId NOT IN (SELECT movieId FROM item_factors)
           UNION ALL
           SELECT DISTINCT userId, 'no_list' FROM fresh
           WHERE userId NOT IN (SELECT userId FROM fresh JOIN item_factors USING (movieId))
              OR (SELECT count(*) FROM item_factors i WHERE NOT EXISTS (
                    SELECT 1 FROM fresh r WHERE r.userId = fresh.userId AND r.movieId = i.movieId)) = 0""",
        "fresh",
        "item_factors",
    ).replace(*_SPREAD_ITEMS, 1),
    # --- model: what holds whatever its random start --------------------------
    "als_recommend": _sql(_COMPLETE_LISTS.format("SELECT DISTINCT userId FROM train"), "train"),
    "als_recommend_subset": _sql(
        _COMPLETE_LISTS.format("SELECT DISTINCT userId FROM fresh WHERE userId IN (SELECT userId FROM train)"),
        "train",
        "fresh",
    ),
    "als_normal_equations": _sql("SELECT DISTINCT userId, TRUE AS solved FROM train", "train"),
    "als_predict": _sql(
        """SELECT userId, movieId, rating, TRUE AS is_product FROM test
           WHERE userId IN (SELECT userId FROM train) AND movieId IN (SELECT movieId FROM train)""",
        "test",
        "train",
    ),
    "als_rmse": _sql(
        """SELECT TRUE AS right, count(*) AS scored FROM test
           WHERE userId IN (SELECT userId FROM train) AND movieId IN (SELECT movieId FROM train)""",
        "test",
        "train",
    ),
    "als_evaluation": _sql(
        """SELECT TRUE AS rmse, TRUE AS hit_rate, TRUE AS ndcg, count(*) AS scored FROM test
           WHERE userId IN (SELECT userId FROM train) AND movieId IN (SELECT movieId FROM train)""",
        "test",
        "train",
    ),
    "als_list_lengths": _sql(
        """SELECT userId, CAST(n AS INTEGER) AS length, CAST(n AS INTEGER) AS distinct_movies
           FROM (SELECT DISTINCT userId FROM train), (SELECT least(30, count(DISTINCT movieId)) AS n FROM train)""",
        "train",
    ),
    "als_subset_lengths": _sql(
        """SELECT userId, CAST(n AS INTEGER) AS length
           FROM (SELECT DISTINCT userId FROM fresh WHERE userId IN (SELECT userId FROM train)),
                (SELECT least(30, count(DISTINCT movieId)) AS n FROM train)""",
        "train",
        "fresh",
    ),
    "als_rmse_agreement": _sql(
        """SELECT TRUE AS agree, count(*) AS scored FROM test
           WHERE userId IN (SELECT userId FROM train) AND movieId IN (SELECT movieId FROM train)""",
        "test",
        "train",
    ),
    "als_prediction_pairs": _sql(
        """SELECT userId, movieId, rating FROM test
           WHERE userId IN (SELECT userId FROM train) AND movieId IN (SELECT movieId FROM train)""",
        "test",
        "train",
    ),
    "als_factor_ids": _sql(
        """SELECT DISTINCT 'user' AS kind, userId AS id, 100 AS width FROM train
           UNION ALL SELECT DISTINCT 'item', movieId, 100 FROM train""",
        "train",
    ),
    "als_stored_model": _sql(
        """SELECT TRUE AS same, count(*) AS pairs FROM (SELECT DISTINCT userId, movieId FROM test
           WHERE userId IN (SELECT userId FROM train) AND movieId IN (SELECT movieId FROM train))""",
        "test",
        "train",
    ),
    # --- serving -------------------------------------------------------------
    "serving_upsert_latest": _sql("SELECT user_id, top_10, source, version FROM served_lists", "served_lists"),
    "serving_compacted": _sql(
        """SELECT CAST(userId AS VARCHAR) AS user_id, string_agg(CAST(movieId AS VARCHAR), '|' ORDER BY place) AS top_10,
                  'online' AS source, 4294967298 AS version
           FROM low_favourites GROUP BY userId
           UNION ALL
           SELECT user_id, top_10, source, version FROM served_lists
           WHERE user_id NOT IN (SELECT CAST(userId AS VARCHAR) FROM low_favourites)""",
        "served_lists",
        "low_favourites",
    ),
    "serving_lookup": _sql(
        """SELECT key AS user_id, coalesce(top_10, '') AS top_10, top_10 IS NOT NULL AS found
           FROM (SELECT DISTINCT CAST(c_custkey * 2 AS VARCHAR) AS key FROM customer)
           LEFT JOIN served_lists ON user_id = key""",
        "served_lists",
    ),
    "recs_with_titles": _sql("SELECT user_id, place, movieId, title FROM titled", "titled"),
    "recs_first_page": _sql("SELECT user_id, place, movieId, title FROM titled WHERE place < 5", "titled"),
    "recs_last_page": _sql(
        """SELECT user_id, CAST(place - greatest(entries - 5, 0) AS INTEGER) AS place, movieId, title
           FROM titled WHERE place >= entries - 5""",
        "titled",
    ),
    "recs_last_n": _sql(
        """SELECT userId, string_agg(CAST(movieId AS VARCHAR), '|' ORDER BY place) AS movies
           FROM (SELECT *, max(place) OVER (PARTITION BY userId) AS last FROM favourites)
           WHERE place > last - 5 GROUP BY userId""",
        "favourites",
    ),
    "movie_catalogue": _sql("SELECT movieId, title, genres, tmdbId FROM catalogue", "catalogue"),
    "movie_lookup": _sql(
        """SELECT movieId, title, genres, tmdbId, title IS NOT NULL AS found
           FROM (SELECT DISTINCT movieId FROM parsed WHERE movieId IS NOT NULL) LEFT JOIN catalogue USING (movieId)""",
        "parsed",
        "catalogue",
    ),
    "batch_publish": _sql(
        """SELECT CAST(userId AS VARCHAR) AS user_id, CAST(n AS INTEGER) AS length, 'batch' AS source
           FROM (SELECT DISTINCT userId FROM train), (SELECT least(30, count(DISTINCT movieId)) AS n FROM train)""",
        "train",
    ),
    "batch_publish_unseen": _sql(
        """SELECT userId, least(30, (SELECT count(DISTINCT movieId) FROM train) - rated) AS length,
                  CAST(0 AS BIGINT) AS seen_movies
           FROM (SELECT userId, count(DISTINCT movieId) FILTER (WHERE movieId IN (SELECT movieId FROM train)) AS rated
                 FROM ratings WHERE userId IN (SELECT userId FROM train) GROUP BY userId)""",
        "train",
        "ratings",
    ),
    # --- streams -------------------------------------------------------------
    "stream_parse": _sql(
        "SELECT event_id, userId, movieId, rating FROM parsed WHERE rating IS NOT NULL AND userId IS NOT NULL AND movieId IS NOT NULL",
        "parsed",
    ),
    "stream_refresh_batch": _sql(
        _BEST_SERVED,
        "pairs",
        "item_factors",
        extra=[*_solved("pairs"), _best("solved", 30, "fresh"), *_stored("best")],
        recursive=True,
    ),
    "stream_refresh_history": _sql(
        _BEST_SERVED,
        "fresh",
        "item_factors",
        extra=[_HISTORY, *_solved("history"), _best("solved", 30, "fresh"), *_stored("best")],
        recursive=True,
    ),
    "stream_refresh_state": _sql(
        _BEST_SERVED,
        "fresh",
        "item_factors",
        extra=[_HISTORY, *_solved("history"), _best("solved", 30, "fresh"), *_stored("best")],
        recursive=True,
    ),
    "stream_refresh_fallback": _sql(
        f"""SELECT {_TOPPED}, 'online' AS source FROM best GROUP BY userId
            UNION ALL SELECT {_TOPPED}, 'fallback' FROM stored GROUP BY userId""",
        "item_factors",
        "pairs",
        extra=[
            *_solved("pairs"),
            _best("solved", 30, "fresh"),
            _ALL_USERS,
            """rest AS (SELECT * FROM vector_users WHERE userId IN (SELECT userId FROM fresh)
                        AND userId NOT IN (SELECT userId FROM best))""",
            _best("rest", 30).replace("best AS", "stored AS", 1),
        ],
        recursive=True,
    ).replace(*_SPREAD_ITEMS, 1),
    "stream_refresh_model_first": _sql(
        f"""SELECT {_TOPPED}, 'online' AS source FROM best
            WHERE userId NOT IN (SELECT userId FROM stored) GROUP BY userId
            UNION ALL SELECT {_TOPPED}, 'fallback' FROM stored GROUP BY userId""",
        "item_factors",
        "pairs",
        extra=[
            *_solved("pairs"),
            _best("solved", 30, "fresh"),
            _ALL_USERS,
            """rest AS (SELECT * FROM vector_users WHERE userId IN (SELECT userId FROM fresh)
                        AND (userId NOT IN (SELECT userId FROM best)
                             OR userId IN (SELECT userId FROM fresh
                                           WHERE movieId NOT IN (SELECT movieId FROM item_factors))))""",
            _best("rest", 30).replace("best AS", "stored AS", 1),
        ],
        recursive=True,
    ).replace(*_SPREAD_ITEMS, 1),
    "serving_publish_while_streaming": _sql(
        """SELECT CAST(userId AS VARCHAR) AS user_id, arg_max(source, turn) AS source,
                  CAST(max(turn) // 2 + 1 AS BIGINT) AS generation
           FROM (SELECT DISTINCT userId, 'batch' AS source, 0 AS turn FROM favourites
                 UNION ALL SELECT DISTINCT userId, 'batch', 2 FROM low_favourites
                 UNION ALL SELECT userId, 'online', 2 * part + 1 FROM known
                 UNION ALL SELECT userId, 'fallback', 2 * part + 1 FROM sent
                 WHERE (userId, part) NOT IN (SELECT (userId, part) FROM known)
                   AND userId IN (SELECT movieId FROM item_factors))
           GROUP BY userId""",
        "favourites",
        "low_favourites",
        "parsed",
        "item_factors",
        extra=[
            f"""numbered AS (SELECT userId, movieId, {_PART.format(2)} AS part FROM parsed
                WHERE userId IS NOT NULL AND movieId IS NOT NULL AND rating IS NOT NULL)""",
            "sent AS (SELECT DISTINCT userId, part FROM numbered)",
            "known AS (SELECT DISTINCT userId, part FROM numbered JOIN item_factors USING (movieId))",
        ],
    ),
    "stream_histories": _sql(
        "SELECT userId, movieId, max(rating) AS rating FROM fresh GROUP BY userId, movieId", "fresh"
    ),
    "stream_dead_letters": _sql(
        "SELECT value FROM parsed WHERE rating IS NULL OR userId IS NULL OR movieId IS NULL", "parsed"
    ),
    "stream_rating_log": _sql(_LATEST, "parsed"),
}

for _name in ("stream_state_map", "stream_log_bucketed"):
    ORACLES[_name] = ORACLES["stream_refresh_history"]

_SKEWED = """skewed AS (
    SELECT movieId, list_transform(features, lambda x: x * (1.0::DOUBLE / (1 + movieId % 50))) AS features FROM item_factors)"""
_SPARED_ROWS = "SELECT userId, movieId, round(score, 6) AS score, rank, TRUE AS spared FROM best"
ORACLES["score_topk_pruned"] = _sql(
    _SPARED_ROWS,
    "item_factors",
    extra=[_VECTOR_USERS, _SKEWED, _best("vector_users", 10).replace("item_factors i", "skewed i")],
)
ORACLES["score_topk_pruned_excluding"] = _sql(
    _SPARED_ROWS,
    "item_factors",
    "ratings",
    extra=[_VECTOR_USERS, _SKEWED, _best("vector_users", 10, "ratings").replace("item_factors i", "skewed i")],
)
ORACLES["score_topk_pruned_even"] = ORACLES["score_topk_from_vectors"]
# A user -1 who rated every movie that has a vector.
_WITH_COLLECTOR = """pairs_and_collector AS (
    SELECT userId, movieId, n, total FROM pairs
    UNION ALL SELECT -1, movieId, 1, CAST(1 + movieId % 9 AS DOUBLE) / 2 FROM item_factors)"""
ORACLES["fold_in_split_user"] = _sql(
    """SELECT userId, n_items, CAST(place - 1 AS INTEGER) AS place, round(features[place], 6) AS component
       FROM (SELECT userId, n_items, features, unnest(range(1, len(features) + 1)) AS place FROM solved)""",
    "pairs",
    "item_factors",
    extra=[_WITH_COLLECTOR, *_solved("pairs_and_collector")],
    recursive=True,
)
ORACLES["serving_tiered"] = ORACLES["serving_compacted"]
ORACLES["serving_tiered_lookup"] = ORACLES["serving_lookup"]
ORACLES["stream_from_latest"] = _sql(
    f"""SELECT userId, movieId, rating FROM (SELECT *, {_PART.format(3)} AS part FROM parsed)
        WHERE part > 0 AND userId IS NOT NULL AND movieId IS NOT NULL AND rating IS NOT NULL""",
    "parsed",
)
ORACLES["landed_incrementally"] = _sql(
    """SELECT userId, movieId, CAST(rating AS FLOAT) AS rating, timestamp,
              CAST(CASE WHEN movieId % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS part FROM ratings""",
    "ratings",
)
ORACLES["stored_split_point"] = _sql(
    "SELECT TRUE AS enough_before, TRUE AS enough_after, count(*) AS ratings FROM ratings", "ratings"
)
ORACLES["maintained_exploration"] = "\nUNION ALL\n".join(
    f"""SELECT '{_measure}' AS measure, CAST({_key} AS DOUBLE) AS key, round(CAST({_value} AS DOUBLE), 6) AS value
        FROM ({ORACLES[_recounted]})"""
    for _measure, _key, _value, _recounted in (
        ("rating", "rating", "count", "rating_distribution"),
        ("year", "year", "count", "ratings_per_year"),
        ("tail", "movieId", "position", "long_tail_rank"),
        ("histogram", "bin", "rows", "user_count_histogram"),
        ("release", "ReleaseYear", "total_ratings", "ratings_by_release_year"),
        ("top", "userId", "count", "top_users"),
        ("head", "head_size", "head_percent", "head_share"),
        ("totals", "ratings", "users", "dataset_totals"),
        ("sparsity", "movies", "sparsity_percent", "matrix_sparsity"),
    )
)
ORACLES["als_model_generations"] = _sql(
    """SELECT step, generation, pairs, pairs AS same_pairs
       FROM (VALUES ('saved', 0), ('half written', 0), ('saved again', 1), ('rolled back', 0)) steps(step, generation),
            (SELECT count(*) AS pairs FROM (SELECT DISTINCT userId, movieId FROM test
             WHERE userId IN (SELECT userId FROM train) AND movieId IN (SELECT movieId FROM train)))""",
    "test",
    "train",
)
