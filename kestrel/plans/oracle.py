"""Independent SQL for every registered query, runnable by DuckDB over the
same Parquet tables (registered as views under their table names).

Each statement starts from the raw tables and re-derives the reference's
inputs with the same rules as ``kestrel.plans.fixtures``. Column names and
rounding match the Spark query of the same name.
"""

from __future__ import annotations

# --- derived inputs -------------------------------------------------------

TWEETS = """tweets AS (
  SELECT CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS timestamp,
         CASE WHEN user_id % 37 <> 0 THEN CAST(-125.0 + user_id * 0.5 AS DOUBLE) END AS longitude,
         CAST(24 + length(event_type) AS DOUBLE) AS latitude
  FROM events),
tweets_t AS (
  SELECT *, try_strptime(CAST(timestamp AS VARCHAR), '%Y%m%d%H%M%S') AS tweet_time
  FROM tweets),
weekday AS (
  SELECT * FROM tweets_t WHERE dayofweek(tweet_time) BETWEEN 1 AND 5)"""

RATINGS = """ratings AS (
  SELECT o_custkey AS userId, l_partkey AS movieId, (l_quantity * 10 + l_orderkey % 4) / 100 AS rating,
         CAST(epoch(o_orderdate) AS BIGINT) AS timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ratings_t AS (
  SELECT *, TIMESTAMP '1970-01-01 00:00:00' + to_seconds(timestamp) AS rated_at FROM ratings),
movies AS (
  SELECT p_partkey AS movieId, p_name AS title,
         replace(p_name, ' ', '|') || '|' || p_type AS genres
  FROM part)"""


def _genre_list() -> str:
    from kestrel.plans.fixtures import TEST_GENRES
    return ", ".join(f"'{g}'" for g in TEST_GENRES)


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def tweets_sql() -> dict[str, str]:
    w = _with(TWEETS)
    day_counts = (w + ", g AS (SELECT dayname(tweet_time) AS day_name, count(*) AS count "
                  "FROM tweets_t GROUP BY 1)\n")
    from kestrel.functions.bands import TIME_OF_DAY_ORDER, WEEKDAY_ORDER
    tod = (
        "SELECT CASE WHEN hour(tweet_time) BETWEEN 5 AND 11 THEN 'Morning' "
        "WHEN hour(tweet_time) BETWEEN 12 AND 16 THEN 'Afternoon' "
        "WHEN hour(tweet_time) BETWEEN 17 AND 21 THEN 'Evening' ELSE 'Night' END "
        "AS time_of_day, count(*) AS count FROM weekday GROUP BY 1")
    return {
        "tweets_day_share_ordered": day_counts + (
            "SELECT day_name, count, count / (SELECT sum(count) FROM g) * 100 AS percentage, "
            f"CAST(list_position({_sql_list(WEEKDAY_ORDER)}, day_name) AS INTEGER) AS position FROM g"),
        "tweets_time_of_day_ordered": w + ", t AS (" + tod + ")\n" + (
            f"SELECT *, CAST(list_position({_sql_list(TIME_OF_DAY_ORDER)}, time_of_day) AS INTEGER) "
            "AS position FROM t"),
        "tweets_total_entries": w + "SELECT count(*) AS total_entries FROM tweets",
        "tweets_weekday_rows": w + (
            "SELECT timestamp, longitude, latitude, tweet_time, "
            "strftime(tweet_time, '%Y-%m-%d') AS tweet_date FROM weekday"),
        "tweets_location_counts": w + (
            "SELECT longitude || ',' || latitude AS location, count(*) AS count "
            "FROM weekday GROUP BY 1"),
        "tweets_time_of_day": w + (
            "SELECT CASE WHEN hour(tweet_time) BETWEEN 5 AND 11 THEN 'Morning' "
            "WHEN hour(tweet_time) BETWEEN 12 AND 16 THEN 'Afternoon' "
            "WHEN hour(tweet_time) BETWEEN 17 AND 21 THEN 'Evening' ELSE 'Night' END "
            "AS time_of_day, count(*) AS count FROM weekday GROUP BY 1"),
        "tweets_day_share": day_counts + (
            "SELECT day_name, count, count / (SELECT sum(count) FROM g) * 100 AS percentage FROM g"),
        "tweets_busy_days": day_counts + (
            "SELECT day_name, count, count / (SELECT sum(count) FROM g) * 100 AS percentage "
            "FROM g WHERE count > (SELECT avg(count) FROM g)"),
        "tweets_top_locations": w + (
            "SELECT longitude || ',' || latitude AS location, count(*) AS count "
            "FROM tweets GROUP BY 1 ORDER BY count DESC, location ASC NULLS LAST LIMIT 10"),
        "tweets_map_points": w + (
            "SELECT longitude, latitude, count(*) AS count FROM weekday "
            "WHERE longitude BETWEEN -125 AND -66 AND latitude BETWEEN 24 AND 50 "
            "GROUP BY longitude, latitude"),
    }


def ratings_sql() -> dict[str, str]:
    w = _with(RATINGS)
    genres = _genre_list()
    per_genre = (w + ", mg AS (SELECT movieId, unnest(string_split(genres, '|')) AS genre FROM movies),\n"
                 f"vg AS (SELECT * FROM mg WHERE genre IN ({genres}))\n")
    users = w + ", u AS (SELECT userId, count(*) AS rating_count FROM ratings GROUP BY userId)\n"
    bands = ("SELECT CASE WHEN rating < 3 THEN 'Low' WHEN rating >= 3 AND rating < 5 THEN 'Medium' "
             "WHEN rating = 5 THEN 'High' END AS rating_category, count(*) AS count "
             "FROM ratings WHERE rating >= 1 AND rating <= 5 GROUP BY 1")
    years = w + (", y AS (SELECT strftime(rated_at, '%Y') AS year, count(*) AS count "
                 "FROM ratings_t GROUP BY 1)\n")
    from kestrel.functions.bands import HALF_YEAR_ORDER
    half = ("SELECT CASE WHEN CAST(strftime(rated_at, '%m') AS INTEGER) <= 6 THEN 'Early Year' "
            "ELSE 'Late Year' END AS time_of_year, count(*) AS count FROM ratings_t GROUP BY 1")
    return {
        "ratings_half_year_ordered": w + ", h AS (" + half + ")\n" + (
            f"SELECT *, CAST(list_position({_sql_list(HALF_YEAR_ORDER)}, time_of_year) AS INTEGER) "
            "AS position FROM h"),
        "ratings_unique_users": w + "SELECT count(DISTINCT userId) AS unique_users FROM ratings",
        "ratings_with_date": w + (
            "SELECT userId, movieId, rating, timestamp, strftime(rated_at, '%Y-%m-%d') AS rating_date "
            "FROM ratings_t"),
        "ratings_bands": w + bands,
        "ratings_band_shares": w + ", b AS (" + bands + ")\n" + (
            "SELECT rating_category, count, round(count / (SELECT sum(count) FROM b) * 100, 1) AS share FROM b"),
        "ratings_half_year": w + (
            "SELECT CASE WHEN CAST(strftime(rated_at, '%m') AS INTEGER) <= 6 THEN 'Early Year' "
            "ELSE 'Late Year' END AS time_of_year, count(*) AS count FROM ratings_t GROUP BY 1"),
        "ratings_genre_counts": per_genre + (
            "SELECT genre, count(*) AS count FROM vg JOIN ratings USING (movieId) GROUP BY genre"),
        "ratings_genre_average": per_genre + (
            "SELECT genre, round(avg(rating), 9) AS avg_rating, count(rating) AS rating_count "
            "FROM vg JOIN ratings USING (movieId) GROUP BY genre"),
        "ratings_year_share": years + (
            "SELECT year, count, count / (SELECT sum(count) FROM y) * 100 AS percentage FROM y"),
        "ratings_years": years + (
            "SELECT DISTINCT TRY_CAST(year AS INTEGER) AS year FROM y WHERE TRY_CAST(year AS INTEGER) IS NOT NULL"),
        "ratings_top_movies": w + (
            "SELECT movieId, title, genres, round(avg(rating), 9) AS avg_rating, "
            "count(rating) AS rating_count FROM movies JOIN ratings USING (movieId) "
            "GROUP BY movieId, title, genres "
            "ORDER BY avg_rating DESC NULLS LAST, movieId LIMIT 10"),
        "ratings_top_raters": users + (
            "SELECT userId, rating_count, CASE WHEN rating_count > 50 THEN 'Frequent Raters' "
            "ELSE 'Infrequent Raters' END AS rater_category FROM u "
            "ORDER BY rating_count DESC, userId LIMIT 10"),
        "ratings_rater_distribution": users + (
            "SELECT CASE WHEN rating_count > 50 THEN 'Frequent Raters' ELSE 'Infrequent Raters' END "
            "AS rater_category, count(*) AS count FROM u GROUP BY 1"),
    }




# --- trips ------------------------------------------------------------------

TRIPS = """trips AS (
  SELECT l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS trip_start,
         l_partkey AS trip_seconds,
         CASE WHEN l_partkey % 61 <> 0 THEN l_quantity END AS trip_miles,
         CASE WHEN l_partkey % 59 <> 0 THEN l_extendedprice / 1000 END AS fare,
         pickup AS pickup_area,
         CAST(41.0 AS DOUBLE) + pickup * CAST(0.01 AS DOUBLE) AS pickup_lat,
         CAST(-87.0 AS DOUBLE) - pickup * CAST(0.01 AS DOUBLE) AS pickup_lon,
         c_custkey % 2 AS pickup_tract,
         dropoff AS dropoff_area,
         CAST(41.0 AS DOUBLE) + dropoff * CAST(0.01 AS DOUBLE) AS dropoff_lat,
         CAST(-87.0 AS DOUBLE) - dropoff * CAST(0.01 AS DOUBLE) AS dropoff_lon,
         CASE WHEN l_partkey % 41 <> 0 THEN s_suppkey % 2 END AS dropoff_tract
  FROM (SELECT *, CASE WHEN l_orderkey % 53 <> 0 THEN CASE WHEN c_custkey % 97 = 0 THEN 100 ELSE c_nationkey END END AS pickup,
               CASE WHEN s_suppkey % 7 = 0 THEN 200 ELSE s_nationkey END AS dropoff
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             JOIN customer ON o_custkey = c_custkey
             JOIN supplier ON l_suppkey = s_suppkey)),
verts AS (
  SELECT DISTINCT * FROM (
    SELECT pickup_area AS id, pickup_lat AS latitude, pickup_lon AS longitude, pickup_tract AS CensusTract
    FROM trips WHERE pickup_area IS NOT NULL AND pickup_lat IS NOT NULL
                 AND pickup_lon IS NOT NULL AND pickup_tract IS NOT NULL
    UNION ALL
    SELECT dropoff_area, dropoff_lat, dropoff_lon, dropoff_tract
    FROM trips WHERE dropoff_area IS NOT NULL AND dropoff_lat IS NOT NULL
                 AND dropoff_lon IS NOT NULL AND dropoff_tract IS NOT NULL)),
edges AS (
  SELECT pickup_area AS src, dropoff_area AS dst, trip_miles AS TripMiles,
         trip_seconds AS TripSeconds, fare AS Fare
  FROM trips WHERE pickup_area IS NOT NULL AND dropoff_area IS NOT NULL AND trip_miles IS NOT NULL
               AND trip_seconds IS NOT NULL AND fare IS NOT NULL),
uverts AS (
  SELECT id,
         first(latitude ORDER BY latitude, longitude, CensusTract) AS latitude,
         first(longitude ORDER BY latitude, longitude, CensusTract) AS longitude,
         first(CensusTract ORDER BY latitude, longitude, CensusTract) AS CensusTract
  FROM verts WHERE id IS NOT NULL GROUP BY id),
fares AS (
  SELECT * FROM (
    SELECT CAST(hour(trip_start) AS INTEGER) AS start_hour, CAST(trip_miles AS DOUBLE) AS distance,
           CAST(trip_seconds AS DOUBLE) AS duration, CAST(fare AS DOUBLE) AS fare_amount FROM trips)
  WHERE start_hour IS NOT NULL AND distance IS NOT NULL AND duration IS NOT NULL
        AND fare_amount IS NOT NULL)"""

WEIGHTED = """wedges AS (
  SELECT * FROM (
    SELECT CAST(pickup_area AS INTEGER) AS src, CAST(dropoff_area AS INTEGER) AS dst,
           sum(trip_miles) AS weight
    FROM trips GROUP BY 1, 2)
  WHERE src IS NOT NULL AND dst IS NOT NULL AND weight IS NOT NULL),
nedges AS (
  SELECT src, dst, weight, sumOut,
         CASE WHEN sumOut = 0 THEN CAST(0 AS DOUBLE) ELSE weight / sumOut END AS norm_weight
  FROM (SELECT *, sum(weight) OVER (PARTITION BY src) AS sumOut FROM wedges))"""

SUPPLY = """sverts AS (
  SELECT 'S' || s_suppkey AS id FROM supplier
  UNION ALL SELECT 'P' || p_partkey AS id FROM part),
sedges AS (
  SELECT 'S' || l_suppkey AS src, 'P' || l_partkey AS dst, l_quantity AS TripMiles FROM lineitem
  UNION ALL
  SELECT 'P' || l_partkey AS src, 'S' || l_suppkey AS dst, l_quantity AS TripMiles FROM lineitem)"""


def _distance_sql(prefix: str, verts: str, edges: str, from_cond: str, target_sql: str, max_len: int) -> str:
    """Hop distances to the target by a recursive CTE, the starts and their
    smallest distance."""
    return prefix + f""",
ids AS (SELECT DISTINCT id FROM {verts}),
known AS (SELECT * FROM {edges} WHERE src IN (SELECT id FROM ids) AND dst IN (SELECT id FROM ids)),
pairs AS (SELECT DISTINCT src, dst FROM known),
dist(id, hops) AS (
  SELECT id, 0 FROM ids WHERE id = {target_sql}
  UNION
  SELECT p.src, d.hops + 1 FROM pairs p JOIN dist d ON p.dst = d.id WHERE d.hops < {max_len}),
best AS (SELECT id, min(hops) AS hops FROM dist GROUP BY id),
starts AS (SELECT b.id, b.hops FROM best b JOIN (SELECT DISTINCT id FROM {verts} WHERE {from_cond}) f USING (id)),
depth AS (SELECT min(hops) AS d FROM starts)"""


def _bfs_sql(prefix: str, verts: str, edges: str, from_cond: str, target_sql: str,
             max_len: int = 10) -> str:
    """Shortest-path first legs, summarised per start: the smallest first-edge
    miles over shortest paths."""
    return _distance_sql(prefix, verts, edges, from_cond, target_sql, max_len) + f"""
SELECT s.id AS startComm, {target_sql} AS landmark, min(k.TripMiles) AS shortestMiles
FROM starts s JOIN known k ON k.src = s.id JOIN best b ON b.id = k.dst
WHERE s.hops = (SELECT d FROM depth) AND b.hops = (SELECT d FROM depth) - 1
GROUP BY s.id"""


def _paths_sql(prefix: str, verts: str, edges: str, from_cond: str, target_sql: str, max_len: int = 10) -> str:
    """All shortest paths, walked one distance less at every step."""
    return _distance_sql(prefix, verts, edges, from_cond, target_sql, max_len) + f""",
walk(start, id, hops, path) AS (
  SELECT id, id, hops, [id] FROM starts WHERE hops = (SELECT d FROM depth)
  UNION ALL
  SELECT w.start, b.id, b.hops, list_append(w.path, b.id)
  FROM walk w JOIN pairs p ON p.src = w.id JOIN best b ON b.id = p.dst AND b.hops = w.hops - 1)
SELECT start, id AS "end", CAST((SELECT d FROM depth) AS INTEGER) AS hops, array_to_string(path, ' > ') AS path
FROM walk WHERE hops = 0"""


def _weighted_pagerank_sql(prefix: str, rounds: int = 10, damping: float = 0.85) -> str:
    parts = [prefix + ",",
             "n AS (SELECT count(*) AS n FROM uverts),",
             "r0 AS MATERIALIZED (SELECT id, CAST(1 AS DOUBLE) / (SELECT n FROM n) AS pagerank FROM uverts),"]
    for i in range(1, rounds + 1):
        parts.append(
            f"r{i} AS MATERIALIZED (SELECT u.id, (CAST(1 AS DOUBLE) - CAST({damping} AS DOUBLE)) / (SELECT n FROM n)"
            f" + CAST({damping} AS DOUBLE) * coalesce(c.total, CAST(0 AS DOUBLE)) AS pagerank"
            f" FROM uverts u LEFT JOIN (SELECT e.dst AS id, sum(r.pagerank * e.norm_weight) AS total"
            f" FROM nedges e JOIN r{i - 1} r ON r.id = e.src GROUP BY e.dst) c USING (id))"
            + ("," if i < rounds else ""))
    parts.append(f"SELECT id, round(pagerank, 9) AS pagerank FROM r{rounds}")
    return "\n".join(parts)


def _pagerank_sql(prefix: str, reset: float = 0.15, tol: float = 0.01, steps: int = 120) -> str:
    """Dynamic PageRank unrolled for ``steps`` rounds (more than it needs to
    converge; rounds after convergence change nothing), then scaled."""
    keep = f"(CAST(1 AS DOUBLE) - CAST({reset} AS DOUBLE))"
    first = f"({keep} * (CAST({reset} AS DOUBLE) / {keep}))"
    parts = [prefix + ",",
             "pids AS (SELECT DISTINCT id FROM uverts),",
             "pknown AS (SELECT src, dst FROM edges WHERE src IN (SELECT id FROM pids) AND dst IN (SELECT id FROM pids)),",
             "pdeg AS (SELECT src, count(*) AS deg FROM pknown GROUP BY src),",
             "pw AS MATERIALIZED (SELECT k.src, k.dst, count(*) / max(d.deg) AS w FROM pknown k JOIN pdeg d USING (src) GROUP BY k.src, k.dst),",
             f"s0 AS MATERIALIZED (SELECT id, {first} AS pr, {first} AS delta, true AS active FROM pids),"]
    for i in range(1, steps + 1):
        parts.append(
            f"m{i} AS MATERIALIZED (SELECT w.dst AS id, sum(s.delta * w.w) AS msg FROM pw w JOIN s{i - 1} s ON w.src = s.id"
            f" WHERE s.active AND s.delta > {tol} GROUP BY w.dst),")
        parts.append(
            f"s{i} AS MATERIALIZED (SELECT s.id,"
            f" CASE WHEN m.msg IS NULL THEN s.pr ELSE s.pr + {keep} * m.msg END AS pr,"
            f" CASE WHEN m.msg IS NULL THEN s.delta ELSE (s.pr + {keep} * m.msg) - s.pr END AS delta,"
            f" m.msg IS NOT NULL AS active FROM s{i - 1} s LEFT JOIN m{i} m USING (id))"
            + ("," if i < steps else ""))
    parts.append(f"SELECT id, round(pr * (SELECT count(*) FROM s{steps}) / (SELECT sum(pr) FROM s{steps}), 9)"
                 f" AS pagerank FROM s{steps}")
    return "\n".join(parts)


def _ranked_sql(ranks: str) -> str:
    """Ranks in a registered order: highest first, ties by id."""
    return f"SELECT *, CAST(row_number() OVER (ORDER BY pagerank DESC, id) AS INTEGER) AS position FROM ({ranks})"


def _histogram_sql(prefix: str, column: str, lo: float, hi: float, bins: int) -> str:
    width = (hi - lo) / bins
    return prefix + f""",
counted AS (
  SELECT CAST(least(floor({bins} * ({column} - CAST({lo} AS DOUBLE)) / (CAST({hi} AS DOUBLE) - CAST({lo} AS DOUBLE))) + 1, {bins}) AS INTEGER) AS bin,
         count(*) AS count
  FROM fares WHERE {column} BETWEEN {lo} AND {hi} GROUP BY 1),
allbins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, {bins} + 1))
SELECT a.bin, CAST({lo} AS DOUBLE) + (a.bin - 1) * CAST({width} AS DOUBLE) AS bin_start,
       CAST({lo} AS DOUBLE) + a.bin * CAST({width} AS DOUBLE) AS bin_end,
       CAST(coalesce(c.count, 0) AS BIGINT) AS count
FROM allbins a LEFT JOIN counted c USING (bin)"""


def trips_sql() -> dict[str, str]:
    from kestrel.plans.trips import BFS_TARGET_AREA, FARE_HISTOGRAMS, SUPPLY_TARGET
    w = _with(TRIPS)
    ww = _with(TRIPS, WEIGHTED)
    fare_avg = "SELECT {k}, round(avg(fare_amount), 9) AS avg_fare FROM fares GROUP BY {k}"
    out = {
        "trips_record_count": w + "SELECT count(*) AS record_count FROM trips",
        "trips_vertices": w + "SELECT * FROM verts",
        "trips_edges": w + "SELECT * FROM edges",
        "trips_triplets": w + (
            "SELECT e.src, e.dst, e.TripMiles, e.TripSeconds, e.Fare, s.latitude AS srcLat, "
            "s.longitude AS srcLon, s.CensusTract AS srcTract, d.latitude AS dstLat, "
            "d.longitude AS dstLon, d.CensusTract AS dstTract "
            "FROM edges e LEFT JOIN verts s ON e.src = s.id LEFT JOIN verts d ON e.dst = d.id"),
        "trips_same_area": w + "SELECT * FROM edges WHERE src = dst",
        "trips_same_area_count": w + "SELECT count(*) AS same_area_count FROM edges WHERE src = dst",
        "trips_bfs_summary": _bfs_sql("WITH RECURSIVE " + TRIPS, "verts", "edges",
                                      f"id <> {BFS_TARGET_AREA}", str(BFS_TARGET_AREA)),
        "trips_bfs_paths": _paths_sql("WITH RECURSIVE " + TRIPS, "verts", "edges",
                                      f"id <> {BFS_TARGET_AREA}", str(BFS_TARGET_AREA)),
        "supply_bfs_paths": _paths_sql("WITH RECURSIVE " + SUPPLY, "sverts", "sedges",
                                       f"id LIKE 'S%' AND id <> '{SUPPLY_TARGET}'", f"'{SUPPLY_TARGET}'"),
        "supply_bfs_summary": _bfs_sql("WITH RECURSIVE " + SUPPLY, "sverts", "sedges",
                                       f"id LIKE 'S%' AND id <> '{SUPPLY_TARGET}'", f"'{SUPPLY_TARGET}'"),
        "trips_unique_vertices": w + "SELECT * FROM uverts",
        "trips_weighted_edges": ww + "SELECT * FROM nedges",
        "trips_pagerank_ranked": _ranked_sql(_pagerank_sql("WITH " + TRIPS)),
        "trips_weighted_pagerank_ranked": _ranked_sql(_weighted_pagerank_sql("WITH " + TRIPS + ",\n" + WEIGHTED)),
        "trips_weighted_pagerank": _weighted_pagerank_sql("WITH " + TRIPS + ",\n" + WEIGHTED),
        "trips_pagerank": _pagerank_sql("WITH " + TRIPS),
        "trips_fare_table": w + "SELECT * FROM fares",
        "trips_avg_fare_by_distance": w + fare_avg.format(k="distance"),
        "trips_avg_fare_by_duration": w + fare_avg.format(k="duration"),
        "trips_avg_fare_by_hour": w + fare_avg.format(k="start_hour"),
        "trips_fare_correlations": w + (
            "SELECT round(covar_pop(distance, fare_amount) / nullif(stddev_pop(distance) * stddev_pop(fare_amount), 0), 9) AS corr_distance, "
            "round(covar_pop(duration, fare_amount) / nullif(stddev_pop(duration) * stddev_pop(fare_amount), 0), 9) AS corr_duration, "
            "round(covar_pop(start_hour, fare_amount) / nullif(stddev_pop(start_hour) * stddev_pop(fare_amount), 0), 9) AS corr_hour "
            "FROM fares"),
    }
    for column, lo, hi, bins in FARE_HISTOGRAMS:
        out[f"trips_histogram_{column}"] = _histogram_sql(w.rstrip("\n"), column, lo, hi, bins)
    return out


# --- logs ---------------------------------------------------------------------

LOGS = r"""logs AS (
  SELECT CASE
    WHEN event_type = 'click' THEN 'INFO dfs.DataNode$DataXceiver: Receiving block blk_' || event_id
         || ' src: /10.0.0.' || user_id || ':50010 dest: /10.0.1.1:50010 of size '
         || CAST(round(value * 100) AS BIGINT)
    WHEN event_type = 'view' THEN 'INFO dfs.FSNamesystem: BLOCK* NameSystem.addStoredBlock: blk_' || event_id
         || ' src: /10.0.0.' || user_id || ':50010 stored, size ' || CAST(round(value * 100) AS BIGINT)
    WHEN event_type = 'purchase' THEN 'INFO dfs.DataNode$PacketResponder: Received block blk_' || event_id
         || ' of size ' || CAST(round(value * 100) AS BIGINT) || ' from /10.0.0.' || user_id || ':50010'
    WHEN event_type = 'signup' THEN 'INFO dfs.DataNode$DataXceiver: Served block blk_' || event_id
         || ' to /10.0.0.' || user_id || ' of size ' || CAST(round(value * 100) AS BIGINT) || '   '
    ELSE 'ERROR dfs.datanode: blk_' || event_id || ' src: /10.0.0.' || user_id || ':50010 checksum mismatch'
  END AS value, ts AS timestamp
  FROM events)"""

HOST = r"regexp_extract(value, 'src:\s*/([\d\.]+):', 1)"
TRAILING = r"TRY_CAST(regexp_extract(value, '(\d+)\s*$', 1) AS BIGINT)"


def logs_sql() -> dict[str, str]:
    w = _with(LOGS)
    windows = w + (
        ", buckets AS (SELECT time_bucket(INTERVAL 30 second, timestamp) AS b FROM logs "
        "WHERE contains(value, 'DataNode'))\n"
        "SELECT s AS window_start, s + INTERVAL 60 second AS window_end, count(*) AS datanode_count "
        "FROM (SELECT unnest([b, b - INTERVAL 30 second]) AS s FROM buckets) GROUP BY s")
    per_host = w + f"SELECT {HOST} AS hostname, CAST(sum({TRAILING}) AS BIGINT) AS total_bytes FROM logs GROUP BY 1"
    info = w + (f"SELECT {HOST} AS hostname, count(*) AS count FROM logs "
                "WHERE contains(value, 'INFO') AND contains(value, 'blk_') GROUP BY 1")
    lines = w + "SELECT value, timestamp FROM logs"
    from kestrel.streaming.logs import LATE_ONE_IN, REPLAY_SLICES
    late = ("(epoch_us(ts) - lo) / CAST(hi - lo + 1 AS DOUBLE) < 0.5 AND event_id % " + str(LATE_ONE_IN) + " = 0")
    replay = _with(
        "span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events)",
        f"arrived AS (SELECT *, {late} AS is_late FROM events, span)",
        LOGS.replace("ts AS timestamp\n  FROM events", "ts AS timestamp, is_late\n  FROM arrived"),
        "mark AS (SELECT max(timestamp) - INTERVAL 5 second AS mark FROM logs WHERE NOT is_late)",
        "w AS (SELECT unnest([b, b - INTERVAL 30 second]) AS s, is_late FROM (SELECT is_late, "
        "time_bucket(INTERVAL 30 second, timestamp) AS b FROM logs WHERE contains(value, 'DataNode')))") + (
        "SELECT s AS window_start, s + INTERVAL 60 second AS window_end, count(*) AS datanode_count FROM w, mark "
        "WHERE NOT is_late OR s + INTERVAL 60 second > mark GROUP BY s")
    # Text lines carry their time to the second; the rows of an arrival meet the
    # watermark that the DataNode lines of earlier arrivals have left.
    dropped = _with(
        "span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events)",
        f"arrived AS (SELECT *, CASE WHEN {late} THEN {REPLAY_SLICES} ELSE "
        f"CAST(floor((epoch_us(ts) - lo) / CAST(hi - lo + 1 AS DOUBLE) * {REPLAY_SLICES}) AS INTEGER) END AS arrival FROM events, span)",
        LOGS.replace("ts AS timestamp\n  FROM events", "date_trunc('second', ts) AS timestamp, arrival\n  FROM arrived"),
        "nodes AS (SELECT timestamp AS t, arrival FROM logs WHERE contains(value, 'DataNode'))",
        "ends AS (SELECT arrival, max(t) - INTERVAL 5 second AS mark FROM nodes GROUP BY arrival)",
        "marks AS (SELECT arrival, max(mark) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark FROM ends)",
        "w AS (SELECT DISTINCT arrival, unnest([b, b - INTERVAL 30 second]) AS s FROM (SELECT arrival, "
        "time_bucket(INTERVAL 30 second, t) AS b FROM nodes))") + (
        "SELECT arrival, watermark, count(*) FILTER (WHERE s + INTERVAL 60 second <= watermark) AS dropped "
        "FROM marks JOIN w USING (arrival) GROUP BY arrival, watermark")
    return {
        "logs_text_windows_replay": replay, "logs_late_windows_replay": dropped,
        "logs_text_windows_interrupted": windows, "logs_info_block_counts_triggered": info,
        "logs_lines": lines, "logs_lines_stream": lines,
        "logs_datanode_windows": windows, "logs_datanode_windows_stream": windows,
        "logs_bytes_per_host": per_host, "logs_bytes_per_host_stream": per_host,
        "logs_datanode_windows_replay": replay,
        "logs_info_block_counts": info, "logs_info_block_counts_stream": info,
    }


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(tweets_sql())
    out.update(ratings_sql())
    out.update(trips_sql())
    out.update(logs_sql())
    out |= {"csv_tweets_day_share": out["tweets_day_share"], "csv_stored_tweets_day_share": out["tweets_day_share"], "csv_ratings_top_movies": out["ratings_top_movies"],
            "csv_trips_avg_fare_by_hour": out["trips_avg_fare_by_hour"], "csv_trips_malformed":
            _with(TRIPS) + "SELECT count(*) FILTER (WHERE trip_seconds % 43 = 0) AS malformed_values, "
            "count(*) AS trips, count(pickup_area) AS with_pickup FROM trips"}
    out["documents_hashtags"] = (
        r"SELECT hashtag, count(*) AS count FROM (SELECT unnest(regexp_extract_all(replace(text, ' a', ' #a'), '#(\w+)', 1)) "
        r"AS hashtag FROM documents) GROUP BY hashtag")
    return out
