"""DuckDB SQL for every checked query.

Each statement derives the raw tables from the driver's tables exactly as
``snaplake.fixtures`` does (FIXTURES.md section 4), rebuilds staging/core/gold in plain
SQL, and ends in the query under check.  Conventions shared with ``spark_side``:
arrays leave as JSON text, decimals and averages as DOUBLE rounded through
DECIMAL(38,10) (traps T6, T12), Postgres' DESC puts NULL first (T1).
"""

from __future__ import annotations

import re

# name -> body; a statement includes only the CTEs it (transitively) references.
_CTES: dict[str, str] = {}


def _cte(name: str, body: str) -> None:
    _CTES[name] = body.strip()


_cte("fx_days", "SELECT unnest([0, 1, 2]) AS day")
_cte("fx_genre_lists", """
SELECT l_orderkey AS gl_key,
       list_sort(list_distinct(list(CAST(l_suppkey % 19 AS INTEGER)))) AS genre_list
FROM lineitem GROUP BY l_orderkey""")
_FX_ROW = """
SELECT o.o_orderkey AS id, d.day AS day,
       'Movie ' || CAST(o.o_orderkey AS VARCHAR) AS title,
       g.genre_list,
       CASE WHEN o.o_orderkey % 1499 = 0 THEN NULL
            ELSE o.o_totalprice / 1000 + d.day END AS popularity,
       CAST((o.o_orderkey * 7) % 101 AS DOUBLE) / 10 AS vote_average,
       (o.o_orderkey * 13) % 500 AS vote_count,
       CASE WHEN o.o_orderkey % 89 = 0 THEN '' ELSE strftime(o.o_orderdate, '%Y-%m-%d') END
           AS release_date,
       CAST(year(o.o_orderdate) AS INTEGER) AS release_year,
       CASE WHEN o.o_orderkey % 5 = 0 THEN NULL
            ELSE '/p' || CAST(o.o_orderkey AS VARCHAR) || '.jpg' END AS poster_path,
       CAST(o.o_orderkey % 180 AS INTEGER) AS runtime,
       o.o_orderkey * 1000 AS budget, o.o_orderkey * 1500 AS revenue,
       o.o_orderpriority AS overview, o.o_orderstatus AS status,
       DATE '2024-01-01' + d.day AS snapshot_date
FROM orders o LEFT JOIN fx_genre_lists g ON g.gl_key = o.o_orderkey
CROSS JOIN {days} d"""
_cte("fx_rows", _FX_ROW.format(days="fx_days"))
_cte("fx_days23", "SELECT unnest([2, 3]) AS day")
_cte("fx_rows23", _FX_ROW.format(days="fx_days23"))

_GENRE_OBJ_JSON = ("CAST(to_json(list_transform(genre_list, lambda x: {'id': x, "
                   "'name': 'NATION_' || CAST(x AS VARCHAR)})) AS VARCHAR)")
_cte("raw_movie_details", f"""
SELECT id, CAST(NULL AS VARCHAR) AS imdb_id, title, title AS original_title, overview, status,
       CAST(NULL AS VARCHAR) AS tagline, runtime, budget, revenue, popularity, vote_average,
       vote_count, release_date, {_GENRE_OBJ_JSON} AS genres,
       CAST(NULL AS VARCHAR) AS production_companies,
       CAST(NULL AS VARCHAR) AS production_countries,
       CAST(NULL AS VARCHAR) AS spoken_languages, CAST(NULL AS VARCHAR) AS homepage,
       CAST(NULL AS VARCHAR) AS backdrop_path, poster_path, CAST(NULL AS BOOLEAN) AS adult,
       CAST(NULL AS BOOLEAN) AS video, CAST(NULL AS VARCHAR) AS original_language,
       CAST(NULL AS VARCHAR) AS belongs_to_collection, snapshot_date, 'api' AS data_source
FROM fx_rows WHERE (id + day) % 3 = 0""")
_DISCOVER_SELECT = """
SELECT id, title, CAST(to_json(genre_list) AS VARCHAR) AS genre_ids, {pop} AS popularity,
       vote_average, vote_count, release_date, release_year, snapshot_date,
       '{src}' AS data_source
FROM {rows} WHERE (id + day) % 2 = 0{extra}"""


def _discover(rows: str) -> str:
    a = _DISCOVER_SELECT.format(pop="popularity", src="discover", rows=rows, extra="")
    b = _DISCOVER_SELECT.format(pop="popularity + 0.5", src="manual", rows=rows,
                                extra=" AND id % 11 = 0")
    return a + "\nUNION ALL" + b


_cte("raw_discover", _discover("fx_rows"))
_cte("raw_discover_batch2_base", _discover("fx_rows23"))
_cte("raw_discover_batch2", """
SELECT id, title, genre_ids,
       CASE WHEN snapshot_date = DATE '2024-01-03' THEN popularity * 2 ELSE popularity END
           AS popularity,
       vote_average, vote_count, release_date, release_year, snapshot_date, data_source
FROM raw_discover_batch2_base""")
_LIST_SELECT = """
SELECT id, title, title AS original_title, overview, poster_path,{media}
       CAST(NULL AS BOOLEAN) AS adult, CAST(NULL AS VARCHAR) AS original_language,
       CAST(to_json(genre_list) AS VARCHAR) AS genre_ids, popularity, release_date,
       CAST(NULL AS BOOLEAN) AS video, vote_average, vote_count, snapshot_date,
       'api' AS data_source
FROM fx_rows WHERE id % {every} = 0"""
_cte("raw_trending", _LIST_SELECT.format(media=" CAST(NULL AS VARCHAR) AS media_type,",
                                         every=7))
_cte("raw_popular", _LIST_SELECT.format(media="", every=10))
_cte("raw_top_rated", _LIST_SELECT.format(media="", every=15))
_cte("raw_genres", """
SELECT CAST(n_nationkey AS INTEGER) AS id, n_name AS name,
       DATE '2024-01-01' + d.day AS snapshot_date, 'api' AS data_source
FROM nation CROSS JOIN fx_days d WHERE n_nationkey <> 18""")

_cte("discover_served", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY release_year, snapshot_date
                               ORDER BY popularity DESC NULLS LAST, id) AS rn
  FROM raw_discover WHERE data_source = 'discover')""")
# What a client with a limit of five pages of 20 is served.
_cte("discover_served_5", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY release_year, snapshot_date
                               ORDER BY popularity DESC NULLS LAST, id) AS rn
  FROM raw_discover WHERE data_source = 'discover') WHERE rn <= 100""")

# ---- silver -------------------------------------------------------------------------
_cte("stg_genres", """
SELECT id AS genre_id, name AS genre_name, snapshot_date FROM (
  SELECT *, row_number() OVER (PARTITION BY id, snapshot_date ORDER BY data_source) AS rn
  FROM raw_genres) WHERE rn = 1""")
_cte("stg_movie_details", """
SELECT id AS movie_id, title, original_title, overview, status, tagline, runtime, budget,
       revenue, popularity, vote_average, vote_count, TRY_CAST(release_date AS DATE)
           AS release_date,
       from_json(genres, '[{"id":"INTEGER","name":"VARCHAR"}]') AS raw_genres,
       poster_path, snapshot_date FROM (
  SELECT *, row_number() OVER (PARTITION BY id, snapshot_date ORDER BY data_source) AS rn
  FROM raw_movie_details) WHERE rn = 1""")
_cte("stg_discover", """
SELECT id AS movie_id, title, from_json(genre_ids, '["INTEGER"]') AS raw_genre_ids,
       popularity, vote_average, vote_count, TRY_CAST(release_date AS DATE) AS release_date,
       release_year, snapshot_date, data_source FROM (
  SELECT *, row_number() OVER (PARTITION BY id, snapshot_date ORDER BY data_source) AS rn
  FROM raw_discover) WHERE rn = 1""")
_cte("core_combined", """
SELECT movie_id, title, original_title, overview, status, tagline, runtime, budget, revenue,
       popularity, vote_average, vote_count, release_date, raw_genres,
       CASE WHEN len(raw_genres) > 0 THEN list_transform(raw_genres, lambda g: g.id) END
           AS raw_genre_ids,
       poster_path, snapshot_date, 'api' AS source
FROM stg_movie_details
UNION ALL
SELECT movie_id, title, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
       CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER), CAST(NULL AS BIGINT),
       CAST(NULL AS BIGINT), popularity, vote_average, vote_count, release_date,
       CAST(NULL AS STRUCT(id INTEGER, name VARCHAR)[]), raw_genre_ids,
       CAST(NULL AS VARCHAR), snapshot_date, 'discover'
FROM stg_discover""")
_cte("core_movies", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY movie_id, snapshot_date
                               ORDER BY CASE WHEN source = 'api' THEN 1 ELSE 2 END) AS rn
  FROM core_combined) WHERE rn = 1""")

# ---- gold ---------------------------------------------------------------------------
_cte("latest_genres", """
SELECT genre_id, genre_name FROM stg_genres
WHERE snapshot_date = (SELECT max(snapshot_date) FROM stg_genres)
  AND genre_name IS NOT NULL""")
_cte("gold_daily_total_movies", """
SELECT count(DISTINCT movie_id) AS total_movies_in_db FROM core_movies""")
_cte("latest_api", """
SELECT * FROM core_movies
WHERE source = 'api'
  AND snapshot_date = (SELECT max(snapshot_date) FROM core_movies WHERE source = 'api')""")
_POSTER = ("CASE WHEN poster_path IS NOT NULL THEN 'https://image.tmdb.org/t/p/w200' || "
           "poster_path ELSE NULL END")
_cte("gold_daily_top_rated_movies", f"""
SELECT movie_id, title, vote_average, vote_count, popularity, release_date,
       {_POSTER} AS poster_url
FROM latest_api WHERE vote_count > 100
ORDER BY vote_average DESC NULLS FIRST, vote_count DESC NULLS FIRST, movie_id
LIMIT 20""")
_cte("gold_daily_most_popular_movies", f"""
SELECT movie_id, title, popularity, vote_average, vote_count, release_date,
       {_POSTER} AS poster_url
FROM latest_api ORDER BY popularity DESC NULLS FIRST, movie_id LIMIT 20""")
_cte("core_genre_pairs", """
SELECT c.movie_id, c.release_date, c.popularity, c.vote_average, u.genre_id
FROM core_movies c, unnest(c.raw_genre_ids) AS u(genre_id)""")
_cte("gold_historical_genre_distribution", """
SELECT g.genre_name, count(DISTINCT p.movie_id) AS movie_count
FROM core_genre_pairs p JOIN latest_genres g ON p.genre_id = g.genre_id
GROUP BY g.genre_name""")
_cte("gold_agg_genre_trends", """
SELECT genre_name AS genre, snapshot_date, avg(popularity) AS avg_popularity,
       count(*) AS movie_count FROM (
  SELECT u.g.name AS genre_name, c.snapshot_date, c.popularity
  FROM core_movies c, unnest(c.raw_genres) AS u(g) WHERE c.source = 'api'
  UNION ALL
  SELECT g.genre_name, d.snapshot_date, d.popularity
  FROM stg_discover d, unnest(d.raw_genre_ids) AS u(gid)
  JOIN stg_genres g ON u.gid = g.genre_id AND d.snapshot_date = g.snapshot_date)
GROUP BY genre_name, snapshot_date""")
_cte("hist_yearly", """
SELECT CAST(year(p.release_date) AS INTEGER) AS release_year, g.genre_name,
       avg(p.popularity) AS avg_popularity, avg(p.vote_average) AS avg_rating,
       count(DISTINCT p.movie_id) AS movie_count
FROM core_genre_pairs p JOIN latest_genres g ON p.genre_id = g.genre_id
WHERE p.release_date >= DATE '2000-01-01'
GROUP BY 1, 2""")
_cte("gold_agg_historical_analysis", """
SELECT release_year, genre_name, movie_count, avg_popularity,
       coalesce(avg_rating, 0.0) AS avg_rating,
       CAST(sum(movie_count) OVER (PARTITION BY release_year) AS BIGINT)
           AS total_movies_per_year,
       ((20000 * movie_count + sum(movie_count) OVER (PARTITION BY release_year))
         // (2 * sum(movie_count) OVER (PARTITION BY release_year))) / 100.0
           AS genre_market_share
FROM hist_yearly""")
_cte("gold_fact_movie_popularity", """
SELECT movie_id, snapshot_date, popularity, vote_average, vote_count FROM core_movies""")
_cte("gold_dim_movies", """
SELECT movie_id, title,
       CASE WHEN len(list_filter(list_transform(raw_genres, lambda g: g.name), lambda n: n IS NOT NULL)) > 0
            THEN array_to_string(list_filter(list_transform(raw_genres, lambda g: g.name),
                                             lambda n: n IS NOT NULL), ', ') END AS genres,
       release_date, runtime, snapshot_date
FROM core_movies WHERE snapshot_date = (SELECT max(snapshot_date) FROM core_movies)""")

_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _needed(sql: str) -> list[str]:
    """CTE names referenced by ``sql``, dependencies first."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for w in dict.fromkeys(_WORD.findall(text)):
            if w in _CTES and w not in seen:
                seen.add(w)
                visit(_CTES[w])
                order.append(w)

    visit(sql)
    return order


def with_ctes(final: str) -> str:
    names = _needed(final)
    if not names:
        return final.strip()
    body = ",\n".join(f"{n} AS (\n{_CTES[n]}\n)" for n in names)
    final = final.strip()
    if final[:5].upper() == "WITH ":  # the statement brings CTEs of its own
        return f"WITH {body},\n{final[5:]}"
    return f"WITH {body}\n{final}"


def r4(expr: str) -> str:
    """Average -> DOUBLE, rounded to 4 places through DECIMAL(38,10) (T12)."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), 4) AS DOUBLE)"
