"""Registry of checked queries: name -> (Spark query, DuckDB SQL or None).

Each Spark query takes ``(spark, sf_dir)``, derives the raw tables from the driver's
tables with Spark, runs the library code, and returns a DataFrame.  Its SQL twin (in
``oracle``) derives the same rows in DuckDB.  Arrays leave as JSON text; averages and
decimals leave as DOUBLE rounded through DECIMAL(38,10) so both engines hash equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake import fixtures
from snaplake.checks.oracle import r4 as sql_r4
from snaplake.checks.oracle import with_ctes
from snaplake.plans import cards, gold, silver

Query = Callable[[SparkSession, str], DataFrame]
CHECKS: dict[str, tuple[Query, str | None]] = {}


def check(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in CHECKS:
            raise ValueError(f"a check named {name} is registered already")
        CHECKS[name] = (fn, with_ctes(sql) if sql else None)
        return fn
    return deco


def r4(c) -> Column:
    """Average -> DOUBLE rounded to 4 places through DECIMAL(38,10) (trap T12)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("decimal(38,10)"), 4).cast("double")


def layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = fixtures.raw_tables(spark, sf_dir)
    return {**raw, **silver.build_silver(raw)}


def gold_model(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    s = layers(spark, sf_dir)
    core, genres, disc = s["core_movies"], s["stg_genres"], s["stg_discover"]
    # The latest day from the raw rows: staging and core needn't be computed for it.
    api_days = s["movie_details"].select("snapshot_date")
    days = api_days.unionByName(s["discover"].select("snapshot_date"))
    build = {
        "daily_total_movies": lambda: gold.daily_total_movies(core),
        "daily_top_rated_movies": lambda: gold.daily_top_rated_movies(core, api_days),
        "daily_most_popular_movies": lambda: gold.daily_most_popular_movies(core, api_days),
        "historical_genre_distribution":
            lambda: gold.historical_genre_distribution(core, genres),
        "agg_genre_trends": lambda: gold.agg_genre_trends(core, disc, genres),
        "agg_historical_analysis": lambda: gold.agg_historical_analysis(core, genres),
        "fact_movie_popularity": lambda: gold.fact_movie_popularity(core),
        "dim_movies": lambda: gold.dim_movies(core, days),
    }
    return build[name]()


# ---- silver models ------------------------------------------------------------------

@check("stg_genres", "SELECT * FROM stg_genres")
def q_stg_genres(spark, sf_dir):
    return layers(spark, sf_dir)["stg_genres"]


_STG_DETAILS_COLS = ("movie_id, title, original_title, overview, status, tagline, runtime, "
                     "budget, revenue, popularity, vote_average, vote_count, release_date")


@check("stg_movie_details", f"""
SELECT {_STG_DETAILS_COLS}, CAST(to_json(raw_genres) AS VARCHAR) AS raw_genres, poster_path,
       snapshot_date FROM stg_movie_details""")
def q_stg_movie_details(spark, sf_dir):
    d = layers(spark, sf_dir)["stg_movie_details"]
    return d.withColumn("raw_genres", F.to_json("raw_genres"))


@check("stg_discover", """
SELECT movie_id, title, CAST(to_json(raw_genre_ids) AS VARCHAR) AS raw_genre_ids, popularity,
       vote_average, vote_count, release_date, release_year, snapshot_date, data_source
FROM stg_discover""")
def q_stg_discover(spark, sf_dir):
    d = layers(spark, sf_dir)["stg_discover"]
    return d.withColumn("raw_genre_ids", F.to_json("raw_genre_ids"))


@check("core_movies", f"""
SELECT {_STG_DETAILS_COLS}, CAST(to_json(raw_genres) AS VARCHAR) AS raw_genres,
       CAST(to_json(raw_genre_ids) AS VARCHAR) AS raw_genre_ids, poster_path, snapshot_date,
       source FROM core_movies""")
def q_core_movies(spark, sf_dir):
    c = layers(spark, sf_dir)["core_movies"]
    return c.withColumn("raw_genres", F.to_json("raw_genres")) \
            .withColumn("raw_genre_ids", F.to_json("raw_genre_ids"))


# ---- gold models --------------------------------------------------------------------

@check("daily_total_movies", "SELECT * FROM gold_daily_total_movies")
def q_daily_total_movies(spark, sf_dir):
    return gold_model(spark, sf_dir, "daily_total_movies")


@check("daily_top_rated_movies", "SELECT * FROM gold_daily_top_rated_movies")
def q_daily_top_rated(spark, sf_dir):
    return gold_model(spark, sf_dir, "daily_top_rated_movies")


@check("daily_most_popular_movies", "SELECT * FROM gold_daily_most_popular_movies")
def q_daily_most_popular(spark, sf_dir):
    return gold_model(spark, sf_dir, "daily_most_popular_movies")


@check("historical_genre_distribution", "SELECT * FROM gold_historical_genre_distribution")
def q_hist_genre_dist(spark, sf_dir):
    return gold_model(spark, sf_dir, "historical_genre_distribution")


@check("agg_genre_trends", f"""
SELECT genre, snapshot_date, {sql_r4('avg_popularity')} AS avg_popularity, movie_count
FROM gold_agg_genre_trends""")
def q_agg_genre_trends(spark, sf_dir):
    return gold_model(spark, sf_dir, "agg_genre_trends") \
        .withColumn("avg_popularity", r4("avg_popularity"))


_HIST_SQL = f"""
SELECT release_year, genre_name, movie_count, {sql_r4('avg_popularity')} AS avg_popularity,
       {sql_r4('avg_rating')} AS avg_rating, total_movies_per_year,
       CAST(genre_market_share AS DOUBLE) AS genre_market_share
FROM gold_agg_historical_analysis"""


def hist_for_check(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_popularity", r4("avg_popularity")) \
             .withColumn("avg_rating", r4("avg_rating")) \
             .withColumn("genre_market_share", F.col("genre_market_share").cast("double"))


@check("agg_historical_analysis", _HIST_SQL)
def q_agg_historical_analysis(spark, sf_dir):
    return hist_for_check(gold_model(spark, sf_dir, "agg_historical_analysis"))


@check("fact_movie_popularity", "SELECT * FROM gold_fact_movie_popularity")
def q_fact_movie_popularity(spark, sf_dir):
    return gold_model(spark, sf_dir, "fact_movie_popularity")


@check("dim_movies", "SELECT * FROM gold_dim_movies")
def q_dim_movies(spark, sf_dir):
    return gold_model(spark, sf_dir, "dim_movies")


# ---- dashboard cards ----------------------------------------------------------------

@check("card_total_movies",
       "SELECT total_movies_in_db AS total_movies FROM gold_daily_total_movies")
def q_card_total(spark, sf_dir):
    return cards.total_movies(gold_model(spark, sf_dir, "daily_total_movies"))


@check("card_highest_rated", """
SELECT poster_url AS poster, title, vote_average AS rating, vote_count AS votes
FROM gold_daily_top_rated_movies
ORDER BY vote_average DESC NULLS FIRST, vote_count DESC NULLS FIRST, movie_id LIMIT 10""")
def q_card_highest_rated(spark, sf_dir):
    return cards.highest_rated(gold_model(spark, sf_dir, "daily_top_rated_movies"))


@check("card_trending", """
SELECT poster_url AS poster, title, popularity, release_date
FROM gold_daily_most_popular_movies
ORDER BY popularity DESC NULLS FIRST, movie_id LIMIT 10""")
def q_card_trending(spark, sf_dir):
    return cards.trending(gold_model(spark, sf_dir, "daily_most_popular_movies"))


@check("card_genre_distribution", """
SELECT genre_name AS genre, movie_count FROM gold_historical_genre_distribution""")
def q_card_genre_distribution(spark, sf_dir):
    return cards.genre_distribution(gold_model(spark, sf_dir, "historical_genre_distribution"))


@check("card_avg_rating_by_genre", """
SELECT genre_name AS genre,
       CAST(round(CAST(avg(avg_rating) AS DECIMAL(38,10)), 2) AS DOUBLE) AS average_rating
FROM gold_agg_historical_analysis WHERE avg_rating > 0 GROUP BY genre_name""")
def q_card_avg_rating(spark, sf_dir):
    return cards.avg_rating_by_genre(gold_model(spark, sf_dir, "agg_historical_analysis")) \
        .withColumn("average_rating", F.col("average_rating").cast("double"))


@check("card_movies_by_year", """
SELECT release_year AS year, CAST(sum(movie_count) AS BIGINT) AS movies_produced
FROM gold_agg_historical_analysis GROUP BY release_year""")
def q_card_movies_by_year(spark, sf_dir):
    return cards.movies_by_year(gold_model(spark, sf_dir, "agg_historical_analysis"))


@check("card_genre_share", """
SELECT genre_name AS genre, movie_count,
       ((20000 * movie_count + (SELECT sum(movie_count) FROM gold_historical_genre_distribution))
        // (2 * (SELECT sum(movie_count) FROM gold_historical_genre_distribution))) / 100.0
           AS share_percent
FROM gold_historical_genre_distribution""")
def q_card_genre_share(spark, sf_dir):
    return cards.genre_share(gold_model(spark, sf_dir, "historical_genre_distribution")) \
        .withColumn("share_percent", F.col("share_percent").cast("double"))


def _register_all() -> None:
    from snaplake.checks import io_checks, operator_checks  # noqa: F401  (register)


def spark_queries() -> dict[str, Query]:
    _register_all()
    return {k: v[0] for k, v in CHECKS.items()}


def oracle_queries() -> dict[str, str]:
    _register_all()
    return {k: v[1] for k, v in CHECKS.items() if v[1] is not None}
