"""Gold layer (MOD-05..12).  Each model takes silver DataFrames and returns a lazy plan.

Traps applied (SURVEY section 5): DESC puts NULL first as in the reference warehouse
(T1); top-k ties are broken by movie_id (T3); NULL genre name is a group in MOD-09 but
filtered in MOD-08/10 (T14).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaplake.functions import scalar as fn

TOP_N = 20
HISTORY_FROM = "2000-01-01"

# Declared row order of the stored models (the reference's ORDER BY).  A stored table
# has no row order in Spark, so the models are written unsorted (no range-partitioning
# pass) and readers that need the order apply it with ``ordered`` (trap T7).
ORDER = {  # (column, descending); every DESC puts NULL first (T1)
    "historical_genre_distribution": [("movie_count", True), ("genre_name", False)],
    "agg_genre_trends": [("snapshot_date", True), ("avg_popularity", True),
                         ("genre", False)],
    "agg_historical_analysis": [("release_year", True), ("genre_market_share", True),
                                ("genre_name", False)],
}


def ordered(df: DataFrame, model: str) -> DataFrame:
    """A stored model read back in its declared order."""
    return df.orderBy(*[F.col(c).desc_nulls_first() if desc else F.col(c).asc()
                        for c, desc in ORDER[model]])


def latest(df: DataFrame, date_col: str = "snapshot_date",
           days: DataFrame | None = None) -> DataFrame:
    """FLT-05/AGG-05: rows of the latest snapshot, via an uncorrelated scalar subquery.
    On a table partitioned by ``date_col`` the subquery result prunes partitions.  ``days``:
    a table with the same days that is cheaper to look at (the input of a plan not stored
    yet: dedupe never removes a day)."""
    days = df if days is None else days
    return df.where(F.col(date_col) == days.agg(F.max(date_col)).scalar())


def latest_api(core: DataFrame, days: DataFrame | None = None) -> DataFrame:
    return latest(core.where(F.col("source") == "api"), days=days)


def latest_genres(stg_genres: DataFrame) -> DataFrame:
    """Genre names of the latest genre snapshot, NULL names dropped.  Whether a join with it
    broadcasts it is left to Spark, which knows its size at run time."""
    g = latest(stg_genres).where(F.col("genre_name").isNotNull())
    return g.select("genre_id", "genre_name")


def daily_total_movies(core: DataFrame) -> DataFrame:
    """MOD-05/AGG-01: exact distinct movie count."""
    return core.agg(F.count_distinct("movie_id").alias("total_movies_in_db"))


def daily_top_rated_movies(core: DataFrame, api_days: DataFrame | None = None) -> DataFrame:
    """MOD-06: latest api snapshot, > 100 votes, top 20 by rating then votes."""
    d = latest_api(core, api_days).where(F.col("vote_count") > 100)
    return d.select(
        "movie_id", "title", "vote_average", "vote_count", "popularity", "release_date",
        fn.poster_url("poster_path").alias("poster_url"),
    ).orderBy(F.col("vote_average").desc_nulls_first(), F.col("vote_count").desc_nulls_first(),
              F.col("movie_id").asc()).limit(TOP_N)


def daily_most_popular_movies(core: DataFrame, api_days: DataFrame | None = None) -> DataFrame:
    """MOD-07: latest api snapshot, top 20 by popularity (NULL first, as the reference)."""
    return latest_api(core, api_days).select(
        "movie_id", "title", "popularity", "vote_average", "vote_count", "release_date",
        fn.poster_url("poster_path").alias("poster_url"),
    ).orderBy(F.col("popularity").desc_nulls_first(), F.col("movie_id").asc()).limit(TOP_N)


def _movie_genres(core: DataFrame, stg_genres: DataFrame, *cols: str) -> DataFrame:
    """(movie, genre_name) pairs: explode genre ids (NULL/empty arrays drop, JN-04), join
    the latest genre names (a left join filtered on its right side = inner, JN-03)."""
    ids = core.select(*cols, F.explode("raw_genre_ids").alias("genre_id"))
    return ids.join(latest_genres(stg_genres), "genre_id")


def historical_genre_distribution(core: DataFrame, stg_genres: DataFrame) -> DataFrame:
    """MOD-08: distinct movies per genre over all snapshots."""
    pairs = _movie_genres(core, stg_genres, "movie_id")
    return pairs.groupBy("genre_name").agg(F.count_distinct("movie_id").alias("movie_count"))


def agg_genre_trends(core: DataFrame, stg_discover: DataFrame,
                     stg_genres: DataFrame) -> DataFrame:
    """MOD-09: mean popularity and row count per genre and snapshot.  api rows come from
    core, discover rows from *staging* (a movie seen by both on a day counts twice), and
    discover genre ids are named by the genre snapshot of the same day."""
    api = core.where(F.col("source") == "api").select(
        "snapshot_date", "popularity", F.explode("raw_genres").alias("g")) \
        .select(F.col("g.name").alias("genre_name"), "snapshot_date", "popularity")
    names = stg_genres.select("genre_id", "genre_name", "snapshot_date")
    disc = stg_discover.select("snapshot_date", "popularity",
                               F.explode("raw_genre_ids").alias("genre_id")) \
        .join(names, ["genre_id", "snapshot_date"]) \
        .select("genre_name", "snapshot_date", "popularity")
    both = api.unionByName(disc)
    return both.groupBy("genre_name", "snapshot_date").agg(
        F.avg("popularity").alias("avg_popularity"), F.count(F.lit(1)).alias("movie_count"),
    ).select(F.col("genre_name").alias("genre"), "snapshot_date", "avg_popularity",
             "movie_count")


def agg_historical_analysis(core: DataFrame, stg_genres: DataFrame) -> DataFrame:
    """MOD-10 (flagship): per release year (>= 2000) and genre: distinct movies, mean
    popularity, mean rating (NULL -> 0), the year's total and the genre's share of it.

    One aggregate carries the two means and the distinct count (Spark plans it as one
    partial/final chain keyed first by (year, genre, movie), so a hot genre is spread by
    movie id before it is collapsed).  The year window runs on the small aggregated rows.
    """
    hist = core.where(fn.date_from("release_date", HISTORY_FROM)).select(
        "movie_id", F.year("release_date").alias("release_year"), "popularity",
        "vote_average", "raw_genre_ids")
    pairs = _movie_genres(hist, stg_genres, "movie_id", "release_year", "popularity",
                          "vote_average")
    yearly = pairs.groupBy("release_year", "genre_name").agg(
        F.avg("popularity").alias("avg_popularity"),
        F.avg("vote_average").alias("avg_rating"),
        F.count_distinct("movie_id").alias("movie_count"))
    total = F.sum("movie_count").over(Window.partitionBy("release_year"))
    out = yearly.select(
        "release_year", "genre_name", "movie_count", "avg_popularity",
        F.coalesce(F.col("avg_rating"), F.lit(0.0)).alias("avg_rating"),
        total.alias("total_movies_per_year"),
        fn.share_percent(F.col("movie_count"), total).alias("genre_market_share"))
    return out


def fact_movie_popularity(core: DataFrame) -> DataFrame:
    """MOD-11."""
    return core.select("movie_id", "snapshot_date", "popularity", "vote_average",
                       "vote_count")


def dim_movies(core: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """MOD-12: latest snapshot of every source, genre names joined by ', '.

    core is unique on (movie_id, snapshot_date), so the reference's group-by + left join
    back collapses into a per-row array expression: no shuffle at all.
    """
    return latest(core, days=days).select(
        "movie_id", "title", fn.genre_names_joined("raw_genres").alias("genres"),
        "release_date", "runtime", "snapshot_date")


def build_gold(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    core, genres, disc = silver["core_movies"], silver["stg_genres"], silver["stg_discover"]
    return {
        "daily_total_movies": daily_total_movies(core),
        "daily_top_rated_movies": daily_top_rated_movies(core),
        "daily_most_popular_movies": daily_most_popular_movies(core),
        "historical_genre_distribution": historical_genre_distribution(core, genres),
        "agg_genre_trends": agg_genre_trends(core, disc, genres),
        "agg_historical_analysis": agg_historical_analysis(core, genres),
        "fact_movie_popularity": fact_movie_popularity(core),
        "dim_movies": dim_movies(core),
    }
