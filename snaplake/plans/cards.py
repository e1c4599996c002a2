"""Dashboard cards (CARD-01..07): the dashboard's SQL over gold tables.

Display names of the reference ("Total Movies", "Average Rating", ...) become snake_case.
A stored table has no row order in Spark, so cards that read "the first 10 rows" repeat
the model's sort before ``limit`` (trap T7).  Every card input is a small gold table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.functions import scalar as fn

CARD_ROWS = 10


def total_movies(daily_total: DataFrame) -> DataFrame:
    """CARD-01: the scalar."""
    return daily_total.select(F.col("total_movies_in_db").alias("total_movies"))


def highest_rated(top_rated: DataFrame) -> DataFrame:
    """CARD-02: first 10 of daily_top_rated_movies."""
    return top_rated.orderBy(F.col("vote_average").desc_nulls_first(),
                             F.col("vote_count").desc_nulls_first(),
                             F.col("movie_id").asc()).limit(CARD_ROWS).select(
        F.col("poster_url").alias("poster"), "title", F.col("vote_average").alias("rating"),
        F.col("vote_count").alias("votes"))


def trending(most_popular: DataFrame) -> DataFrame:
    """CARD-03: first 10 of daily_most_popular_movies."""
    return most_popular.orderBy(F.col("popularity").desc_nulls_first(),
                                F.col("movie_id").asc()).limit(CARD_ROWS).select(
        F.col("poster_url").alias("poster"), "title", "popularity", "release_date")


def genre_distribution(dist: DataFrame) -> DataFrame:
    """CARD-04: genre counts for the pie."""
    return dist.select(F.col("genre_name").alias("genre"), "movie_count") \
        .orderBy(F.col("movie_count").desc(), F.col("genre"))


def avg_rating_by_genre(hist: DataFrame) -> DataFrame:
    """CARD-05: unweighted mean of the yearly means > 0, 2 decimals, best first."""
    return hist.where(F.col("avg_rating") > 0).groupBy("genre_name").agg(
        F.round(F.avg("avg_rating").cast("decimal(38,10)"), 2).alias("average_rating"),
    ).select(F.col("genre_name").alias("genre"), "average_rating") \
        .orderBy(F.col("average_rating").desc_nulls_first(), F.col("genre"))


def movies_by_year(hist: DataFrame) -> DataFrame:
    """CARD-06: sum of genre counts per year, ascending."""
    return hist.groupBy("release_year").agg(F.sum("movie_count").alias("movies_produced")) \
        .select(F.col("release_year").alias("year"), "movies_produced").orderBy("year")


def genre_share(dist: DataFrame) -> DataFrame:
    """CARD-07 / WIN-05: each genre's percent of the pie total.  The total is an
    uncorrelated scalar subquery (one small aggregate), not a single-partition window."""
    total = dist.agg(F.sum("movie_count")).scalar()
    return dist.select(F.col("genre_name").alias("genre"), "movie_count",
                       fn.share_percent(F.col("movie_count"), total).alias("share_percent"))


#: Card -> (gold table, query).
CARDS = {
    "total_movies": ("daily_total_movies", total_movies),
    "highest_rated": ("daily_top_rated_movies", highest_rated),
    "trending": ("daily_most_popular_movies", trending),
    "genre_distribution": ("historical_genre_distribution", genre_distribution),
    "avg_rating_by_genre": ("agg_historical_analysis", avg_rating_by_genre),
    "movies_by_year": ("agg_historical_analysis", movies_by_year),
    "genre_share": ("historical_genre_distribution", genre_share),
}


def by_name(spark: SparkSession, card: str, db: str = "gold") -> DataFrame:
    """A card over the catalog's gold tables."""
    table, query = CARDS[card]
    return query(spark.table(f"`{db}`.`{table}`"))
