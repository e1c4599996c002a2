"""Silver layer: staging dedupe (MOD-01..03) and the merged core table (MOD-04).

JSON text is parsed exactly once here; gold only ever sees typed arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake import schemas
from snaplake.functions import scalar as fn
from snaplake.operators.dedupe import first_per_key

SNAPSHOT_KEYS = ("id", "snapshot_date")
CORE_KEYS = ("movie_id", "snapshot_date")
CORE_COLUMNS = (
    "movie_id", "title", "original_title", "overview", "status", "tagline", "runtime",
    "budget", "revenue", "popularity", "vote_average", "vote_count", "release_date",
    "raw_genres", "raw_genre_ids", "poster_path", "snapshot_date", "source",
)


def _dedupe_raw(raw: DataFrame, first=first_per_key) -> DataFrame:
    # The reference orders by snapshot_date inside its own partition (a constant), so its
    # winner is arbitrary; data_source ASC makes it deterministic (trap T2).
    return first(raw, SNAPSHOT_KEYS, [F.col("data_source").asc_nulls_last()])


def stg_genres(raw_genres: DataFrame, first=first_per_key) -> DataFrame:
    """MOD-01 -> genre_id INT, genre_name STRING, snapshot_date DATE."""
    g = _dedupe_raw(raw_genres.select("id", "name", "snapshot_date", "data_source"), first)
    return g.select(F.col("id").cast("int").alias("genre_id"),
                    F.col("name").alias("genre_name"), "snapshot_date")


def stg_movie_details(raw_details: DataFrame, first=first_per_key) -> DataFrame:
    """MOD-02: one row per (movie, snapshot); release date cast, genres parsed."""
    d = _dedupe_raw(raw_details.select(
        "id", "title", "original_title", "overview", "status", "tagline", "runtime",
        "budget", "revenue", "popularity", "vote_average", "vote_count", "release_date",
        "genres", "poster_path", "snapshot_date", "data_source"), first)
    return d.select(
        F.col("id").alias("movie_id"), "title", "original_title", "overview", "status",
        "tagline", "runtime", "budget", "revenue", "popularity", "vote_average",
        "vote_count", fn.text_to_date("release_date").alias("release_date"),
        fn.parse_genre_objects("genres").alias("raw_genres"), "poster_path",
        "snapshot_date")


def stg_discover(raw_discover: DataFrame, first=first_per_key) -> DataFrame:
    """MOD-03: one row per (movie, snapshot) of the discover feed."""
    d = _dedupe_raw(raw_discover.select(
        "id", "title", "genre_ids", "popularity", "vote_average", "vote_count",
        "release_date", "release_year", "snapshot_date", "data_source"), first)
    return d.select(
        F.col("id").alias("movie_id"), "title",
        fn.parse_genre_ids("genre_ids").alias("raw_genre_ids"), "popularity",
        "vote_average", "vote_count", fn.text_to_date("release_date").alias("release_date"),
        "release_year", "snapshot_date", "data_source")


def core_movies(details: DataFrame, discover: DataFrame) -> DataFrame:
    """MOD-04: both staging tables in one 18-column schema; per (movie, snapshot) the api
    row beats the discover row.  Every snapshot is kept.

    Staging is unique on (movie_id, snapshot_date), so the winner is: every api row, and the
    discover rows whose key no api row has.  Api rows never move; the anti-join shuffles
    discover rows and the api side's keys only.
    """
    null = lambda t: F.lit(None).cast(t)
    api = details.select(
        "movie_id", "title", "original_title", "overview", "status", "tagline", "runtime",
        "budget", "revenue", "popularity", "vote_average", "vote_count", "release_date",
        "raw_genres", fn.genre_ids_of("raw_genres").alias("raw_genre_ids"), "poster_path",
        "snapshot_date", F.lit("api").alias("source"))
    disc = discover.select(
        "movie_id", "title", null("string").alias("original_title"),
        null("string").alias("overview"), null("string").alias("status"),
        null("string").alias("tagline"), null("int").alias("runtime"),
        null("bigint").alias("budget"), null("bigint").alias("revenue"), "popularity",
        "vote_average", "vote_count", "release_date",
        null(schemas.GENRE_OBJECTS).alias("raw_genres"), "raw_genre_ids",
        null("string").alias("poster_path"), "snapshot_date",
        F.lit("discover").alias("source"))
    disc = disc.join(details.select(*CORE_KEYS), list(CORE_KEYS), "left_anti")
    return api.select(*CORE_COLUMNS).unionByName(disc.select(*CORE_COLUMNS))


def build_silver(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All four silver models from the raw tables (lazy plans)."""
    details = stg_movie_details(raw["movie_details"])
    disc = stg_discover(raw["discover"])
    return {
        "stg_genres": stg_genres(raw["genres"]),
        "stg_movie_details": details,
        "stg_discover": disc,
        "core_movies": core_movies(details, disc),
    }
