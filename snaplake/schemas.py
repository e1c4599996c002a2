"""Explicit schemas: the six raw snapshot tables, the landing documents, silver arrays.

Raw tables keep nested API values as JSON text; staging parses them once into the
typed arrays below.  Landing, raw and state reads pass a schema; lake snapshots, whose columns
vary, are read with the schema their files have.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType)

S, L, I, D, B, DT = StringType(), LongType(), IntegerType(), DoubleType(), BooleanType(), DateType()

# Key of every raw table, and its partition column.
RAW_KEYS = ("id", "snapshot_date", "data_source")
PARTITION_COLUMN = "snapshot_date"


# Where a landed row stood: it travels from the readers through the lake to the load, which keeps
# the first row of a key, and is not stored in raw tables.  Sorts as the responses came.
ARRIVAL = "_arrival"


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


_LIST_COMMON = [
    ("id", L), ("title", S), ("original_title", S), ("overview", S), ("poster_path", S),
]
_LIST_TAIL = [
    ("adult", B), ("original_language", S), ("genre_ids", S), ("popularity", D),
    ("release_date", S), ("video", B), ("vote_average", D), ("vote_count", L),
    ("snapshot_date", DT), ("data_source", S),
]

TRENDING = _struct(*_LIST_COMMON, ("media_type", S), *_LIST_TAIL)
POPULAR = _struct(*_LIST_COMMON, *_LIST_TAIL)
TOP_RATED = POPULAR

DISCOVER = _struct(
    ("id", L), ("title", S), ("genre_ids", S), ("popularity", D), ("vote_average", D),
    ("vote_count", L), ("release_date", S), ("release_year", I), ("snapshot_date", DT),
    ("data_source", S),
)

MOVIE_DETAILS = _struct(
    ("id", L), ("imdb_id", S), ("title", S), ("original_title", S), ("overview", S),
    ("status", S), ("tagline", S), ("runtime", I), ("budget", L), ("revenue", L),
    ("popularity", D), ("vote_average", D), ("vote_count", L), ("release_date", S),
    ("genres", S), ("production_companies", S), ("production_countries", S),
    ("spoken_languages", S), ("homepage", S), ("backdrop_path", S), ("poster_path", S),
    ("adult", B), ("video", B), ("original_language", S), ("belongs_to_collection", S),
    ("snapshot_date", DT), ("data_source", S),
)

GENRES = _struct(("id", I), ("name", S), ("snapshot_date", DT), ("data_source", S))

RAW_TABLES: dict[str, StructType] = {
    "trending": TRENDING,
    "popular": POPULAR,
    "top_rated": TOP_RATED,
    "discover": DISCOVER,
    "movie_details": MOVIE_DETAILS,
    "genres": GENRES,
}

# Columns that hold JSON text in raw (JSONB in the reference warehouse).
JSON_COLUMNS = {
    "genre_ids", "genres", "production_companies", "production_countries",
    "spoken_languages", "belongs_to_collection",
}

# Typed forms after parsing (silver).
GENRE_OBJ = _struct(("id", I), ("name", S))
GENRE_OBJECTS = ArrayType(GENRE_OBJ)
GENRE_IDS = ArrayType(I)

# ---- landing documents (what the API returned, kept as JSON files) ----------------

LANDING_MOVIE = _struct(
    ("id", L), ("title", S), ("original_title", S), ("overview", S), ("poster_path", S),
    ("media_type", S), ("adult", B), ("original_language", S), ("genre_ids", ArrayType(I)),
    ("popularity", D), ("release_date", S), ("video", B), ("vote_average", D),
    ("vote_count", L),
)
LIST_PAGE = _struct(("page", I), ("total_pages", I), ("results", ArrayType(LANDING_MOVIE)))
GENRE_DOC = _struct(("genres", ArrayType(_struct(("id", I), ("name", S)))))
DISCOVER_PAGE = _struct(("release_year", I), ("page", I), ("total_pages", I),
                        ("results", ArrayType(LANDING_MOVIE)))
DETAIL_DOC = _struct(
    ("id", L), ("imdb_id", S), ("title", S), ("original_title", S), ("overview", S),
    ("status", S), ("tagline", S), ("runtime", I), ("budget", L), ("revenue", L),
    ("popularity", D), ("vote_average", D), ("vote_count", L), ("release_date", S),
    # Nested values stay raw JSON text: the JSON reader hands a string column the value's
    # text as it is, so no field of it is cut.
    ("genres", S), ("production_companies", S), ("production_countries", S),
    ("spoken_languages", S),
    ("homepage", S), ("backdrop_path", S), ("poster_path", S), ("adult", B), ("video", B),
    ("original_language", S), ("belongs_to_collection", S),
)
