"""Raw snapshot tables derived from the driver's read-only tables (FIXTURES.md section 4).

A movie is an order, its genres are ``l_suppkey % 19`` of its line items, a genre is a
nation, and there are three daily snapshots.  Every row is computed by Spark from
``orders``, ``lineitem`` and ``nation``; nothing is made up on the driver.  DuckDB
derives the same rows in ``snaplake.checks.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from snaplake import schemas
from snaplake.session import scratch_path

# Fixed values of the derivation (FIXTURES.md section 4).
DAYS = (0, 1, 2)
FIRST_SNAPSHOT = "2024-01-01"
GENRE_MODULUS = 19
UNKNOWN_GENRE = 18               # the one nation key that becomes no genre row
NULL_POPULARITY_EVERY = 1499
EMPTY_DATE_EVERY = 89
NULL_POSTER_EVERY = 5
LIST_EVERY = {"trending": 7, "popular": 10, "top_rated": 15}
DETAILS_EVERY, DISCOVER_EVERY, MANUAL_EVERY = 3, 2, 11
ARRIVES_TWICE_EVERY = 5

#: Rows of a file of the stored movies: small files are dealt evenly over the tasks of a scan, few
#: large ones leave some tasks twice the rows of others.
FILE_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def genre_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted distinct genre ids per order.

    With only 19 possible ids, the set is a 19-bit mask: ``bit_or`` is a fixed-width
    aggregate (hash aggregation with codegen and map-side combine), and the mask turns
    into the sorted list per row afterwards.  The state per order is one long whatever
    the number of line items."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.expr(
        f"shiftleft(CAST(1 AS BIGINT), CAST(l_suppkey % {GENRE_MODULUS} AS INT))").alias("bit"))
    masks = li.groupBy("l_orderkey").agg(F.bit_or("bit").alias("mask"))
    return masks.select("l_orderkey", F.expr(
        f"filter(sequence(0, {GENRE_MODULUS - 1}), i -> ((mask >> i) & 1) = 1)")
        .alias("genre_list"))


def movie_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its genres."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus")
    g = genre_lists(spark, sf_dir)
    return o.join(g, o.o_orderkey == g.l_orderkey, "left").drop("l_orderkey")


def stored_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``movie_base`` written once, for checks that derive several landings from it."""
    path = scratch_path(spark, "movies")
    base = movie_base(spark, sf_dir)
    base.write.option("maxRecordsPerFile", FILE_ROWS) \
        .options(**no_dictionary("o_orderkey", "o_totalprice")).parquet(path)
    return spark.read.schema(base.schema).parquet(path)


def no_dictionary(*columns: str) -> dict[str, str]:
    """Write options for columns of mostly unlike values: a dictionary of them costs half the time
    of a write and saves nothing."""
    return {f"parquet.enable.dictionary#{c}": "false" for c in columns}


def movie_rows(spark: SparkSession, sf_dir: str, days=DAYS,
               base: DataFrame | None = None) -> DataFrame:
    """One row per (order, day) with every field any raw table needs."""
    base = movie_base(spark, sf_dir) if base is None else base
    base = base.withColumn("day", F.explode(F.array(*[F.lit(d) for d in days])))
    k = F.col("o_orderkey")
    return base.select(
        k.alias("id"),
        F.col("day"),
        F.concat(F.lit("Movie "), k.cast("string")).alias("title"),
        F.col("genre_list"),
        F.when(k % NULL_POPULARITY_EVERY == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice") / 1000 + F.col("day")).alias("popularity"),
        (((k * 7) % 101).cast("double") / 10).alias("vote_average"),
        ((k * 13) % 500).alias("vote_count"),
        F.when(k % EMPTY_DATE_EVERY == 0, F.lit(""))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("release_date"),
        F.year("o_orderdate").alias("release_year"),
        F.when(k % NULL_POSTER_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("/p"), k.cast("string"), F.lit(".jpg"))).alias("poster_path"),
        (k % 180).cast("int").alias("runtime"),
        (k * 1000).alias("budget"),
        (k * 1500).alias("revenue"),
        F.col("o_orderpriority").alias("overview"),
        F.col("o_orderstatus").alias("status"),
        F.date_add(F.lit(FIRST_SNAPSHOT).cast("date"), F.col("day")).alias("snapshot_date"),
    )


def genre_objects(genre_list: Column) -> Column:
    """``[{id, name}]`` for a list of genre ids (the detail document shape)."""
    return F.transform(genre_list, lambda g: F.struct(
        g.alias("id"), F.concat(F.lit("NATION_"), g.cast("string")).alias("name")))


def _conform(df: DataFrame, schema) -> DataFrame:
    """Select ``schema``'s columns in order; absent ones become typed NULLs."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def raw_movie_details(rows: DataFrame) -> DataFrame:
    d = rows.where((F.col("id") + F.col("day")) % DETAILS_EVERY == 0)
    d = d.withColumn("original_title", F.col("title")) \
         .withColumn("genres", F.to_json(genre_objects(F.col("genre_list")))) \
         .withColumn("data_source", F.lit("api"))
    return _conform(d, schemas.MOVIE_DETAILS)


def discover_rows(rows: DataFrame) -> DataFrame:
    """Discover rows, plus a ``manual`` copy (+0.5 popularity) of every 11th movie; genres as the
    list ``genre_list``."""
    d = rows.where((F.col("id") + F.col("day")) % DISCOVER_EVERY == 0)
    d = d.withColumn("data_source", F.explode(
        F.when(F.col("id") % MANUAL_EVERY == 0, F.array(F.lit("discover"), F.lit("manual")))
         .otherwise(F.array(F.lit("discover")))))
    return d.withColumn("popularity", F.when(F.col("data_source") == "manual",
                                             F.col("popularity") + 0.5)
                                       .otherwise(F.col("popularity")))


def raw_discover(rows: DataFrame) -> DataFrame:
    d = discover_rows(rows).withColumn("genre_ids", F.to_json("genre_list"))
    return _conform(d, schemas.DISCOVER)


def raw_list(rows: DataFrame, dataset: str) -> DataFrame:
    every = LIST_EVERY[dataset]
    d = rows.where(F.col("id") % every == 0) \
            .withColumn("original_title", F.col("title")) \
            .withColumn("genre_ids", F.to_json("genre_list")) \
            .withColumn("data_source", F.lit("api"))
    return _conform(d, schemas.RAW_TABLES[dataset])


def raw_genres(spark: SparkSession, sf_dir: str, days=DAYS) -> DataFrame:
    n = table(spark, sf_dir, "nation").where(F.col("n_nationkey") != UNKNOWN_GENRE)
    n = n.withColumn("day", F.explode(F.array(*[F.lit(d) for d in days])))
    return n.select(
        F.col("n_nationkey").cast("int").alias("id"), F.col("n_name").alias("name"),
        F.date_add(F.lit(FIRST_SNAPSHOT).cast("date"), F.col("day")).alias("snapshot_date"),
        F.lit("api").alias("data_source"))


def second_discover_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second load batch: day-2 discover rows again with doubled popularity (keys already
    stored, so insert-if-absent must skip them) plus day 3 (new keys).  Every 5th movie
    arrives twice (``arrival`` 1 and 2), the second time with another popularity."""
    d = raw_discover(movie_rows(spark, sf_dir, days=(2, 3)))
    day2 = F.col("snapshot_date") == F.date_add(F.lit(FIRST_SNAPSHOT).cast("date"), 2)
    d = d.withColumn("popularity", F.when(day2, F.col("popularity") * 2)
                                    .otherwise(F.col("popularity")))
    again = F.when(F.col("id") % ARRIVES_TWICE_EVERY == 0, F.array(F.lit(2), F.lit(1))) \
        .otherwise(F.array(F.lit(1)))
    d = d.withColumn("arrival", F.explode(again))
    return d.withColumn("popularity", F.when(F.col("arrival") == 2, F.col("popularity") - 1000)
                                        .otherwise(F.col("popularity")))


def raw_tables(spark: SparkSession, sf_dir: str,
               base: DataFrame | None = None) -> dict[str, DataFrame]:
    """All six raw tables as Spark plans over the driver tables (or over a stored ``base``)."""
    rows = movie_rows(spark, sf_dir, base=base)
    out = {name: raw_list(rows, name) for name in LIST_EVERY}
    out["movie_details"] = raw_movie_details(rows)
    out["discover"] = raw_discover(rows)
    out["genres"] = raw_genres(spark, sf_dir)
    return out


# ---- landing documents written from the derived rows -------------------------------
# Layout: <root>/<dataset>/snapshot_date=D/part-*.json, one JSON document per line.

PAGE_SIZE = 20
#: The order of rows in ``land_again``.
AGAIN_ORDER = "(id * 7919 + copy * 104729) % 10007"
CORRUPT_DETAIL_EVERY = 997
CORRUPT_LENGTH = 25
#: Nested detail values by column: a JSON text in which ``#`` stands for the movie's id, and
#: the movies that have it (every so-manieth).
NESTED_TEXTS = {
    "production_companies": (2, '[{"id":#,"logo_path":"/l#.png","name":"Studio #",'
                                '"origin_country":"US"},{"id":7,"logo_path":null,"name":"B"}]'),
    "production_countries": (3, '[{"iso_3166_1":"FR","name":"France","since":#}]'),
    "spoken_languages": (4, '[{"english_name":"German","iso_639_1":"de","name":"D #"}]'),
    "belongs_to_collection": (6, '{"id":#,"name":"C #","poster_path":"/c#.jpg"}'),
}


def nested_text(column: str) -> Column:
    every, text = NESTED_TEXTS[column]
    return F.when(F.col("id") % every == 0, F.replace(
        F.lit(text), F.lit("#"), F.col("id").cast("string")))
_LANDING_MOVIE_FIELDS = ("id", "title", "original_title", "overview", "poster_path",
                         "media_type", "adult", "original_language", "genre_ids",
                         "popularity", "release_date", "video", "vote_average", "vote_count")


def landing_movies(raw: DataFrame) -> DataFrame:
    """Raw list/discover rows back in API shape: ``genre_ids`` a real array again (or as yet)."""
    d = raw if dict(raw.dtypes)["genre_ids"] != "string" else \
        raw.withColumn("genre_ids", F.from_json("genre_ids", schemas.GENRE_IDS))
    keep = schemas.LANDING_MOVIE.fields + [
        StructField("snapshot_date", DateType()), StructField("release_year", IntegerType())]
    # A column that isn't there would be null in every row, and documents leave nulls out.
    return _conform(d, StructType([f for f in keep if f.name in d.columns]))


def _write_docs(docs: DataFrame, path: str, movies_each: int = 1) -> str:
    """Documents in gzip files, at its fastest level.  Such a file is read by one task, so none has
    more than ``FILE_ROWS`` movies."""
    docs.write.mode("overwrite").partitionBy("snapshot_date").option("compression", "gzip") \
        .option("zlib.compress.level", "BEST_SPEED") \
        .option("maxRecordsPerFile", max(1, FILE_ROWS // movies_each)).text(path)
    return path


def land_copy(path: str, *paths: str) -> None:
    """The documents landed at ``path`` also at ``paths``."""
    spark = SparkSession.getActiveSession()
    for to in paths:
        _write_docs(spark.read.schema("value string, snapshot_date date").text(path), to, PAGE_SIZE)


def land_pages(movies: DataFrame, path: str, page_size: int = PAGE_SIZE) -> str:
    """Movie-list responses: page documents ``{page, total_pages, results}`` per day.

    A movie's page is a hash bucket of its id among ``ceil(n / page_size)`` pages of its
    day, so no window orders a whole day; list readers take every landed page."""
    groups = ["snapshot_date"]
    counts = movies.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("total_pages", F.greatest(
        F.lit(1), F.ceil(F.col("n") / page_size).cast("int")))
    # One row per day: a join that dealt movies by day would leave all of a day to one task.
    m = movies.join(F.broadcast(counts), groups)
    m = m.withColumn("page", (F.pmod(F.xxhash64("id"), F.col("total_pages")) + 1).cast("int"))
    fields = [c for c in _LANDING_MOVIE_FIELDS if c in movies.columns]
    pages = m.groupBy(*groups, "page", "total_pages").agg(
        F.collect_list(F.struct(*fields)).alias("results"))
    docs = pages.select("snapshot_date", F.to_json(F.struct(
        "page", "total_pages", "results")).alias("value"))
    return _write_docs(docs, path, page_size)


def _kept(df: DataFrame) -> DataFrame:
    """``df`` made once, in the scratch folder."""
    path = scratch_path(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Movies of one request that a task ranks, and the most parts that a request is cut into.
RANKED, PARTS = 250_000, 256


def _ranked(movies: DataFrame, groups: list[str]) -> DataFrame:
    """Movies with the number ``n`` of their group and their ``rank`` in it: by popularity, unknown
    ones last, then by id.  Large groups are cut at quantiles of the popularity; a rank is the number
    of rows in the parts before plus the place in the own part, wherever the cuts lie."""
    v = F.col("popularity")
    cuts = movies.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(
        v, [k / PARTS for k in range(1, PARTS)], 8 * PARTS).alias("cuts"))
    every = F.ceil(F.lit(PARTS) * RANKED / F.col("n"))
    cuts = _kept(cuts.select(*groups, "n", F.filter(
        F.coalesce("cuts", F.array().cast("array<double>")), lambda c, i: (i + 1) % every == 0)
        .alias("cuts")))
    # Few rows: a request's cuts, and the counts of its parts.
    parts = movies.join(F.broadcast(cuts), groups).withColumn("part", F.when(
        v.isNull(), F.size("cuts") + 1).otherwise(F.size(F.filter("cuts", lambda c: c > v))))
    counts = parts.groupBy(*groups, "part").agg(F.count(F.lit(1)).alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy(*groups).orderBy("part"))
    before = counts.select(*groups, "part", (upto - F.col("rows")).alias("before"))
    place = F.row_number().over(Window.partitionBy(*groups, "part").orderBy(
        v.desc_nulls_last(), F.col("id").asc()))
    return parts.join(F.broadcast(before), [*groups, "part"]) \
        .withColumn("rank", F.col("before") + place).drop("cuts", "part", "before")


def land_discover_pages(movies: DataFrame, path: str, max_pages: int | None = None,
                        page_size: int = PAGE_SIZE, beyond_last: bool = False) -> str:
    """What the discover endpoint serves per (request date, release year): movies by
    popularity, ``page_size`` per page in that order; with ``max_pages`` no more pages than
    that (the exact top-n, ING-03, then cuts each group before the rank window)."""
    from snaplake.operators.ingest import discover_top
    groups = ["snapshot_date", "release_year"]
    top = discover_top(movies, max_pages, page_size, request_cols=["snapshot_date"])
    paged = _ranked(top, groups) \
        .withColumn("page", ((F.col("rank") - 1) / page_size).cast("int") + 1) \
        .withColumn("total_pages", F.ceil(F.col("n") / page_size).cast("int"))
    fields = [c for c in _LANDING_MOVIE_FIELDS if c in movies.columns]
    pages = paged.groupBy(*groups, "page", "total_pages").agg(
        F.collect_list(F.struct(*fields)).alias("results"))
    if beyond_last:
        extra = pages.where(F.col("page") == 1).select(
            *groups, (F.col("total_pages") + 1).alias("page"), "total_pages",
            F.transform("results", lambda r: r.withField("popularity", F.lit(-1.0)))
             .alias("results"))
        pages = pages.unionByName(extra)
    docs = pages.select("snapshot_date", F.to_json(F.struct(
        "release_year", "page", "total_pages", "results")).alias("value"))
    return _write_docs(docs, path, page_size)


def land_again(movies: DataFrame, path: str, request: str | None = None, files: int = 8,
               page_size: int = PAGE_SIZE, shift: float = 0.0) -> str:
    """Responses in which every movie comes twice, on pages dealt over ``files`` files: copy 1 has
    1000 more popularity and another title.  Rows follow each other by ``AGAIN_ORDER``, within
    their day and ``request`` column (a discover request's year).  ``shift`` is added to all
    popularities."""
    groups = ["snapshot_date", *([request] if request else [])]
    copy = F.explode(F.array(F.lit(0), F.lit(1))).alias("copy")
    m = movies.select("*", copy)
    m = m.withColumn("popularity", F.col("popularity") + F.col("copy") * 1000 + F.lit(shift)) \
         .withColumn("title", F.when(F.col("copy") == 1, F.concat("title", F.lit(" again")))
                     .otherwise(F.col("title")))
    nth = F.row_number().over(Window.partitionBy(*groups).orderBy(
        F.expr(AGAIN_ORDER), "id", "copy"))
    counts = m.groupBy(*groups).agg(F.ceil(F.count(F.lit(1)) / page_size).cast("int")
                                    .alias("total_pages"))
    m = m.withColumn("nth", nth).join(counts, groups) \
         .withColumn("page", F.ceil(F.col("nth") / page_size).cast("int"))
    fields = [c for c in _LANDING_MOVIE_FIELDS if c in movies.columns]
    pages = m.groupBy(*groups, "page", "total_pages").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("nth", F.struct(*fields).alias("movie")))),
        lambda r: r["movie"]).alias("results"))
    body = [*groups[1:], "page", "total_pages", "results"]
    docs = pages.repartition(files, F.xxhash64("page")).select(
        "snapshot_date", F.to_json(F.struct(*body)).alias("value"))
    return _write_docs(docs, path, page_size)


def land_genre_docs(genres: DataFrame, path: str) -> str:
    """One ``{"genres": [...]}`` document per day (a genre list has tens of entries)."""
    docs = genres.groupBy("snapshot_date").agg(
        F.array_sort(F.collect_list(F.struct("id", "name"))).alias("genres"))
    return _write_docs(docs.select("snapshot_date",
                                   F.to_json(F.struct("genres")).alias("value")), path)


def land_detail_docs(details: DataFrame, path: str, corrupt: bool = True) -> str:
    """One detail document per movie and day; every 997th is cut short (a failed fetch).
    Nested values are written as the JSON they are, with fields that no model reads."""
    d = details.withColumns({c: nested_text(c) for c in NESTED_TEXTS})
    nested = ["genres", *NESTED_TEXTS]
    plain = [f.name for f in schemas.DETAIL_DOC.fields
             if f.name in d.columns and f.name not in nested]
    d = d.withColumn("_plain", F.to_json(F.struct(*plain)))
    more = [F.coalesce(F.concat(F.lit(f',"{c}":'), F.col(c)), F.lit("")) for c in nested]
    text = F.concat(F.substr("_plain", F.lit(1), F.length("_plain") - 1), *more, F.lit("}"))
    bad = (F.col("id") % CORRUPT_DETAIL_EVERY == 0) & F.lit(corrupt)
    docs = d.select("snapshot_date", F.when(bad, F.substring(text, 1, CORRUPT_LENGTH))
                    .otherwise(text).alias("value"))
    return _write_docs(docs, path)
