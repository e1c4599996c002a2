"""Checks that write: landing readers, lake and raw sinks, loads, DQ, stream, whole runs.

Each writes the derived rows to a fresh folder under the shared scratch root
(``spark.checkpoint.dir``), runs the library code on it and returns what it reads back,
so its SQL twin is plain SQL over the derived rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from snaplake import fixtures, schemas
from snaplake.checks.catalog import _HIST_SQL, check, gold_model, hist_for_check, layers
from snaplake.checks.oracle import r4 as sql_r4
from snaplake.operators import ingest, load
from snaplake.plans import cards, gold, history, jobs, quality
from snaplake.session import scratch_path
from snaplake.sinks import catalog as ddl
from snaplake.sinks import lake as lake_sink
from snaplake.sources import landing, lake as lake_source
from snaplake.streaming.incremental import (ingest_available, ingest_lake,
                                            ingest_with_state)

DAY = ("2024-01-01", "2024-01-02", "2024-01-03")
_RAW_DISCOVER_COLS = ("id", "title", "genre_ids", "popularity", "vote_average", "vote_count",
                      "release_date", "release_year", "snapshot_date", "data_source")


def _json_arrays(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.to_json(c))
    return df


def _days(df):
    """(date, rows of that day without the date) for each fixture day."""
    for d in DAY:
        yield d, df.where(F.col("snapshot_date") == F.lit(d).cast("date")).drop("snapshot_date")


# ---- SRC: landing readers -----------------------------------------------------------

def _land_list(spark, sf_dir, dataset):
    path = scratch_path(spark, f"landing-{dataset}")
    fixtures.land_pages(fixtures.landing_movies(layers(spark, sf_dir)[dataset]), path)
    return path


@check("src_list_pages", "SELECT * FROM raw_trending")
def q_src_list_pages(spark, sf_dir):
    path = _land_list(spark, sf_dir, "trending")
    return _json_arrays(landing.read_list_pages(spark, path, "trending"), "genre_ids")


@check("src_genre_doc", "SELECT * FROM raw_genres")
def q_src_genre_doc(spark, sf_dir):
    path = scratch_path(spark, "landing-genres")
    fixtures.land_genre_docs(layers(spark, sf_dir)["genres"], path)
    return landing.read_genre_doc(spark, path)


def _land_discover(spark, sf_dir):
    raw = layers(spark, sf_dir)["discover"].where(F.col("data_source") == "discover")
    path = scratch_path(spark, "landing-discover")
    fixtures.land_discover_pages(fixtures.landing_movies(raw), path, beyond_last=True)
    return path


@check("src_discover_pages", """
SELECT id, title, genre_ids, popularity, vote_average, vote_count, release_date, release_year,
       snapshot_date FROM discover_served""")
def q_src_discover_pages(spark, sf_dir):
    """Every landed page is read; a page past ``total_pages`` is landed too and must not be."""
    rows = landing.read_discover_pages(spark, _land_discover(spark, sf_dir))
    return _json_arrays(rows, "genre_ids").select(*_RAW_DISCOVER_COLS[:-1])


@check("src_discover_pages_limit", """
SELECT id, title, genre_ids, popularity, vote_average, vote_count, release_date, release_year,
       snapshot_date FROM discover_served_5""")
def q_src_discover_pages_limit(spark, sf_dir):
    """The same landing for a client with a limit of five pages of 20."""
    rows = landing.read_discover_pages(spark, _land_discover(spark, sf_dir), max_page=5)
    return _json_arrays(rows, "genre_ids").select(*_RAW_DISCOVER_COLS[:-1])


_DETAIL_COLS = ("id", "title", "original_title", "overview", "status", "runtime", "budget",
                "revenue", "popularity", "vote_average", "vote_count", "release_date",
                "poster_path", "snapshot_date")


def _land_details(spark, sf_dir):
    path = scratch_path(spark, "landing-details")
    fixtures.land_detail_docs(layers(spark, sf_dir)["movie_details"], path)
    return path


@check("src_detail_docs", f"""
SELECT {', '.join(_DETAIL_COLS)}, genres FROM raw_movie_details WHERE id % 997 <> 0""")
def q_src_detail_docs(spark, sf_dir):
    good, _ = landing.read_detail_docs(spark, _land_details(spark, sf_dir))
    return good.select(*_DETAIL_COLS, "genres")


@check("src_detail_docs_failed", f"""
SELECT snapshot_date, CAST(NULL AS BIGINT) AS id,
       substr('{{"id":' || id || ',"title":"Movie ' || id || '"', 1, {fixtures.CORRUPT_LENGTH})
           AS document
FROM raw_movie_details WHERE id % 997 = 0""")
def q_src_detail_docs_failed(spark, sf_dir):
    """Every cut-short document is set aside with its text (its id could not be parsed)."""
    _, bad = landing.read_detail_docs(spark, _land_details(spark, sf_dir))
    return bad.select("snapshot_date", "id", "document")


def _lake_details(spark, sf_dir):
    root = scratch_path(spark, "lake")
    for d, rows in _days(layers(spark, sf_dir)["movie_details"]):
        lake_sink.write_snapshot(rows, root, "movie_details", d)
    return root


@check("src_lake_snapshot",
       "SELECT * FROM raw_movie_details WHERE snapshot_date = DATE '2024-01-02'")
def q_src_lake_snapshot(spark, sf_dir):
    root = _lake_details(spark, sf_dir)
    return lake_source.read_snapshot(spark, root, "movie_details", DAY[1])


@check("src_registry", " UNION ALL ".join(
    f"SELECT '{t}' AS source_table, count(*) AS n_rows, count(DISTINCT snapshot_date) AS n_days "
    f"FROM raw_{t}" for t in schemas.RAW_TABLES))
def q_src_registry(spark, sf_dir):
    """SRC-06: six raw tables loaded under one root, registered as named views and
    queried by name with Spark SQL."""
    root = scratch_path(spark, "warehouse")
    derived = layers(spark, sf_dir)
    for name in schemas.RAW_TABLES:
        load.insert_if_absent(derived[name], lake_sink.raw_path(root, name),
                              order=load.by_value(derived[name]))
    lake_source.register_sources(spark, root)
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{t}' AS source_table, count(*) AS n_rows, "
        f"count(DISTINCT snapshot_date) AS n_days FROM raw__{t}" for t in schemas.RAW_TABLES))


# ---- SNK: lake and layer writes -----------------------------------------------------

@check("snk_lake_overwrite", """
SELECT * REPLACE (CASE WHEN snapshot_date = DATE '2024-01-02' THEN popularity + 100
                       ELSE popularity END AS popularity)
FROM raw_movie_details""")
def q_snk_lake_overwrite(spark, sf_dir):
    """A re-run of one day replaces that day only."""
    root = _lake_details(spark, sf_dir)
    rows = dict(_days(layers(spark, sf_dir)["movie_details"]))[DAY[1]]
    lake_sink.write_snapshot(rows.withColumn("popularity", F.col("popularity") + 100),
                             root, "movie_details", DAY[1])
    return spark.read.schema(schemas.MOVIE_DETAILS).parquet(
        lake_sink.dataset_path(root, "movie_details"))


@check("snk_discover_overwrite", f"""
SELECT {', '.join(c for c in _RAW_DISCOVER_COLS if c != 'popularity')},
       CASE WHEN snapshot_date = DATE '2024-01-03' AND release_year >= 2000
            THEN popularity * 10 ELSE popularity END AS popularity
FROM raw_discover""")
def q_snk_discover_overwrite(spark, sf_dir):
    """Backfill layout year=Y/snapshot_date=D: re-running some years of a day replaces
    exactly those (year, day) directories."""
    root = scratch_path(spark, "lake-discover")
    for d, rows in _days(layers(spark, sf_dir)["discover"]):
        lake_sink.write_discover(rows, root, d)
    rows = dict(_days(layers(spark, sf_dir)["discover"]))[DAY[2]]
    again = rows.where(F.col("release_year") >= 2000) \
        .withColumn("popularity", F.col("popularity") * 10)
    lake_sink.write_discover(again, root, DAY[2])
    return spark.read.parquet(lake_sink.discover_path(root)).select(*_RAW_DISCOVER_COLS)


@check("snk_partitions", """
SELECT DISTINCT 'snapshot_date=' || strftime(snapshot_date, '%Y-%m-%d') AS partition_dir,
       snapshot_date FROM raw_movie_details""")
def q_snk_partitions(spark, sf_dir):
    """SNK-08: the load makes one directory per day on demand."""
    path, rows = scratch_path(spark, "raw-details"), layers(spark, sf_dir)["movie_details"]
    load.insert_if_absent(rows, path, order=load.by_value(rows))
    files = spark.read.schema(schemas.MOVIE_DETAILS).parquet(path) \
        .select(F.input_file_name().alias("f")).distinct()
    d = F.regexp_extract("f", r"(snapshot_date=[0-9-]+)", 1)
    return files.select(d.alias("partition_dir")).distinct().select(
        "partition_dir", F.to_date(F.substring("partition_dir", 15, 10)).alias("snapshot_date"))


@check("snk_materialise", """
SELECT movie_id, title, original_title, overview, status, tagline, runtime, budget, revenue,
       popularity, vote_average, vote_count, release_date,
       CAST(to_json(raw_genres) AS VARCHAR) AS raw_genres,
       CAST(to_json(raw_genre_ids) AS VARCHAR) AS raw_genre_ids, poster_path, snapshot_date,
       source FROM core_movies""")
def q_snk_materialise(spark, sf_dir):
    """SNK-04: core written partitioned by day and read back."""
    root = scratch_path(spark, "layers")
    core = lake_sink.materialise(layers(spark, sf_dir)["core_movies"], root, "core",
                                 "core_movies", partition_by=["snapshot_date"])
    return _json_arrays(core, "raw_genres", "raw_genre_ids")


@check("snk_view", "SELECT * FROM stg_genres")
def q_snk_view(spark, sf_dir):
    """SNK-05: a model materialised as a view."""
    return lake_sink.materialise(layers(spark, sf_dir)["stg_genres"], "", "raw",
                                 "stg_genres_view", kind="view")


def _raw_database(spark, sf_dir, tables):
    """A fresh layer with the raw ``tables`` loaded and registered; its name."""
    root = scratch_path(spark, "warehouse")
    db = "raw_" + root.rsplit("-", 1)[-1]
    derived = layers(spark, sf_dir)
    for name in tables:
        load.insert_if_absent(derived[name], lake_sink.raw_path(root, name),
                              order=load.by_value(derived[name]))
    ddl.create_layers(spark, root, layers=(db,))
    ddl.create_raw_tables(spark, root, db=db)
    return db


@check("snk_catalog_views", """
SELECT 'details' AS feed, movie_id, title, popularity, release_date,
       CAST(to_json(raw_genres) AS VARCHAR) AS genres, snapshot_date FROM stg_movie_details
UNION ALL
SELECT 'discover', movie_id, title, popularity, release_date,
       CAST(to_json(raw_genre_ids) AS VARCHAR), snapshot_date FROM stg_discover
UNION ALL
SELECT 'genres', genre_id, genre_name, NULL, NULL, NULL, snapshot_date FROM stg_genres""")
def q_snk_catalog_views(spark, sf_dir):
    """SNK-05: the staging models as catalog views over stored raw tables, read by name from
    another session."""
    db = _raw_database(spark, sf_dir, ("movie_details", "discover", "genres"))
    ddl.staging_views(spark, db)
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    return other.sql(f"""
        SELECT 'details' AS feed, movie_id, title, popularity, release_date,
               to_json(raw_genres) AS genres, snapshot_date FROM {db}.stg_movie_details
        UNION ALL
        SELECT 'discover', movie_id, title, popularity, release_date, to_json(raw_genre_ids),
               snapshot_date FROM {db}.stg_discover
        UNION ALL
        SELECT 'genres', genre_id, genre_name, NULL, NULL, NULL, snapshot_date
        FROM {db}.stg_genres""")


@check("snk_days_in_one_job", """
SELECT * REPLACE (popularity + 100 AS popularity) FROM raw_movie_details
WHERE snapshot_date <> DATE '2024-01-02'""")
def q_snk_days_in_one_job(spark, sf_dir):
    """SNK-01/SNK-04: three days replaced by one write; the second has no rows any more."""
    path = lake_sink.dataset_path(_lake_details(spark, sf_dir), "movie_details")
    rows = layers(spark, sf_dir)["movie_details"]
    rows = rows.withColumn("popularity", F.col("popularity") + 100) \
        .where(F.col("snapshot_date") != F.lit(DAY[1]).cast("date"))
    lake_sink.replace_days(rows, path, DAY)
    return spark.read.schema(schemas.MOVIE_DETAILS).parquet(path)


@check("ddl_raw_tables", " UNION ALL ".join(
    f"SELECT '{t}' AS source_table, id, snapshot_date, data_source FROM raw_{t}"
    for t in schemas.RAW_TABLES))
def q_ddl_raw_tables(spark, sf_dir):
    """SNK-06/07: layers and raw tables created idempotently (twice), all six loaded into
    the catalog tables' locations and read back by name."""
    root = scratch_path(spark, "warehouse")
    suffix = root.rsplit("-", 1)[-1]
    db = ddl.layer_name(f"  raw_{suffix} ", "raw")
    for _ in range(2):
        ddl.create_layers(spark, root, layers=(db,))
        ddl.create_raw_tables(spark, root, db=db)
    derived = layers(spark, sf_dir)
    for name in schemas.RAW_TABLES:
        load.insert_if_absent(derived[name], lake_sink.raw_path(root, name),
                              order=load.by_value(derived[name]))
        spark.catalog.recoverPartitions(f"`{db}`.`{name}`")
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{t}' AS source_table, CAST(id AS BIGINT) AS id, snapshot_date, data_source "
        f"FROM `{db}`.`{t}`" for t in schemas.RAW_TABLES))


@check("card_by_name", """
SELECT release_year AS year, CAST(sum(movie_count) AS BIGINT) AS movies_produced
FROM gold_agg_historical_analysis GROUP BY release_year""")
def q_card_by_name(spark, sf_dir):
    """A card over a stored gold table, read from the catalog by name."""
    root = scratch_path(spark, "warehouse")
    db = "gold_" + root.rsplit("-", 1)[-1]
    stored = lake_sink.materialise(gold_model(spark, sf_dir, "agg_historical_analysis"), root,
                                   "gold", "agg_historical_analysis")
    ddl.create_layers(spark, root, layers=(db,))
    ddl.register(spark, db, "agg_historical_analysis", stored.schema,
                 f"{root}/gold/agg_historical_analysis")
    return cards.movies_by_year(spark.sql(f"SELECT * FROM {db}.agg_historical_analysis"))


#: Card -> (its label, its value, the gold rows that it shows).
_CARD_ROWS = {
    "total_movies": ("NULL", "total_movies_in_db", "gold_daily_total_movies"),
    "highest_rated": ("title", "vote_average", """gold_daily_top_rated_movies
        ORDER BY vote_average DESC NULLS FIRST, vote_count DESC NULLS FIRST, movie_id LIMIT 10"""),
    "trending": ("title", "popularity", """gold_daily_most_popular_movies
        ORDER BY popularity DESC NULLS FIRST, movie_id LIMIT 10"""),
    "genre_distribution": ("genre_name", "movie_count", "gold_historical_genre_distribution"),
    "avg_rating_by_genre": (
        "genre_name", "round(CAST(avg(avg_rating) AS DECIMAL(38,10)), 2)",
        "gold_agg_historical_analysis WHERE avg_rating > 0 GROUP BY genre_name"),
    "movies_by_year": ("CAST(release_year AS VARCHAR)", "sum(movie_count)",
                       "gold_agg_historical_analysis GROUP BY release_year"),
    "genre_share": ("genre_name", """((20000 * movie_count + (SELECT sum(movie_count)
        FROM gold_historical_genre_distribution)) // (2 * (SELECT sum(movie_count)
        FROM gold_historical_genre_distribution))) / 100.0""",
                    "gold_historical_genre_distribution"),
}


@check("cards_by_name", " UNION ALL ".join(
    f"(SELECT '{card}' AS card, {label} AS label, CAST({value} AS DOUBLE) AS value FROM {rows})"
    for card, (label, value, rows) in _CARD_ROWS.items()))
def q_cards_by_name(spark, sf_dir):
    """CARD-01..07 over stored gold tables, all looked up in the catalog."""
    root = scratch_path(spark, "warehouse")
    db = "gold_" + root.rsplit("-", 1)[-1]
    ddl.create_layers(spark, root, layers=(db,))
    for name in dict.fromkeys(table for table, _ in cards.CARDS.values()):
        stored = lake_sink.materialise(gold_model(spark, sf_dir, name), root, "gold", name)
        ddl.register(spark, db, name, stored.schema, f"{root}/gold/{name}")
    out = None
    for card in cards.CARDS:
        rows = cards.by_name(spark, card, db)
        label = {"total_movies": F.lit(None), "movies_by_year": F.col("year")} \
            .get(card, F.col("title" if "title" in rows.columns else rows.columns[0]))
        value = {"highest_rated": "rating", "trending": "popularity"}.get(card, rows.columns[-1])
        part = rows.select(F.lit(card).alias("card"), label.cast("string").alias("label"),
                           F.col(value).cast("double").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


# ---- ING over landed documents ------------------------------------------------------

def _nested_sql(column: str, absent: str) -> str:
    every, text = fixtures.NESTED_TEXTS[column]
    return (f"CASE WHEN id % {every} = 0 THEN replace('{text}', '#', CAST(id AS VARCHAR)) "
            f"ELSE {absent} END AS {column}")


@check("ing_jsonify", f"""
SELECT id, snapshot_date, coalesce(genres, '[]') AS genres,
       {_nested_sql('production_companies', "'[]'")},
       {_nested_sql('production_countries', "'[]'")},
       {_nested_sql('spoken_languages', "'[]'")},
       {_nested_sql('belongs_to_collection', 'NULL')}
FROM raw_movie_details WHERE id % 997 <> 0""")
def q_ing_jsonify(spark, sf_dir):
    """Nested values arrive whole, whatever fields they have."""
    good, _ = landing.read_detail_docs(spark, _land_details(spark, sf_dir))
    return ingest.jsonify(good).select("id", "snapshot_date", *ingest.DETAIL_NESTED,
                                       "belongs_to_collection")


@check("ing_backfill_years", f"""
SELECT {', '.join(_RAW_DISCOVER_COLS)} FROM discover_served
WHERE release_year BETWEEN 2000 AND 2024""")
def q_ing_backfill_years(spark, sf_dir):
    """ING-05: each landed run date backfills all years 2000..2024 in one job."""
    pages = _land_discover(spark, sf_dir)
    lake = scratch_path(spark, "lake-backfill")
    for d in DAY:
        jobs.backfill(spark, f"{pages}/snapshot_date={d}", lake, range(2000, 2025), d)
    out = spark.read.parquet(lake_sink.discover_path(lake))
    return _json_arrays(out, "genre_ids").select(*_RAW_DISCOVER_COLS)


# ---- LOAD ---------------------------------------------------------------------------

@check("load_normalise_nested", "SELECT * FROM raw_popular")
def q_load_normalise_nested(spark, sf_dir):
    rows = landing.read_list_pages(spark, _land_list(spark, sf_dir, "popular"), "popular")
    return load.normalise_nested(rows)


@check("load_default_source", """
SELECT id, snapshot_date, 'api' AS data_source FROM raw_movie_details""")
def q_load_default_source(spark, sf_dir):
    rows = layers(spark, sf_dir)["movie_details"].drop("data_source")
    return load.default_source(rows).select("id", "snapshot_date", "data_source")


@check("load_align_schema", "SELECT * FROM raw_top_rated")
def q_load_align_schema(spark, sf_dir):
    """Unknown column dropped, missing column NULL, text date cast, array -> JSON text."""
    rows = landing.read_list_pages(spark, _land_list(spark, sf_dir, "top_rated"), "top_rated")
    rows = rows.withColumn("unknown_field", F.lit(1)).drop("video") \
               .withColumn("snapshot_date", F.col("snapshot_date").cast("string"))
    return load.align(rows, schemas.TOP_RATED)


@check("load_insert_if_absent", """
SELECT * FROM raw_discover
UNION ALL
SELECT * FROM raw_discover_batch2 WHERE snapshot_date = DATE '2024-01-04'""")
def q_load_insert_if_absent(spark, sf_dir):
    """First batch, then a second one whose day-2 keys exist already (skipped) and whose
    day-3 keys are new (added, the first to arrive where a key comes twice); then the second
    batch once more (adds nothing)."""
    path, rows = scratch_path(spark, "raw-discover"), layers(spark, sf_dir)["discover"]
    load.insert_if_absent(rows, path, order=load.by_value(rows))
    second = fixtures.second_discover_batch(spark, sf_dir)
    load.insert_if_absent(second, path, arrival="arrival")
    load.insert_if_absent(second, path, arrival="arrival")
    return spark.read.schema(schemas.DISCOVER).parquet(path)


@check("load_into_buckets", """
SELECT * FROM raw_discover
UNION ALL
SELECT * FROM raw_discover_batch2 WHERE snapshot_date = DATE '2024-01-04'""")
def q_load_into_buckets(spark, sf_dir):
    """``load_insert_if_absent`` into a catalog table whose days lie in buckets of the id."""
    root = scratch_path(spark, "warehouse")
    db = "buckets_" + root.rsplit("-", 1)[-1]
    ddl.create_layers(spark, root, layers=(db,))
    table = ddl.register(spark, db, "discover", schemas.DISCOVER, f"{root}/discover",
                         ["snapshot_date"], buckets=("id", 8))
    rows = layers(spark, sf_dir)["discover"]
    load.insert_into_buckets(rows, table, DAY, order=load.by_value(rows))
    second = fixtures.second_discover_batch(spark, sf_dir)
    for _ in range(2):
        load.insert_into_buckets(second, table, ("2024-01-03", "2024-01-04"), arrival="arrival")
    return spark.table(table)


@check("load_variant", """
SELECT 'details' AS feed, id, snapshot_date, CAST(g.id AS BIGINT) AS genre_id, g.name AS name
FROM (SELECT id, snapshot_date, unnest(from_json(genres, '[{"id":"BIGINT","name":"VARCHAR"}]')) AS g
      FROM raw_movie_details)
UNION ALL
SELECT 'discover', id, snapshot_date, g, NULL
FROM (SELECT id, snapshot_date, unnest(from_json(genre_ids, '["BIGINT"]')) AS g
      FROM raw_discover WHERE data_source = 'discover')""")
def q_load_variant(spark, sf_dir):
    """CST-05 with JSN-01..04: JSON columns stored as VARIANT, read back and taken apart by
    ``variant_explode`` and ``variant_get``."""
    s, out = layers(spark, sf_dir), None
    for name, column in (("movie_details", "genres"), ("discover", "genre_ids")):
        path = scratch_path(spark, f"variant-{name}")
        rows = load.align(s[name], schemas.RAW_TABLES[name], json_as_variant=True)
        rows = rows.where(F.col("data_source") == ("api" if name == "movie_details" else "discover"))
        load.insert_if_absent(rows.select("id", column, "snapshot_date", "data_source"), path,
                              order=[F.col("id")])
        stored = spark.read.schema(f"id bigint, {column} variant, snapshot_date date, "
                                   "data_source string").parquet(path)
        view = f"stored_{column}"
        stored.createOrReplaceTempView(view)
        genre_id, genre_name = ("variant_get(value, '$.id', 'bigint')",
                                "variant_get(value, '$.name', 'string')") \
            if name == "movie_details" else ("CAST(value AS BIGINT)", "CAST(NULL AS STRING)")
        part = spark.sql(f"""
            SELECT '{"details" if name == "movie_details" else name}' AS feed, id, snapshot_date,
                   {genre_id} AS genre_id, {genre_name} AS name
            FROM {view}, LATERAL variant_explode({column})""")
        out = part if out is None else out.unionByName(part)
    return out


# ---- DQ -----------------------------------------------------------------------------

def _dq_models(spark, sf_dir):
    s = layers(spark, sf_dir)
    return {"fact_movie_popularity": gold.fact_movie_popularity(s["core_movies"]),
            "dim_movies": gold.dim_movies(s["core_movies"])}


@check("dq_not_null", """
SELECT count(*) AS failures FROM gold_fact_movie_popularity WHERE popularity IS NULL""")
def q_dq_not_null(spark, sf_dir):
    return quality.not_null(_dq_models(spark, sf_dir)["fact_movie_popularity"], "popularity")


@check("dq_unique", """
SELECT count(*) AS failures FROM (
  SELECT movie_id FROM gold_fact_movie_popularity WHERE movie_id IS NOT NULL
  GROUP BY movie_id HAVING count(*) > 1)""")
def q_dq_unique(spark, sf_dir):
    return quality.unique(_dq_models(spark, sf_dir)["fact_movie_popularity"], "movie_id")


def _suite_sql(tables: dict[str, str]) -> str:
    """The declared suite in SQL over the given model tables."""
    parts = []
    for m, c, t in quality.SUITE:
        if t == "not_null":
            q = f"SELECT count(*) AS failures FROM {tables[m]} WHERE {c} IS NULL"
        else:
            q = (f"SELECT count(*) AS failures FROM (SELECT {c} FROM {tables[m]} "
                 f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
        parts.append(f"SELECT '{m}' AS model, '{c}' AS column_name, '{t}' AS test, "
                     f"failures FROM ({q})")
    return f"""
SELECT model, column_name, test, CAST(failures AS BIGINT) AS failures,
       CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status
FROM ({" UNION ALL ".join(parts)})"""


@check("dq_suite", _suite_sql({"fact_movie_popularity": "gold_fact_movie_popularity",
                               "dim_movies": "gold_dim_movies"}))
def q_dq_suite(spark, sf_dir):
    return quality.run_suite(_dq_models(spark, sf_dir))


@check("dq_bad_json", """
SELECT 'movie_details' AS source_table, count(*) AS failures FROM raw_movie_details
WHERE genres IS NOT NULL AND NOT json_valid(genres)
UNION ALL
SELECT 'discover', count(*) FROM raw_discover
WHERE genre_ids IS NOT NULL AND NOT json_valid(genre_ids)""")
def q_dq_bad_json(spark, sf_dir):
    s = layers(spark, sf_dir)
    a = quality.bad_json(s["movie_details"], "genres", schemas.GENRE_OBJECTS)
    b = quality.bad_json(s["discover"], "genre_ids", schemas.GENRE_IDS)
    return a.select(F.lit("movie_details").alias("source_table"), "failures").unionByName(
        b.select(F.lit("discover").alias("source_table"), "failures"))


@check("dq_cut_json", """
SELECT 'movie_details' AS source_table, count(*) AS failures FROM raw_movie_details
WHERE genres IS NOT NULL AND id % 13 = 0
UNION ALL
SELECT 'discover', count(*) FROM raw_discover WHERE genre_ids IS NOT NULL AND id % 17 = 0""")
def q_dq_cut_json(spark, sf_dir):
    """Planted: the JSON text of every 13th movie, and of every 17th discover row, lacks its end."""
    s, out = layers(spark, sf_dir), None
    for name, column, every, schema in (
            ("movie_details", "genres", 13, schemas.GENRE_OBJECTS),
            ("discover", "genre_ids", 17, schemas.GENRE_IDS)):
        short = F.substr(column, F.lit(1), F.length(column) - 1)
        rows = s[name].withColumn(column, F.when(F.col("id") % every == 0, short)
                                  .otherwise(F.col(column)))
        part = quality.bad_json(rows, column, schema).select(
            F.lit(name).alias("source_table"), "failures")
        out = part if out is None else out.unionByName(part)
    return out


# ---- whole-history gold kept per day (plans.history) ----------------------------------

def _history(spark, sf_dir, name):
    """Three daily refreshes of the state, one per fixture day, then the model."""
    s = layers(spark, sf_dir)
    root = scratch_path(spark, "history")
    core = lake_sink.materialise(s["core_movies"], root, "core", "core_movies",
                                 partition_by=["snapshot_date"])
    for d in DAY:
        history.refresh(core, root, [d])
    build = {"daily_total_movies": lambda: history.daily_total_movies(spark, root),
             "historical_genre_distribution":
                 lambda: history.historical_genre_distribution(spark, root, s["stg_genres"]),
             "agg_historical_analysis":
                 lambda: history.agg_historical_analysis(spark, root, s["stg_genres"])}
    return build[name]()


@check("history_total_movies", "SELECT * FROM gold_daily_total_movies")
def q_history_total_movies(spark, sf_dir):
    return _history(spark, sf_dir, "daily_total_movies")


@check("history_genre_distribution", "SELECT * FROM gold_historical_genre_distribution")
def q_history_genre_distribution(spark, sf_dir):
    return _history(spark, sf_dir, "historical_genre_distribution")


@check("history_agg_historical_analysis", _HIST_SQL)
def q_history_agg_historical_analysis(spark, sf_dir):
    return hist_for_check(_history(spark, sf_dir, "agg_historical_analysis"))


# ---- ST-01 --------------------------------------------------------------------------

@check("stream_insert_if_absent", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, CAST(ts AS DATE) AS event_date,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), event_type
                            ORDER BY event_id % 2, event_id) AS rn
  FROM events) WHERE rn = 1""")
def q_stream_insert_if_absent(spark, sf_dir):
    """Events land in two deliveries (even ids, then odd ones), each as several files dealt
    by key; the stream is run after each, two files a micro-batch.  The first row per (user,
    day, event type) wins: within a batch by id, across batches by what is stored already."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    src, table = scratch_path(spark, "events-landing"), scratch_path(spark, "events-table")
    ckpt = scratch_path(spark, "events-ckpt")
    for delivery in (0, 1):
        events.where(F.col("event_id") % 2 == delivery) \
            .repartition(4, "user_id", F.to_date("ts"), "event_type") \
            .write.mode("append").parquet(src)
        ingest_available(
            spark, src, events.schema, table, ckpt,
            keys=("user_id", "event_date", "event_type"), partition_col="event_date",
            order=[F.col("event_id").asc()],
            prepare=lambda b: b.withColumn("event_date", F.to_date("ts")),
            max_files_per_trigger=2)
    return spark.read.parquet(table)


def _lake_deliveries(spark, sf_dir, ingest_delivery):
    """The discover lake's files land in three deliveries, the third one all rows again with other
    popularities; ``ingest_delivery(folder, schema)`` runs after each.  Every movie comes twice, the
    later one with 1000 more popularity."""
    movies = fixtures.movie_rows(spark, sf_dir, base=fixtures.stored_base(spark, sf_dir))
    raw = fixtures.discover_rows(movies).where(F.col("data_source") == "discover") \
        .withColumn("genre_ids", F.col("genre_list").cast(schemas.GENRE_IDS)) \
        .select(*schemas.DISCOVER.fieldNames())
    lake = scratch_path(spark, "lake-stream")
    place = F.struct(F.col("release_year").alias("year"), F.lit(0).alias("page"),
                     F.lit("").alias("file"), F.lit(0).cast("long").alias("block"),
                     F.col("copy").alias("pos")).alias(schemas.ARRIVAL)
    twice = raw.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(0)))) \
        .withColumn("popularity", F.col("popularity") + F.col("copy") * 1000)
    rows = twice.select("*", place, F.lit(1).alias("unknown_field")) \
        .withColumn("snapshot_date", F.col("snapshot_date").cast("string")).drop("copy")
    for days, shift in ((DAY[:1], 0), (DAY[1:], 0), (DAY, 5000)):
        rows.where(F.col("snapshot_date").isin(list(days))) \
            .withColumn("popularity", F.col("popularity") + shift) \
            .write.mode("append").option("compression", lake_sink.COMPRESSION) \
            .option("maxRecordsPerFile", 2 * fixtures.FILE_ROWS) \
            .options(**fixtures.no_dictionary("id", "title", "popularity")).parquet(lake)
        ingest_delivery(lake, rows.schema)


@check("stream_lake_files", """
SELECT * FROM raw_discover WHERE data_source = 'discover'""")
def q_stream_lake_files(spark, sf_dir):
    """ST-01 over LOAD-01..05: the discover lake's files stream into the raw table, reconciled to
    its schema, the first row of a key (as the responses came) kept.  The stream stops after each
    delivery and goes on from its checkpoint."""
    table, ckpt = scratch_path(spark, "raw-stream"), scratch_path(spark, "raw-stream-ckpt")
    _lake_deliveries(spark, sf_dir, lambda lake, schema: ingest_lake(
        spark, lake, schema, "discover", table, ckpt))
    return spark.read.schema(schemas.DISCOVER).parquet(table)


@check("stream_with_state", """
SELECT * FROM raw_discover WHERE data_source = 'discover'""")
def q_stream_with_state(spark, sf_dir):
    """The same deliveries through the state store: what was loaded is known without the table."""
    table, ckpt = scratch_path(spark, "raw-state"), scratch_path(spark, "raw-state-ckpt")
    _lake_deliveries(spark, sf_dir, lambda lake, schema: ingest_with_state(
        spark, lake, schema, "discover", table, ckpt))
    return spark.read.schema(schemas.DISCOVER).parquet(table)


# ---- PIPE ---------------------------------------------------------------------------

def _land_day(spark, sf_dir, root):
    s = fixtures.raw_tables(spark, sf_dir, fixtures.stored_base(spark, sf_dir))
    for name in landing.LIST_DATASETS:
        fixtures.land_pages(fixtures.landing_movies(s[name]), f"{root}/{name}")
    fixtures.land_genre_docs(s["genres"], f"{root}/genres")
    fixtures.land_detail_docs(s["movie_details"], f"{root}/movie_details")
    disc = s["discover"].where(F.col("data_source") == "discover")
    fixtures.land_discover_pages(fixtures.landing_movies(disc), f"{root}/discover")


_PIPE_DAILY_SQL = "WITH " + """
pd_details AS (
  SELECT * FROM raw_movie_details
  WHERE id % 997 <> 0 AND (id % 7 = 0 OR id % 10 = 0 OR id % 15 = 0)),
pd_fact AS (SELECT id AS movie_id, snapshot_date, popularity FROM pd_details
            WHERE snapshot_date = (SELECT max(snapshot_date) FROM pd_details)),
pd_dim AS (SELECT id AS movie_id, title FROM pd_details
           WHERE snapshot_date = (SELECT max(snapshot_date) FROM pd_details))
""" + _suite_sql({"fact_movie_popularity": "pd_fact", "dim_movies": "pd_dim"}) + "".join(f"""
UNION ALL SELECT 'raw_{table}', '{column}', '{test}', CAST(0 AS BIGINT), 'pass'"""
                        for table, column, test in quality.RAW_SUITE)


@check("pipe_daily", _PIPE_DAILY_SQL)
def q_pipe_daily(spark, sf_dir):
    """PIPE-01 for every landed day in turn, then the DQ results of the last run.
    Details are loaded only for ids on one of the three lists, minus the documents
    that failed to parse; no discover rows are loaded by a daily run.  The planted NULL
    popularities fail a test, so the runs are told to go on."""
    landing_root, root = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    _land_day(spark, sf_dir, landing_root)
    out = None
    for d in DAY:
        out = jobs.run_daily(spark, landing_root, root, d, require_pass=False)
    return out["dq_results"]


def _first_sql(table: str, partition: str, where: str) -> str:
    copies = f"""(SELECT r.*, copy FROM raw_{table} r CROSS JOIN (VALUES (0), (1)) c(copy)
        WHERE snapshot_date = DATE '{DAY[1]}' AND {where})"""
    return f"""
SELECT '{table}' AS source_table, id,
       CASE WHEN copy = 1 THEN title || ' again' ELSE title END AS title,
       popularity + copy * 1000 AS popularity, snapshot_date, data_source
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY nth) AS first FROM (
        SELECT *, row_number() OVER (PARTITION BY {partition}
                                     ORDER BY {fixtures.AGAIN_ORDER}, id, copy) AS nth
        FROM {copies})) WHERE first = 1"""


@check("pipe_first_wins", " UNION ALL ".join(
    [_first_sql(t, "snapshot_date", "true") for t in landing.LIST_DATASETS]
    + [_first_sql("discover", "release_year", "data_source = 'discover' "
                                              "AND release_year BETWEEN 2000 AND 2024")]))
def q_pipe_first_wins(spark, sf_dir):
    """LOAD-05/SNK-03 in whole runs: every movie comes on two places of the responses, whose pages
    lie in any order over files; the row that the client meets first is stored.  The same day run
    again with other responses adds nothing."""
    s = fixtures.raw_tables(spark, sf_dir, fixtures.stored_base(spark, sf_dir))
    root = scratch_path(spark, "warehouse")
    day = F.col("snapshot_date") == F.lit(DAY[1]).cast("date")
    for shift in (0.0, 7777.0):
        landed = scratch_path(spark, "landing")
        for name in landing.LIST_DATASETS:
            fixtures.land_again(fixtures.landing_movies(s[name].where(day)), f"{landed}/{name}",
                                shift=shift)
        fixtures.land_genre_docs(s["genres"], f"{landed}/genres")
        fixtures.land_detail_docs(s["movie_details"].where(day), f"{landed}/movie_details")
        disc = s["discover"].where(day & (F.col("data_source") == "discover"))
        fixtures.land_again(fixtures.landing_movies(disc), f"{landed}/discover", "release_year",
                            shift=shift)
        jobs.extract_and_load(spark, landed, root, DAY[1])
        jobs.backfill_and_load(spark, landed, root, range(2000, 2025), DAY[1])
    out = None
    for name in (*landing.LIST_DATASETS, "discover"):
        rows = spark.read.schema(schemas.RAW_TABLES[name]).parquet(lake_sink.raw_path(root, name)) \
            .select(F.lit(name).alias("source_table"), "id", "title", "popularity",
                    "snapshot_date", "data_source")
        out = rows if out is None else out.unionByName(rows)
    return out


@check("pipe_backfill", """
SELECT id AS movie_id, snapshot_date, popularity, vote_average, vote_count
FROM discover_served
WHERE snapshot_date = DATE '2024-01-03' AND release_year BETWEEN 2000 AND 2024""")
def q_pipe_backfill(spark, sf_dir):
    """PIPE-02: backfill of years 2000..2024 on the last day, then models and tests.
    No genre list is loaded by a backfill, so genre models stay empty (as in the
    reference); the popularity fact holds every backfilled movie."""
    landing_root, root = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    _land_day(spark, sf_dir, landing_root)
    out = jobs.run_backfill(spark, landing_root, root, range(2000, 2025), DAY[2],
                            require_pass=False)
    return out["fact_movie_popularity"]


# Days loaded again: DAY[1] by a backfill; DAY[2] by a backfill and two daily runs, whose
# details cover every discover movie of the day, with other genres and a later year.

_RERUN = f"""
rr_rows AS (
  SELECT id, snapshot_date, popularity, vote_average, 'api' AS source,
         list_transform(genre_list, lambda g: (g + 1) % 19) AS genre_ids,
         CASE WHEN release_date <> '' THEN CAST(release_date AS DATE) + INTERVAL 1 YEAR END
             AS release_date
  FROM fx_rows WHERE (id + day) % 2 = 0 AND day = 2
  UNION ALL
  SELECT id, snapshot_date, popularity, vote_average, 'discover', genre_list,
         TRY_CAST(release_date AS DATE)
  FROM fx_rows WHERE (id + day) % 2 = 0 AND day = 1 AND release_year BETWEEN 2000 AND 2024),
rr_pairs AS (
  SELECT r.*, g.name AS genre_name
  FROM (SELECT *, unnest(genre_ids) AS genre_id FROM rr_rows) r
  JOIN raw_genres g ON g.id = r.genre_id AND g.snapshot_date = DATE '{DAY[2]}'),
rr_years AS (
  SELECT CAST(year(release_date) AS INTEGER) AS release_year, genre_name,
         count(DISTINCT id) AS movie_count, avg(popularity) AS avg_popularity,
         coalesce(avg(vote_average), 0) AS avg_rating
  FROM rr_pairs WHERE release_date >= DATE '2000-01-01' GROUP BY ALL)"""


def _land_rerun(spark, sf_dir):
    landing_root = scratch_path(spark, "landing")
    rows = fixtures.movie_rows(spark, sf_dir, (1, 2), fixtures.stored_base(spark, sf_dir))
    rows = rows.where((F.col("id") + F.col("day")) % fixtures.DISCOVER_EVERY == 0)
    disc = fixtures.discover_rows(rows).where(F.col("data_source") == "discover") \
        .withColumn("genre_ids", F.col("genre_list").cast(schemas.GENRE_IDS)) \
        .select(*schemas.DISCOVER.fieldNames())
    fixtures.land_discover_pages(fixtures.landing_movies(disc), f"{landing_root}/discover")
    last = rows.where(F.col("day") == 2)
    year_on = F.when(F.col("release_date") != "", F.date_format(
        F.add_months(F.to_date("release_date"), 12), "yyyy-MM-dd"))
    other = last.withColumn("release_date", year_on).withColumn("genre_list", F.transform(
        "genre_list", lambda g: ((g + 1) % fixtures.GENRE_MODULUS).cast("int")))
    details = other.withColumn("genres", F.to_json(fixtures.genre_objects(F.col("genre_list")))) \
        .withColumn("data_source", F.lit("api"))
    details = details.select([(F.col(f.name) if f.name in details.columns else F.lit(None))
                              .cast(f.dataType).alias(f.name)
                              for f in schemas.MOVIE_DETAILS.fields])
    fixtures.land_detail_docs(details, f"{landing_root}/movie_details", corrupt=False)
    # The three lists have the same movies.
    one, *others = [f"{landing_root}/{name}" for name in landing.LIST_DATASETS]
    fixtures.land_pages(fixtures.landing_movies(disc.where(
        F.col("snapshot_date") == F.lit(DAY[2]).cast("date"))), one)
    fixtures.land_copy(one, *others)
    fixtures.land_genre_docs(fixtures.raw_genres(spark, sf_dir), f"{landing_root}/genres")
    return landing_root


def _rerun(spark, landing_root, runs):
    """The models after ``runs`` (of 'backfill' and 'daily') on one day."""
    root = scratch_path(spark, "warehouse")
    years, out = range(2000, 2025), None
    jobs.run_backfill(spark, landing_root, root, years, DAY[1], require_pass=False)
    for kind in runs:
        out = jobs.run_daily(spark, landing_root, root, DAY[2], require_pass=False) \
            if kind == "daily" else jobs.run_backfill(spark, landing_root, root, years, DAY[2],
                                                      require_pass=False)
    return out


@check("pipe_rerun_core", f"""
WITH {_RERUN.strip()}
SELECT o.run_order, id AS movie_id, snapshot_date, source, CAST(release_date AS DATE)
       AS release_date, CAST(to_json(genre_ids) AS VARCHAR) AS raw_genre_ids
FROM rr_rows CROSS JOIN (VALUES ('backfill first'), ('daily first')) o(run_order)""")
def q_pipe_rerun_core(spark, sf_dir):
    """Core holds each movie of the day once, whichever run came first."""
    both, landed = None, _land_rerun(spark, sf_dir)
    for order, runs in (("backfill first", ("backfill", "daily", "daily")),
                        ("daily first", ("daily", "backfill", "daily"))):
        core = _rerun(spark, landed, runs)["core_movies"].select(
            F.lit(order).alias("run_order"), "movie_id", "snapshot_date", "source",
            "release_date", F.to_json("raw_genre_ids").alias("raw_genre_ids"))
        both = core if both is None else both.unionByName(core)
    return both


@check("pipe_rerun_genre_distribution", f"""
WITH {_RERUN.strip()}
SELECT genre_name, count(DISTINCT id) AS movie_count FROM rr_pairs GROUP BY genre_name""")
def q_pipe_rerun_genre_distribution(spark, sf_dir):
    return _rerun(spark, _land_rerun(spark, sf_dir),
                  ("backfill", "daily", "daily"))["historical_genre_distribution"]


@check("pipe_rerun_historical", f"""
WITH {_RERUN.strip()}
SELECT release_year, genre_name, movie_count, {sql_r4('avg_popularity')} AS avg_popularity,
       {sql_r4('avg_rating')} AS avg_rating,
       CAST(sum(movie_count) OVER (PARTITION BY release_year) AS BIGINT) AS total_movies_per_year
FROM rr_years""")
def q_pipe_rerun_historical(spark, sf_dir):
    out = _rerun(spark, _land_rerun(spark, sf_dir),
                 ("daily", "backfill", "daily"))["agg_historical_analysis"]
    return hist_for_check(out).drop("genre_market_share")

