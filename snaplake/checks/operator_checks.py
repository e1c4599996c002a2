"""Single-operator checks: each is the smallest
query that exercises one operator over the whole derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from snaplake import fixtures
from snaplake.checks.catalog import check, layers, r4
from snaplake.checks.oracle import r4 as sql_r4
from snaplake.functions import scalar as fn
from snaplake.operators import ingest
from snaplake.operators.dedupe import first_per_key
from snaplake.plans import gold


@check("flt_date_from", """
SELECT movie_id, snapshot_date, release_date FROM core_movies
WHERE release_date >= DATE '2000-01-01'""")
def q_flt_date_from(spark, sf_dir):
    core = layers(spark, sf_dir)["core_movies"]
    return core.where(fn.date_from("release_date", "2000-01-01")) \
        .select("movie_id", "snapshot_date", "release_date")


@check("flt_latest_snapshot", """
SELECT movie_id, snapshot_date, source FROM core_movies
WHERE snapshot_date = (SELECT max(snapshot_date) FROM core_movies)""")
def q_flt_latest_snapshot(spark, sf_dir):
    return gold.latest(layers(spark, sf_dir)["core_movies"]) \
        .select("movie_id", "snapshot_date", "source")


@check("agg_latest_dates", """
SELECT max(snapshot_date) AS latest_snapshot,
       max(snapshot_date) FILTER (WHERE source = 'api') AS latest_api_snapshot
FROM core_movies""")
def q_agg_latest_dates(spark, sf_dir):
    """AGG-05: global MAX(date), plain and filtered, in one pass."""
    core = layers(spark, sf_dir)["core_movies"]
    return core.agg(F.max("snapshot_date").alias("latest_snapshot"),
                    F.max(F.when(F.col("source") == "api", F.col("snapshot_date")))
                     .alias("latest_api_snapshot"))


@check("fn_poster_url", """
SELECT movie_id, snapshot_date,
       CASE WHEN poster_path IS NOT NULL THEN 'https://image.tmdb.org/t/p/w200' || poster_path
       END AS poster_url
FROM stg_movie_details""")
def q_fn_poster_url(spark, sf_dir):
    d = layers(spark, sf_dir)["stg_movie_details"]
    return d.select("movie_id", "snapshot_date", fn.poster_url().alias("poster_url"))


@check("fn_partition_name", """
SELECT DISTINCT 'movie_details_' || strftime(snapshot_date, '%Y_%m_%d') AS partition_name,
       snapshot_date AS range_from, CAST(snapshot_date + INTERVAL 1 DAY AS DATE) AS range_to
FROM raw_movie_details""")
def q_fn_partition_name(spark, sf_dir):
    raw = layers(spark, sf_dir)["movie_details"]
    return raw.select("snapshot_date").distinct().select(
        fn.partition_name("movie_details").alias("partition_name"),
        F.col("snapshot_date").alias("range_from"), fn.next_day().alias("range_to"))


@check("fn_text_to_date", """
SELECT id, snapshot_date, data_source, release_date AS release_text,
       TRY_CAST(release_date AS DATE) AS release_date
FROM raw_discover""")
def q_fn_text_to_date(spark, sf_dir):
    raw = layers(spark, sf_dir)["discover"]
    return raw.select("id", "snapshot_date", "data_source",
                      F.col("release_date").alias("release_text"),
                      fn.text_to_date("release_date").alias("release_date"))


@check("fn_year_month", """
SELECT movie_id, snapshot_date, CAST(year(release_date) AS INTEGER) AS release_year,
       CAST(month(release_date) AS INTEGER) AS release_month
FROM core_movies""")
def q_fn_year_month(spark, sf_dir):
    core = layers(spark, sf_dir)["core_movies"]
    return core.select("movie_id", "snapshot_date",
                       F.year("release_date").alias("release_year"),
                       F.month("release_date").alias("release_month"))


@check("json_explode_ids", """
SELECT r.id, r.snapshot_date, r.data_source, u.genre_id
FROM raw_discover r, unnest(from_json(r.genre_ids, '["INTEGER"]')) AS u(genre_id)""")
def q_json_explode_ids(spark, sf_dir):
    raw = layers(spark, sf_dir)["discover"]
    return raw.select("id", "snapshot_date", "data_source",
                      F.explode(fn.parse_genre_ids("genre_ids")).alias("genre_id"))


@check("json_explode_objects", """
SELECT r.id, r.snapshot_date, u.g.id AS genre_id, u.g.name AS genre_name
FROM raw_movie_details r,
     unnest(from_json(r.genres, '[{"id":"INTEGER","name":"VARCHAR"}]')) AS u(g)""")
def q_json_explode_objects(spark, sf_dir):
    raw = layers(spark, sf_dir)["movie_details"]
    return raw.select("id", "snapshot_date",
                      F.explode(fn.parse_genre_objects("genres")).alias("g")) \
        .select("id", "snapshot_date", F.col("g.id").alias("genre_id"),
                F.col("g.name").alias("genre_name"))


@check("json_field_array", """
SELECT movie_id, snapshot_date,
       CAST(to_json(CASE WHEN len(raw_genres) > 0
                         THEN list_transform(raw_genres, lambda g: g.id) END) AS VARCHAR)
           AS genre_ids
FROM stg_movie_details""")
def q_json_field_array(spark, sf_dir):
    d = layers(spark, sf_dir)["stg_movie_details"]
    return d.select("movie_id", "snapshot_date",
                    F.to_json(fn.genre_ids_of("raw_genres")).alias("genre_ids"))


@check("join_genre_by_snapshot", """
SELECT d.movie_id, d.snapshot_date, u.gid AS genre_id, g.genre_name
FROM stg_discover d, unnest(d.raw_genre_ids) AS u(gid)
JOIN stg_genres g ON u.gid = g.genre_id AND d.snapshot_date = g.snapshot_date""")
def q_join_genre_by_snapshot(spark, sf_dir):
    s = layers(spark, sf_dir)
    names = s["stg_genres"]
    return s["stg_discover"].select("movie_id", "snapshot_date",
                                    F.explode("raw_genre_ids").alias("genre_id")) \
        .join(names, ["genre_id", "snapshot_date"]) \
        .select("movie_id", "snapshot_date", "genre_id", "genre_name")


_FLAT_NAMES = """
SELECT c.movie_id, c.snapshot_date,
       string_agg(c.raw_genres[u.pos].name, ', ' ORDER BY u.pos) AS genres
FROM core_movies c, unnest(range(1, len(c.raw_genres) + 1)) AS u(pos)
WHERE c.raw_genres IS NOT NULL
GROUP BY c.movie_id, c.snapshot_date"""


def _grouped_names(core):
    """The reference's literal form: explode, then a grouped ordered string_agg."""
    flat = core.select("movie_id", "snapshot_date",
                       F.posexplode("raw_genres").alias("pos", "g"))
    return flat.groupBy("movie_id", "snapshot_date").agg(
        F.expr("listagg(g.name, ', ') WITHIN GROUP (ORDER BY pos)").alias("genres"))


@check("agg_string_agg", f"SELECT * FROM ({_FLAT_NAMES}) WHERE genres IS NOT NULL")
def q_agg_string_agg(spark, sf_dir):
    """AGG-06 grouped form (listagg ... WITHIN GROUP keeps array order, skips NULL)."""
    return _grouped_names(layers(spark, sf_dir)["core_movies"]).where("genres IS NOT NULL")


@check("join_left_two_key", f"""
SELECT m.movie_id, m.snapshot_date, m.title, g.genres
FROM core_movies m LEFT JOIN ({_FLAT_NAMES}) g
  ON m.movie_id = g.movie_id AND m.snapshot_date = g.snapshot_date""")
def q_join_left_two_key(spark, sf_dir):
    """JN-02: left join on (movie_id, snapshot_date); both sides are partitioned on those
    keys already, so the join adds no shuffle of its own."""
    core = layers(spark, sf_dir)["core_movies"]
    return core.select("movie_id", "snapshot_date", "title") \
        .join(_grouped_names(core), ["movie_id", "snapshot_date"], "left")


@check("join_left_to_inner", """
SELECT p.movie_id, p.genre_id, g.genre_name
FROM core_genre_pairs p LEFT JOIN stg_genres g ON p.genre_id = g.genre_id
WHERE g.snapshot_date = (SELECT max(snapshot_date) FROM stg_genres)""")
def q_join_left_to_inner(spark, sf_dir):
    """JN-03: a left join filtered on its right side is an inner join."""
    s = layers(spark, sf_dir)
    g = gold.latest(s["stg_genres"]).select("genre_id", "genre_name")
    ids = s["core_movies"].select("movie_id", F.explode("raw_genre_ids").alias("genre_id"))
    return ids.join(g, "genre_id").select("movie_id", "genre_id",
                                                              "genre_name")


@check("agg_mixed_distinct", f"""
SELECT release_year, genre_name, {sql_r4('avg_popularity')} AS avg_popularity,
       {sql_r4('avg_rating')} AS avg_rating, movie_count FROM hist_yearly""")
def q_agg_mixed_distinct(spark, sf_dir):
    """AGG-04: AVG, AVG and COUNT(DISTINCT) in one grouped aggregate."""
    s = layers(spark, sf_dir)
    hist = s["core_movies"].where(fn.date_from("release_date", "2000-01-01")).select(
        "movie_id", F.year("release_date").alias("release_year"), "popularity",
        "vote_average", F.explode("raw_genre_ids").alias("genre_id"))
    g = gold.latest_genres(s["stg_genres"])
    out = hist.join(g, "genre_id").groupBy("release_year", "genre_name").agg(
        F.avg("popularity").alias("avg_popularity"), F.avg("vote_average").alias("avg_rating"),
        F.count_distinct("movie_id").alias("movie_count"))
    return out.withColumn("avg_popularity", r4("avg_popularity")) \
              .withColumn("avg_rating", r4("avg_rating"))


@check("win_dedupe", """
SELECT id, snapshot_date, data_source, popularity FROM (
  SELECT *, row_number() OVER (PARTITION BY id, snapshot_date ORDER BY data_source) AS rn
  FROM raw_discover) WHERE rn = 1""")
def q_win_dedupe(spark, sf_dir):
    raw = layers(spark, sf_dir)["discover"]
    return first_per_key(raw, ["id", "snapshot_date"], [F.col("data_source").asc()]) \
        .select("id", "snapshot_date", "data_source", "popularity")


@check("win_priority_dedupe", """
SELECT movie_id, snapshot_date, source, popularity FROM core_movies""")
def q_win_priority_dedupe(spark, sf_dir):
    core = layers(spark, sf_dir)["core_movies"]
    return core.select("movie_id", "snapshot_date", "source", "popularity")


@check("set_union_all_genres", """
SELECT u.g.name AS genre_name, c.snapshot_date, c.popularity
FROM core_movies c, unnest(c.raw_genres) AS u(g) WHERE c.source = 'api'
UNION ALL
SELECT g.genre_name, d.snapshot_date, d.popularity
FROM stg_discover d, unnest(d.raw_genre_ids) AS u(gid)
JOIN stg_genres g ON u.gid = g.genre_id AND d.snapshot_date = g.snapshot_date""")
def q_set_union_all_genres(spark, sf_dir):
    s = layers(spark, sf_dir)
    api = s["core_movies"].where(F.col("source") == "api").select(
        F.explode("raw_genres").alias("g"), "snapshot_date", "popularity") \
        .select(F.col("g.name").alias("genre_name"), "snapshot_date", "popularity")
    names = s["stg_genres"]
    disc = s["stg_discover"].select("snapshot_date", "popularity",
                                    F.explode("raw_genre_ids").alias("genre_id")) \
        .join(names, ["genre_id", "snapshot_date"]) \
        .select("genre_name", "snapshot_date", "popularity")
    return api.unionByName(disc)


# ---- ingest transforms over the derived raw tables ----------------------------------

@check("ing_candidate_ids", """
SELECT snapshot_date, id FROM raw_trending
UNION SELECT snapshot_date, id FROM raw_popular
UNION SELECT snapshot_date, id FROM raw_top_rated""")
def q_ing_candidate_ids(spark, sf_dir):
    s = layers(spark, sf_dir)
    return ingest.candidate_ids(s["trending"], s["popular"], s["top_rated"],
                                keys=("snapshot_date", "id"))


@check("ing_details_for", """
SELECT d.id, d.snapshot_date, d.title, d.popularity FROM raw_movie_details d
WHERE (d.id, d.snapshot_date) IN (
  SELECT (id, snapshot_date) FROM raw_trending UNION SELECT (id, snapshot_date) FROM raw_popular
  UNION SELECT (id, snapshot_date) FROM raw_top_rated)""")
def q_ing_details_for(spark, sf_dir):
    s = layers(spark, sf_dir)
    keys = ("id", "snapshot_date")
    ids = ingest.candidate_ids(s["trending"], s["popular"], s["top_rated"], keys=keys)
    return ingest.details_for(ids, s["movie_details"], keys=keys) \
        .select("id", "snapshot_date", "title", "popularity")


@check("ing_discover_top", """
SELECT id, release_year, snapshot_date, popularity FROM (
  SELECT *, row_number() OVER (PARTITION BY release_year, snapshot_date
                               ORDER BY popularity DESC NULLS LAST, id) AS rn
  FROM raw_discover WHERE data_source = 'discover') WHERE rn <= 100""")
def q_ing_discover_top(spark, sf_dir):
    """ING-03 for a client with a limit of 5 pages of 20 per (year, request date)."""
    raw = layers(spark, sf_dir)["discover"].where(F.col("data_source") == "discover")
    return ingest.discover_top(raw, max_pages=5, request_cols=["snapshot_date"]) \
        .select("id", "release_year", "snapshot_date", "popularity")


@check("win_priority_by_case", """
SELECT movie_id, snapshot_date, source FROM core_movies""")
def q_win_priority_by_case(spark, sf_dir):
    """WIN-02/CAS-03: the first row per (movie, snapshot) by a CASE over the source."""
    s = layers(spark, sf_dir)
    keys = ["movie_id", "snapshot_date"]
    both = s["stg_movie_details"].select(*keys, F.lit("api").alias("source")).unionByName(
        s["stg_discover"].select(*keys, F.lit("discover").alias("source")))
    return first_per_key(both, keys, [fn.source_priority("source")])


@check("ing_shape_discover", """
SELECT id, title, genre_ids, popularity, vote_average, vote_count, release_date,
       release_year, data_source
FROM raw_discover WHERE data_source = 'discover'""")
def q_ing_shape_discover(spark, sf_dir):
    raw = layers(spark, sf_dir)["discover"].where(F.col("data_source") == "discover")
    movies = fixtures.landing_movies(raw).withColumnRenamed("release_year", "request_year")
    shaped = ingest.shape_discover(movies, year_col="request_year")
    return shaped.withColumn("genre_ids", F.to_json("genre_ids"))
