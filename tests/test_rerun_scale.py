"""A run's work is dealt over tasks however many movies a day has, and wide rows stay in place."""

import glob

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from snaplake import fixtures, schemas
from snaplake.operators import ingest, load
from snaplake.plans import history, jobs, quality, silver
from snaplake.session import scratch_path
from snaplake.sinks import lake as lake_sink
from tests.test_plans import plan, tree

D1 = "2024-01-01"


@pytest.fixture
def large(spark):
    """Plans as for large tables: no join is small enough to be broadcast by its size."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _files(path):
    return glob.glob(f"{path.split(':')[-1]}/**/part-*", recursive=True)


def _movies(spark, n):
    # Not a literal, which would fold the joins by day.
    day = F.date_add(F.lit(D1).cast("date"), (F.col("id") % 1).cast("int"))
    return spark.range(n).select("id", day.alias("snapshot_date"))


def test_pages_of_one_day_are_dealt_over_tasks(large):
    path = scratch_path(large, "pages")
    fixtures.land_pages(_movies(large, 2000), path)
    assert len(_files(path)) == 4  # the test session's shuffle partitions
    docs = large.read.schema(schemas.LIST_PAGE).json(path)
    assert sorted(r.id for r in docs.select(F.explode("results.id").alias("id")).collect()) \
        == list(range(2000))


def test_landed_files_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "FILE_ROWS", 100)
    path, copy = scratch_path(spark, "bounded"), scratch_path(spark, "bounded-copy")
    fixtures.land_pages(_movies(spark, 2000), path)
    fixtures.land_copy(path, copy)
    for p in (path, copy):
        assert spark.read.text(p).groupBy(F.input_file_name()).count().agg(F.max("count")) \
            .first()[0] <= 5


def test_documents_stay_where_they_are(large):
    docs = large.range(1000).withColumn("text", F.lit("a"))
    got = ingest.details_for(large.range(0, 1000, 3), docs)
    assert got.count() == 334
    assert "BroadcastHashJoin" in plan(got) and "SortMergeJoin" not in plan(got)


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_candidate_ids_are_told_apart_by_64(spark, kind):
    values = [0, 1, -1, 63, 64, 65, -64, -65, 2 ** 31 - 1, -2 ** 31, None, None, 5, 5]
    values += [] if kind == "int" else [2 ** 62, 2 ** 63 - 1, -2 ** 63]
    ids = spark.createDataFrame([(v,) for v in values], f"id {kind}")
    got = ingest.candidate_ids(ids, ids.limit(3))
    assert got.dtypes == [("id", kind)] and "bit_or" in plan(got)
    assert sorted(map(str, (r.id for r in got.collect()))) == sorted(map(str, set(values)))
    assert ingest.candidate_ids(ids.limit(0)).count() == 0


def test_landed_lists_are_read_once(spark, monkeypatch):
    """The candidate ids come from the lists' stored snapshots."""
    landed, root, seen = scratch_path(spark, "once-landing"), scratch_path(spark, "once"), []
    for name in ("trending", "popular", "top_rated"):
        fixtures.land_pages(_movies(spark, 9), f"{landed}/{name}")
    details = spark.range(12).select(*[
        (F.col("id") if f.name == "id" else F.lit(D1) if f.name == "snapshot_date"
         else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.MOVIE_DETAILS.fields])
    fixtures.land_detail_docs(details, f"{landed}/movie_details", corrupt=False)
    genres = spark.sql(f"SELECT 1 AS id, 'a' AS name, DATE '{D1}' AS snapshot_date")
    fixtures.land_genre_docs(genres, f"{landed}/genres")
    real = ingest.candidate_ids

    def spy(*lists, **options):
        seen.extend(f for df in lists for f in df.inputFiles())
        return real(*lists, **options)

    monkeypatch.setattr(ingest, "candidate_ids", spy)
    jobs.extract_and_load(spark, landed, root, D1)
    assert seen and all(f.endswith(".parquet") for f in seen)
    raw = spark.read.parquet(f"{root}/raw/movie_details")
    assert sorted(r.id for r in raw.select("id").collect()) == list(range(9))


def test_requests_are_ranked_in_parts(spark, monkeypatch):
    """Ties, unknown popularities and requests without a year, against one window a request."""
    monkeypatch.setattr(fixtures, "RANKED", 40)
    monkeypatch.setattr(fixtures, "PARTS", 16)
    groups = ["snapshot_date", "release_year"]
    movies = _movies(spark, 3000).select(
        "*", F.when(F.col("id") % 7 > 0, (F.col("id") % 4).cast("int")).alias("release_year"),
        F.when((F.col("id") % 37 > 0) & (F.col("id") % 4 != 3),
               (F.xxhash64("id") % 50).cast("double")).alias("popularity"))
    whole = Window.partitionBy(*groups)
    plain = movies.where("release_year IS NOT NULL").withColumn("rank", F.row_number().over(
        whole.orderBy(F.col("popularity").desc_nulls_last(), "id"))) \
        .withColumn("n", F.count(F.lit(1)).over(whole))
    columns = ["id", "release_year", "n", "rank"]
    got = fixtures._ranked(movies, groups)
    assert "part" in plan(got) and "part" not in got.columns
    assert sorted(map(tuple, got.select(columns).collect())) \
        == sorted(map(tuple, plain.select(columns).collect()))


@pytest.mark.parametrize("kind", ["int", "bigint", "string"])
def test_only_keys_that_are_not_stored(spark, kind):
    have = [-65, -64, -1, 0, 1, 63, 64, 64, 2 ** 31 - 1]
    ids = lambda values: spark.createDataFrame([(v, "s") for v in values], "id long, source string") \
        .withColumn("id", F.col("id").cast(kind))
    batch = ids(have).withColumn("_looked", F.lit(False))
    got = load._not_stored(batch, ids([-64, 2, 63]).unionByName(
        ids([0, 1]).withColumn("source", F.lit("other"))), ["id", "source"])
    assert got.columns == ["id", "source", "_looked"] and dict(got.dtypes)["id"] == kind
    assert ("bit_or" in plan(got)) == (kind != "string")
    assert sorted(int(r.id) for r in got.collect()) == [-65, -1, 0, 1, 64, 2 ** 31 - 1]


@pytest.mark.parametrize("repeats", [False, True])
def test_what_staging_parsed_is_not_parsed_again(spark, repeats):
    texts = [(1, "[1]", "2024-01-01"), (2, "[1", "x"), (3, None, None), (4, "{}", ""),
             (5, "[]", "2024-13-01"), (6, "null", "2024-01-01")]
    rows = spark.createDataFrame([(*t, s) for t in texts for s in (["a", "b"] if repeats else "a")],
                                 "id long, text string, release_date string, data_source string")
    raw = {}
    for name, column in (("movie_details", "genres"), ("discover", "genre_ids")):
        have = rows.withColumn(column, F.col("text")).withColumn("snapshot_date", F.lit(D1))
        raw[name] = have.select(*[
            (F.col(f.name) if f.name in have.columns else F.lit(None)).cast(f.dataType)
            .alias(f.name) for f in schemas.RAW_TABLES[name].fields])
    staged = {"movie_details": silver.stg_movie_details(raw["movie_details"]),
              "discover": silver.stg_discover(raw["discover"])}
    got = quality.run_raw_suite(raw, staged={k: v.localCheckpoint() for k, v in staged.items()})
    assert sorted(map(tuple, got.collect())) \
        == sorted(map(tuple, quality.run_raw_suite(raw).collect()))
    assert {r.failures for r in got.collect()} != {0}
    assert ("from_json" in plan(got)) == repeats


def test_a_bucket_of_ids_is_one_tasks(spark, monkeypatch):
    """However ids lie in the files, bitmaps are made once a bucket, and none moves."""
    plans = []
    real = lake_sink.materialise
    monkeypatch.setattr(lake_sink, "materialise", lambda df, root, layer, name, **more: (
        plans.append(plan(df)) if name == "movie_bitmaps" else None,
        real(df, root, layer, name, **more))[1])
    core = _movies(spark, 70_000).repartition(5).select(
        F.col("id").alias("movie_id"), "snapshot_date", F.lit(1.0).alias("popularity"),
        F.lit(2.0).alias("vote_average"), F.lit("2001-01-01").cast("date").alias("release_date"),
        F.when(F.col("id") % 5 > 0, F.array((F.col("id") % 2).cast("int"))).alias("raw_genre_ids"))
    root = scratch_path(spark, "buckets")
    history.refresh(core, root, [D1])
    assert len(plans) == 1
    above = tree(plans[0]).split("Exchange")[0]
    assert "SortAggregate" in above and "Generate" in above  # genres are told apart after the move
    got = spark.read.parquet(f"{root}/state/movie_bitmaps").select(
        "genre_id", "bucket", F.bitmap_count("movies").alias("n"))
    assert {(r.genre_id, r.n) for r in got.groupBy("genre_id").agg(F.sum("n").alias("n")).collect()} \
        == {(None, 14_000), (0, 28_000), (1, 28_000)}
    assert got.count() == 10  # id 0 is the last of a bucket
