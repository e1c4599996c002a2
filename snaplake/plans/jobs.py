"""Whole runs (PIPE-01/02): landing -> lake -> raw -> silver -> gold -> tests.

One session; each step hands DataFrames to the next.  Raw, silver and gold are written
as Parquet under ``root`` and read back by the next layer, so each layer starts from
files (short lineage, restartable) exactly like the reference's materialised tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake import schemas
from snaplake.operators import ingest, load
from snaplake.operators.dedupe import first_in_place
from snaplake.plans import gold, history, quality, silver
from snaplake.session import scratch_path
from snaplake.sinks import catalog
from snaplake.sinks import lake as lake_sink
from snaplake.sources import landing, lake as lake_source

LAYERS = {"silver": "core", "gold": "gold", "tests": "gold"}
# Independent models build concurrently, as the reference builds with 4 threads; on a
# cluster the small gold jobs then share the executors instead of queueing.
THREADS = 4


def _each(fn: Callable, items: dict, threads: int = THREADS) -> dict:
    """``fn(key, value)`` for every item, as concurrent Spark jobs; results by key."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        futures = {k: pool.submit(fn, k, v) for k, v in items.items()}
        return {k: f.result() for k, f in futures.items()}


def _lake(root: str) -> str:
    return f"{root.rstrip('/')}/lake"


def _landing_day(landing_root: str, dataset: str, date: str) -> str:
    return f"{landing_root.rstrip('/')}/{dataset}/snapshot_date={date}"


def load_dataset(spark: SparkSession, root: str, dataset: str, date: str,
                 snapshot: DataFrame | None = None) -> str:
    """LOAD-01..05 for one lake snapshot into ``raw/<dataset>``: the first row of a key, as the
    responses came, stays (snapshots without an arrival: one by its values)."""
    df = snapshot if snapshot is not None else \
        lake_source.read_snapshot(spark, _lake(root), dataset, date)
    df = load.reconcile(df, dataset, date)
    order = None if schemas.ARRIVAL in df.columns else load.by_value(df)
    return load.insert_if_absent(df, lake_sink.raw_path(root, dataset), order=order, days=[date],
                                 in_place=True)


SILVER = ("stg_genres", "stg_movie_details", "stg_discover", "core_movies")
CORE_PARTITIONS = ("snapshot_date", "source")
# Gold models on the latest snapshot: read from stored silver, pruned to one day.
LATEST_GOLD = {
    "daily_top_rated_movies": lambda s: gold.daily_top_rated_movies(s["core_movies"]),
    "daily_most_popular_movies": lambda s: gold.daily_most_popular_movies(s["core_movies"]),
    "dim_movies": lambda s: gold.dim_movies(s["core_movies"]),
}
# Gold models whose rows of a day depend only on that day's silver rows: a run refreshes
# just its days (the fact table alone is as large as core).
PER_DAY_GOLD = {
    "agg_genre_trends": lambda s: gold.agg_genre_trends(s["core_movies"], s["stg_discover"],
                                                        s["stg_genres"]),
    "fact_movie_popularity": lambda s: gold.fact_movie_popularity(s["core_movies"]),
}


def build_models(spark: SparkSession, root: str, days: Iterable[str] | None = None,
                 require_pass: bool = True) -> dict[str, DataFrame]:
    """All silver and gold models, each materialised and read back, then the tests.

    Silver rows of a day depend only on that day's raw rows (every dedupe key holds
    ``snapshot_date``), so with ``days`` only those days of silver are recomputed (raw scans
    pruned to them) and replaced, each as a whole.  The same holds for the per-day gold
    models and for the state of the whole-history ones (MOD-05/08/10, ``plans.history``);
    the latest-snapshot ones read one stored day.  Without ``days`` everything is rebuilt
    from raw.  Raw, core and gold tables are registered in the catalog.  A failing test
    raises ``quality.DataTestsFailed`` once all results are stored (``require_pass``).
    """
    days = None if days is None else list(days)
    raw = lake_source.register_sources(spark, root)
    in_scope = (lambda df: df) if days is None else (lambda df: history.days_of(df, days))
    raw = {k: in_scope(v) for k, v in raw.items()}
    daily = dict(partition_by=["snapshot_date"], days=days)
    # Raw rows seldom share (id, day): only those that do are moved to find the first.
    staging = {"stg_genres": lambda: silver.stg_genres(raw["genres"], first_in_place),
               "stg_movie_details":
                   lambda: silver.stg_movie_details(raw["movie_details"], first_in_place),
               "stg_discover": lambda: silver.stg_discover(raw["discover"], first_in_place)}
    mat = _each(lambda name, rows: lake_sink.materialise(rows(), root, LAYERS["silver"], name,
                                                         **daily), staging)
    # core from the stored staging (read back, pruned to the run's days): the staging
    # windows are not computed a second time.
    core = silver.core_movies(in_scope(mat["stg_movie_details"]), in_scope(mat["stg_discover"]))
    # A task of the union has rows of one source, so a run of one day needn't gather them.
    gather = None if days is None or len(days) > 1 else False
    # core is laid out by (day, source): "latest api snapshot" (MOD-06/07) is then
    # answered from directory names, and the api-only reads prune to api directories.
    mat["core_movies"] = lake_sink.materialise(
        core, root, LAYERS["silver"], "core_movies",
        **{**daily, "partition_by": list(CORE_PARTITIONS)}, gather=gather)
    scope = {k: in_scope(mat[k]) for k in SILVER}
    # MOD-05/08/10 from per-day state (plans.history), the rest from stored silver.
    whole = history.build(spark, root, mat["core_movies"], mat["stg_genres"], days)
    whole.update({name: build(mat) for name, build in LATEST_GOLD.items()})
    # The declared not_null tests are counted by the writes themselves: the fact table's for the
    # run's days (earlier ones were tested by their runs).
    counted = {m: quality.NullCounts(m) for m in dict.fromkeys(m for m, _, _ in quality.SUITE)}
    watch = lambda name: counted[name].watch if name in counted else None
    mat.update(_each(lambda name, df: lake_sink.materialise(
        df, root, LAYERS["gold"], name, watch=watch(name)), whole))
    per_day = {name: build(scope) for name, build in PER_DAY_GOLD.items()}
    mat.update(_each(lambda name, df: lake_sink.materialise(
        df, root, LAYERS["gold"], name, watch=watch(name), **daily), per_day))
    results = quality.run_suite(mat, counted=counted).unionByName(quality.run_raw_suite(
        raw, staged={"movie_details": scope["stg_movie_details"],
                     "discover": scope["stg_discover"]}))
    mat["dq_results"] = lake_sink.materialise(results, root, LAYERS["tests"], "dq_results")
    _register(spark, root, mat, days)
    if require_pass:
        quality.require_pass(mat["dq_results"])
    return mat


def _register(spark: SparkSession, root: str, models: dict[str, DataFrame],
              days: list[str] | None) -> None:
    """SNK-04..07: layers, tables and the staging views of this root, readable by name
    (``gold.dim_movies``); of tables known already only the partitions of ``days`` change."""
    catalog.create_layers(spark, root)
    catalog.create_raw_tables(spark, root, days=days)
    catalog.staging_views(spark)
    for name, df in models.items():
        layer = LAYERS["silver"] if name in SILVER else LAYERS["gold"]
        partitions = list(CORE_PARTITIONS) if name == "core_movies" else \
            ["snapshot_date"] if name in SILVER or name in PER_DAY_GOLD else []
        catalog.register(spark, layer, name, df.schema, f"{root.rstrip('/')}/{layer}/{name}",
                         partitions, days)


def extract_and_load(spark: SparkSession, landing_root: str, root: str, date: str,
                     multi_line: bool = False) -> None:
    """Three lists -> candidate ids -> their details; genres; each to the lake (day
    overwrite), each lake snapshot into raw (insert-if-absent).  The candidate ids come from the
    lists' stored snapshots, so the landed lists are read once."""
    day = lambda dataset: _landing_day(landing_root, dataset, date)
    to_lake = lambda name, df: lake_sink.write_snapshot(df, _lake(root), name, date)
    lists = {d: landing.read_list_pages(spark, day(d), d, multi_line, arrival=True)
             for d in landing.LIST_DATASETS}
    genres = landing.read_genre_doc(spark, day("genres"), multi_line, arrival=True)
    _each(to_lake, {**lists, "genres": genres})
    ids, kept = ingest.candidate_ids(*[
        history.days_of(lake_source.read_or_empty(
            spark, lake_sink.dataset_path(_lake(root), d), "id long, snapshot_date date"), [date])
        for d in lists]), scratch_path(spark, "ids")
    ids.write.parquet(kept)  # read twice
    ids = spark.read.schema(ids.schema).parquet(kept)
    good, _bad = landing.read_detail_docs(spark, day("movie_details"), multi_line, arrival=True)
    details = ingest.stamp(ingest.jsonify(ingest.details_for(ids, good)), source="api")
    to_lake("movie_details", details)
    lake_sink.delete_path(spark, kept)
    _each(lambda name, _: load_dataset(spark, root, name, date),
          {**lists, "movie_details": details, "genres": genres})


def run_daily(spark: SparkSession, landing_root: str, root: str, date: str,
              multi_line: bool = False, require_pass: bool = True) -> dict[str, DataFrame]:
    """PIPE-01: landed responses -> lake -> raw, then models, tests."""
    extract_and_load(spark, landing_root, root, date, multi_line)
    return build_models(spark, root, days=[date], require_pass=require_pass)


def backfill(spark: SparkSession, landing_dir: str, lake_root: str, years: Iterable[int],
             date: str, max_pages: int | None = None) -> str:
    """ING-05: every year of the range in one job -- read all landed pages, keep the
    requested years, shape, and replace each year's ``year=Y/snapshot_date=D``."""
    years = list(years)
    movies = landing.read_discover_pages(spark, landing_dir, max_page=max_pages, arrival=True,
                                         first=first_in_place) \
        .where(F.col("release_year").isin(years))
    return lake_sink.write_discover(ingest.shape_discover(movies), lake_root, date, years)


def backfill_and_load(spark: SparkSession, landing_root: str, root: str, years: Iterable[int],
                      date: str) -> None:
    """Backfill all years, and their rows into raw discover."""
    years = list(years)
    backfill(spark, _landing_day(landing_root, "discover", date), _lake(root), years, date)
    path = lake_sink.discover_path(_lake(root))
    snap = spark.read.option("basePath", path).parquet(f"{path}/year=*/snapshot_date={date}") \
        .where(F.col("year").isin(years)).drop("year")
    load_dataset(spark, root, "discover", date, snapshot=snap)


def run_backfill(spark: SparkSession, landing_root: str, root: str, years: Iterable[int],
                 date: str, require_pass: bool = True) -> dict[str, DataFrame]:
    """PIPE-02: backfill all years -> raw discover -> models -> tests."""
    backfill_and_load(spark, landing_root, root, years, date)
    return build_models(spark, root, days=[date], require_pass=require_pass)
