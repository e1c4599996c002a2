"""Guards on plan shape: the properties the scale design relies on (PLANS.md)."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from snaplake import fixtures
from snaplake.plans import gold, silver
from snaplake.session import scratch_path
from snaplake.sinks import lake


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree(text: str) -> str:
    return text.split("\n\n")[0]


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    root = scratch_path(spark, "plans")
    s = silver.build_silver(fixtures.raw_tables(spark, sf_dir))
    return {k: lake.materialise(v, root, "core", k, partition_by=(
        ["snapshot_date", "source"] if k == "core_movies" else ["snapshot_date"]))
        for k, v in s.items()}


def test_dedupe_limits_rows_before_the_shuffle(spark, sf_dir):
    s = silver.build_silver(fixtures.raw_tables(spark, sf_dir))
    text = plan(s["stg_discover"])
    assert "row_number(), 1, Partial" in text
    assert re.search(r"WindowGroupLimit \(\d+\)\n\s*\+- Sort \(\d+\)\n\s*\+- Exchange", tree(text))


def test_core_api_rows_never_move(stored):
    """On stored staging the api branch is a scan; only discover rows and keys shuffle."""
    t = tree(plan(silver.core_movies(stored["stg_movie_details"], stored["stg_discover"])))
    api = t.split("Union")[1].split(":- ", 1)[1].split("+- Project", 1)[0]
    assert "Scan parquet" in t and "Window" not in t
    first_branch = re.split(r"\n\s*\+- ", t.split("Union", 1)[1], maxsplit=1)[0]
    assert "Exchange" not in first_branch and api


def test_latest_snapshot_prunes_partitions(stored):
    text = plan(gold.dim_movies(stored["core_movies"]))
    assert re.search(r"PartitionFilters: \[.*snapshot_date.*= Subquery", text)
    assert "Exchange (" not in tree(text)


def test_gold_scans_read_only_needed_columns(stored):
    text = plan(gold.agg_historical_analysis(stored["core_movies"], stored["stg_genres"]))
    schemas = re.findall(r"ReadSchema: (struct<.*>)", text)
    core_scan = [s for s in schemas if "movie_id" in s]
    assert core_scan and all("title" not in s and "overview" not in s for s in core_scan)


def test_the_join_with_genres_is_left_to_spark(spark, stored):
    """No hint and no count of our own: the plan follows Spark's sizes, and building a model
    starts no job."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    model = gold.historical_genre_distribution(stored["core_movies"], stored["stg_genres"])
    gold.agg_genre_trends(stored["core_movies"], stored["stg_discover"], stored["stg_genres"])
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("", "")
    assert "BroadcastHashJoin" in plan(model)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(gold.historical_genre_distribution(stored["core_movies"],
                                                       stored["stg_genres"]))
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top20_is_take_ordered(stored):
    text = plan(gold.daily_top_rated_movies(stored["core_movies"]))
    assert "TakeOrderedAndProject" in text


def test_insert_if_absent_computes_its_batch_once(spark, sf_dir):
    """Loading with and without known days reads each batch row once."""
    from snaplake.operators import load
    raw = fixtures.raw_tables(spark, sf_dir)["genres"]
    n = raw.count()
    for days in (None, ["2024-01-01", "2024-01-02", "2024-01-03"]):
        path = scratch_path(spark, "plans-load")
        order = load.by_value(raw)
        load.insert_if_absent(raw, path, order=order, days=days)
        seen = spark.sparkContext.accumulator(0)

        def count(rows, seen=seen):
            for b in rows:
                seen.add(b.num_rows)
                yield b
        load.insert_if_absent(raw.mapInArrow(count, raw.schema), path, order=order, days=days)
        assert seen.value == n
        assert spark.read.parquet(path).count() == n


def test_insert_if_absent_prunes_stored_days(spark, sf_dir):
    path = scratch_path(spark, "plans-load")
    raw = fixtures.raw_tables(spark, sf_dir)["genres"]
    from snaplake.operators import load
    load.insert_if_absent(raw, path, order=load.by_value(raw))
    stored_days = spark.read.schema(raw.schema).parquet(path).where(
        F.col("snapshot_date").isin([F.lit("2024-01-02").cast("date")]))
    text = plan(raw.join(stored_days.select("id", "snapshot_date", "data_source"),
                         ["id", "snapshot_date", "data_source"], "left_anti"))
    assert re.search(r"PartitionFilters: \[.*snapshot_date.*2024-01-02", text)


def test_bucketed_days_need_no_exchange(spark, sf_dir):
    """Conflict check and staging dedupe read the stored rows as they lie: only the batch is
    exchanged (to find its first rows, and to be dealt into buckets), and the dedupe has none."""
    from snaplake import schemas
    from snaplake.operators import load
    from snaplake.plans import silver
    from snaplake.sinks import catalog
    root = scratch_path(spark, "plans-buckets")
    db = "plans_" + root.rsplit("-", 1)[-1]
    catalog.create_layers(spark, root, layers=(db,))
    table = catalog.register(spark, db, "discover", schemas.DISCOVER, f"{root}/discover",
                             ["snapshot_date"], buckets=("id", 4))
    rows = fixtures.raw_tables(spark, sf_dir)["discover"]
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    batch = spark.createDataFrame(rows.limit(50).collect(), rows.schema)
    load.insert_into_buckets(batch, table, days, order=load.by_value(batch))
    n = spark.table(table).count()
    load.insert_into_buckets(batch, table, days, order=load.by_value(batch))
    assert spark.table(table).count() == n == 50
    text = plan(load.conflict_free(batch, table, days, order=load.by_value(batch)))
    shape = tree(text)
    assert shape.count("Exchange") == 2 and "SortMergeJoin" in shape
    assert shape.rindex("Exchange") < shape.index("Scan parquet")
    assert "Exchange" not in plan(silver.stg_discover(spark.table(table)))
