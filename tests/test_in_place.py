"""First rows found in place: keys alone are counted, only rows that may share theirs move."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snaplake.operators import load
from snaplake.operators.dedupe import first_in_place, first_per_key
from snaplake.plans import jobs, silver
from snaplake.session import scratch_path
from snaplake.sinks import lake as lake_sink
from snaplake.sources.lake import read_or_empty
from snaplake import schemas
from tests.test_plans import plan

DAY = dt.date(2024, 1, 2)
KEYS = ["id", "d"]


def _rows(spark, repeats):
    ids = (None, -65, -64, -1, 0, 1, 63, 64, 2 ** 40, 2 ** 63 - 1)
    rows = [(i, d, v) for i in ids for d in ("a", None)
            for v in ((3, 1, 2) if i in repeats else (1,))]
    return spark.createDataFrame(rows, "id long, d string, v int")


@pytest.mark.parametrize("repeats", [(), (None,), (-64, 63), (None, -65, 0, 2 ** 63 - 1)])
@pytest.mark.parametrize("few", [0, 100])
def test_same_rows_as_the_window(spark, repeats, few):
    for keys in (KEYS, ["d", "v"]):
        df = _rows(spark, repeats)
        order = [F.col("v"), F.col("id").asc_nulls_first()]
        got = first_in_place(df, keys, order, few).collect()
        assert sorted(map(str, got)) == sorted(map(str, first_per_key(df, keys, order).collect()))


def test_unlike_keys_stay_where_they_are(spark):
    path = scratch_path(spark, "in-place")
    lake_sink.materialise(spark.range(5000).select(
        F.col("id"), F.lit(DAY).alias("snapshot_date"), F.lit("discover").alias("data_source")),
        path, "raw", "discover")
    raw = read_or_empty(spark, f"{path}/raw/discover", schemas.DISCOVER)
    assert "Exchange" in plan(silver.stg_discover(raw))
    assert "Exchange" not in plan(silver.stg_discover(raw, first_in_place))


def test_load_in_place_keeps_the_first_to_arrive(spark):
    path = scratch_path(spark, "in-place-load")
    rows = [(i, DAY, "api", v) for i in range(300) for v in ((7, 3) if i % 50 == 0 else (5,))]
    df = spark.createDataFrame(rows, "id long, snapshot_date date, data_source string, v int")
    for _ in range(2):
        load.insert_if_absent(df, path, order=[F.col("v")], days=[DAY], in_place=True)
    got = sorted((r.id, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(i, 3 if i % 50 == 0 else 5) for i in range(300)]


def test_runs_look_for_firsts_in_place(spark, monkeypatch):
    """A run's staging asks for first rows in place, a load of a day that isn't stored too."""
    asked = []

    def spy(df, keys, order, *more):
        asked.append(sorted(keys))
        return first_in_place(df, keys, order, *more)

    monkeypatch.setattr(jobs, "first_in_place", spy)
    monkeypatch.setattr(load, "first_in_place", spy)
    root = scratch_path(spark, "in-place-run")
    movies = spark.range(40).select("id", F.lit("discover").alias("data_source"),
                                    F.lit(DAY).alias("snapshot_date"))
    jobs.load_dataset(spark, root, "discover", str(DAY), movies)
    out = jobs.build_models(spark, root, days=[str(DAY)], require_pass=False)
    assert out["core_movies"].count() == 40
    assert asked.count(["id", "snapshot_date"]) == 3
    assert sorted(schemas.RAW_KEYS) in asked
