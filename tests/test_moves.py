"""What a run moves and writes: rows of one day stay where they are, a day loaded again moves keys."""

import glob

import pytest
from pyspark.sql import functions as F

from snaplake import fixtures, schemas
from snaplake.operators import ingest, load
from snaplake.session import scratch_path
from snaplake.sinks import lake

D1, D2 = "2024-01-01", "2024-01-02"


def _files(path):
    return glob.glob(f"{path.split(':')[-1]}/**/part-*", recursive=True)


def test_one_day_is_written_without_moving_rows(spark):
    root = scratch_path(spark, "mv-lake")
    path = lake.write_snapshot(spark.range(300).repartition(3), root, "x", D1)
    assert len(_files(path)) == 3 and all(f.endswith(".zstd.parquet") for f in _files(path))
    assert spark.read.parquet(path).count() == 300


def test_landed_documents_are_compressed(spark):
    path, copy = scratch_path(spark, "mv-land"), scratch_path(spark, "mv-copy")
    movies = spark.range(50).select("id", F.lit(D1).cast("date").alias("snapshot_date"))
    fixtures.land_pages(movies, path)
    fixtures.land_copy(path, copy)
    assert all(f.endswith(".gz") for f in _files(path) + _files(copy))
    lines = [sorted(r.value for r in spark.read.text(p).collect()) for p in (path, copy)]
    assert lines[0] == lines[1] and len(lines[0]) > 0


def test_detail_ids_go_as_bitmaps(spark):
    values = [0, 1, -1, 7, 8, 32767, 32768, 32769, -32768, -32769, 2 ** 62, -2 ** 63, None, 5, 5]
    ids = spark.createDataFrame([(v,) for v in values], "id long")
    docs = spark.createDataFrame([(v, "a") for v in values]
                                 + [(i, "b") for i in range(-40000, 40000, 7)], "id long, t string")
    got, plain = ingest.details_for(ids, docs), docs.join(ids, ["id"], "left_semi")
    assert got.columns == plain.columns
    assert got.count() == plain.count() > 0 and got.exceptAll(plain).isEmpty()
    assert "bitmap_construct_agg" in got._jdf.queryExecution().toString()


def _batch(spark, rows):
    return spark.createDataFrame(rows, "id long, v string, snapshot_date string, data_source string") \
        .withColumn("snapshot_date", F.col("snapshot_date").cast("date"))


@pytest.mark.parametrize("named", [True, False])
def test_load_again_adds_new_keys_only(spark, named):
    path = scratch_path(spark, "mv-raw")
    put = lambda rows, days: load.insert_if_absent(
        _batch(spark, rows), path, order=[F.col("v").asc()], days=days if named else None)
    put([(1, "a", D1, "s"), (1, "b", D1, "s")], [D1])
    n = len(_files(path))
    put([(1, "0", D1, "s")], [D1])
    assert len(_files(path)) == n  # nothing new: nothing written
    put([(1, "0", D1, "s"), (2, "z", D1, "s"), (2, "y", D1, "s"), (1, "q", D2, "s")], [D1, D2])
    got = spark.read.parquet(path).select("id", "v", F.col("snapshot_date").cast("string")).collect()
    assert sorted(map(tuple, got)) == [(1, "a", D1), (1, "q", D2), (2, "y", D1)]


def test_a_stored_key_does_not_hide_text_that_is_not_json(spark):
    path = scratch_path(spark, "mv-json")
    rows = lambda text: load.align(spark.createDataFrame(
        [(1, text, D1, "s")], "id long, genre_ids string, snapshot_date string, data_source string"),
        schemas.DISCOVER)
    load.insert_if_absent(rows("[1]"), path, order=[F.col("id")], days=[D1])
    with pytest.raises(Exception, match="is not JSON"):
        load.insert_if_absent(rows("[1,"), path, order=[F.col("id")], days=[D1])
