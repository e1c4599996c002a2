"""ST-01: what a micro-batch of the lake moves and looks at, and how its files are dealt."""

import pytest
from pyspark.sql import functions as F

from snaplake import fixtures, schemas
from snaplake.operators import load
from snaplake.session import scratch_path
from snaplake.streaming.incremental import ingest_lake


def _rows(spark, days, title, ids=40, genres=None):
    place = F.struct(F.lit(2000).alias("year"), F.lit(0).alias("page"), F.lit("f").alias("file"),
                     F.lit(0).cast("long").alias("block"), F.lit(0).alias("pos"))
    genres = F.array(F.col("id").cast("int"), F.lit(2)) if genres is None else genres
    return spark.range(ids).select(
        "id", F.lit(title).alias("title"), genres.alias("genre_ids"),
        F.explode(F.array(*[F.lit(d) for d in days])).alias("snapshot_date"),
        F.lit("discover").alias("data_source"), place.alias(schemas.ARRIVAL))


def test_only_batches_of_stored_days_keep_keys(spark, monkeypatch):
    """A batch whose days aren't stored has nothing to compare its keys with."""
    src, table, ckpt = (scratch_path(spark, n) for n in ("sl-src", "sl-table", "sl-ckpt"))
    kept = []
    monkeypatch.setattr(load, "scratch_path",
                        lambda spark, name: kept.append(name) or scratch_path(spark, name))
    counts = []
    for days, title, ids in ((["2024-01-01"], "a", 40), (["2024-01-02", "2024-01-03"], "b", 40),
                             (["2024-01-01", "2024-01-03", "2024-01-04"], "c", 50)):
        rows = _rows(spark, days, title, ids)
        rows.write.mode("append").parquet(src)
        ingest_lake(spark, src, rows.schema, "discover", table, ckpt)
        counts.append(len(kept))
    assert counts == [0, 0, 1]
    got = {(str(r.snapshot_date), r.title): r.n for r in
           spark.read.schema(schemas.DISCOVER).parquet(table)
           .groupBy("snapshot_date", "title").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {("2024-01-01", "a"): 40, ("2024-01-02", "b"): 40, ("2024-01-03", "b"): 40,
                   ("2024-01-01", "c"): 10, ("2024-01-03", "c"): 10, ("2024-01-04", "c"): 50}


def test_text_that_was_just_written_is_not_parsed(spark):
    plan = lambda df: load.reconcile(
        df, "discover")._jdf.queryExecution().optimizedPlan().toString().lower()
    nested = _rows(spark, ["2024-01-01"], "a", 3)
    text = _rows(spark, ["2024-01-01"], "a", 3,
                 F.concat(F.lit("["), F.col("id").cast("string"), F.lit("]")))
    assert "not json" in plan(text) and "not json" not in plan(nested)
    got = load.reconcile(nested, "discover").orderBy("id").collect()
    assert [r.genre_ids for r in got] == ["[0,2]", "[1,2]", "[2,2]"]


def test_bad_text_of_a_stored_key_fails_the_load(spark):
    table, day = scratch_path(spark, "sl-bad"), ["2024-01-01"]
    good = load.reconcile(_rows(spark, day, "a", 5), "discover")
    load.insert_if_absent(good, table, days=day)
    bad = load.reconcile(_rows(spark, day, "a", 5, F.when(F.col("id") == 3, "[1").otherwise("[1]")),
                         "discover")
    with pytest.raises(Exception, match="is not JSON"):
        load.insert_if_absent(bad, table, days=day)
    assert spark.read.schema(schemas.DISCOVER).parquet(table).count() == 5


def test_stored_movies_are_files_of_few_rows(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(fixtures, "FILE_ROWS", 100)
    base = fixtures.stored_base(spark, sf_dir)
    sizes = [r["count"] for r in base.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 100 and sum(sizes) == base.count()
