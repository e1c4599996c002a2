"""ST-01: the incremental load survives a restart and even a lost checkpoint."""

from pyspark.sql import functions as F

from snaplake import schemas
from snaplake.session import scratch_path
from snaplake.streaming.incremental import STATE_BUCKETS, ingest_available, ingest_with_state


def _run(spark, src, table, ckpt, schema):
    ingest_available(spark, src, schema, table, ckpt,
                     keys=("user_id", "event_date", "event_type"), partition_col="event_date",
                     order=[F.col("event_id").asc()],
                     prepare=lambda b: b.withColumn("event_date", F.to_date("ts")),
                     max_files_per_trigger=1)


def test_replay_adds_nothing(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    src, table = scratch_path(spark, "st-src"), scratch_path(spark, "st-table")
    ckpt = scratch_path(spark, "st-ckpt")
    events.where("event_id % 2 = 0").coalesce(1).write.parquet(src)
    _run(spark, src, table, ckpt, events.schema)
    first = spark.read.parquet(table).count()
    events.where("event_id % 2 = 1").coalesce(1).write.mode("append").parquet(src)
    _run(spark, src, table, ckpt, events.schema)          # restart: only the new file
    second = spark.read.parquet(table).count()
    _run(spark, src, table, scratch_path(spark, "st-ckpt2"), events.schema)  # lost checkpoint
    assert spark.read.parquet(table).count() == second
    keys = events.select("user_id", F.to_date("ts").alias("d"), "event_type").distinct().count()
    assert first <= second == keys
    dup = spark.read.parquet(table).groupBy("user_id", "event_date", "event_type").count() \
        .where("count > 1").count()
    assert dup == 0


def test_state_holds_buckets_and_first_row_wins(spark):
    """The state has a value per hash bucket of a day, not one per key; of copies in a batch the
    first by place stays, and keys of earlier batches add nothing."""
    src, table = scratch_path(spark, "ws-src"), scratch_path(spark, "ws-table")
    ckpt, n = scratch_path(spark, "ws-ckpt"), 3 * STATE_BUCKETS
    copies = spark.range(n).select(F.col("id"), F.explode(F.array(F.lit(2), F.lit(1), F.lit(3)))
                                   .alias("copy"))
    place = F.struct(F.lit(2000).alias("year"), F.col("copy").alias("page"), F.lit("f").alias("file"),
                     F.lit(0).cast("long").alias("block"), F.lit(0).alias("pos"))
    rows = copies.select("id", F.concat(F.lit("t"), F.col("copy")).alias("title"),
                         F.lit("2024-01-01").alias("snapshot_date"),
                         F.lit("discover").alias("data_source"), place.alias(schemas.ARRIVAL))
    for wanted in (rows.where("id % 2 = 0"), rows.withColumn("title", F.concat("title", F.lit("b")))):
        wanted.repartition(3).write.mode("append").parquet(src)
        q = ingest_with_state(spark, src, rows.schema, "discover", table, ckpt)
    state = [s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]]
    assert 0 < max(state) <= STATE_BUCKETS
    got = {r.id: r.title for r in spark.read.schema(schemas.DISCOVER).parquet(table).collect()}
    assert got == {i: "t1" if i % 2 == 0 else "t1b" for i in range(n)}
    assert spark.read.schema(schemas.DISCOVER).parquet(table).count() == n
