"""Safe replacement, registration, views, arrival and observed counts of whole runs."""

import datetime as dt
import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from snaplake import schemas
from snaplake.operators import load
from snaplake.plans import history, quality
from snaplake.session import scratch_path
from snaplake.sinks import catalog, lake
from snaplake.sources import landing

DAYS = ("2024-01-01", "2024-01-02", "2024-01-03")


def days_table(spark, rows):
    return spark.createDataFrame(rows, "id long, v string, snapshot_date string") \
        .withColumn("snapshot_date", F.to_date("snapshot_date"))


def stored(spark, path):
    return sorted((r.id, r.v, str(r.snapshot_date)) for r in spark.read.parquet(path).collect())


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


# ---- SNK-04: replacement ------------------------------------------------------------

@pytest.mark.parametrize("whole", [False, True])
def test_a_failing_job_leaves_the_old_rows_readable(spark, whole):
    root = scratch_path(spark, "t-swap")
    old = days_table(spark, [(i, "old", d) for i, d in enumerate(DAYS)])
    kept = dict(partition_by=[lake.DAY])
    lake.materialise(old, root, "gold", "m", **kept)
    before = stored(spark, f"{root}/gold/m")
    bad = days_table(spark, [(i, "new", DAYS[1]) for i in range(100)]).repartition(4) \
        .withColumn("v", F.when(F.col("id") == 57, F.raise_error(F.lit("planted")).cast("string"))
                    .otherwise(F.col("v")))
    with pytest.raises(Exception, match="planted"):
        lake.materialise(bad, root, "gold", "m", **kept, days=None if whole else [DAYS[1]])
    assert stored(spark, f"{root}/gold/m") == before
    new = days_table(spark, [(7, "new", DAYS[1])])
    lake.materialise(new, root, "gold", "m", **kept, days=None if whole else [DAYS[1]])
    assert stored(spark, f"{root}/gold/m") == \
        ([] if whole else [r for r in before if r[2] != DAYS[1]]) + [(7, "new", DAYS[1])]


def test_three_days_are_one_write(spark):
    root = scratch_path(spark, "t-one-write")
    path, sc = f"{root}/t", spark.sparkContext
    lake.replace_days(days_table(spark, [(1, "a", d) for d in DAYS]), path, DAYS)
    rows = days_table(spark, [(2, "b", DAYS[0]), (3, "c", DAYS[2]), (4, "d", "2024-02-01")])
    seen = sc.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    lake.replace_days(rows.mapInArrow(count, rows.schema), path, DAYS)
    assert seen.value == 3  # computed once for all days
    assert stored(spark, path) == [(2, "b", DAYS[0]), (3, "c", DAYS[2])]
    assert lake.directories(spark, path) == [f"snapshot_date={DAYS[0]}", f"snapshot_date={DAYS[2]}"]


# ---- SNK-05..08: catalog ------------------------------------------------------------

def test_registration_adds_the_days_of_a_run_only(spark, monkeypatch):
    root = scratch_path(spark, "t-register")
    db = "reg_" + root.rsplit("-", 1)[-1]
    catalog.create_layers(spark, root, layers=(db,))
    path, schema = f"{root}/t", days_table(spark, []).schema
    lake.replace_days(days_table(spark, [(1, "a", DAYS[0]), (2, "b", DAYS[1])]), path, DAYS[:2])
    catalog.register(spark, db, "t", schema, path, ["snapshot_date"], DAYS[:2])
    partitions = lambda: [r[0] for r in spark.sql(f"SHOW PARTITIONS {db}.t").collect()]
    assert len(partitions()) == 2
    lake.replace_days(days_table(spark, [(3, "c", DAYS[2])]), path, DAYS[2:])
    # The table is never dropped, and other days aren't listed.
    said, sql = [], spark.sql
    monkeypatch.setattr(spark, "sql", lambda text, *a, **k: said.append(text) or sql(text, *a, **k))
    assert catalog.refresh_days(spark, f"`{db}`.`t`", path, ["snapshot_date"], DAYS[2:]) == 1
    catalog.register(spark, db, "t", schema, path, ["snapshot_date"], DAYS[2:])
    assert not [s for s in said if "DROP" in s or "CREATE" in s]
    monkeypatch.undo()
    assert len(partitions()) == 3 and spark.table(f"{db}.t").count() == 3
    # A day that lost its rows leaves the table, with a column below the day too.
    lake.replace_days(days_table(spark, []), path, [DAYS[0]])
    catalog.register(spark, db, "t", schema, path, ["snapshot_date"], [DAYS[0]])
    assert len(partitions()) == 2 and spark.table(f"{db}.t").count() == 2


def test_partitions_below_the_day(spark):
    root = scratch_path(spark, "t-below")
    db = "below_" + root.rsplit("-", 1)[-1]
    catalog.create_layers(spark, root, layers=(db,))
    columns, path = ["snapshot_date", "v"], f"{root}/t"
    for rows in ([(1, "api", DAYS[0]), (2, "discover", DAYS[0])], [(3, "discover", DAYS[0])]):
        df = days_table(spark, rows)
        lake.replace_days(df, path, [DAYS[0]], columns)
        catalog.register(spark, db, "t", df.schema, path, columns, [DAYS[0]])
        assert sorted((r.id, r.v) for r in spark.table(f"{db}.t").collect()) == \
            [(i, v) for i, v, _ in rows]
    # Another place or other columns: registered anew.
    other = days_table(spark, [(9, "x", DAYS[1])]).withColumn("w", F.lit(1))
    lake.replace_days(other, f"{root}/u", DAYS, ["snapshot_date"])
    catalog.register(spark, db, "t", other.schema, f"{root}/u", ["snapshot_date"], DAYS)
    assert [r.w for r in spark.table(f"{db}.t").collect()] == [1]


def test_views_outlive_their_session(spark):
    root = scratch_path(spark, "t-view")
    db = "view_" + root.rsplit("-", 1)[-1]
    catalog.create_layers(spark, root, layers=(db,))
    genres = spark.createDataFrame([(1, "old", "2024-01-01", "b"), (1, "kept", "2024-01-01", "a")],
                                   "id int, name string, snapshot_date string, data_source string")
    rows = load.reconcile(genres, "genres")
    load.insert_if_absent(rows, lake.raw_path(root, "genres"), order=load.by_value(rows))
    catalog.create_raw_tables(spark, root, db=db)
    for _ in range(2):
        catalog.staging_views(spark, db)
    got = spark.newSession().sql(f"SELECT genre_id, genre_name FROM {db}.stg_genres").collect()
    assert [tuple(r) for r in got] == [(1, "kept")]


# ---- LOAD-05: arrival ---------------------------------------------------------------

def test_a_load_needs_an_order(spark):
    df = days_table(spark, [(1, "a", DAYS[0])]).withColumn("data_source", F.lit("api"))
    with pytest.raises(ValueError, match="order"):
        load.insert_if_absent(df, scratch_path(spark, "t-order"))


def test_arrival_is_the_order_of_pages_not_of_files(spark):
    root = scratch_path(spark, "t-arrival")
    page = lambda n, *movies: (n, '{"page":%d,"total_pages":3,"results":[%s]}' % (
        n, ",".join('{"id":%d,"title":"%s"}' % m for m in movies)))
    pages = [page(2, (1, "second"), (2, "first"), (2, "later")), page(1, (1, "first"), (3, "only")),
             page(3, (2, "third"), (1, "third"))]
    for i, (_, text) in enumerate(pages):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{root}/f{i}")
    rows = landing.read_list_pages(spark, f"{root}/f*", "popular", arrival=True) \
        .withColumn("snapshot_date", F.lit(DAYS[0]))
    for _ in range(2):
        load.insert_if_absent(load.reconcile(rows, "popular"), f"{root}/raw")
    got = spark.read.schema(schemas.POPULAR).parquet(f"{root}/raw")
    assert sorted((r.id, r.title) for r in got.collect()) == [(1, "first"), (2, "first"), (3, "only")]
    assert schemas.ARRIVAL not in spark.read.parquet(f"{root}/raw").columns


# ---- history by bitmaps -------------------------------------------------------------

CORE = ("movie_id long, popularity double, vote_average double, release_date date, "
        "raw_genre_ids array<int>, snapshot_date date")


def core_rows(spark, rows):
    return spark.createDataFrame([(i, float(i), 5.0, dt.date(2001, 1, 1), g, dt.date.fromisoformat(d))
                                  for i, g, d in rows], CORE)


def test_history_reads_months_and_counts_each_movie_once(spark):
    root = scratch_path(spark, "t-history")
    genres = spark.createDataFrame([(1, "A", dt.date(2024, 2, 1)), (2, "B", dt.date(2024, 2, 1)),
                                    (3, "B", dt.date(2024, 2, 1))],
                                   "genre_id int, genre_name string, snapshot_date date")
    rows = [(i, [1, 2, 3] if i % 2 else None, d) for i in (1, 2, 3, 40_000, 32_768, 32_769, 10 ** 12)
            for d in ("2024-01-01", "2024-01-02", "2024-02-01")]
    core = core_rows(spark, rows + [(77, [2], "2024-01-02")])
    for d in ("2024-02-01", "2024-01-01", "2024-01-02"):
        history.refresh(core, root, [d])
    total = history.daily_total_movies(spark, root)
    assert total.first()[0] == 8
    dist = history.historical_genre_distribution(spark, root, genres)
    assert sorted(tuple(r) for r in dist.collect()) == [("A", 3), ("B", 4)]
    text = plan(total) + plan(history.agg_historical_analysis(spark, root, genres))
    assert "state/month_" in text and "state/movie_bitmaps" not in text and "movie_id" not in text
    # A day loaded again without a movie: it is gone, others stay.
    history.refresh(core_rows(spark, [(5, [1], "2024-01-02")]), root, ["2024-01-02"])
    assert history.daily_total_movies(spark, root).first()[0] == 8  # 77 gone, 5 new
    history.refresh(core_rows(spark, []), root, ["2024-01-01"])
    history.refresh(core_rows(spark, []), root, ["2024-02-01"])
    assert history.daily_total_movies(spark, root).first()[0] == 1
    history.refresh(core_rows(spark, []), root, ["2024-01-02"])
    assert history.daily_total_movies(spark, root).first()[0] == 0


# ---- DQ-01: counted by the write ----------------------------------------------------

def test_null_counts_of_a_write(spark):
    root = scratch_path(spark, "t-counted")
    spec = (("m", "id", "not_null"), ("m", "v", "not_null"), ("m", "id", "unique"))
    rows = days_table(spark, [(i % 9 or None, None if i % 5 == 0 else "x", DAYS[i % 3])
                              for i in range(90)])
    counts = quality.NullCounts("m", spec)
    out = lake.materialise(rows, root, "gold", "m", partition_by=[lake.DAY], days=DAYS[:2],
                           watch=counts.watch)
    seen = quality.run_suite({"m": out}, spec, {"m": counts})
    assert sorted(map(tuple, seen.collect())) == \
        sorted(map(tuple, quality.run_suite({"m": out}, spec).collect()))
    assert "Scan parquet" not in plan(counts.rows(spark, "m"))
