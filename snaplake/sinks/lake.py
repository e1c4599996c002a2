"""Lake and layer writes (SNK-01, SNK-02, SNK-04, SNK-05).

A day is always replaced as a whole: whatever partitions below it the new rows have, a re-run
leaves nothing of the earlier one -- not even when it has no rows for that day.  New rows are
written beside the table first, all days in one job, and the folders change places once that job
has ended, by renames: a job that fails leaves the old rows as they were, and no reader meets a
half-written day.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake import schemas

DAY = "snapshot_date"


def dataset_path(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{dataset}"


def discover_path(root: str) -> str:
    return f"{root.rstrip('/')}/discover_by_year"


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Lake and layer files are read a few times and kept: small beats fast.
COMPRESSION = "zstd"
#: Columns of mostly unlike values, for which a dictionary is made in vain.
UNLIKE = ("id", "movie_id", "title", "original_title", "poster_path", "popularity")
#: How lake, raw and layer files are written; at zstd's first level, a list's write took half the
#: time of its third.
WRITE = {"compression": COMPRESSION, "parquet.compression.codec.zstd.level": "1",
         **{f"parquet.enable.dictionary#{c}": "false" for c in UNLIKE}}


def _staged(df: DataFrame, path: str, partition_cols: Sequence[str], watch=None,
            gather: bool = True) -> str:
    """Write ``df`` to a fresh folder beside ``path``.  Rows of one directory are brought together
    first, so a task writes few files; AQE splits directories above its advisory size.  Without
    ``gather`` rows stay where they are, a file per task and directory: for a day or two of
    folders, where moving every row would change nothing but the files' number.
    ``watch``: (Observation, metrics), counted by the writing tasks themselves, behind the last
    shuffle, so a task that runs again doesn't count twice."""
    to = f"{path.rstrip('/').rsplit('/', 1)[0]}/_staged-{uuid.uuid4().hex[:12]}"
    if partition_cols and gather:
        df = df.hint("rebalance", *partition_cols)
    if watch is not None:
        df = df.observe(watch[0], *watch[1])
    w = df.write.options(**WRITE)
    (w.partitionBy(*partition_cols) if partition_cols else w).parquet(to)
    return to


def swap(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` (or nothing, if there is none) in the place of ``path``."""
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    target, source = jvm.Path(path), jvm.Path(new)
    old = jvm.Path(target.getParent(), f"_old-{uuid.uuid4().hex[:12]}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move {path} away")
    if fs.exists(source) and not fs.rename(source, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"cannot move {new} to {path}")
    if had:
        fs.delete(old, True)


def replace_partitions(df: DataFrame, path: str, column: str, values: Iterable[str],
                       below: Sequence[str] = (), watch=None, gather: bool | None = None) -> str:
    """Replace the directories ``<path>/<column>=V`` of the dates ``values`` by the rows of ``df``
    that have them, written in one job; every other one stays as it is.  ``gather`` (see
    ``_staged``): unless told, where there may be several directories."""
    spark, values = df.sparkSession, [str(v) for v in values]
    rows = df.where(F.col(column).isin([F.lit(v).cast("date") for v in values]))
    gather = bool(below) or len(values) > 1 if gather is None else gather
    staged = _staged(rows, path, [column, *below], watch, gather)
    for v in values:
        swap(spark, f"{staged}/{column}={v}", f"{path}/{column}={v}")
    delete_path(spark, staged)
    return path


def replace_days(df: DataFrame, path: str, days: Iterable[str],
                 partition_cols: Sequence[str] = (DAY,), watch=None,
                 gather: bool | None = None) -> str:
    """``replace_partitions`` by day."""
    return replace_partitions(df, path, DAY, days, [c for c in partition_cols if c != DAY], watch,
                              gather)


def directories(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders ``column=value`` right below ``path`` (none, if it doesn't exist)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p)
                  if s.isDirectory() and "=" in s.getPath().getName())


def write_snapshot(df: DataFrame, root: str, dataset: str, date: str) -> str:
    """SNK-01: stamp the run date, write ``<root>/<dataset>/snapshot_date=D/``."""
    stamped = df.withColumn(DAY, F.lit(date).cast("date"))
    return replace_days(stamped, dataset_path(root, dataset), [date])


def write_discover(df: DataFrame, root: str, date: str,
                   years: Iterable[int] | None = None) -> str:
    """SNK-02: backfill layout ``year=Y/snapshot_date=D``; ``release_year`` stays a data
    column, ``year`` is its copy in the path.  The (year, day) directories of ``years``
    (default: the years that ``df`` has) are replaced as a whole."""
    path, spark = discover_path(root), df.sparkSession
    stamped = df.withColumn(DAY, F.lit(date).cast("date")) \
                .withColumn("year", F.col("release_year"))
    staged = _staged(stamped, path, ["year", DAY])
    for year in sorted({f"year={y}" for y in years or ()} | set(directories(spark, staged))):
        swap(spark, f"{staged}/{year}/{DAY}={date}", f"{path}/{year}/{DAY}={date}")
    delete_path(spark, staged)
    return path


def materialise(df: DataFrame, root: str, layer: str, name: str, kind: str = "table",
                partition_by: Sequence[str] = (), days: Iterable[str] | None = None,
                watch=None, gather: bool | None = None) -> DataFrame:
    """SNK-04/SNK-05: rebuild of a model.

    ``table``: replace ``<root>/<layer>/<name>`` and return a DataFrame reading it
    back -- downstream models start from the written files, which also cuts lineage.
    With ``days`` only those days are replaced, each as a whole (a model whose rows for a
    day depend only on that day's input, refreshed per day).
    ``watch``: metrics of the written rows, counted by the write (``quality.NullCounts``).
    ``view``: a temporary view ``<layer>__<name>`` over the plan, nothing written (views that
    outlive the session: ``catalog.create_view``).
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(f"{layer}__{name}")
        return spark.table(f"{layer}__{name}")
    path = f"{root.rstrip('/')}/{layer}/{name}"
    if days is None:
        swap(spark, _staged(df, path, partition_by, watch), path)
    else:
        replace_days(df, path, days, partition_by, watch, gather)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def raw_path(root: str, dataset: str) -> str:
    if dataset not in schemas.RAW_TABLES:
        raise ValueError(f"unknown raw table: {dataset}")
    return f"{root.rstrip('/')}/raw/{dataset}"


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The partition columns of a stored table, from its files' paths."""
    files = spark.read.parquet(path).inputFiles()
    below = files[0].split(path.rstrip("/").split(":")[-1], 1)[-1] if files else ""
    return [d.split("=", 1)[0] for d in below.split("/") if "=" in d]


def compact(spark: SparkSession, path: str, date, schema, rows_per_file: int = 5_000_000) -> int:
    """Rewrite one day of a table partitioned by day (and maybe further columns below it)
    into ``ceil(rows / rows_per_file)`` files a directory at most; all partition columns stay.

    The day is first copied to a fresh folder of the shared scratch root and packed from that
    copy, then the folders change places.  Run it as the table's single writer (as for loads).  Returns
    the number of files that hold the day now.
    """
    from snaplake.session import scratch_path
    columns = partition_columns(spark, path)
    part = spark.read.schema(schema).parquet(path) \
        .where(F.col(DAY) == F.lit(str(date)).cast("date"))
    staged = scratch_path(spark, "compact")
    part.write.parquet(staged)
    copy = spark.read.schema(schema).parquet(staged)
    n = max(1, -(-copy.count() // rows_per_file))
    below = [c for c in columns if c != DAY]
    target = f"{path.rstrip('/')}/{DAY}={date}"
    packed = f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex[:12]}"
    w = copy.drop(DAY).repartition(n).write
    (w.partitionBy(*below) if below else w).parquet(packed)
    swap(spark, packed, target)
    delete_path(spark, staged)
    return len(spark.read.schema(schema).parquet(target).inputFiles())
