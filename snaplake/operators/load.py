"""Warehouse load (LOAD-01..05, SNK-03, SNK-08): reconcile a lake snapshot to the raw
schema and append only rows whose key is not stored yet.

Plain Parquet has no atomic merge, so the contract is one writer per table.  A re-run is
safe: every row it would add is already present, so it adds nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DateType, MapType, StringType, StructType,
                               VariantType)

from snaplake import schemas
from snaplake.operators import ingest
from snaplake.operators.dedupe import first_in_place, first_per_key
from snaplake.session import scratch_path
from snaplake.sinks.lake import WRITE, delete_path
from snaplake.sources.lake import read_or_none


def _nested(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (ArrayType, StructType, MapType)) and f.name != schemas.ARRIVAL]


def normalise_nested(df: DataFrame) -> DataFrame:
    """LOAD-01: every array/struct/map column becomes JSON text (whole column); the arrival stays."""
    nested = _nested(df)
    return df.select([F.to_json(F.col(c)).alias(c) if c in nested else F.col(c)
                      for c in df.columns])


def default_source(df: DataFrame, source: str = "api") -> DataFrame:
    """LOAD-03: ``data_source`` defaults to 'api' when the column is absent."""
    return df if "data_source" in df.columns else df.withColumn("data_source", F.lit(source))


def align(df: DataFrame, target: StructType,
          json_columns: Sequence[str] = tuple(schemas.JSON_COLUMNS),
          json_as_variant: bool = False, written: Sequence[str] = ()) -> DataFrame:
    """LOAD-04: reconcile to the target schema -- unknown columns dropped, missing ones
    NULL, DATE columns cast, JSON columns kept as JSON text, others cast by assignment.
    Text that is not JSON in a JSON column fails the load; ``written`` names columns whose text
    ``to_json`` has just made, which isn't parsed again.  The arrival stays, for
    ``insert_if_absent``.

    CST-05: with ``json_as_variant`` the JSON columns become VARIANT (``try_parse_json``:
    text that is not JSON gives NULL instead of failing the load)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols: list[Column] = []
    for f in target.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.name in written and not json_as_variant:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in json_columns:
            text = F.col(f.name) if isinstance(have[f.name], StringType) \
                else F.to_json(F.col(f.name))
            parsed = F.try_parse_json(text)
            # An empty list needn't be parsed to be JSON.
            checked = F.when((text != "[]") & parsed.isNull(), F.raise_error(F.concat(
                F.lit(f"column '{f.name}' is not JSON: "), F.substring(text, 1, 100)))) \
                .otherwise(text)
            cols.append((parsed if json_as_variant else checked).alias(f.name))
        elif isinstance(f.dataType, DateType):
            cols.append(F.to_date(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    if schemas.ARRIVAL in have:
        cols.append(F.col(schemas.ARRIVAL))
    return df.select(cols)


def reconcile(df: DataFrame, dataset: str, date: str | None = None) -> DataFrame:
    """LOAD-01..04: lake rows as rows of the raw table ``dataset``."""
    nested = _nested(df)
    df = ingest.stamp(normalise_nested(df), date=date)
    return align(default_source(df), schemas.RAW_TABLES[dataset], written=nested)


def reject_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """T13: a NULL key fails the write job (like a primary-key violation) -- checked
    inside the same pass that writes, no extra scan."""
    return df.select([
        F.when(F.col(c).isNull(), F.raise_error(F.lit(f"NULL key column '{c}' in load batch")))
         .otherwise(F.col(c)).alias(c) if c in keys else F.col(c)
        for c in df.columns])


def by_value(df: DataFrame) -> list[Column]:
    """An order by the rows' values alone: of unlike rows of a key, the same one every time."""
    return [F.xxhash64(*[F.to_json(f.name) if isinstance(f.dataType, VariantType)
                         else F.col(f.name) for f in df.schema.fields])]


def _first_to_arrive(batch: DataFrame, keys: Sequence[str], order: Sequence[Column] | None,
                     arrival: str | None, first=first_per_key) -> DataFrame:
    if order is None and arrival is None and schemas.ARRIVAL in batch.columns:
        arrival = schemas.ARRIVAL
    if arrival is not None:
        order = [F.col(arrival).asc_nulls_last()]
    if not order:
        raise ValueError("a load needs the order in which its rows arrived")
    rows = first(batch, keys, [*order, *by_value(batch)])
    return rows if arrival is None else rows.drop(arrival)


#: Rows of so many days are appended from where they are, a file per task and day.
FEW_DAYS = 8


def insert_if_absent(batch: DataFrame, path: str,
                     keys: Sequence[str] = schemas.RAW_KEYS,
                     partition_col: str = schemas.PARTITION_COLUMN,
                     order: Sequence[Column] | None = None, arrival: str | None = None,
                     days: Iterable | None = None, in_place: bool = False) -> str:
    """LOAD-05/SNK-03/JN-06: keyed append that never overwrites.

    1. NULL keys abort the job.
    2. Inside the batch the first row per key wins: by the column ``arrival``, which is not
       stored (a batch of the readers has ``schemas.ARRIVAL``), or by ``order``.  One of them
       must be there.  Rows alike in it are ordered by their values, so re-runs agree.
    3. Against stored rows: the batch's keys alone are counted with those of the day partitions
       it touches.  A load that knows its ``days`` names them, else the batch's keys are staged
       in the scratch folder and their directories tell.  Whole rows move only where a key is
       new; where no day of the batch is stored, there is nothing to compare.
       ``in_place``: rows of such a batch whose key comes once don't move either
       (``dedupe.first_in_place``).
    4. The rest is appended, one directory per day made on demand (SNK-08); of more than
       ``FEW_DAYS`` days, or days not known, rows are brought together by day first.
    """
    spark, keys = batch.sparkSession, list(keys)
    batch = reject_null_keys(batch, keys)
    days = None if days is None else list(days)
    first = _first_to_arrive(batch, keys, order, arrival)
    stored = read_or_none(spark, path, first.schema)
    scratch = []
    if stored is not None:
        of_days = lambda days: stored.where(F.col(partition_col).isin(
            [F.lit(d).cast(first.schema[partition_col].dataType) for d in days]))
        if days is None or not of_days(days).select(partition_col).isEmpty():
            have = _looked(batch, keys)
            if days is None:
                scratch.append(scratch_path(spark, "load"))
                _distinct(have, keys).write.partitionBy(partition_col).parquet(scratch[0])
                have = spark.read.schema(have.schema).parquet(scratch[0])
                # Answered from the directories' names, one per day.
                days = [r[0] for r in have.select(partition_col).distinct().collect()]
            stored = of_days(days)
        else:
            stored = None
        if stored is not None and not stored.select(partition_col).isEmpty():
            scratch.append(scratch_path(spark, "load"))
            _not_stored(have, stored, keys).write.parquet(scratch[-1])
            new = spark.read.schema(have.select(*keys).schema).parquet(scratch[-1])
            first = None if new.isEmpty() else _first_to_arrive(
                batch.join(new, keys, "left_semi"), keys, order, arrival).select(first.columns)
            in_place = False
    if first is not None:
        if in_place:
            first = _first_to_arrive(batch, keys, order, arrival, first_in_place)
        if days is None or len(days) > FEW_DAYS:
            first = first.hint("rebalance", partition_col)
        first.write.mode("append").partitionBy(partition_col).options(**WRITE).parquet(path)
    for at in scratch:
        delete_path(spark, at)
    return path


def _looked(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of a batch's rows.  Every column is looked at, so a row that fails the load (text
    that is not JSON) fails it even where its key is stored."""
    return batch.select(*keys, (by_value(batch)[0] == 0).alias("_looked"))


def _distinct(have: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    return have.groupBy(*keys).agg(F.max("_looked").alias("_looked"), *more)


def _not_stored(have: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys that only the batch has.  Both sides are counted together: no side is
    sorted, as it would be for a join.  Keys with a whole number (the first such) move 64 at a time,
    as the bits of one long for either side; others each for itself."""
    both = have.withColumn("_stored", F.lit(0)).unionByName(stored.select(
        *keys, F.lit(None).cast("boolean").alias("_looked"), F.lit(1).alias("_stored")))
    whole = next((k for k in keys if dict(have.dtypes)[k] in ("int", "bigint")), None)
    if whole is None:
        return _distinct(both, keys, F.max("_stored").alias("_stored")) \
            .where(F.col("_stored") == 0).drop("_stored")
    bit = f"shiftleft(1L, CAST(`{whole}` & 63 AS INT))"
    bits = lambda side: F.expr(f"bit_or(CASE WHEN _stored = {side} THEN {bit} ELSE 0L END)")
    others = [k for k in keys if k != whole]
    groups = _distinct(both.select("*", F.shiftright(F.col(whole).cast("long"), 6).alias("_high")),
                       ["_high", *others], bits(0).alias("_new"), bits(1).alias("_had"))
    only = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i:
                    (F.getbit("_new", i) == 1) & (F.getbit("_had", i) == 0))
    # A key's text may fail the load where it is stored too, so every group is looked at.
    return groups.select("_high", *others, "_looked", F.explode(only).alias("_low")).select(
        *[(F.shiftleft("_high", 6) + F.col("_low")).cast(have.schema[k].dataType).alias(k)
          if k == whole else F.col(k) for k in keys], "_looked")


def conflict_free(batch: DataFrame, table: str, days: Iterable,
                  keys: Sequence[str] = schemas.RAW_KEYS,
                  partition_col: str = schemas.PARTITION_COLUMN,
                  order: Sequence[Column] | None = None, arrival: str | None = None) -> DataFrame:
    """The rows of ``batch`` that a load into the bucketed catalog table ``table`` adds.

    Stored days lie in buckets of the first key, sorted by it, and the batch's first rows are dealt
    the same way, so neither the stored rows nor the join shuffles: only the batch moves."""
    spark, keys = batch.sparkSession, list(keys)
    n = buckets_of(spark, table)
    first = _first_to_arrive(reject_null_keys(batch, keys), keys, order, arrival) \
        .repartition(n, keys[0])
    stored = spark.table(table).where(F.col(partition_col).isin(
        [F.lit(d).cast(first.schema[partition_col].dataType) for d in days]))
    # The only join key is the bucketed one: equality of the others is told as an order, which
    # asks for no partitioning of its own.
    rest = F.to_json(F.struct(*keys[1:])) if len(keys) > 1 else F.lit("")
    have = stored.select(F.col(keys[0]).alias("s_key"), rest.alias("s_rest"))
    new = first.withColumn("b_rest", rest)
    alike = (F.col("s_rest") <= F.col("b_rest")) & (F.col("s_rest") >= F.col("b_rest"))
    return new.join(have.hint("merge"), (F.col(keys[0]) == F.col("s_key")) & alike, "left_anti") \
        .drop("b_rest")


def buckets_of(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return int(next(r["data_type"] for r in rows if r["col_name"] == "Num Buckets"))


def insert_into_buckets(batch: DataFrame, table: str, days: Iterable, **options) -> str:
    """LOAD-05 into a bucketed catalog table (``catalog.register`` with ``buckets``): a file per
    bucket and day, so the next load and the staging dedupe read them as they lie."""
    spark = batch.sparkSession
    new = conflict_free(batch, table, days, **options).select(spark.table(table).columns)
    new.write.mode("append").insertInto(table)
    return table
