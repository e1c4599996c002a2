"""Lake snapshots and the named raw source registry (SRC-05, SRC-06)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snaplake import schemas
from snaplake.sinks.lake import dataset_path, raw_path


def read_or_none(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """A stored table, or None if nothing was ever written there; any other failure is one."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    df = read_or_none(spark, path, schema)
    return empty(spark, schema) if df is None else df


def empty(spark: SparkSession, schema) -> DataFrame:
    """No rows of ``schema``, without a Python worker."""
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return spark.range(0).select([F.lit(None).cast(f.dataType).alias(f.name)
                                  for f in fields.fields])


def read_snapshot(spark: SparkSession, root: str, dataset: str, date: str,
                  schema=None) -> DataFrame:
    """SRC-05: one day of one lake dataset; the day filter prunes to one directory."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(dataset_path(root, dataset)) \
        .where(F.col("snapshot_date") == F.lit(date).cast("date"))


def register_sources(spark: SparkSession, root: str,
                     prefix: str = "raw__") -> dict[str, DataFrame]:
    """SRC-06: the six raw tables as named views ``raw__<table>``.  A table never
    loaded yet (genres before the first daily run) is registered empty."""
    out = {}
    for name, schema in schemas.RAW_TABLES.items():
        read_or_empty(spark, raw_path(root, name), schema).createOrReplaceTempView(prefix + name)
        out[name] = spark.table(prefix + name)
    return out
