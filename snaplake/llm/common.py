"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import functools
import tempfile
import zipfile
import zlib
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from snaplake.session import scratch_path
from snaplake.sinks.lake import delete_path

_SHIPPED: set[str] = set()
#: A word: a run of anything but ASCII white space (as ``bytes.split()`` in Python).
WORD = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once: their tasks import it, and they
    needn't have it installed."""
    import snaplake
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(snaplake.__file__).resolve().parent
    to = Path(tempfile.mkdtemp(prefix="snaplake-package-")) / "snaplake_package.zip"
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(str(to))  # the driver serves it to the executors
    _SHIPPED.add(sc.applicationId)


def shipped(query: Callable) -> Callable:
    """``query(spark, ...)`` after ``ship(spark)``."""
    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        ship(spark)
        return query(spark, *args)
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the plan starts anew at
    files that survive lost executors.  The folder goes when the session ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete what ``cut`` wrote, once nothing reads it any more."""
    delete_path(df.sparkSession, df.cut_path)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null id: the empty text)."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % n).cast("int")


def fold_of(doc_id, n: int) -> int:
    """``fold`` in Python."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def mod_sample(df: DataFrame, key: Column, bound: int, seed: int) -> DataFrame:
    """About ``bound`` rows of ``df`` by a hash of ``key`` (all, if there are no more): the
    same rows on every run, chosen without a sort."""
    n = df.count()
    if n <= bound:
        return df
    return df.filter(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 32))
                     < int((1 << 32) * bound / n))


def own_columns(df: DataFrame, prefix: str, *taken: str) -> list[str]:
    """Names starting with ``prefix`` that none of ``df``'s columns has (case ignored)."""
    have = {c.lower() for c in df.columns}
    out = []
    for t in taken:
        name = f"{prefix}{t}"
        while name.lower() in have:
            name = "_" + name
        have.add(name.lower())
        out.append(name)
    return out


def row_hash(df: DataFrame, seed: int = 0) -> Column:
    """A hash of all columns of a row."""
    nested = (ArrayType, MapType, StructType, VariantType)
    return F.xxhash64(*[F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, nested)
                        else F.col(f"`{f.name}`") for f in df.schema.fields], F.lit(seed))
