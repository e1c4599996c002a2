"""Ingest transforms (ING-01..07): choose ids, pick details, shape discover rows.

All of them stay DataFrames: the candidate id set is never collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake import schemas
from snaplake.operators.dedupe import top_n_by_value

PAGE_SIZE = 20
#: So many bitmaps of 4 KB go to every task (33 MB, 268 million close ids); above, documents move.
FEW_BITMAPS = 8192
DETAIL_NESTED = ("genres", "production_companies", "production_countries", "spoken_languages")
DISCOVER_FIELDS = ("id", "title", "genre_ids", "popularity", "vote_average", "vote_count",
                   "release_date")


def candidate_ids(*lists: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """ING-01/SET-03: distinct union of the ids of several movie lists."""
    cols = list(keys)
    out = lists[0].select(*cols)
    for d in lists[1:]:
        out = out.unionByName(d.select(*cols))
    if len(cols) > 1 or dict(out.dtypes)[cols[0]] not in ("int", "bigint"):
        return out.distinct()
    # Whole numbers are told apart 64 at a time, as the bits of one long.
    key, kind = F.col(cols[0]), out.schema[cols[0]].dataType
    bits = out.groupBy(F.shiftright(key.cast("long"), 6).alias("_high")) \
        .agg(F.expr(f"bit_or(shiftleft(1L, CAST(`{cols[0]}` & 63 AS INT)))").alias("_bits"))
    low = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit("_bits", i) == 1)
    return bits.select("_high", F.explode_outer(low).alias("_low")).select(
        (F.shiftleft("_high", 6) + F.col("_low")).cast(kind).alias(cols[0]))


def details_for(ids: DataFrame, docs: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """ING-02/JN-07: detail documents of exactly the candidate ids (semi join: a doc is
    kept once however many lists named it; ids without a doc simply drop out).

    Whole numbers are joined as bitmaps of 32,768 ids: of close ids they are small enough to go
    to the documents, which are far wider and then needn't move.  They are counted at once: whether
    they are few must be known before the documents are dealt."""
    keys = list(keys)
    if len(keys) > 1 or any(dict(d.dtypes)[keys[0]] not in ("int", "bigint") for d in (ids, docs)):
        return docs.join(ids, keys, "left_semi")
    key = F.col(keys[0])
    bitmaps = ids.where(key.isNotNull()) \
        .groupBy(F.bitmap_bucket_number(key).alias("_bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("_ids"))
    if bitmaps.count() <= FEW_BITMAPS:
        bitmaps = F.broadcast(bitmaps)
    at = F.bitmap_bit_position(key).cast("int")
    byte = F.conv(F.hex(F.substring("_ids", (at / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    return docs.join(bitmaps, (F.bitmap_bucket_number(key) == F.col("_bucket"))
                     & (F.getbit(byte, at % 8) == 1), "left_semi")


def discover_top(df: DataFrame, max_pages: int | None = None, page_size: int = PAGE_SIZE,
                 year_col: str = "release_year",
                 request_cols: Sequence[str] = ()) -> DataFrame:
    """ING-03: what a discover query returns per release year (and per request, e.g.
    snapshot date) -- popularity descending, at most ``max_pages * page_size`` rows if
    the API's client was given a page limit, all rows otherwise.
    Ties go to the smaller id; unknown popularity ranks last.  A quantile pre-filter
    keeps the final per-year window small however many rows a year holds."""
    if max_pages is None:
        return df
    return top_n_by_value(df, [year_col, *request_cols], "popularity", "id",
                          max_pages * page_size)


def shape_discover(movies: DataFrame, year_col: str = "release_year") -> DataFrame:
    """ING-04/ING-07: the seven kept fields (absent ones NULL), the request's year,
    ``data_source = 'discover'``, and the arrival if there is one."""
    have = set(movies.columns)
    arrival = [schemas.ARRIVAL] if schemas.ARRIVAL in have else []
    cols = [F.col(c) if c in have else F.lit(None).alias(c) for c in DISCOVER_FIELDS]
    return movies.select(*cols, F.col(year_col).cast("int").alias("release_year"),
                         F.lit("discover").alias("data_source"), *arrival)


def jsonify(df: DataFrame, cols: Sequence[str] = DETAIL_NESTED) -> DataFrame:
    """ING-06/JSN-06: nested detail fields become JSON text; an absent value gives '[]'.
    Fields that the reader kept as text already are JSON."""
    out, types = df, dict(df.dtypes)
    for c in cols:
        text = F.lit(None) if c not in types else \
            F.col(c) if types[c] == "string" else F.to_json(F.col(c))
        out = out.withColumn(c, F.coalesce(text, F.lit("[]")))
    return out


def stamp(df: DataFrame, source: str | None = None, date: str | None = None) -> DataFrame:
    """ING-07/LOAD-02: provenance ``data_source`` and/or the run's ``snapshot_date``."""
    out = df
    if source is not None:
        out = out.withColumn("data_source", F.lit(source))
    if date is not None:
        out = out.withColumn("snapshot_date", F.lit(date).cast("date"))
    return out
