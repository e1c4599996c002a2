"""Readers of landed API responses (SRC-01..04), re-aimed from HTTP calls to JSON files.

One JSON document per page (JSON Lines by default, so large landings split across
tasks; ``multi_line=True`` reads one pretty-printed document per file).  Schemas are
explicit; nothing is inferred.  With ``arrival`` a reader adds where each row stood
(``schemas.ARRIVAL``): year and page of the request, file, place of the document in it, place of
the row in the document -- the order in which a client that reads page after page meets them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from snaplake import schemas
from snaplake.operators.dedupe import first_per_key

LIST_DATASETS = ("trending", "popular", "top_rated")
CORRUPT = "_corrupt_record"


# Landing folders may be laid out as ``<dataset>/snapshot_date=D/``; naming the partition
# column in the schema lets a read of the dataset folder carry the day of each document
# (a read of one day's folder leaves it NULL, and the run stamps its date).
DAY = StructField("snapshot_date", DateType())


def _with_day(schema: StructType) -> StructType:
    return StructType(schema.fields + [DAY])


_FILE = "_file"


def _json(spark: SparkSession, path: str, schema: StructType, multi_line: bool) -> DataFrame:
    """Documents of ``path`` with the place they were read from; one that does not parse fails
    the query that reads it."""
    fields = _with_day(schema).fields + [StructField(CORRUPT, StringType())]
    docs = spark.read.schema(StructType(fields)).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", CORRUPT).json(path, multiLine=multi_line)
    failed = F.raise_error(F.concat(F.lit("document does not parse: "),
                                    F.substring(CORRUPT, 1, 100)))
    # Whatever field a reader looks at, it meets the check.
    return docs.select(*[F.when(F.col(CORRUPT).isNotNull(), failed).otherwise(F.col(c)).alias(c)
                         for c in schema.fieldNames()], DAY.name, _file())


def _file() -> Column:
    return F.struct("_metadata.file_path", "_metadata.file_block_start").alias(_FILE)


def _arrival(year: Column | None = None, page: Column | None = None,
             pos: Column | None = None) -> Column:
    """Unknown years and pages come last."""
    part = lambda c, name: F.coalesce(
        c if c is not None else F.lit(None), F.lit(2 ** 31 - 1)).cast("int").alias(name)
    return F.struct(part(year, "year"), part(page, "page"),
                    F.col(f"{_FILE}.file_path").alias("file"),
                    F.col(f"{_FILE}.file_block_start").alias("block"),
                    part(pos, "pos")).alias(schemas.ARRIVAL)


def read_list_pages(spark: SparkSession, path: str, dataset: str,
                    multi_line: bool = False, arrival: bool = False) -> DataFrame:
    """SRC-01: rows under ``results`` of every page; provenance ``data_source='api'``.
    A page that does not parse is an error, as a failed fetch is."""
    if dataset not in LIST_DATASETS:
        raise ValueError(f"Unknown dataset type: {dataset}")
    pages = _json(spark, path, schemas.LIST_PAGE, multi_line)
    movies = pages.select("snapshot_date", "page", _FILE, F.posexplode("results").alias("at", "r")) \
        .select("r.*", "snapshot_date",
                *([_arrival(page=F.col("page"), pos=F.col("at"))] if arrival else []))
    if dataset != "trending":
        movies = movies.drop("media_type")
    return movies.withColumn("data_source", F.lit("api"))


def read_genre_doc(spark: SparkSession, path: str, multi_line: bool = False,
                   arrival: bool = False) -> DataFrame:
    """SRC-02: rows under ``genres`` (id, name)."""
    doc = _json(spark, path, schemas.GENRE_DOC, multi_line)
    return doc.select("snapshot_date", _FILE, F.posexplode("genres").alias("at", "g")) \
        .select("g.id", "g.name", "snapshot_date",
                *([_arrival(pos=F.col("at"))] if arrival else [])) \
        .withColumn("data_source", F.lit("api"))


def read_discover_pages(spark: SparkSession, path: str, max_page: int | None = None,
                        multi_line: bool = False, arrival: bool = False,
                        first=first_per_key) -> DataFrame:
    """SRC-03: all results of each year's pages, read the way the paging loop stops: at the
    first page without results, after the page that reaches ``total_pages``, and -- if the
    client had a page limit -- after page ``max_page``.

    A page landed twice counts once.  A page that does not parse, or that is missing before
    the loop's end, is an error.  The stop point is found on page metadata only (one small
    row per page) and joined back.  ``first``: how a page's repeats are found
    (``dedupe.first_in_place`` leaves pages that came once where they are).
    """
    pages = _json(spark, path, schemas.DISCOVER_PAGE, multi_line)
    request = ["snapshot_date", "release_year"]  # one paging loop per request
    pages = first(pages.where(F.col("page") >= 1), [*request, "page"],
                  [F.coalesce(F.size("results"), F.lit(0)).desc(), F.xxhash64("results")])
    n = F.coalesce(F.size("results"), F.lit(0))
    end = F.col("total_pages") if max_page is None else \
        F.least(F.col("total_pages"), F.lit(max_page))
    meta = pages.select(*request, "page", "total_pages", n.alias("n"), end.alias("end"))
    empty = F.min(F.when(F.col("n") <= 0, F.col("page")))
    ends = F.min(F.when((F.col("n") > 0) & (F.col("page") >= F.col("end")), F.col("page")))
    stops = meta.groupBy(*request).agg(
        empty.alias("empty"), ends.alias("ends"), F.max("end").alias("end"),
        F.collect_set("page").alias("landed"))
    # The last page of the loop, and whether all pages up to it have landed.
    last = F.least(F.coalesce("empty", "ends", "end"), F.coalesce("ends", "empty", "end"))
    landed = F.size(F.filter("landed", lambda p: p <= F.col("last")))
    stops = stops.withColumn("last", last).select(
        *[F.col(c).alias("k_" + c) for c in request],
        F.when(landed < F.col("last"), F.raise_error(F.concat(
            F.lit("pages are missing: year "), F.col("release_year").cast("string"),
            F.lit(" has "), landed.cast("string"), F.lit(" of "), F.col("last").cast("string"))))
        .otherwise(F.col("last")).alias("keep_to"))
    on = [F.col(c).eqNullSafe(F.col("k_" + c)) for c in request]
    kept = pages.join(stops, on).where(F.col("page") <= F.col("keep_to"))
    return kept.select(*request, "page", _FILE, F.posexplode("results").alias("at", "r")).select(
        "r.*", *request, *([_arrival(F.col("release_year"), F.col("page"), F.col("at"))]
                           if arrival else []))


def read_detail_docs(spark: SparkSession, path: str, multi_line: bool = False,
                     arrival: bool = False) -> tuple[DataFrame, DataFrame]:
    """SRC-04: movie detail documents -> (good rows, failed documents).

    A document that does not parse is set aside with its raw text; the others go on,
    as the reference logs and skips a failed fetch."""
    schema = StructType(schemas.DETAIL_DOC.fields + [StructField(CORRUPT, StringType()), DAY])
    docs = spark.read.schema(schema).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", CORRUPT).json(path, multiLine=multi_line)
    good = docs.where(F.col(CORRUPT).isNull())
    good = good.select(*schemas.DETAIL_DOC.fieldNames(), DAY.name, _file()).select(
        *schemas.DETAIL_DOC.fieldNames(), DAY.name, *([_arrival()] if arrival else []))
    # A failed document keeps its raw text; ``id`` rides along (NULL when the text did
    # not parse) because Spark refuses a scan that needs only the corrupt-record column.
    bad = docs.where(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("document"), "id", "snapshot_date",
        F.input_file_name().alias("file"))
    return good, bad
