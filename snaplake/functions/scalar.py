"""Column-level helpers.  All of them are built-in Spark expressions (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snaplake import schemas

# Fixed value: the image host prefix the dashboard shows posters from.
POSTER_PREFIX = "https://image.tmdb.org/t/p/w200"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def poster_url(poster_path="poster_path") -> Column:
    """CAS-01/STR-01: prefix || path, NULL when the path is NULL (concat propagates NULL)."""
    p = _c(poster_path)
    return F.when(p.isNotNull(), F.concat(F.lit(POSTER_PREFIX), p))


def text_to_date(c="release_date") -> Column:
    """CST-01: text -> DATE.  Unparseable text ('' included) becomes NULL (trap T4)."""
    return F.try_to_date(_c(c), "yyyy-MM-dd")


def date_from(c, first: str) -> Column:
    """FLT-03: ``c >= DATE first``; NULL dates fail the predicate and drop."""
    return _c(c) >= F.lit(first).cast("date")


def parse_genre_ids(c="genre_ids") -> Column:
    """CST-02/JSN-04: JSON text ``[28, 12]`` -> array<int>.  Non-arrays give NULL (T10)."""
    return F.from_json(_c(c), schemas.GENRE_IDS)


def parse_genre_objects(c="genres") -> Column:
    """JSN-03: JSON text ``[{"id":..,"name":..}]`` -> array<struct<id:int,name:string>>."""
    return F.from_json(_c(c), schemas.GENRE_OBJECTS)


def genre_ids_of(objects="raw_genres") -> Column:
    """JSN-02/JSN-05: the ``id`` of every element; an empty or NULL array gives NULL.
    Evaluated per row, so the reference's correlated sub-select needs no shuffle."""
    a = _c(objects)
    return F.when(F.size(a) > 0, F.transform(a, lambda g: g["id"]))


def genre_names_joined(objects="raw_genres", sep: str = ", ") -> Column:
    """AGG-06: ``string_agg(name, ', ')`` over one row's array, in array order.
    NULL names are skipped; no non-NULL name at all gives NULL (trap T8)."""
    names = F.filter(F.transform(_c(objects), lambda g: g["name"]), lambda n: n.isNotNull())
    return F.when(F.size(names) > 0, F.array_join(names, sep))


def share_percent(part, total, scale: int = 2) -> Column:
    """MTH-01/02: ROUND(part::numeric / total * 100, 2) in exact decimal arithmetic,
    half away from zero."""
    num = _c(part).cast("decimal(20,0)")
    den = _c(total).cast("decimal(20,0)")
    return F.round(num / den * F.lit(100), scale)


def partition_name(dataset: str, date_col="snapshot_date") -> Column:
    """STR-02: ``<dataset>_YYYY_MM_DD``, the name of a day partition."""
    return F.concat(F.lit(dataset + "_"),
                    F.replace(F.date_format(_c(date_col), "yyyy-MM-dd"), F.lit("-"), F.lit("_")))


def next_day(date_col="snapshot_date") -> Column:
    """DAT-03: exclusive upper bound of a day partition."""
    return F.date_add(_c(date_col), 1)


def source_priority(source="source") -> Column:
    """CAS-03: api rows sort before discover rows."""
    return F.when(_c(source) == "api", F.lit(1)).otherwise(F.lit(2))
