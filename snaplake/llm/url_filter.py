"""URL filter by host-suffix and path-prefix expressions (DataFrame functions only).

A rule is (host, path, action).  It fits a URL whose host is the rule's host or a subdomain of
it and whose path starts with the rule's path.  Each distinct URL is expanded into all
``suffix + path prefix`` expressions that a rule of the given depths and lengths could have;
expressions meet rules by an equi-join on the first ``PREFIX_HEX`` hex digits of their SHA-256,
full digests confirm, and the longest rule wins (then the longer host, then block).

Defined cases: null URLs and URLs without ``://`` have an empty host and path, fit no rule and
get the default verdict; null parts of rules make the rule fit nothing; repeated rules count
once; an empty rule table gives every URL the default; repeated URLs are judged once and joined
back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_HEX = 8
DEFAULT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.
    Path: from there up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    before_query = F.regexp_extract(rest, r"^([^?#]*)", 1)
    host = F.regexp_extract(before_query, r"^([^/]*)", 1)
    path = F.substr(before_query, F.length(host) + 1)
    return F.translate(host, _UPPER, _LOWER), path


def _digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def _shapes(rules: DataFrame) -> tuple[int, list[int]]:
    """The most labels of a rule's host and the lengths that rules' paths have: as many
    values as there are different path lengths, whatever the number of rules."""
    row = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("labels"),
                    F.sort_array(F.collect_set(F.length("path"))).alias("lengths")).first()
    return row["labels"] or 0, list(row["lengths"] or [])


def expressions(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """All ``suffix + path prefix`` strings with up to ``labels`` labels and those lengths."""
    parts = F.split(host, r"\.")
    depth = F.least(F.size(parts), F.lit(labels))
    suffixes = F.transform(F.sequence(F.lit(1), depth),
                           lambda k: F.array_join(F.slice(parts, -k, k), "."))
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path)),
        lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(
        prefixes, lambda p: F.concat(s, p))))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """(page_id, url) against (host, path, action) -> page_id, host, path, rule, verdict."""
    rules = rules.select("host", "path", "action").dropna().distinct()
    labels, lengths = _shapes(rules)
    host, path = host_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    if not lengths:
        return parsed.withColumn("rule", F.lit(None).cast("string")) \
            .withColumn("verdict", F.lit(default))
    digest = _digest(F.concat("host", "path"))
    book = rules.select(
        F.concat("host", "path").alias("rule"), F.length("host").alias("host_length"), "action",
        digest.alias("digest"), F.substring(digest, 1, PREFIX_HEX).alias("prefix"))
    book = book.select(*[F.col(c).alias(f"r_{c}") for c in book.columns])
    places = parsed.filter(F.col("host") != "").select("host", "path").distinct()
    wanted = places.select("host", "path", F.explode(expressions(
        F.col("host"), F.col("path"), labels, lengths)).alias("expression"))
    wanted = wanted.withColumn("digest", _digest(F.col("expression")))
    hits = wanted.join(book, F.substring("digest", 1, PREFIX_HEX) == F.col("r_prefix")) \
        .filter(F.col("digest") == F.col("r_digest"))
    best = hits.groupBy("host", "path").agg(F.max(F.struct(
        F.length("r_rule").alias("length"), F.col("r_host_length").alias("host_length"),
        (F.col("r_action") == "block").alias("blocks"), F.col("r_rule").alias("rule"),
        F.col("r_action").alias("action"))).alias("best"))
    return parsed.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.action"), F.lit(default)).alias("verdict"))
