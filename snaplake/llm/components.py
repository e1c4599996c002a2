"""Connected components by alternating stars (large star, then small star), on DataFrames.

Each round joins every edge with the smallest neighbour of its end and writes the new edges to
the shared folder; nothing is collected and no node's neighbours meet in one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import cut, release


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u") \
        .select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter(F.col("v") != F.col("m")) \
        .select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links between longs -> (node, root): every linked node but the smallest of its
    component, with that smallest one.  Links to itself are ignored."""
    e = cut(edges.select("a", "b").filter(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
            "components")
    state = _state(e)
    while state[0]:
        new = cut(_small_star(_large_star(e).distinct()).distinct(), "components")
        release(e)
        e, last, state = new, state, _state(new)
        if state == last:
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
