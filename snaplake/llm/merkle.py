"""Merkle manifest of a dataset by slot pivots.

Every row is a leaf: the sha256 of its fields, each written as its length in bytes, a colon and
its value (``-`` for null).  The leaves of a group (a language) follow each other by id; runs of
``FANOUT`` nodes become their parent, the hash of their digests joined, until one node, the
group's subroot, remains.  Subroots, in order of their group, grow into the root the same way.

Building goes ``LEVELS`` levels at a time: conditional aggregates spread the descendants of a
node over ``FANOUT ** LEVELS`` slot columns, and joining neighbouring columns and hashing them
gives the levels in between.  On the way down each slot gets its siblings from the same columns,
its own slot left out (what stands before it and what stands behind it), put before those of its
ancestors.  The leaves' rows ride in the slots, so no join meets a row of the dataset again: a
row is shuffled once to find its place and once to the pivot, and a node's siblings travel with
one row in ``FANOUT ** LEVELS``.

Places are found by ranges: rows are spread by sorted ranges and numbered inside them, and a
small table with one row a range and group adds what stands before.  No group meets in one task.

Defined cases: nulls in any field have a leaf of their own; null ids come first, equal ids follow
each other by leaf; equal rows get one place each; a group of one row is its own subroot, a
single group's subroot is the root, and a leaf without siblings has the proof of the empty text;
an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import cut

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
#: Levels that one pivot spans: its slot columns are FANOUT ** LEVELS.
LEVELS = 4
SEED = 13
_ROW_BITS = 33
_SIDES = "array<struct<before:string,behind:string>>"


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A field as its length in bytes, a colon and its value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """Digest of a row's fields; ``changed`` replaces some of them."""
    return _sha(F.concat(*[field(changed.get(c, F.col(c))) for c in FIELDS]))


def placed(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0) within their group by ``order`` (nulls first) and ``size``,
    the group's number of rows.  Equal rows are spread over ranges at random."""
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    salted = rows.withColumn("salt", F.rand(SEED))
    spread = salted.repartitionByRange(*keys, F.col("salt")) \
        .sortWithinPartitions(*keys, F.col("salt")).drop("salt") \
        .withColumn("at", F.monotonically_increasing_id())
    spread = cut(spread, "merkle-placed").withColumn("part", F.shiftright("at", _ROW_BITS))
    runs = spread.groupBy(*group, "part").agg(F.count("*").alias("n"), F.min("at").alias("start"))
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*[F.col(g).alias(f"r_{g}") for g in group], F.col("part").alias("r_part"),
                       (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("start"))
                       .alias("shift"), F.sum("n").over(Window.partitionBy(*group)).alias("size"))
    same = F.col("part") == F.col("r_part")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"r_{g}"))
    return spread.join(runs, same).withColumn("pos", F.col("at") + F.col("shift")) \
        .select(*rows.columns, "pos", "size")


def _joined(cells: list[str]) -> str:
    return f"concat('', {', '.join(f"coalesce({c}, '')" for c in cells)})" if cells else "''"


def pivot(nodes: DataFrame, group: list[str], fanout: int = FANOUT, levels: int = LEVELS
          ) -> DataFrame:
    """``nodes`` (group, pos, size: nodes of the group at their level, h, carried) -> a row for
    each of their ancestors ``levels`` higher, or for the top of their group: group, pos, size,
    h, and ``slots``, an array of (h, carried, sides): the siblings on the way up, lowest first.

    ``size`` shrinks by the fanout at every level, and a level is left out once it is 1.
    """
    width = fanout ** levels
    slot = f"pos % {width}"
    wide = nodes.groupBy(*group, "size", F.expr(f"pos div {width}").alias("parent")).agg(
        *[F.expr(f"max(CASE WHEN {slot} = {i} THEN struct(h, carried) END)").alias(f"c{i}")
          for i in range(width)])
    # n{k}: nodes of the group k levels up; h{k}_{i}: the i-th descendant k levels up.  Each
    # level has columns of its own, so none is computed again inside the next.
    wide = wide.selectExpr("*", "size AS n0", *[f"c{i}.h AS h0_{i}" for i in range(width)])
    for k in range(1, levels + 1):
        below = [f"h{k - 1}_{i}" for i in range(fanout ** (levels - k + 1))]
        made = []
        for i in range(0, len(below), fanout):
            run = below[i:i + fanout]
            made.append(f"CASE WHEN n{k - 1} > 1 AND {run[0]} IS NOT NULL "
                        f"THEN sha2(CAST({_joined(run)} AS BINARY), 256) ELSE {run[0]} END "
                        f"AS h{k}_{i // fanout}")
        wide = wide.selectExpr(
            "*", f"(n{k - 1} + {fanout - 1}) div {fanout} AS n{k}", *made)

    def sides(i: int) -> str:
        steps = []
        for k in range(levels):
            own, first = i // fanout ** k, i // fanout ** (k + 1) * fanout
            cells = [(j, f"h{k}_{j}") for j in range(first, first + fanout)]
            steps.append(f"CASE WHEN n{k} > 1 THEN named_struct("
                         f"'before', {_joined([c for j, c in cells if j < own])}, "
                         f"'behind', {_joined([c for j, c in cells if j > own])}) END")
        return f"filter(array({', '.join(steps)}), s -> s IS NOT NULL)"

    slots = ", ".join(f"CASE WHEN h0_{i} IS NOT NULL THEN named_struct('slot', {i}, 'h', h0_{i}, "
                      f"'carried', c{i}.carried, 'sides', {sides(i)}) END" for i in range(width))
    return wide.selectExpr(*[f"`{g}`" for g in group], "parent AS pos", f"n{levels} AS size",
                           f"h{levels}_0 AS h", f"filter(array({slots}), s -> s IS NOT NULL) AS slots")


def tree(nodes: DataFrame, group: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Pivots from the bottom to one node a group: the written tables, lowest first, and the
    groups' tops (group, h)."""
    written = []
    while True:
        rows = cut(pivot(nodes, group), "merkle-level")
        written.append(rows)
        if rows.filter("size > 1").isEmpty():
            return written, rows.select(*group, "h")
        nodes = rows.select(*group, "pos", "size", "h", F.lit(None).cast("string").alias("carried"))


def downward(written: list[DataFrame], above: DataFrame, group: list[str]) -> DataFrame:
    """Every node of the lowest level: group, h, carried, top, and ``proof``, its siblings from
    its own level to the root's.  ``above``: (group, proof, top) of the groups' tops."""
    g = [F.col(c).alias(f"a_{c}") for c in group]
    proofs = above.select(*g, F.lit(0).cast("long").alias("a_pos"), F.col("proof").alias("higher"),
                          "top")
    for depth, rows in reversed(list(enumerate(written))):
        same = F.col("pos") == F.col("a_pos")
        for c in group:
            same = same & F.col(c).eqNullSafe(F.col(f"a_{c}"))
        found = rows.join(proofs, same).select(
            *group, "pos", "higher", "top", F.explode("slots").alias("s"))
        found = found.select(
            *group, (F.col("pos") * FANOUT ** LEVELS + F.col("s.slot")).alias("pos"),
            F.col("s.h").alias("h"), F.col("s.carried").alias("carried"),
            F.concat("s.sides", "higher").alias("proof"), "top")
        if depth:
            proofs = found.select(*g, F.col("pos").alias("a_pos"), F.col("proof").alias("higher"),
                                  "top")
    return found.select(*group, "h", "carried", "proof", "top")


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, start, lambda h, s: _sha(F.concat(s["before"], h, s["behind"])))


def manifest(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, leaf, subroot, root, and proof, its siblings bottom up (what
    stands before and behind its ancestor at each level)."""
    return _manifest(docs, F.lit(None).cast("string")).drop("lang", "other")


def _manifest(docs: DataFrame, other_leaf: Column) -> DataFrame:
    leaves = docs.select("doc_id", "lang", leaf().alias("h"), other_leaf.alias("other"))
    nodes = placed(leaves, ["lang"], ["doc_id", "h"]).select(
        "lang", "pos", "size", "h", F.struct("doc_id", "other").alias("carried"))
    written, tops = tree(nodes, ["lang"])
    # The subroots are a group of their own, placed by their language.
    one = tops.withColumn("g", F.lit(0))
    upper = placed(one, ["g"], ["lang"]).select(
        "g", "pos", "size", "h", F.struct("lang").alias("carried"))
    upper_written, roots = tree(upper, ["g"])
    start = roots.select("g", F.array().cast(_SIDES).alias("proof"), F.col("h").alias("top"))
    subroots = cut(downward(upper_written, start, ["g"]).select(
        F.col("carried.lang").alias("lang"), "proof",
        F.struct(F.col("h").alias("subroot"), F.col("top").alias("root")).alias("top")),
        "merkle-subroots")
    return downward(written, subroots, ["lang"]).select(
        F.col("carried.doc_id").alias("doc_id"), "lang", F.col("h").alias("leaf"), "top.subroot",
        "top.root", "proof", F.col("carried.other").alias("other"))


def verified(docs: DataFrame, is_tampered: Column, **changed: Column) -> DataFrame:
    """The manifest of ``docs``, and each row checked against it after ``changed`` replaced fields
    of the rows for which ``is_tampered`` is true: doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified."""
    m = _manifest(docs, F.when(is_tampered, leaf(**changed)))
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["before"], s["behind"])), "")
    m = m.select("doc_id", "leaf", "subroot", "root", _sha(siblings).alias("proof_sha256"),
                 fold(F.coalesce("other", "leaf"), F.col("proof")).alias("folded_root"))
    return m.withColumn("verified", F.col("folded_root") == F.col("root"))
