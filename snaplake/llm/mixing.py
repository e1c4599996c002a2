"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only).

Every document gets the key ``u ** (1 / w)``, kept as its logarithm ``ln(u) / w``: ``u`` is a uniform
number hashed from its id and text, ``w`` its quality weight.  Within a source documents follow each
other by falling key, and a prefix sum of their sizes meets the source's budget.  A target above
the source's own size takes whole epochs first; only the rest is selected by key.

A document too large for what is left of the budget ends the prefix; the documents behind it that
still fit are summed up again in the same order, until none fits.  Then one more is taken if that
comes nearer to the budget.

The prefix sums never put one source into one task: rows are spread by sorted ranges of source and
key (by quantiles, however the keys lie), ranges are summed first, and rows are ordered inside one
range of one source.  The sources' own order is found the same way.  Equal rows (all columns) are
counted once and carried as a number of copies, so a row repeated over a third of the table is one
row there.

Defined cases: null text has size 0 and is taken only with whole epochs; a null source is a
source of its own, last in order; equal keys are ordered by id, size, text hash and a hash of the
other columns; rows unlike in any column are rows of their own; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import WORD, cut, own_columns, row_hash

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = 20240
_ROW_BITS = 33


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Default weight of a document: the share of its characters that are lower-case letters
    or blanks, squared (0.05 at least): shouting, symbols and tables come later."""
    plain = F.length(F.regexp_replace(text, r"[\p{Ll} ]+", ""))
    share = 1.0 - plain / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(0.05), F.coalesce(share * share, F.lit(0.05)))


def spread(rows: DataFrame, order: list[Column], name: str, ranges: int | None = None) -> DataFrame:
    """``rows`` spread by ranges of ``order`` and written, with ``at``, a number that grows in this
    order, and ``b``, their range."""
    r = rows.repartitionByRange(*([ranges] if ranges else []), *order) \
        .sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return cut(r, name).withColumn("b", F.shiftright("at", _ROW_BITS).cast("int"))


def _before(rows: DataFrame, value: Column, group: str | None) -> DataFrame:
    """``rows`` (of ``spread``) with ``before``, the sum of ``value`` over earlier rows of their
    group: over earlier ranges, and over earlier rows of their own range."""
    groups = [group] if group else []
    per = rows.groupBy(*groups, "b").agg(F.sum(value).alias("words"))
    earlier = Window.partitionBy(*groups).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*[F.col(g).alias(f"o_{g}") for g in groups], F.col("b").alias("o_b"),
                     F.sum("words").over(earlier).alias("offset"))
    inside = Window.partitionBy(*groups, "b").orderBy("at").rowsBetween(
        Window.unboundedPreceding, -1)
    same = F.col("b") == F.col("o_b")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"o_{g}"))
    return rows.withColumn("inside", F.sum(value).over(inside)).join(per, same) \
        .withColumn("before", F.coalesce("inside", F.lit(0)) + F.coalesce("offset", F.lit(0))) \
        .drop("inside", "offset", "o_b", *[f"o_{g}" for g in groups])


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same with ``target`` in words.

    Sources by code point (null last) get the weights in turn and share the sum of all sizes;
    a target stops at ``max_epochs`` times its source's size and the excess is shared again by
    weight.  That is one level ``x`` with ``sum(min(cap, weight * x)) = total``: with sources
    by rising cap/weight, ``x`` is the first ``(total - caps before) / weights from here`` that
    the source's own cap/weight doesn't fall short of.
    """
    in_order = spread(sizes, [F.col("source").asc_nulls_last()], "mix-sources")
    turn = _before(in_order, F.lit(1), None).select(
        "source", "source_size", (F.col("before") % len(weights)).alias("turn"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("turn") + 1).cast("int"))
    s = turn.withColumn("w", w).withColumn("cap", F.col("source_size").cast("double") * max_epochs)
    s = spread(s, [F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()], "mix-ratios")
    total = s.agg(F.sum("source_size").alias("words"), F.sum("w").alias("w")).first()
    if total["words"] is None:
        return s.select("source", "source_size", F.col("cap").alias("target"))
    caps = _before(s, F.col("cap"), None).select("at", F.col("before").alias("caps"))
    ratio = _before(s, F.col("w"), None).join(caps, "at")
    x = (F.lit(float(total["words"])) - F.col("caps")) / (F.lit(total["w"]) - F.col("before"))
    first = ratio.withColumn("x", x).filter(F.col("x") <= F.col("cap") / F.col("w")) \
        .agg(F.min(F.struct("at", "x")).alias("first")).first()["first"]
    target = F.col("cap") if first is None else F.least("cap", F.col("w") * F.lit(first["x"]))
    return s.select("source", "source_size", target.alias("target"))


def _keyed(docs: DataFrame, weight: Column | None) -> DataFrame:
    text = F.col("text")
    h = F.xxhash64(F.col("doc_id"), text, F.lit(SEED))
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(1 << 53)
    w = quality_weight(text) if weight is None else weight
    return docs.select(
        F.col("doc_id"), F.col("source"), word_count(text).alias("size"), h.alias("h"),
        row_hash(docs, SEED).alias("row"),
        (F.log(u) / F.greatest(F.coalesce(w, F.lit(0.05)), F.lit(1e-6))).alias("key"))


def _fitting(rows: DataFrame, budget: str) -> DataFrame:
    """``rows`` (n equal ones each) with ``fit``: how many of them the prefix sum of their source
    takes within ``budget``."""
    r = _before(rows, F.col("n") * F.col("size"), "source")
    some = F.floor((F.col(budget) - F.col("before")) / F.col("size")).cast("long")
    fit = F.when(F.col("size") > 0, F.least("n", F.greatest(F.lit(0), some))).otherwise(0)
    return r.withColumn("fit", fit.cast("long")).drop("before")


def _with_gaps(rows: DataFrame, picked: DataFrame) -> DataFrame:
    """Untaken rows with what is left of their source's ``rest`` behind the rows of ``picked``."""
    gaps = picked.groupBy("source").agg(
        (F.max("rest") - F.sum(F.col("fit") * F.col("size"))).alias("gap")) \
        .withColumnRenamed("source", "g_source")
    r = rows.withColumn("n", F.col("n") - F.col("fit")).filter((F.col("n") > 0) & (F.col("size") > 0))
    return r.drop("fit").join(gaps, F.col("source").eqNullSafe(F.col("g_source"))).drop("g_source")


def plan(docs: DataFrame, weight: Column | None = None,
         weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
         ranges: int | None = None) -> DataFrame:
    """One row per distinct row of ``docs`` (hash ``row``): doc_id, source, n equal rows, size,
    source_size, target, epochs (copies that each of the n rows gives), and extra (how many
    of the n rows give one copy more).  ``ranges``: the number of ranges (None: Spark's)."""
    rows = _keyed(docs, weight).groupBy("doc_id", "source", "size", "h", "row", "key") \
        .agg(F.count("*").alias("n"))
    order = [F.col("source").asc_nulls_last(), F.col("key").desc(),
             F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("h"), F.col("row")]
    rows = spread(rows, order, "mix-keys", ranges)
    sizes = rows.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).cast("long").alias("source_size"))
    sources = source_targets(sizes, weights, max_epochs).select(
        F.col("source").alias("s_source"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).cast("long").alias("epochs")) \
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    rows = rows.join(sources, rows["source"].eqNullSafe(sources["s_source"])).drop("s_source")
    rows = cut(_fitting(rows, "rest"), "mix-fit")
    # Rows behind the first that doesn't fit, as long as some fit into what is left.
    picks = rows.select("at", "fit")
    spare = _with_gaps(rows, rows)
    while True:
        small = cut(spare.filter(F.col("size") <= F.col("gap"))
                    .drop("rest").withColumnRenamed("gap", "rest"), "mix-small")
        if small.isEmpty():
            break
        small = cut(_fitting(small, "rest"), "mix-fit")
        picks = picks.unionByName(small.select("at", "fit"))
        spare = _with_gaps(small, small)
    # None fits: the one row that comes nearest to what is left, if it comes nearer than none.
    taken = picks.groupBy("at").agg(F.sum("fit").alias("fit"))
    rows = cut(rows.drop("fit").join(taken, "at"), "mix-taken")
    spare = _with_gaps(rows, rows).filter(F.abs(F.col("size") - F.col("gap")) < F.col("gap"))
    last = spare.groupBy("source").agg(F.min(F.struct(
        F.abs(F.col("size") - F.col("gap")).alias("off"), F.col("at"))).alias("pick")) \
        .select(F.col("pick.at").alias("l_at"), F.lit(1).cast("long").alias("more"))
    rows = rows.join(last, F.col("at") == F.col("l_at"), "left")
    extra = F.col("fit") + F.coalesce("more", F.lit(0))
    return rows.select("doc_id", "source", "row", "n", "size", "source_size", "target", "epochs",
                       extra.alias("extra"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """A row per document: doc_id, source, size, source_size, target, taken (words)."""
    p = plan(docs, **options)
    i = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("i")
    return p.select("*", i).select(
        "doc_id", "source", "size", "source_size", "target",
        ((F.col("epochs") + (F.col("i") <= F.col("extra")).cast("long")) * F.col("size"))
        .alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture takes it (all columns kept)."""
    p = plan(docs, **options)
    row, copies, key = own_columns(docs, "mix_", "row", "copies", "key")
    total = (F.col("n") * F.col("epochs") + F.col("extra")).cast("int")
    p = p.select(F.col("row").alias(key), total.alias(copies)).filter(F.col(copies) > 0)
    # Equal rows become one before the join, so a repeated row isn't a hot join key; the join
    # has the grouping's key and shuffles the texts no second time.
    one = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
                      row_hash(docs, SEED).alias(key)).groupBy(key).agg(F.first(row).alias(row))
    j = one.join(p.hint("merge"), key)
    j = j.select(row, F.explode(F.sequence(F.lit(1), F.col(copies))).alias("i"))
    return j.select(f"{row}.*")
