"""WIN-01/WIN-02/FLT-06: keep the first row per key.

``row_number() ... = 1`` is planned by Spark as a *partial* WindowGroupLimit before the
shuffle (each map task keeps one row per key) and a final one after it, so even a key
holding a third of all rows sends at most one row per map task across the network.
Every order passed in should be total; callers append tie-breaks (trap T2).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaplake.session import scratch_path

_RN = "__rn"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


#: Above so many groups of keys with repeats, ``first_in_place`` moves all rows at once.
FEW = 100_000


def first_in_place(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   few: int = FEW) -> DataFrame:
    """``first_per_key`` of rows that can be read twice and whose keys seldom repeat: a first pass,
    run at once, counts the keys alone, and only rows that may share theirs move.

    Keys are counted in groups: whole numbers by 64 as the bits of one long (the first such key),
    else each for itself.  A group with more rows than keys goes through the window, the others
    stay where they are.  The groups that go are kept in the scratch folder; if they are more than
    ``few``, everything goes."""
    whole = next((k for k in keys if dict(df.dtypes)[k] in ("int", "bigint")), None)
    group = [F.shiftright(F.col(k).cast("long"), 6) if k == whole else F.col(k) for k in keys]
    names = [f"__group_{i}" for i in range(len(group))]
    n, held = F.count(F.lit(1)), F.lit(1)
    if whole is not None:
        bit = F.expr(f"shiftleft(1L, CAST(`{whole}` & 63 AS INT))")
        held = F.coalesce(F.bit_count(F.bit_or(bit)), F.lit(0))
    path = scratch_path(df.sparkSession, "repeated")
    repeated = df.groupBy(*[g.alias(c) for g, c in zip(group, names)]) \
        .agg(n.alias("_n"), held.alias("_held")).where(F.col("_n") > F.col("_held")).select(*names)
    repeated.write.parquet(path)
    repeated = df.sparkSession.read.schema(repeated.schema).parquet(path)
    found = repeated.count()
    if found == 0:
        return df
    if found > few:
        return first_per_key(df, keys, order)
    same = [g.eqNullSafe(F.col(c)) for g, c in zip(group, names)]
    small = F.broadcast(repeated)  # ``few`` rows at most
    return df.join(small, same, "left_anti").unionByName(
        first_per_key(df.join(small, same, "left_semi"), keys, order))


def top_n_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column],
                    n: int) -> DataFrame:
    """ING-03: the first ``n`` rows of every group (partial top-n before the shuffle)."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) <= n).drop(_RN)


# Quantile levels 1 - 2^-k: the value above which about n_rows * 2^-k rows lie.
_LEVELS = [1.0 - 2.0 ** -k for k in range(1, 41)]


def top_n_by_value(df: DataFrame, groups: Sequence[str], value: str, tie: str, n: int,
                   accuracy: int = 10_000) -> DataFrame:
    """Exact first ``n`` rows per group by ``value`` DESC (NULL last), then ``tie`` ASC.

    A plain rank window ships up to ``n`` rows per group from every map task, so with a
    large ``n`` and many tasks one group's final task would receive tasks * n rows.  So
    a first pass computes, per group, a mergeable quantile sketch (``percentile_approx``,
    rank error at most ``rows / accuracy``) and picks the highest quantile that still
    leaves at least ``n`` rows above it even after twice that error.  Only rows at or
    above it survive (a few times ``n`` per group) and the exact window runs on them.
    Every true top-``n`` row survives: at least ``n`` rows are >= the threshold, so the
    n-th best value is too.  Groups too small for a safe threshold keep all rows.
    """
    groups = list(groups)
    v = F.col(value)
    stats = df.groupBy(*groups).agg(
        F.count(v).alias("_n_values"),
        F.percentile_approx(v, _LEVELS, accuracy).alias("_q"))
    err = 2.0 / accuracy
    picks = [F.when(F.col("_n_values") * (2.0 ** -k - err) >= n, F.col("_q")[k - 1])
             for k in range(len(_LEVELS), 0, -1)]
    thresholds = stats.select(*[F.col(g).alias("_g_" + g) for g in groups],
                              F.coalesce(*picks).alias("_threshold"))
    on = [F.col(g).eqNullSafe(F.col("_g_" + g)) for g in groups]
    kept = df.join(thresholds, on, "left") \
        .where(F.col("_threshold").isNull() | (v >= F.col("_threshold"))) \
        .drop("_threshold", *["_g_" + g for g in groups])
    order = [v.desc_nulls_last(), F.col(tie).asc()]
    return top_n_per_group(kept, groups, order, n)
