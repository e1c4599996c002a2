from collections import defaultdict

from pyspark.sql import functions as F

from snaplake.llm import mixing
from tests.llm.helpers import docs, rows, with_clashes


def shared(sizes, weights=(5.0, 2.0, 1.0), most=3):
    """Targets by sharing round after round, as the rule is told."""
    order = sorted(sizes, key=lambda s: (s is None, "" if s is None else s.encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        unit = left / sum(w[s] for s in free)
        full = [s for s in free if w[s] * unit > most * sizes[s]]
        if not full:
            target |= {s: w[s] * unit for s in free}
            break
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
            free.discard(s)
    return target


def summed(out):
    got = defaultdict(lambda: [0, 0, 0, 0.0])
    for r in out:
        g = got[r.source]
        g[0] += r.size
        g[1], g[3] = r.source_size, r.target
        g[2] += r.taken
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    return got


def table(spark, seed=0, n=600):
    texts = ["w " * ((i * 37 + seed) % 50) for i in range(n)]
    sources = [["Z", "a", "é", "\U00010000", "￿", None, "tiny", "b"][0 if i % 3 == 0 else i % 8] for i in range(n)]
    sources[5] = "tiny2"
    return docs(spark, texts, sources=sources)


def test_targets_and_sums(spark):
    out = mixing.mixture(with_clashes(table(spark))).collect()
    got = summed(out)
    want = shared({s: g[0] for s, g in got.items()})
    for s, (size, source_size, taken, target) in got.items():
        assert size == source_size and abs(target - want[s]) < 1e-6
        assert abs(taken - target) <= 3, (s, taken, target)
    assert len(out) == 600


def test_capped_sources(spark):
    df = docs(spark, ["a b"] * 5 + ["w " * 40] * 10, sources=["a"] * 5 + ["b"] * 5 + ["c"] * 5)
    for s, (size, _, taken, target) in summed(mixing.mixture(df).collect()).items():
        assert abs(target - shared({"a": 10, "b": 200, "c": 200})[s]) < 1e-9
        assert abs(taken - target) <= 20
        if s == "a":
            assert taken == 30


def test_reruns_agree_whatever_the_partitioning(spark):
    df = table(spark, 3)
    assert rows(mixing.mixture(df)) == rows(mixing.mixture(df.repartition(7))) \
        == rows(mixing.mixture(df, ranges=3))


def test_repeated_rows_are_counted_apart(spark):
    df = docs(spark, ["a b c"] * 100 + ["d e f g"] * 10 + [None, ""], ids=[1] * 100 + list(range(2, 14)),
              sources=["x"] * 50 + ["y"] * 55 + ["z"] * 7)
    out = mixing.mixture(df).collect()
    assert len(out) == 112
    for size, source_size, taken, target in summed(out).values():
        assert abs(taken - target) <= 2


def test_rows_of_the_mixture(spark):
    df = with_clashes(table(spark, 5)).withColumn("text", F.col("text"))
    taken = {r.doc_id: r.taken // r.size for r in mixing.mixture(df).collect() if r.taken}
    out = mixing.mix(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert {k: v for k, v in got.items() if k in taken} == taken
    words = out.select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert abs(words - df.select(F.sum(mixing.word_count(F.col("text")))).first()[0]) < 20


def test_higher_weights_come_more_often(spark):
    df = docs(spark, ["a b c d"] * 900, sources=["s"] * 600 + ["t"] * 300) \
        .withColumn("w", F.when(F.col("doc_id") % 2 == 0, 8.0).otherwise(1.0))
    out = mixing.mixture(df, weight=F.col("w"), weights=(1.0, 5.0)).filter("source = 's'").collect()
    even = sum(r.taken for r in out if r.doc_id % 2 == 0)
    assert even > 2 * sum(r.taken for r in out if r.doc_id % 2) > 0


def test_empty_table_and_no_words(spark):
    assert mixing.mixture(docs(spark, [])).count() == 0
    assert mixing.mix(docs(spark, [])).count() == 0
    assert [r.taken for r in mixing.mixture(docs(spark, [None, " "])).collect()] == [0, 0]


def chosen(out):
    """What each source takes beyond whole epochs, by the rule as it is told: rows by key, one
    after another if they still fit; then one that comes nearer."""
    by_source = defaultdict(list)
    for r in out:
        by_source[r.source].append(r)
    want = {}
    for rows_ in by_source.values():
        size, target = rows_[0].source_size, rows_[0].target
        epochs = int(target // size) if size else 0
        left, untaken = target - epochs * size, []
        for r in sorted(rows_, key=lambda r: (-r.key, r.doc_id)):
            want[r.doc_id] = epochs * r.size
            if 0 < r.size <= left:
                want[r.doc_id] += r.size
                left -= r.size
            elif r.size:
                untaken.append(r)
        nearer = [r for r in untaken if abs(r.size - left) < left]
        if nearer:
            r = min(nearer, key=lambda r: (abs(r.size - left), -r.key, r.doc_id))
            want[r.doc_id] += r.size
    return want


def check_rows_taken(df):
    keys = mixing._keyed(df, None).select(F.col("doc_id").alias("k_id"), "key")
    out = mixing.mixture(df)
    got = out.join(keys, F.col("doc_id") == F.col("k_id")).collect()
    assert {r.doc_id: r.taken for r in got} == chosen(got)
    return got


def test_which_rows_are_taken(spark):
    check_rows_taken(table(spark, 9))


def test_large_documents_leave_room_for_small_ones(spark):
    texts = ["w " * (700 if i % 5 == 0 else 20) for i in range(400)]
    got = check_rows_taken(docs(spark, texts, sources=["abcd"[i % 4] for i in range(400)]))
    for s, (size, _, taken, target) in summed(got).items():
        assert abs(taken - target) <= 10, (s, taken, target)


def test_texts_without_small_letters_spread_over_ranges(spark):
    texts = ["日本語 " * (i % 30 + 1) if i % 2 else "LOUD " * (i % 17) for i in range(500)]
    df = docs(spark, texts, sources=["ab"[i % 2] for i in range(500)])
    check_rows_taken(df)
    keys = mixing._keyed(df, None).groupBy("doc_id", "source", "size", "h", "row", "key").count()
    parts = mixing.spread(keys, [F.col("source"), F.col("key").desc()], "t-spread", 10)
    assert max(r["count"] for r in parts.groupBy("b").count().collect()) < 120


def test_rows_alike_but_for_another_column_stay_themselves(spark):
    df = docs(spark, ["a b c"] * 6 + ["x y"] * 3, ids=[1] * 6 + [2] * 3,
              langs=["en", "de", "fr"] * 3).withColumn("tags", F.array(F.lit("t")))
    taken = {(r.doc_id, r.taken) for r in mixing.mixture(df).collect()}
    assert taken == {(1, 3), (2, 2)}
    assert rows(mixing.mix(df)) == rows(df)
