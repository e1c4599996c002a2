import math

import numpy as np

from snaplake.llm import topk_search

SCHEMA = "vec_id long, embedding array<double>"


def plain(vectors, queries, k):
    def good(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    ints = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if i is not None and good(v)]
    out = []
    for q, v in [(i, [math.floor(256 * x) for x in v]) for i, v in queries if i is not None and good(v)]:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ints
                        if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found(spark, vectors, queries, k, **options):
    df = topk_search.top_k(spark.createDataFrame(vectors, SCHEMA), spark.createDataFrame(queries, SCHEMA),
                           k, **options)
    return sorted(tuple(r) for r in df.collect())


def test_many_tiles_with_ties(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = [(int(i), rng.integers(-3, 4, 6).astype(float).tolist()) for i in rng.permutation(700)]
    queries = [v for v in vectors if v[0] % 20 == 0]
    want = plain(vectors, queries, 5)
    assert found(spark, vectors, queries, 5) == want
    monkeypatch.setattr(topk_search, "FAN", 3)
    assert found(spark, vectors, queries, 5, rows=16) == want


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [0.001, -0.001]), (50, [1.0, 2.0]), (50, [1.0, 2.0]), (2, None), (3, [None, 1.0]),
               (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0]), (7, []), (None, [1.0, 1.0]),
               (8, [1e12, -1e12]), (9, [1e12, 1e12]), (100, []), (150, [5.0])]
    queries = [v for v in vectors if v[0] is not None and v[0] % 50 == 0]
    assert found(spark, vectors, queries, 5) == plain(vectors, queries, 5)
    assert found(spark, [], [], 5) == []
    assert found(spark, vectors[:1], vectors[:1], 5) == []


def test_hot_vector(spark):
    vectors = [(i, [1.0, 0.5]) for i in range(300)] + [(i, [float(i), 1.0]) for i in range(300, 330)]
    queries = vectors[::50]
    assert found(spark, vectors, queries, 5, rows=32) == plain(vectors, queries, 5)
