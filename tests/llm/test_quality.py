import itertools

import numpy as np

from snaplake.llm import quality
from snaplake.llm.common import fold_of
from snaplake.llm.queries import op10_quality_classifier
from tests.llm.helpers import docs, with_clashes

LABELS = "doc_id long, quality int, toxic int"
SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = op10_quality_classifier(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(out.held_out == [fold_of(i, 3) == 1 for i in out.doc_id])
    held = out[out.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.95
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.5)).all()


def test_held_out_labels_change_nothing(spark):
    texts = [("good words in a plain line " if i % 2 else "BAD!! LOUD!! ") * (1 + i % 9) for i in range(120)]
    df = docs(spark, texts)
    rows = [(i, i % 2, 0) for i in range(120)]
    other = [(i, 1 - i % 2 if fold_of(i, 3) == 1 else i % 2, 0) for i in range(120)]
    a, b = ({r.doc_id: r.score for r in quality.predictions(df, spark.createDataFrame(x, LABELS)).collect()}
            for x in (rows, other))
    assert all(abs(a[i] - b[i]) < 1e-9 for i in a)
    assert np.mean([(a[i] >= 0.5) == (i % 2) for i in a]) > 0.95


def test_odd_texts_and_clashes(spark):
    texts = ["plain words here", "LOUD!!"] * 20 + [None, "", " ", "x" * 100_000, "a " * 60_000]
    df = with_clashes(docs(spark, texts))
    labels = spark.createDataFrame([(i, (i + 1) % 2, 0) for i in range(40)] + [(40, None, 0), (None, 1, 1), (1, 0, 0)],
                                   LABELS).withColumn("y", quality.F.lit("x"))
    out = quality.predictions(df, labels).collect()
    assert len(out) == 45 and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (40, 41, 42)}) == 1
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns and {0, 2, 4} <= {r.doc_id for r in kept.collect()}


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in quality.predictions(docs(spark, ["a"]), none).collect()] == [0.5]
    ones = spark.createDataFrame([(0, 1, 0), (2, 1, 0)], LABELS)
    assert quality.predictions(docs(spark, ["a", "b", "c"]), ones).first().score > 0.5
    assert quality.predictions(docs(spark, []), none).count() == 0


def test_shapes_and_types():
    assert [quality.shape(w) for w in ("Hello!!", "ÀB9é", "|", "a***", "")] == ["Aa!", "A9a", "|", "a*", ""]
    assert len(quality.shape("a1" * 40)) == 80  # never cut
    assert [quality.type_of(w) for w in ("The", "tree,", "été.", "a***", "LOUD!!", "X", "|", "日本", "x1")] == \
        ["wthe", "wtree,", "wété.", "sa*", "sA!", "wx", "s|", "w日本", "sa9"]
    types = quality.Types()
    the, tree, bar = (quality.row_of(t) for t in ("wthe", "wtree", "s|"))
    assert types.of("The Tree Tree | the").tolist() == [the, tree, quality.AGAIN, bar, the]
    assert types.of(None).tolist() == []


def test_temperature_makes_logits_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = quality.Network(3)
    net.fit(x, y)
    net.w[2], net.w[3] = net.w[2] * 5, net.w[3] * 5
    net.calibrate(x, y)
    assert 3 < net.temperature < 8
    p = net.probability(x)
    for low in np.arange(0, 1, 0.2):
        some = (p >= low) & (p < low + 0.2)
        assert abs(p[some].mean() - y[some].mean()) < 0.1


def plain_sums(texts):
    """Random indexing with plain loops."""
    index, want = quality.index_vectors().astype(float), np.zeros((quality.ROWS, quality.DIM))
    types = quality.Types()
    for t in texts:
        ids = types.of(t)
        for i, a in enumerate(ids):
            for j in range(max(0, i - quality.REACH), min(len(ids), i + quality.REACH + 1)):
                if i != j:
                    want[a] += index[ids[j]]
    return want


def test_every_document_and_word_counts(spark, monkeypatch):
    # 3,000 forms in unlabelled documents, none of them in a labelled one, and a long text.
    rare = ["".join(c) for c in itertools.islice(itertools.product("abcdefgh", repeat=5), 3000)]
    texts = [("plain words here" if i % 2 else "BAD!! LOUD!!") for i in range(20)] \
        + [" ".join(rare[k::10]) for k in range(10)] * 5 + [None, "", "one", " ".join(rare * 2)]
    df = docs(spark, texts).repartition(7)
    got = quality.word_vectors(df)
    want = plain_sums(texts)
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    want += quality.index_vectors() / np.sqrt(quality.NONZERO)
    assert np.allclose(got, want, atol=2e-3)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], LABELS)
    assert np.array_equal(got, quality.learn(df, labels).pool.vectors)


def test_long_texts_are_added_up_by_stretches(monkeypatch):
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 50, 400).astype(np.uint16)
    whole, parts = (np.zeros((quality.ROWS, quality.DIM), np.int32) for _ in range(2))
    quality._add_neighbours(whole, [(rows, 0, 400), (rows[:1], 0, 1)])
    for at in range(0, 400, 7):
        low = max(0, at - quality.REACH)
        quality._add_neighbours(parts, [(rows[low:at + 7 + quality.REACH], at - low,
                                         min(400, at + 7) - low)])
    assert (whole == parts).all() and whole.any()


def test_index_vectors():
    v = quality.index_vectors()
    assert ((v == 1).sum(axis=1) == 4).all() and ((v == -1).sum(axis=1) == 4).all()
    assert len({x.tobytes() for x in v}) == quality.ROWS
