import random

from snaplake.llm import toxicity
from snaplake.llm.common import fold_of
from snaplake.llm.queries import op1_toxicity
from tests.llm.helpers import docs, with_clashes

LABELS = "doc_id long, quality int, toxic int"
SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = op1_toxicity(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(out.held_out == [fold_of(i, 4) == 2 for i in out.doc_id])
    held = out[out.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.toxic).mean() > 0.92
    assert held.predicted[held.toxic == 1].mean() >= 0.6  # too few rows in the other languages
    assert held.predicted[held.toxic == 0].mean() <= 0.02
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.3)).all()


def clause(text):
    return toxicity.Grammar().clause(toxicity._WORD.findall(text.lower()))


def test_grammar_of_clauses():
    w = toxicity.INSULT_WEIGHT
    assert clause("a fine day") == 0
    assert clause("an idiot") == w
    assert clause("you idiot") == clause("idiot that you are") == w * toxicity.TARGETED
    assert clause("not an idiot") == w * toxicity.DAMPED
    assert clause("not one two three idiot") == w
    assert clause("he said idiot") == w * toxicity.REPORTED * toxicity.TARGETED
    assert clause("i will hurt") == 0
    assert clause("i will hurt you") == clause("you i will hurt") == toxicity.THREAT_WEIGHT
    assert clause("i will never hurt you") == toxicity.THREAT_WEIGHT * toxicity.DAMPED
    assert clause("\"idiot\"") == w * toxicity.REPORTED


def test_composed_machine_equals_the_five_side_by_side():
    rng = random.Random(1)
    machines = (*toxicity.CORES, *toxicity.OTHERS)
    for _ in range(3000):
        classes = [rng.randrange(len(toxicity.CLASSES)) for _ in range(rng.randint(0, 12))]
        marks = zip(*(m.run(classes) for m in machines)) if classes else []
        want = [toxicity.event(list(m)) for m in marks]
        state, got = 0, []
        for c in classes:
            state, e = toxicity.MACHINE[state][c]
            got.append(None if e < 0 else toxicity.EVENTS[e])
        assert got == want
    # All states of the product that can be reached, no more.
    assert len(toxicity.MACHINE) <= 3 * 3 * 2 * 4 * 2 and len(toxicity.EVENTS) == 16


def test_event_weights_are_fitted(spark):
    """Here negated insults are meant: their weight grows, the plain one's doesn't."""
    rng = random.Random(2)
    texts, labels = [], []
    for i in range(600):
        toxic = i % 2
        said = ("it is not idiot talk" if toxic else "idiot talk it is not") if i % 3 else "a fine day"
        texts.append(f"{said}. " + " ".join(f"w{rng.randrange(500)}" for _ in range(20)))
        labels.append((i, 1, toxic))
    g = toxicity.learn(docs(spark, texts), spark.createDataFrame(labels, LABELS))
    weight = dict(zip(toxicity.EVENTS, g.weights))
    assert weight["insult", "negated"] > toxicity.DAMPED and weight["insult",] < 1
    assert g.features("not idiot talk")[0] > g.features("idiot talk")[0]


def test_only_hit_clauses_are_walked_and_words_are_whole():
    g = toxicity.Grammar({}, {"zork": 5.0})
    assert g.features("Trashy classification. Idiotic? scumble") == (0.0, 0.0, 0.0)
    assert g.features("zorkish x. An IDIOT, you. Fine.")[0] == toxicity.INSULT_WEIGHT * toxicity.TARGETED
    assert g.features("unzorkish")[0] == 0
    assert g.features(None) == g.features("") == (0.0, 0.0, 0.0)
    assert g.features("ok. " * 50_000 + "idiot")[0] == toxicity.INSULT_WEIGHT
    assert g.features("İ" * 50 + " idiot")[0] == toxicity.INSULT_WEIGHT


def test_lexicon_is_learned_and_held_out_labels_change_nothing(spark):
    texts = [("das blorx haus " if i % 4 == 0 else "das haus ") * 3 + f"w{i}" for i in range(300)]
    rows = [(i, 1, int(i % 4 == 0)) for i in range(300)]
    other = [(i, 1, int(i % 4 == 0) ^ (fold_of(i, 4) == 2)) for i in range(300)]
    a, b = ({r.doc_id: r for r in toxicity.predictions(docs(spark, texts), spark.createDataFrame(x, LABELS)).collect()}
            for x in (rows, other))
    assert all(abs(a[i].score - b[i].score) < 1e-9 for i in a)
    assert all(a[i].predicted == (i % 4 == 0) for i in a)


def test_odd_tables(spark):
    none = spark.createDataFrame([], LABELS)
    df = with_clashes(docs(spark, [None, "", "you idiot", "x" * 200_000, "you idiot"], ids=[0, 1, 2, 3, 2]))
    out = sorted((r.doc_id, r.predicted) for r in toxicity.predictions(df, none).collect())
    assert out == [(0, 0), (1, 0), (2, 1), (2, 1), (3, 0)]
    assert toxicity.predictions(docs(spark, []), none).count() == 0
    odd = spark.createDataFrame([(0, None, None), (None, 1, 1), (1, 1, 0), (1, 1, 0)], LABELS)
    assert toxicity.predictions(df, odd).count() == 5


def test_learning_rows_without_features_or_labels_of_one_kind(spark):
    """Tasks without a toxic row, empty texts and words of one or two letters."""
    rows = [(i, 1, int(i == 0)) for i in range(40)]
    for texts in ([""] * 40, ["a bc"] * 40, ["you blorx"] + ["fine day"] * 39):
        df = docs(spark, texts).repartitionByRange(8, "doc_id")
        out = toxicity.predictions(df, spark.createDataFrame(rows, LABELS)).collect()
        assert len(out) == 40 and all(0 <= r.score <= 1 for r in out)


def test_recall_where_there_are_enough_learning_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    held = op1_toxicity(spark, sf).filter("held_out").toPandas().merge(labels, on="doc_id")
    assert held.predicted[held.toxic == 1].mean() >= 0.9
    assert held.predicted[held.toxic == 0].mean() <= 0.02
