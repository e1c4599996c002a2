import math

from snaplake.llm import language_id
from snaplake.llm.common import fold_of
from snaplake.llm.queries import op8_language_id
from tests.llm.helpers import docs, with_clashes

EN = "the house of the river and the people that were there with them "
DE = "das haus an dem fluss und die leute die dort mit ihnen waren sind "
FR = "la maison de la rivière et les gens qui étaient là avec eux "


def some(spark, extra):
    texts, langs = [], []
    for i in range(60):
        lang, t = [("en", EN), ("de", DE), ("fr", FR)][i % 3]
        words = t.split()
        texts.append(" ".join(words[i % 7:] + words[:i % 5]) * 3)
        langs.append(lang)
    return docs(spark, texts + [t for t, _ in extra], langs=langs + [x for _, x in extra])


def test_held_out_accuracy(spark):
    out = op8_language_id(spark, "/root/testdata/sf0.01").toPandas()
    want = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = out.merge(want, on="doc_id")
    assert len(out) == len(want)
    assert all(both.held_out == [fold_of(i, 3) == 1 for i in both.doc_id])
    held = both[both.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.98
    assert both.score.between(0, 1).all()


def test_mixtures_choose_their_languages(spark):
    df = some(spark, [])
    model = language_id.learn(df, df["doc_id"] >= 0)
    assert set(model.mixture(EN * 5)) == {"en"}
    two = model.mixture(EN * 20 + DE * 40)
    assert set(two) == {"en", "de"} and 0.5 < two["de"] < 0.8
    three = model.mixture(EN * 20 + DE * 20 + FR * 20)
    assert set(three) == {"en", "de", "fr"} and all(0.2 < v < 0.5 for v in three.values())
    long = model.mixture(EN * 3000)
    assert set(long) == {"en"}


def test_nulls_empty_letterless_and_clashes(spark):
    df = with_clashes(some(spark, [(None, "en"), ("", "de"), ("123 ... ٣", None), (EN, None), ("é", "fr")]))
    out = {r.doc_id: r for r in language_id.predictions(df).collect()}
    assert [out[i].lang_pred for i in (60, 61, 62, 63)] == ["und", "und", "und", "en"]
    assert [out[i].score for i in (60, 61, 62)] == [0.0] * 3 and out[64].lang_pred == "fr"
    kept = language_id.keep_identified(df)
    assert kept.columns == df.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {60, 61, 62} and 63 in ids


def test_empty_table_and_nothing_to_learn(spark):
    assert language_id.predictions(docs(spark, [])).count() == 0
    out = language_id.predictions(docs(spark, [EN], langs=[None])).first()
    assert (out.lang_pred, out.score) == ("und", 0.0)


def test_lang_source_and_id_are_no_inputs(spark):
    df = some(spark, [])
    model = language_id.learn(df, df["doc_id"] >= 0)
    assert model.predict(EN) == model.predict(EN) and model.predict(DE)[0] == "de"


def plain(texts, langs, text):
    """The mixture by its definition: every trigram on its own, plain floats, EM round by round."""
    def trigrams(t):
        raw = b" " + t.lower().encode() + b" "
        return [raw[i:i + 3] for i in range(len(raw) - 2)]

    bin_of = lambda g: ((int.from_bytes(g, "big") * 0x9E3779B1) & 0xFFFFFFFF) >> 16
    names, counts = sorted(set(langs)), {}
    for lang in names:
        counts[lang] = c = [language_id.SMOOTHING] * language_id.BINS
        for t, x in zip(texts, langs):
            if x == lang:
                for g in trigrams(t):
                    c[bin_of(g)] += 1
    total = {x: sum(c) for x, c in counts.items()}
    p = [[counts[x][bin_of(g)] / total[x] for x in names] for g in trigrams(text)]

    def em(some):
        share = [1 / len(some)] * len(some)
        for _ in range(language_id.ROUNDS):
            new = [0.0] * len(some)
            for row in p:
                mix = sum(s * row[k] for s, k in zip(share, some))
                for i, k in enumerate(some):
                    new[i] += share[i] * row[k] / mix / len(p)
            share = new
        return share

    order = sorted(range(len(names)), key=lambda k, s=em(range(len(names))): -s[k])
    chosen, share, best = order[:1], [1.0], sum(math.log(row[order[0]]) for row in p)
    for size in range(2, len(order) + 1):
        more = em(order[:size])
        got = sum(math.log(sum(s * row[k] for s, k in zip(more, order[:size]))) for row in p)
        if got - best <= language_id.PENALTY * math.log(len(p)):
            break
        chosen, share, best = order[:size], more, got
    return {names[k]: s / sum(share) for k, s in zip(chosen, share)}


def test_against_plain_expectation_maximisation(spark):
    df = some(spark, [])
    rows = df.select("text", "lang").collect()
    model = language_id.learn(df, df["doc_id"] >= 0)
    for text in (EN, EN * 4 + DE * 9, FR + DE + EN, "é", EN * 30 + FR * 3):
        want = plain([r.text for r in rows], [r.lang for r in rows], text)
        got = model.mixture(text)
        assert set(got) == set(want) and all(abs(got[x] - want[x]) < 1e-3 for x in got), (got, want)


def test_portions_of_long_texts_count_every_trigram_once(monkeypatch):
    text = (EN + "été 日本 ") * 40
    whole = language_id.counted(text)
    monkeypatch.setattr(language_id, "_PORTION", 17)
    assert (language_id.counted(text) == whole).all() and whole.sum() == len(text.encode())
