"""Small tables for the operators' tests."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, **columns):
    """A documents table with the given texts; ids from 0 unless given."""
    ids = columns.get("ids", range(len(texts)))
    langs = columns.get("langs", ["en"] * len(texts))
    sources = columns.get("sources", ["s"] * len(texts))
    rows = [(i, t, lang, s, None if t is None else len(t))
            for i, t, lang, s in zip(ids, texts, langs, sources)]
    return spark.createDataFrame(rows, DOCS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def with_clashes(df):
    """The table with extra columns named as the operators' own columns are."""
    from pyspark.sql import functions as F
    for name in ("score", "size", "key", "h", "n", "fp", "fingerprint", "component_id", "label_id",
                 "lang_pred", "lang_score", "lang_found", "quality_score", "simhash_id", "mix_row",
                 "row", "start", "length", "task", "target", "b", "y", "node", "tree"):
        df = df.withColumn(name, F.lit("x"))
    return df
