import corpus_pipeline
from pyspark.sql import functions as F

from snaplake.llm import language_id, packing, quality, simhash
from snaplake.llm.queries import oracle_queries, spark_queries
from tests.llm.helpers import with_clashes

SF = "/root/testdata/sf0.001"


def test_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("mine"))
    before, frames = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, before, SF)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert out.columns == docs.columns
        frames[name] = (before, out)
        before = out
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}

    start, kept = frames["quality_classifier"]
    model = quality.learn(start, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(kept) == {r.doc_id for r in start.collect() if model.scores([r.text])[0] >= 0.5}

    start, kept = frames["language_identification"]
    model = language_id.learn(start, F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    want = {r.doc_id for r in start.collect() if model.predict(r.text)[1] >= language_id.LEAST_SHARE}
    assert ids(kept) == want

    start, kept = frames["simhash_near_dedup"]
    fps = [(r.doc_id, simhash.fingerprint(r.text)) for r in sorted(start.collect())]
    groups = []
    for i, f in fps:
        near = [g for g in groups if any((f ^ x).bit_count() <= 3 for _, x in g)]
        groups = [g for g in groups if g not in near] + [sum(near, []) + [(i, f)]]
    assert ids(kept) == {min(g)[0] for g in groups}

    start, mixed = frames["source_mixture"]
    words = lambda df: sum(len(r.text.encode().split()) for r in df.collect())
    assert abs(words(mixed) / words(start) - 1) < 0.05

    start, pieces = frames["packing"]
    tokens = pieces.agg(F.sum("length")).first()[0]
    enc = packing.Encoder(packing.tokenizer_path())
    assert tokens == sum(len(enc.batch([r.text])[0]) // 4 + 1 for r in start.collect())


def test_run_is_the_stages_one_after_another(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns[:2] == ["doc_id", "start"] and out.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES][2] == "simhash_near_dedup"


def odd_tables(spark, folder, rows):
    """Tables whose documents are those of sf0.001 with ``rows`` added, repeated and with clashing
    columns; their folder."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    more = docs.select("doc_id", "text", "lang", "source", "n_chars") if rows else docs.limit(0)
    df = more.unionByName(spark.createDataFrame(rows * 3, schema)) if rows else more
    with_clashes(df).write.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    (labels if rows else labels.limit(0)).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_run_over_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None, None), (9001, None, "en", "s", None), (9002, "", None, None, 0),
            (None, "words without an id are a document too", "en", "s", 3),
            (9003, "a plain text that comes three times in this table", "en", None, 5),
            (9004, "long text of words " * 40_000, "en", "s", 7)]
    folder = odd_tables(spark, tmp_path, rows)
    pieces = corpus_pipeline.run(spark, folder).collect()
    room = {}
    for p in pieces:
        room.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in room.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    # Of a document that repeats as a whole one row stays, and the mixture takes it 0 to 3 times.
    starts = [p.start for p in pieces if p.doc_id == 9003]
    assert len(starts) <= 3


def test_run_over_an_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, odd_tables(spark, tmp_path, [])).count() == 0


def test_registry():
    names = set(spark_queries())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert {n.split("_")[0] for n in oracle_queries()} == {"op4", "op6", "op12", "op13"}
    assert set(oracle_queries()) <= names


def test_tasks_find_the_package_from_any_folder(tmp_path):
    import os
    import subprocess
    import sys
    home = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    code = (f"import sys; sys.path.insert(0, {home!r})\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "import __spark_entry__ as e\n"
            f"print('ROWS', e.queries()['op8_language_id'](s, {SF!r}).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=300)
    assert "ROWS 200" in out.stdout, out.stderr[-2000:]
