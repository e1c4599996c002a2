import hashlib
import zlib

from pyspark.sql import functions as F

from snaplake.llm import merkle
from tests.llm.helpers import DOCS, docs, with_clashes


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                       for v in (row[0], row[3], row[2], row[4], row[1])))


def grow(level):
    """Levels of a tree over ``level``, lowest first."""
    out = [level]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def path(levels, at):
    """(before, behind) of each level on the way to the top."""
    out = []
    for level in levels[:-1]:
        run = at // 2 * 2
        out.append(("".join(level[run:at]), "".join(level[at + 1:run + 2])))
        at //= 2
    return out


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    key = lambda v: (v is not None, v if v is not None else 0)
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        group = sorted((r for r in rows if r[2] == lang), key=lambda r: (key(r[0]), leaf(r)))
        trees[lang] = group, grow([leaf(r) for r in group])
    upper = grow([trees[lang][1][-1][0] for lang in langs])
    out = []
    for i, lang in enumerate(langs):
        group, levels = trees[lang]
        for at, r in enumerate(group):
            proof = path(levels, at) + path(upper, i)
            now = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                now = (*r[:4], r[4] + 1)
            h = leaf(now)
            for before, behind in proof:
                h = sha(before + h + behind)
            out.append((r[0], leaf(r), levels[-1][0], upper[-1][0],
                        sha("".join(b + a for b, a in proof)), h, h == upper[-1][0]))
    return sorted(out, key=repr)


def verified(df):
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    out = merkle.verified(df, chosen, n_chars=F.col("n_chars") + 1)
    return sorted((tuple(r) for r in out.collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def test_against_brute_force(spark):
    rows = [(i, f"text {i} é" * (i % 5), ("en", "de", "fr", None)[0 if i % 3 else i % 4], "s", i)
            for i in range(-5, 300)]
    rows += [(500, "日本", "ja", None, 2), (501, None, "zz", "s", None), (None, "x", "en", "s", 1)]
    assert verified(table(spark, rows)) == brute(rows)


def test_repeated_rows_and_ids(spark):
    rows = [(7, "same", "en", "s", 4)] * 70 + [(7, f"other {i % 3}", "en", "s", 4) for i in range(9)]
    assert verified(table(spark, rows)) == brute(rows)


def test_small_tables(spark):
    for n in (1, 2, 3, 16, 17):
        rows = [(i, "x", "en", "s", 1) for i in range(n)]
        assert verified(table(spark, rows)) == brute(rows), n
    two = [(1, "x", "en", "s", 1), (2, "y", None, "s", 1)]
    assert verified(table(spark, two)) == brute(two)
    assert verified(table(spark, [])) == []


def test_nulls_long_texts_and_clashing_columns(spark):
    df = with_clashes(docs(spark, [None, "", "long " * 200_000, "ß"], langs=["en", None, "en", ""]))
    rows = [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = verified(df.withColumn("pos", F.lit(3)).withColumn("carried", F.lit(1)))
    assert got == brute(rows)


def test_manifest_proofs_lead_to_the_root(spark):
    df = docs(spark, [f"t{i}" for i in range(50)], langs=["en"] * 33 + ["de"] * 17)
    m = merkle.manifest(df)
    folded = m.withColumn("again", merkle.fold(F.col("leaf"), F.col("proof")))
    assert folded.filter("again = root").count() == 50
    changed = m.withColumn("again", merkle.fold(F.sha2(F.lit(b"x"), 256), F.col("proof")))
    assert changed.filter("again = root").count() == 0
