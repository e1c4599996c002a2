import random

import numpy as np

from snaplake.llm import lsh_forest
from snaplake.llm.queries import op11_minhash_near_dedup
from tests.llm.helpers import docs, with_clashes


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def brute(ids, texts):
    """(doc_id, n_shingles, component_id, kept) of every row, all pairs compared."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        shared = {}
        for x in s:
            for j in where[x]:
                if j > i:
                    shared[j] = shared.get(j, 0) + 1
        for j, both in shared.items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                root[find(j)] = find(i)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)), d == least.get(find(i)))
                   for i, d in enumerate(ids)), key=repr)


def got(df, **options):
    return sorted((tuple(r) for r in lsh_forest.near_duplicates(df, **options).collect()), key=repr)


def near_copies(rng, n, words=120):
    base = [f"b{rng.random()}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(words)] = f"e{rng.random()}"
        out.append(" ".join(w))
    return out


def test_whole_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    out = sorted((tuple(r) for r in op11_minhash_near_dedup(spark, sf).collect()), key=repr)
    assert out == brute([r.doc_id for r in table], [r.text for r in table])


def test_small_regions_and_blocks_lose_nothing(spark):
    rng = random.Random(4)
    texts = near_copies(rng, 150) + near_copies(rng, 60, 30) + near_copies(rng, 40, 400)
    texts += [" ".join(f"r{rng.random()}" for _ in range(50)) for _ in range(50)]
    # Chains: each text is near the next one only.
    chain = [f"c{i}" for i in range(400)]
    texts += [" ".join(chain[9 * i:9 * i + 200]) for i in range(20)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    ids = [3 * i for i in order]
    assert got(docs(spark, texts, ids=ids), block=16, region=8) == brute(ids, texts)


def test_defined_cases(spark):
    texts = [None, "", " \t", "One", "one", "one two three", "ONE  two\nthree", "one two three four",
             "É b c d", "é b c d", "x " * 60_000, "x x x x", "x x x x y"]
    ids = [5, 4, 3, 20, 10, 30, 31, 32, 33, 34, 50, None, 51]
    assert got(with_clashes(docs(spark, texts, ids=ids))) == brute(ids, texts)
    assert got(docs(spark, [])) == []


def test_repeated_rows_and_ids(spark):
    long = " ".join(f"w{i}" for i in range(100))
    texts = [long] * 50 + [long + " z", "other text here now", long, None, None]
    ids = [7] * 50 + [7, 7, 3, 8, 8]
    assert got(docs(spark, texts, ids=ids), block=4, region=4) == brute(ids, texts)


def test_minima_agree_as_the_sets_do():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 64, 3000, np.uint64)
    a, b = lsh_forest.minima(h[:2500]), lsh_forest.minima(h[500:])
    assert abs((a == b).mean() - 2000 / 3000) < 0.2
    assert (lsh_forest.minima(h) == lsh_forest.minima(h[::-1])).all()
