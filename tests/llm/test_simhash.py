import random

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from snaplake.llm import simhash
from snaplake.llm.components import components
from tests.llm.helpers import docs, rows, with_clashes


def plain_fingerprint(text):
    raw = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in raw + " ":
        if c in "\x20\x09\x0a\x0b\x0c\x0d":
            words, word = words + ([word] if word else []), ""
        else:
            word += c
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, radius=3):
    root = dict(zip(range(len(ids)), range(len(ids))))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [min(ids[j] for j in range(len(ids)) if find(j) == find(i)) for i in range(len(ids))]


@given(st.text(alphabet="aB \t\n\x0b\x0c\r\x1c\xa0é.İ", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint_by_definition(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_in_portions():
    rng = random.Random(1)
    text = " ".join(rng.choice("abcdefgh") for _ in range(simhash._PORTION + 100))
    assert simhash.fingerprint(text) == plain_fingerprint_fast(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def plain_fingerprint_fast(text):
    words = text.split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(len(words) - 2)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.integers(0, (1 << 64) - 1), st.lists(st.integers(0, 63), max_size=3))
@settings(max_examples=300, deadline=None)
def test_masks_cover_every_pair_within_the_radius(a, bits):
    b = a
    for i in bits:
        b ^= 1 << i
    assert any(a & m == b & m for m in (x & ((1 << 64) - 1) for x in simhash.masks(3)))


def test_masks_cover_each_radius():
    for radius in (1, 2, 4):
        assert len(simhash.masks(radius)) == 2 ** (radius + 1) - 1


def test_documents_against_all_pairs(spark):
    rng = random.Random(2)
    base = [" ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet", "elit", f"w{rng.random():.2f}"])
                     for _ in range(rng.randint(1, 120))) for _ in range(40)]
    texts = list(base)
    for t in base * 3:
        words = t.split()
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += base[:10] + ["", None, " \t", "A b", "a B"] + [base[0]] * 30
    ids = rng.sample(range(1000), len(texts))
    fps = [plain_fingerprint(t) for t in texts]
    want = sorted(zip(ids, [f"{f:016x}" for f in fps], plain_components(ids, fps)))
    got = simhash.near_duplicates(with_clashes(docs(spark, texts, ids=ids)), block=4)
    assert [tuple(r) for r in sorted(got.collect())] == want
    kept = simhash.keep_one(docs(spark, texts, ids=ids), block=4)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})


def test_chains_and_dense_buckets(spark):
    rng = random.Random(3)
    fps = {0}
    for _ in range(300):  # a chain whose ends are far apart, and a ball around zero
        fps.add(rng.choice(list(fps)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fps |= {rng.getrandbits(64) for _ in range(200)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    want = plain_components(signed, fps)
    for block in (3, 1024):
        roots = dict(components(simhash.links(df, block=block)).collect())
        assert [roots.get(s, s) for s in signed] == want


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(7, 7)], "a long, b long")
    assert dict(components(edges).collect()) == {i: 0 for i in range(1, 201)}
    assert components(edges.limit(0)).count() == 0


def test_repeats_nulls_and_empty(spark):
    df = docs(spark, ["a b c d"] * 3 + ["q w e r t y"], ids=[4, 4, 9, None])
    assert [r[2] for r in rows(simhash.near_duplicates(df))].count(4) == 3
    kept = simhash.keep_one(with_clashes(df))
    assert kept.columns == with_clashes(df).columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 4), (True, None)]
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.keep_one(docs(spark, [])).count() == 0


def test_one_row_of_each_component_stays(spark):
    a, b, c = "a b c d e f g", "one two three four five six", "le chat dort sur le lit bleu"
    # One id for two texts, one of them a copy of a smaller id's; copies without an id.
    df = docs(spark, [a, a, b, c, c, c, b], ids=[1, 4, 4, None, None, None, 9])
    for _ in range(2):
        kept = [(r.doc_id, r.text) for r in simhash.keep_one(with_clashes(df)).collect()]
        assert sorted(kept, key=str) == sorted([(1, a), (4, b), (None, c)], key=str)
