import hashlib

import xxhash
from pyspark.sql import functions as F

from snaplake.llm import order_minhash as omh
from tests.llm.helpers import docs, with_clashes

MASK = (1 << 64) - 1


def signed(x):
    x &= MASK
    return x - (1 << 64) if x >> 63 else x


def h_texts(texts):
    seed = 42
    for t in texts:
        seed = xxhash.xxh64_intdigest(t.encode(), seed & MASK)
    return signed(seed)


def h_longs(values):
    seed = 42
    for v, size in values:
        seed = xxhash.xxh64_intdigest(int(v & ((1 << 8 * size) - 1)).to_bytes(size, "little"), seed & MASK)
    return signed(seed)


def brute(text):
    """Order MinHash entries by the definition, with plain lists."""
    if not text:
        return ""
    tokens = text.split(" ")
    if any(len(w) > omh.TOKEN for w in tokens):
        tokens = [c for w in tokens for c in (w if len(w) > omh.TOKEN else [w])]
    kmers = [h_texts(tokens[i:i + omh.K]) >> omh.POSITION_BITS
             for i in range(max(1, len(tokens) - omh.K + 1))]
    seen, numbered = {}, []
    for at, k in enumerate(kmers):
        o = seen[k] = seen.get(k, -1) + 1
        numbered.append(((k if o == 0 else h_longs([(k, 8), (o, 4)]) >> omh.POSITION_BITS), at))
    numbered.sort()
    bits = 64 - omh.POSITION_BITS - 6
    out = []
    for part in range(-32, 32):
        # The two smallest from the part's lower end on, around the circle.
        start = next((i for i, (h, _) in enumerate(numbered) if h >> bits >= part), 0)
        two = {numbered[start], numbered[(start + 1) % len(numbered)]}
        digest = h_longs([(h, 8) for h, at in sorted(two, key=lambda x: x[1])]) & MASK
        out.append(f"{part + 96:02x}{digest >> 40:06x}")
    return "".join(out)


TEXTS = ["", "a", "a b", "a a a a a a a a", "the cat sat on the mat " * 9, "x" * 100, "né 日本語のテキスト" * 8,
         " ".join(str(i * i) for i in range(400)), "  two  blanks ", "tab\tline\nend", "a " * 300 + "b"]


def test_fingerprint_against_plain_lists(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i long, text string")
    got = dict(omh.with_fingerprint(df, "text", "f").select("i", "f").collect())
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_order_matters_and_likeness(spark):
    words = [f"w{i}" for i in range(500)]
    a, b = " ".join(words), " ".join(words[250:] + words[:250])
    c = " ".join(words[:480] + [f"v{i}" for i in range(20)])
    rev = " ".join(f"{y} {x}" for x, y in zip(words[::2], words[1::2]))
    df = spark.createDataFrame([(a, x) for x in (a, b, c, rev, "")], "a string, b string")
    df = omh.with_fingerprint(omh.with_fingerprint(df, "a", "fa"), "b", "fb")
    same, moved, edited, swapped, empty = [r[0] for r in df.select(omh.likeness(F.col("fa"), F.col("fb"))).collect()]
    assert same == 1.0 and empty == 0.0 and swapped < 0.1
    assert moved < 0.9 and 0.7 < edited < 1.0


def test_whole_operator_against_brute_force(spark):
    texts = TEXTS + [None, "the cat sat on the mat " * 9]
    ids = [7 * i - 20 for i in range(len(texts))]
    got = {r.doc_id: r for r in omh.fingerprints(with_clashes(docs(spark, texts, ids=ids))).collect()}
    full = [t or "" for t in texts]
    for i, t in enumerate(full):
        r, nxt = got[ids[i]], full[(i + 1) % len(full)]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert (r.n_chars, r.fingerprint, r.edited_fingerprint) == (len(t), brute(t), brute(edited))
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = ({x[j:j + 8] for j in range(0, len(x), 8)} for x in (brute(t), brute(nxt)))
        parts = {e[:2] for e in a | b}
        assert abs(r.near_next - (len(a & b) / len(parts) if parts else 1.0)) < 1e-12


def test_repeated_ids_null_ids_and_empty(spark):
    df = docs(spark, ["a b c d", "a b c d", "x y", "z"], ids=[1, 1, None, 5])
    out = omh.fingerprints(df).collect()
    assert len(out) == 4 and len({r.fingerprint for r in out if r.doc_id == 1}) == 1
    assert omh.fingerprints(docs(spark, [])).count() == 0
    one = omh.fingerprints(docs(spark, ["abcd efgh"])).first()
    assert one.near_next == 1.0


def test_successors_over_many_ranges(spark):
    ids = sorted({(i * 7919) % 5003 for i in range(700)})
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    got = dict(omh.successors(df, 13).collect())
    assert got == dict(zip(ids, ids[1:] + ids[:1]))


def test_order_matters_in_short_texts(spark):
    sizes, rows = (10, 20, 30, 60, 120), []
    for n in sizes:
        for k in range(40):
            words = [f"w{k}x{i}" for i in range(n)]
            rows.append((n, " ".join(words), " ".join(words[n // 2:] + words[:n // 2])))
    df = spark.createDataFrame(rows, "n int, a string, b string")
    df = omh.with_fingerprint(omh.with_fingerprint(df, "a", "fa"), "b", "fb")
    got = dict(df.groupBy("n").agg(F.avg(omh.likeness(F.col("fa"), F.col("fb")))).collect())
    assert set(got) == set(sizes) and all(0.2 < x < 0.6 for x in got.values()), got
    assert df.filter(F.length("fa") != omh.SKETCHES * omh.HEX).count() == 0
