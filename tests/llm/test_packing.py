import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from snaplake.llm import packing
from tests.llm.helpers import docs, with_clashes

TOK = Tokenizer.from_file(packing.tokenizer_path())


def ids_of(text):
    return TOK.encode(text or "", add_special_tokens=False).ids + [0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check(pieces, texts):
    """``texts``: id -> text, ids being distinct.  Returns the sequences' lengths."""
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        ids, at = ids_of(text), 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == crc(ids[at:at + p.length])
            at += p.length
        assert at == len(ids)
    lengths = []
    for s in by_seq.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.WINDOW
        lengths.append(at)
    return lengths


def padding(lengths):
    return sum(0 if n & (n - 1) == 0 else packing.WINDOW - n for n in lengths)


def test_every_id_once_and_little_padding(spark):
    rng = random.Random(6)
    texts = {i: " ".join(rng.choice(["alpha", "beta", "gamma,", "née", "x1"]) for _ in range(rng.randint(0, 900)))
             for i in range(300)}
    texts |= {1000: None, 1001: "", 1002: "word " * 30_000, 1003: "<|endoftext|> a  b\n\nc ", 1004: "日本語" * 500}
    df = with_clashes(docs(spark, list(texts.values()), ids=list(texts)))
    lengths = check(packing.pack(df).collect(), texts)
    assert padding(lengths) < packing.WINDOW


def test_repeated_rows_small_and_empty_tables(spark):
    out = packing.pack(docs(spark, ["same text here"] * 400, ids=[1] * 400)).collect()
    n = len(ids_of("same text here"))
    assert sum(p.length for p in out) == 400 * n
    assert packing.pack(docs(spark, [])).count() == 0
    big = packing.pack(docs(spark, ["a", "b b b"], ids=[(1 << 60) + 1, None])).collect()
    assert {p.doc_id for p in big} == {(1 << 60) + 1, None}
    check(packing.pack(docs(spark, ["one"])).collect(), {0: "one"})


def test_encoder_against_the_whole_text():
    enc = packing.Encoder(packing.tokenizer_path())
    rng = random.Random(7)
    pieces = ["a", "the", " ", "  ", "\n", " \n", "\n ", "\t", "'s", "1234", ".", "!?", "é", "\xa0", "　", "日本",
              "<|endoftext|>", "\x1c", "x" * 40, "\r\n", "👍🏽"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    got = enc.batch(texts)
    for t, g in zip(texts, got):
        assert np.frombuffer(g, "<u4").tolist() == TOK.encode(t, add_special_tokens=False).ids, t


def tail_share(histogram):
    for c, repeats in packing.solve(histogram):
        assert sum(c) == packing.WINDOW and repeats > 0 and 2 <= len(c) <= 4
    slots, tails, _ = packing.layout(histogram | {1024: 9})
    placed = {}
    for length, at, n, *_ in slots:
        assert placed.get(length, 0) == at
        placed[length] = at + n
    for length, at, _ in tails:
        assert placed.get(length, 0) == at
    total = sum(n * k for n, k in histogram.items())
    return sum((histogram[n] - at) * n for n, at, _ in tails) / total


def test_solver_and_layout():
    rng = random.Random(8)
    # As remainders of documents are: short ones more often.
    assert tail_share({n: rng.randint(100, 300) + 300 * 2 ** (-n // 200) for n in range(1, 1024)}) < 0.05
    tail_share({n: rng.randint(1, 50) for n in rng.sample(range(1, 1024), 400)})
    assert tail_share({700: 10, 324: 7, 1: 1}) < 0.3
    assert tail_share({5: 3}) == 1.0
    x = packing.nnls([{0: 1, 1: 1}, {1: 2}], [3.0, 7.0])
    assert abs(x[0] - 3) < 0.5 and abs(x[1] - 2) < 0.5


def test_added_tokens_as_the_file_has_them(spark):
    tok = Tokenizer.from_file(packing.tokenizer_path())
    enc = packing.Encoder(packing.tokenizer_path())
    texts = ["x<|endoftext|>", "<|endoftext|>", "a b <|endoftext|> c d", "a  b<|endoftext|><|endoftext|> c",
             "日本 <|endoftext|>é", "<|endoftext| >", "plain words"]
    got = [np.frombuffer(g, "<u4").tolist() for g in enc.batch(texts)]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert got[0] == [87, 50256]
    row = packing.pack(docs(spark, ["x<|endoftext|>"])).first()
    assert (row.doc_tokens, row.ids_crc32) == (3, crc([87, 50256, 0]))
