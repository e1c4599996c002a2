import math
import random
import re

import numpy as np

from snaplake.llm import lexical_search as ls
from tests.llm.helpers import docs, with_clashes

ITEMS = "item_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(documents, items, top=50):
    found = [(i, terms(t)) for i, t in documents]
    found = [(i, t) for i, t in found if t]
    n, total = len(found), sum(len(t) for _, t in found)
    df = {}
    for _, t in found:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, t in found:
            m, s = 100 - 50 + 50 * len(t) * n // total, 0
            for x in set(terms(text)) & set(t):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1)))
                tf = t.count(x)
                s += w * (1_000_000_000 * tf // (1000 * tf + 20 * m))
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def got(spark, documents, items, **options):
    df = with_clashes(docs(spark, [t for _, t in documents], ids=[i for i, _ in documents]))
    out = ls.search(df.repartition(5), spark.createDataFrame(items, ITEMS), **options)
    return sorted((tuple(r) for r in out.collect()), key=repr)


def some(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(12)
    words = ["A", "b.c", "the", "naïve", "ÉTÉ", "x1", "9", "日本"] + [f"w{i}" for i in range(60)]
    documents = [(3 * i, some(rng, words, rng.randint(0, 60))) for i in range(300)]
    documents += [(-i, "tie tie, TIE") for i in range(70)] + [(5000, None), (5001, ""), (5002, "!?"),
                                                              (None, "the naïve x1"), (4, "the " * 30_000)]
    documents += [(7, "same b.c text")] * 60
    items = [(i, some(rng, words, rng.randint(1, 25))) for i in range(40)]
    items += [(100, "tie"), (101, None), (102, "?"), (103, "unseen"), (100, "same w1"), (None, "b c")]
    assert got(spark, documents, items) == brute(documents, items)
    monkeypatch.setattr(ls, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(ls, "_NUMBERS", 500)
    monkeypatch.setattr(ls, "PAIRED", 5)
    assert got(spark, documents, items, top=3) == brute(documents, items, 3)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == []
    assert got(spark, [(1, "a")], []) == []


def test_shared_sets_are_added_up_once():
    rng = random.Random(5)
    items = [frozenset(rng.sample(range(30), rng.randint(1, 12))) for _ in range(60)]
    nodes, operands = ls.shared_sets(items, 30)
    sets = {i: frozenset([i]) for i in range(30)}
    for k, (a, b) in enumerate(nodes):
        assert not sets[a] & sets[b]
        sets[30 + k] = sets[a] | sets[b]
    for item, ops in zip(items, operands):
        assert sum(len(sets[o]) for o in ops) == len(item)
        assert frozenset().union(*(sets[o] for o in ops)) == item
    # Each node serves two items at least, and fewer sums are needed than one by one.
    assert len(nodes) + sum(len(o) - 1 for o in operands) < 0.8 * sum(len(i) - 1 for i in items)


def test_plan_scores_are_plain_sums():
    plan = ls.Plan([(1, "a b c d"), (2, "b c d e"), (3, "a b c"), (4, "z")])
    parts = np.arange(len(plan.terms) * 7).reshape(-1, 7)
    want = [parts[[plan.number[x] for x in t]].sum(axis=0)
            for t in ([b"a", b"b", b"c", b"d"], [b"b", b"c", b"d", b"e"], [b"a", b"b", b"c"], [b"z"])]
    assert plan.nodes and (plan.scores(parts) == np.array(want)).all()
