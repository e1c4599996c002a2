"""Ranked lexical search of many queries at once, their common sub-expressions computed once.

An item's score of a document is a sum over its terms, so items that share terms share partial
sums.  Among the items of a block, shared term sets are mined by pairs: the pair of operands that
most items have becomes a node of its own and takes their place in them, as long as two items
share one; nodes pair with terms and other nodes, so they form a graph.  For a portion of documents
every node is one accumulator per document, added up once from its two operands in the graph's
order; an item adds the few operands that it has left.

1. One pass over the documents writes, for each, its number of terms and the occurrences of the
   items' terms; counts over all documents (documents, terms, documents with a term) follow from
   what was written.
2. Each task evaluates the graph over its documents, a portion at a time, and keeps every item's
   best; lists are merged in two steps, by a hash of the document first.

Scores are whole numbers, so any order of adding gives the same.  Items are taken in blocks of at
most ``BLOCK_ITEMS`` items and ``BLOCK_TERMS`` different terms (or one item): what is broadcast and
mined is bounded by these, however many items there are; one pass serves one block.

Defined cases: null and empty texts have no term and aren't counted among the documents; null ids
rank last among equal scores; repeated documents are ranked each on its own; items of a repeated
id are one each; items without terms, or without a document that has one, have no rows; empty
tables give an empty result; extra columns play no part.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import cut

TOP = 50
BLOCK_ITEMS, BLOCK_TERMS = 256, 100_000
#: Pairs are mined among so many terms of an item, the most popular ones; the others are added one
#: by one (scores are the same).
PAIRED = 128
#: Numbers that a portion of documents may take in accumulators.
_NUMBERS = 1 << 22
_SPREAD = 64

# Letters and digits of ASCII and all bytes above it belong to terms; A-Z are lower-cased.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32
               for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


def shared_sets(items: list[frozenset[int]], first_node: int
                ) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """(nodes, operands of each item): node ``first_node + k`` is the sum of the two operands
    nodes[k], which are terms or earlier nodes; an item is the sum of its operands."""
    left = [set(i) for i in items]
    popular = Counter(op for i in items for op in i)
    having: dict[tuple[int, int], set[int]] = defaultdict(set)
    for n, ops in enumerate(left):
        order = sorted(sorted(ops, key=lambda op: (-popular[op], op))[:PAIRED])
        for i, a in enumerate(order):
            for b in order[i + 1:]:
                having[a, b].add(n)
    for pair in [pair for pair, who in having.items() if len(who) < 2]:
        del having[pair]
    heap = [(-len(who), pair) for pair, who in having.items() if len(who) > 1]
    heapq.heapify(heap)
    nodes: list[tuple[int, int]] = []
    while heap:
        count, pair = heapq.heappop(heap)
        who = having.get(pair, ())
        if len(who) < 2:
            continue
        if len(who) != -count:
            heapq.heappush(heap, (-len(who), pair))
            continue
        node = first_node + len(nodes)
        nodes.append(pair)
        fresh: Counter[int] = Counter()
        for n in list(who):
            ops = left[n]
            ops.difference_update(pair)
            for other in ops:
                for gone in pair:
                    having[min(gone, other), max(gone, other)].discard(n)
                having[other, node].add(n)
                fresh[other] += 1
            ops.add(node)
        del having[pair]
        for other, k in fresh.items():
            if k > 1:
                heapq.heappush(heap, (-k, (other, node)))
    return nodes, [sorted(ops) for ops in left]


class Plan:
    """The terms of a block of items, its graph of shared sums, and the items' operands."""

    def __init__(self, items: list[tuple[int, str | None]]):
        found = [(i, frozenset(terms(t))) for i, t in items]
        found = [(i, t) for i, t in found if t]
        self.items = [(n, i) for n, (i, _) in enumerate(found)]
        self.terms = sorted(set().union(*(t for _, t in found)))
        self.number = {t: n for n, t in enumerate(self.terms)}
        sets = [frozenset(self.number[x] for x in t) for _, t in found]
        self.nodes, self.operands = shared_sets(sets, len(self.terms))

    def scores(self, parts: np.ndarray) -> np.ndarray:
        """(terms x documents) partial scores -> (items x documents) scores."""
        n = len(self.terms)
        sums = np.empty((n + len(self.nodes), parts.shape[1]), np.int64)
        sums[:n] = parts
        for k, (a, b) in enumerate(self.nodes):
            np.add(sums[a], sums[b], out=sums[n + k])
        out = np.empty((len(self.items), parts.shape[1]), np.int64)
        for i, ops in enumerate(self.operands):
            out[i] = sums[ops].sum(axis=0) if len(ops) > 1 else sums[ops[0]]
        return out


def blocks(items: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    """The items block by block, each as (id, text)."""
    block, seen = [], set()
    for row in items.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        new = set(terms(row["text"])) - seen
        if block and (len(block) >= BLOCK_ITEMS or len(seen) + len(new) > BLOCK_TERMS):
            yield block
            block, seen, new = [], set(), set(terms(row["text"]))
        block.append((row["item_id"], row["text"]))
        seen |= new
    if block:
        yield block


def occurrences(docs: DataFrame, plan: Plan) -> DataFrame:
    """doc_id, no_id, n (terms with repeats), and the plan's terms in the document with their
    occurrences, of every document with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(plan.number)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = shared.value
        for b in batches:
            out = []
            for doc_id, no_id, text in zip(b["doc_id"], b["no_id"], b["text"]):
                words = terms(text)
                if words:
                    found = [x for x in map(number.get, words) if x is not None]
                    t, tf = np.unique(np.array(found, np.int32), return_counts=True)
                    out.append((doc_id, no_id, len(words), t.tobytes(),
                                tf.astype(np.int32).tobytes()))
            yield pd.DataFrame(out, columns=["doc_id", "no_id", "n", "terms", "tf"])

    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("doc_id"),
                    F.col("doc_id").isNull().alias("no_id"), "text")
    return d.mapInPandas(count, "doc_id long, no_id boolean, n long, terms binary, tf binary")


def document_counts(found: DataFrame, size: int) -> np.ndarray:
    """Documents that have each of the ``size`` terms."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b["terms"]), np.int32), minlength=size)
        at = np.flatnonzero(total)
        if len(at):
            yield pd.DataFrame({"term": at, "df": total[at]})

    got = found.select("terms").mapInPandas(count, "term long, df long") \
        .groupBy("term").agg(F.sum("df").alias("df")).collect()
    out = np.zeros(size, np.int64)
    for r in got:
        out[r["term"]] = r["df"]
    return out


class _Best:
    """Each item's ``top`` best so far: scores and documents, the worst of which bounds others."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.rows: list[list[tuple]] = [[] for _ in range(items)]
        self.least = np.zeros(items, np.int64)  # a score must be above, or equal to it

    def add(self, scores: np.ndarray, doc_ids: np.ndarray, no_ids: np.ndarray) -> None:
        at, col = np.nonzero(scores >= np.maximum(self.least, 1)[:, None])
        starts = np.searchsorted(at, np.arange(len(self.rows) + 1))
        for i in np.unique(at).tolist():
            c = col[starts[i]:starts[i + 1]]
            s = scores[i, c]
            if len(c) > self.top:
                least = np.partition(s, -self.top)[-self.top]
                c, s = c[s >= least], s[s >= least]
            rows = self.rows[i]
            rows += zip((-s).tolist(), no_ids[c].tolist(), doc_ids[c].tolist())
            if len(rows) > self.top:
                self.rows[i] = rows = heapq.nsmallest(self.top, rows)
            if len(rows) == self.top:
                self.least[i] = -max(rows)[0]


def _task_lists(docs: DataFrame, plan: Plan, top: int) -> DataFrame:
    """Every task's best documents of the plan's items: item (its place in the plan), doc_id,
    no_id, score, spread."""
    found = cut(occurrences(docs, plan), "search-occurrences")
    every = found.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, n_terms = every["docs"], every["terms"]
    df = document_counts(found, len(plan.terms))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(k) + 1)))
                       for k in df], np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((plan, weight, n_docs, n_terms))

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan, weight, n_docs, n_terms = shared.value
        width = len(plan.terms) + len(plan.nodes) + len(plan.items)
        portion, kept = max(1, _NUMBERS // max(1, width)), _Best(len(plan.items), top)
        for b in batches:
            ids, no_ids = b["doc_id"].to_numpy(), b["no_id"].to_numpy()
            m = np.array([100 - 50 + 50 * int(n) * n_docs // n_terms for n in b["n"]], np.int64)
            for at in range(0, len(b), portion):
                rows = slice(at, at + portion)
                found = [np.frombuffer(x, np.int32) for x in b["terms"].iloc[rows]]
                doc = np.repeat(np.arange(len(found)), [len(x) for x in found])
                term = np.concatenate(found)
                tf = np.frombuffer(b"".join(b["tf"].iloc[rows]), np.int32).astype(np.int64)
                parts = np.zeros((len(plan.terms), len(found)), np.int64)
                parts[term, doc] = weight[term] * (
                    (1_000_000_000 * tf) // (1000 * tf + 20 * m[rows][doc]))
                kept.add(plan.scores(parts), ids[rows], no_ids[rows])
        out = [(i, doc_id, no_id, -s, k % _SPREAD) for i, rows in enumerate(kept.rows)
               for k, (s, no_id, doc_id) in enumerate(rows)]
        if out:
            yield pd.DataFrame(out, columns=["item", "doc_id", "no_id", "score", "spread"])

    return found.mapInPandas(best, "item int, doc_id long, no_id boolean, score long, spread int")


def _first(rows: DataFrame, groups: list[str], top: int) -> DataFrame:
    """``rows`` with their rank in ``groups``, the first ``top``."""
    order = Window.partitionBy(*groups).orderBy(F.col("score").desc(), "no_id", "doc_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(doc_id, text) and (item_id, text) -> item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in blocks(items):
        plan = Plan(block)
        if not plan.items:
            continue
        rows = _task_lists(docs, plan, top)
        rows = _first(_first(rows, ["item", "spread"], top).drop("rank"), ["item"], top)
        names = F.broadcast(spark.createDataFrame(plan.items, "item int, item_id long"))
        doc_id = F.when(~F.col("no_id"), F.col("doc_id"))
        out = out.unionByName(rows.join(names, "item").select(
            "item_id", "rank", doc_id.alias("doc_id"), "score"))
    return out
