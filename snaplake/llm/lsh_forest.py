"""MinHash near-duplicates by an LSH forest.

A document's set is its distinct shingles of ``SHINGLE`` words, as 64-bit hashes; documents with
equal sets are one class.  A class has ``TREES * DEEPEST`` minima of permuted hashes.  Each tree of
the forest sorts the classes by its own ``DEEPEST`` minima; those that share the longest prefixes
are neighbours there.  A region of a tree is a run of classes with a common prefix.  Its depth
adapts: ``SHALLOWEST`` where at most ``REGION`` classes share it, deeper where more do, and at
``DEEPEST`` regions of any size are taken, dealt into pairs of blocks.  Neighbours in a region whose
minima agree in ``LEAST_AGREEMENT`` of all places are candidates.

Candidates only say what may belong together: their components are clusters, and every link is
confirmed on the full sets, in two passes over the texts of clusters with company.  First each block
of a cluster is compared together with the cluster's first class; then the blocks of clusters
that this leaves in several parts are compared pair by pair.  Both skip classes that are connected
already, so a cluster of near copies costs one comparison a class, and no task emits its pairs.

Which links may be missed: two documents at exactly the threshold 0.8 share no region of depth 3 with
a probability of 6e-7, of depth 4 with 3e-5, and of depth 5 (in regions of more than ``REGION``
classes) with 4e-4 -- and are then still found if a chain of candidates joins their cluster.
Confirmed links are exact but for 64-bit collisions of shingles.

Defined cases: with fewer words than a shingle the whole sequence is the one shingle; null texts
and texts without a word have an empty set and are linked with nothing, not even each other;
repeated rows share a component; a component's id is its smallest doc_id, null ids count only if
there is no other; extra columns play no part; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import cut
from snaplake.llm.components import components

SHINGLE = 4
#: Link if 100 * intersection >= NEAR * union.
NEAR = 80
TREES, SHALLOWEST, DEEPEST = 20, 3, 5
REGION = 256
BLOCK = 512
#: Share of equal minima (eight bits of each) that makes a candidate: five standard deviations
#: below the threshold.
LEAST_AGREEMENT = 0.6
SEED = 11
KNOWN_WORDS = 200_000
_PORTION = 1 << 9
_FIELDS = "n long, class binary, minima binary"


class Words(dict):
    """Word -> 64-bit hash, remembered for up to ``KNOWN_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return got


_WORDS = Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct shingles' hashes, sorted."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = min(shingle, len(words))
    # Fewer words than a shingle are marked by their number, so they equal no shingle's part.
    total = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        total = _mixed(total + h[i:len(h) - n + 1 + i])
    return np.unique(total)


def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    """What the 32-bit hashes are flipped and multiplied with."""
    rng = np.random.default_rng(SEED)
    draw = lambda: rng.integers(0, 1 << 32, (n, 1), np.uint32)
    return draw(), draw() | np.uint32(1)


_FLIP, _FACTOR = permutations(TREES * DEEPEST)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The minima of the permuted hashes."""
    low = hashes.astype(np.uint32)
    least = np.full(len(_FLIP), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), _PORTION):
        part = low[None, at:at + _PORTION]
        np.minimum(least, ((part ^ _FLIP) * _FACTOR).min(axis=1), out=least)
    return least.astype(">u4")


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, t, n, class, minima) of every row; ``t`` is a hash of the text, class and minima
    are null for an empty set."""
    @F.pandas_udf(_FIELDS)
    def of(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            s = shingle_set(t)
            out.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                        minima(s).tobytes()) if len(s) else (0, None, None))
        return pd.DataFrame(out, columns=["n", "class", "minima"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("t"), of("text").alias("s")) \
        .select("doc_id", "t", "s.*")


def _agreement(least: np.ndarray, one: np.ndarray) -> np.ndarray:
    return (least == one).mean(axis=1)


def _near(a: np.ndarray, b: np.ndarray, near: int) -> bool:
    if 100 * min(len(a), len(b)) < near * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= near * (len(a) + len(b) - both)


def _linked(nodes: np.ndarray, root: np.ndarray, low: np.ndarray, texts: list | None,
            near: int) -> Iterator[tuple[int, int]]:
    """Links inside one group that connect what isn't connected yet: between sets of ``texts``,
    or (None) between minima alone.  Equal ``root``: connected already."""
    sets: dict[int, np.ndarray] = {}

    def of(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingle_set(texts[i])
        return sets[i]

    for i in range(len(nodes) - 1):
        rest = np.flatnonzero(root[i + 1:] != root[i]) + i + 1
        if not len(rest):
            continue
        for j in rest[_agreement(low[rest], low[i]) >= LEAST_AGREEMENT].tolist():
            if root[j] != root[i] and (texts is None or _near(of(i), of(j), near)):
                yield int(nodes[i]), int(nodes[j])
                root[root == root[j]] = root[i]


def _in_runs(batches: Iterator[pd.DataFrame], keys: list[str], near: int
             ) -> Iterator[pd.DataFrame]:
    """``_linked`` for every run of equal ``keys``; a run may go on in the next batch."""
    held = None

    def links(rows: pd.DataFrame, ends: np.ndarray) -> pd.DataFrame:
        nodes, root = rows["node"].to_numpy(), rows["root"].to_numpy().copy()
        low = np.frombuffer(b"".join(rows["minima"]), np.uint8).reshape(len(rows), -1)[:, 3::4]
        texts = rows["text"].tolist() if "text" in rows else None
        found, start = [], 0
        for end in ends.tolist():
            if end - start > 1:
                found += _linked(nodes[start:end], root[start:end], low[start:end],
                                 texts[start:end] if texts else None, near)
            start = end
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    for rows in batches:
        if not len(rows):
            continue
        rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
        k = rows[keys].to_numpy()
        ends = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        whole = int(ends[-1]) if len(ends) else 0
        held = rows.iloc[whole:]
        if whole:
            yield links(rows.iloc[:whole], ends)
    if held is not None:
        yield links(held, np.array([len(held)]))


def _compared(rows: DataFrame, keys: list[str], near: int = NEAR) -> DataFrame:
    """Links (a, b) inside the groups of equal ``keys``, each group in the order of its nodes:
    between full sets if there is a column ``text``, else between minima."""
    return rows.repartition(*keys).sortWithinPartitions(*keys, "node") \
        .mapInPandas(lambda bs: _in_runs(bs, keys, near), "a long, b long")


def _block_pairs(rows: DataFrame, block: int) -> DataFrame:
    """``rows`` (with ``members``, the size of their group) once for each pair of blocks (x, y)
    that their own block is in."""
    blocks = F.ceil(F.col("members") / block).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    r = rows.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return r.withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other")) \
        .drop("own", "other", "members")


def candidates(classes: DataFrame, region: int = REGION, block: int = BLOCK) -> DataFrame:
    """(node, minima) of the classes -> candidate links (a, b) of neighbours in some tree."""
    def prefix(tree: int, depth: int):
        return F.xxhash64(F.lit(tree), F.substring("minima", 4 * DEEPEST * tree + 1, 4 * depth))

    depths = range(SHALLOWEST, DEEPEST + 1)
    trees = F.explode(F.array(*[F.struct(
        F.lit(t).alias("tree"), *[prefix(t, d).alias(f"p{d}") for d in depths])
        for t in range(TREES)])).alias("at")
    open_rows = classes.select("node", trees).select("node", "at.*")
    regions = None
    for d in depths:
        # Alone at this depth: no neighbour.  Few: a region.  Many: a level deeper.
        shared = open_rows.groupBy("tree", f"p{d}").agg(F.count("*").alias("members")) \
            .filter("members > 1")
        company = cut(open_rows.join(shared, ["tree", f"p{d}"]), "forest-depth")
        ends = F.lit(True) if d == DEEPEST else F.col("members") <= region
        done = company.filter(ends).select("node", "tree", F.lit(d).alias("depth"),
                                           F.col(f"p{d}").alias("prefix"), "members")
        regions = done if regions is None else regions.unionByName(done)
        open_rows = company.filter(~ends).drop("members", f"p{d}")
    rows = _block_pairs(regions, max(block, region)).join(
        classes.select("node", "minima"), "node").withColumn("root", F.col("node"))
    return _compared(rows, ["tree", "depth", "prefix", "x", "y"])


def _with_root(rows: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``rows`` with the smallest node that ``links`` connect theirs with, as ``name``."""
    roots = components(links).select(F.col("node").alias("r_node"), F.col("root").alias("r_root"))
    return rows.join(roots, F.col("node") == F.col("r_node"), "left") \
        .withColumn(name, F.coalesce("r_root", "node")).drop("r_node", "r_root")


def _texts(members: DataFrame, docs: DataFrame) -> DataFrame:
    """``members`` (node, doc_id, t, ...) with the text of their document; rows that repeat it
    count once."""
    own = docs.select(F.col("doc_id").cast("long").alias("d_id"), F.xxhash64("text").alias("d_t"),
                      "text")
    found = members.join(own, F.col("doc_id").eqNullSafe(F.col("d_id"))
                         & (F.col("t") == F.col("d_t")))
    others = [F.first(c).alias(c) for c in found.columns if c not in ("node", "d_id", "d_t")]
    return found.groupBy("node").agg(*others).drop("doc_id", "t")


def confirmed(classes: DataFrame, docs: DataFrame, near: int = NEAR, block: int = BLOCK,
              region: int = REGION) -> DataFrame:
    """Classes (node, minima, and doc_id, t: the document that shows its text) -> links (a, b) that
    connect all classes that candidates and full sets link."""
    named = _with_root(classes, candidates(classes, region, block), "cluster")
    sizes = named.groupBy("cluster").agg(F.count("*").alias("members")).filter("members > 1")
    rows = cut(_texts(named.join(sizes, "cluster"), docs), "forest-clusters")
    # First pass: a block of the cluster with the cluster's first class.
    blocks = F.ceil(F.col("members") / block).cast("int")
    first = F.col("node") == F.col("cluster")
    at = F.when(first, F.sequence(F.lit(0), blocks - 1)) \
        .otherwise(F.array(F.pmod(F.xxhash64("node"), blocks).cast("int")))
    dealt = rows.withColumn("x", F.explode(at)).withColumn("root", F.col("node"))
    links = cut(_compared(dealt.drop("members"), ["cluster", "x"], near), "forest-first")
    # Second pass: what is still in parts.
    found = cut(_with_root(rows.select("node", "cluster"), links, "root"), "forest-roots")
    parts = found.groupBy("cluster").agg(F.min("root").alias("least"), F.max("root").alias("most")) \
        .filter("least <> most").select("cluster")
    rest = rows.join(parts, "cluster").join(found.select("node", "root"), "node")
    more = _compared(_block_pairs(rest, block), ["cluster", "x", "y"], near)
    return links.unionByName(cut(more, "forest-second"))


def near_duplicates(docs: DataFrame, near: int = NEAR, block: int = BLOCK,
                    region: int = REGION) -> DataFrame:
    """(doc_id, text) -> doc_id, n_shingles, component_id, kept; a row per row."""
    rows = cut(sketches(docs), "forest-sketches")
    # A class is shown by its smallest document, and named by half of its 128-bit digest.
    node = F.conv(F.substring(F.hex("class"), 1, 16), 16, -10).cast("long")
    shown = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")
    classes = cut(rows.filter("class IS NOT NULL").groupBy("class").agg(
        F.min(shown).alias("first"), F.first("minima").alias("minima"))
        .select("class", node.alias("node"), "first.doc_id", "first.t", "minima"), "forest-classes")
    links = confirmed(classes.drop("class"), docs, near, block, region)
    named = _with_root(classes.select("class", "node", "doc_id"), links, "root")
    ids = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(ids, "root").select(F.col("class").alias("c_class"), "component_id")
    out = rows.join(named, F.col("class") == F.col("c_class"), "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
