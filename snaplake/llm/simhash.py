"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints: 64 bits, from the XXH64 (seed 42) of each shingle of ``SHINGLE`` words.  For a
radius r, every bit i gets a vector m(i) of r + 1 bits; the mask of a vector v keeps the bits
with an odd <m(i), v>.  Whatever r bits two fingerprints differ in, some v other than zero is
orthogonal to their r vectors, so its mask drops them all: with the 2**(r+1) - 1 masks as
tables, each pair within the radius shares a bucket of some table.

Only distinct fingerprints are compared.  Buckets with company are dealt into blocks of about
``BLOCK`` members by their counted size; every pair of blocks is one group, in which bit
distances are computed row by row and the found links are thinned to a spanning forest of real
links.  So a bucket of any size is compared whole, spread over many tasks, and no group emits
its pairs.

Defined cases: null and empty texts have the fingerprint zero and are linked like any other;
fewer words than a shingle make one shingle of the whole sequence; repeated rows share a
component; a component's id is its smallest doc_id (null ids only if it has no other).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import cut, own_columns, row_hash
from snaplake.llm.components import components

SHINGLE = 3
RADIUS = 3
BITS = 64
BLOCK = 1024
SEED = 42
#: Shingles whose bits are counted at once.
_PORTION = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint: bits set in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    join, h64 = b" ".join, xxhash.xxh64_intdigest
    for at in range(0, n, _PORTION):
        part = words[at:at + _PORTION + shingle - 1]
        grams = map(join, zip(*[part[i:] for i in range(shingle)])) \
            if len(words) >= shingle else [join(words)]
        hashes = np.array([h64(g, SEED) for g in grams], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp): the fingerprint as a signed long."""
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
        return pd.Series(fps.view(np.int64))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), of("text").alias("fp"))


def masks(radius: int = RADIUS) -> list[int]:
    """The covering masks, as signed longs."""
    vectors = (1 << (radius + 1)) - 1
    out = []
    for v in range(1, vectors + 1):
        m = sum(1 << i for i in range(BITS) if ((i % vectors + 1) & v).bit_count() % 2)
        out.append(m - (1 << BITS) if m >> (BITS - 1) else m)
    return out


def _forest(fps: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links between fingerprints within the radius, enough to connect what they connect."""
    rest = np.arange(len(fps))
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            near = np.bitwise_count(fps[rest] ^ fps[i]) <= radius
            for j in rest[near]:
                yield i, j
            queue.extend(rest[near])
            rest = rest[~near]


def _links_of(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Links inside the runs of equal (t, bucket, x, y); a run may go on in the next batch."""
    keep = None
    keys = ["t", "bucket", "x", "y"]

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        k = rows[keys].to_numpy()
        ends = np.flatnonzero(np.r_[(k[1:] != k[:-1]).any(axis=1), True]) + 1
        fps, a, b, start = rows["fp"].to_numpy().view(np.uint64), [], [], 0
        for end in ends:
            for i, j in _forest(fps[start:end], radius) if end - start > 1 else ():
                a.append(start + i)
                b.append(start + j)
            start = end
        signed = fps.view(np.int64)
        return pd.DataFrame({"a": signed[a], "b": signed[b]})

    for rows in batches:
        rows = rows if keep is None else pd.concat([keep, rows], ignore_index=True)
        k = rows[keys].to_numpy()
        same = (k == k[-1]).all(axis=1) if len(rows) else np.zeros(0, bool)
        keep = rows[same]
        if (~same).any():
            yield links(rows[~same])
    if keep is not None and len(keep):
        yield links(keep)


def links(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(fp) of distinct fingerprints -> links (a, b) that connect all within the radius."""
    tables = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(m)
                                          .alias("bucket"))
                                 for t, m in enumerate(masks(radius))])).alias("at")
    members = distinct.select("fp", tables).select("fp", "at.t", "at.bucket")
    company = members.groupBy("t", "bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = members.join(company, ["t", "bucket"])
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    members = members.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    members = members.select("t", "bucket", F.least("own", "other").alias("x"),
                             F.greatest("own", "other").alias("y"), "fp")
    keys = ["t", "bucket", "x", "y"]
    return members.repartition(*keys).sortWithinPartitions(*keys) \
        .mapInPandas(lambda bs: _links_of(bs, radius), "a long, b long")


def _classes(docs: DataFrame, shingle: int, radius: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, first, root): each distinct fingerprint's smallest
    doc_id and its component's root."""
    fps = cut(fingerprints(docs, shingle), "simhash-fingerprints")
    classes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    roots = components(links(classes.select("fp"), radius, block))
    named = classes.join(roots, classes["fp"] == roots["node"], "left") \
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    return fps, named


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                    block: int = BLOCK) -> DataFrame:
    """(doc_id, text) -> doc_id, fingerprint (16 hex digits), component_id; a row per row."""
    fps, named = _classes(docs, shingle, radius, block)
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(ids, "root").select(F.col("fp").alias("class_fp"), "component_id")
    return fps.join(named, fps["fp"] == named["class_fp"]).select(
        "doc_id", _hex(F.col("fp")).alias("fingerprint"), "component_id")


def _hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
             block: int = BLOCK) -> DataFrame:
    """One row of ``docs`` (all columns) of each component: that with the smallest doc_id (null
    ids last), of several texts with that id the one with the smallest fingerprint; rows that
    repeat both are one document, of which the first by text and other columns stays."""
    own, kept_id, kept_fp, copies = own_columns(docs, "simhash_", "fp", "id", "kept", "copies")
    fps, named = _classes(docs, shingle, radius, block)
    best = named.groupBy("root").agg(F.min(F.struct(
        F.col("first").isNull().alias("none"), "first", "fp")).alias("best")) \
        .select(F.col("best.first").alias(kept_id), F.col("best.fp").alias(kept_fp))
    # A fingerprint is in one component, so (id, fingerprint) names a single component.
    n = fps.groupBy("doc_id", "fp").agg(F.count("*").alias("n"))
    kept = cut(best.join(n, (F.col(kept_fp) == n["fp"]) & F.col(kept_id).eqNullSafe(n["doc_id"]))
               .select(kept_id, kept_fp, F.col("n").alias(copies)), "simhash-kept")

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts],
                                  np.uint64).view(np.int64))

    rows = docs.withColumn(own, of("text"))
    rows = rows.join(kept, (F.col(own) == F.col(kept_fp))
                     & F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id)))
    once = rows.filter(F.col(copies) == 1).select(docs.columns)
    # Rows that share both but aren't alike: the smallest by text, then by a hash of all columns.
    same = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(own)
    order = F.struct(F.col("text"), row_hash(docs))
    again = rows.filter(F.col(copies) > 1).select(F.col(kept_fp), order.alias(kept_id), same) \
        .groupBy(kept_fp).agg(F.min_by(own, kept_id).alias(own)).select(f"{own}.*")
    return once.unionByName(again)
