"""Exact top-k inner products: tiled matrix products of query blocks and candidate shards,
partial selection in each tile, and a tree merge of the per-query lists.

Vectors become integers floor(``SCALE`` * x).  Rows are packed into blocks of ``ROWS`` vectors
(a binary matrix each), the query blocks are dealt to slots, and every candidate block meets
every slot by an equi-join, so a tile holds two blocks whatever the tables' sizes.  A tile
returns k rows per query; lists merge ``FAN`` tiles at a time.

Products are exact: in float64 while all partial sums stay below 2**53, else in Python
integers; a score that doesn't fit a long is the nearest long.

Defined cases: vectors that are null, or hold null or non-finite components, take no part;
vectors of unlike lengths score only against those of their own length; a candidate with the
query's own vec_id is left out, repeated rows of other ids each count; equal scores go to the
smaller vec_id; fewer than k candidates give them all; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import cut

SCALE = 256
ROWS = 2048
FAN = 64
_LARGEST = float(np.finfo(np.float64).max) / SCALE
_BLOCK = "dim int, block long, ids binary, matrix binary"
_LISTS = "query_id long, q_block long, q_row long, tile long, vec_id long, score long"


def _packed(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Blocks of up to ``rows`` vectors of one length each."""
    from pyspark import TaskContext
    number = TaskContext.get().partitionId() << 32
    waiting: dict[int, list] = {}

    def block(dim: int, part: list) -> pd.DataFrame:
        nonlocal number
        ids, vectors = zip(*part)
        number += 1
        x = np.array(vectors, np.float64).reshape(len(part), dim)
        x = np.floor(np.clip(x, -_LARGEST, _LARGEST) * SCALE)
        return pd.DataFrame([(dim, number, np.array(ids, np.int64).tobytes(), x.tobytes())],
                            columns=["dim", "block", "ids", "matrix"])

    for b in batches:
        for i, v in zip(b["vec_id"], b["embedding"]):
            part = waiting.setdefault(len(v), [])
            part.append((i, v))
            if len(part) == rows:
                yield block(len(v), waiting.pop(len(v)))
    for dim, part in waiting.items():
        yield block(dim, part)


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """(vec_id, embedding), already free of nulls -> binary blocks."""
    n = vectors.count()
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = vectors.repartition(max(1, min(parts, -(-n // rows))))
    return spread.mapInPandas(lambda bs: _packed(bs, rows), _BLOCK)


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    most = (np.abs(q).max(initial=0) * np.abs(c).max(initial=0)) * max(q.shape[1], 1)
    if most < 2.0 ** 53:
        return (q @ c.T).astype(np.int64)
    exact = [[int(x) for x in r] for r in q.tolist()], [[int(x) for x in r] for r in c.tolist()]
    low, high = -(1 << 63), (1 << 63) - 1
    return np.array([[min(high, max(low, sum(x * y for x, y in zip(a, b)))) for b in exact[1]]
                     for a in exact[0]], dtype=np.int64)


def _tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int):
    """(query row, vec_id, score) of the best k candidates of each query in this tile."""
    order = np.argsort(c_ids, kind="stable")  # ties go to the smaller id
    c_ids, s = c_ids[order], _scores(q, c[order])
    out = []
    for row in range(len(q)):
        v = s[row]
        other = c_ids != q_ids[row]
        ids, v = (c_ids, v) if other.all() else (c_ids[other], v[other])
        if len(v) > k:
            least = np.partition(v, len(v) - k)[len(v) - k]
            above, level = np.flatnonzero(v > least), np.flatnonzero(v == least)
            pick = np.r_[above, level[:k - len(above)]]
            ids, v = ids[pick], v[pick]
        out.append((np.full(len(v), row), ids, v))
    return [np.concatenate(x) for x in zip(*out)]


def _tiles(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    for b in batches:
        for r in b.itertuples(index=False):
            q_ids, c_ids = (np.frombuffer(x, np.int64) for x in (r.q_ids, r.ids))
            q, c = (np.frombuffer(m, np.float64).reshape(len(i), r.dim)
                    for m, i in ((r.q_matrix, q_ids), (r.matrix, c_ids)))
            row, ids, score = _tile(q_ids, q, c_ids, c, k)
            yield pd.DataFrame({"query_id": q_ids[row], "q_block": r.q_block, "q_row": row,
                                "tile": r.block, "vec_id": ids, "score": score})


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, rows: int = ROWS) -> DataFrame:
    """(vec_id, embedding) twice -> query_id, rank (from 1), vec_id, score."""
    def usable(df: DataFrame) -> DataFrame:
        x = F.col("embedding").cast("array<double>")
        bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")) \
            .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)

    c = cut(blocks(usable(vectors), rows), "topk-shards")
    q = cut(blocks(usable(queries), rows), "topk-queries")
    slots = max(1, q.count())
    q = q.select(F.pmod(F.xxhash64("block"), F.lit(slots)).alias("slot"), F.col("dim").alias("q_dim"),
                 F.col("block").alias("q_block"), F.col("ids").alias("q_ids"),
                 F.col("matrix").alias("q_matrix"))
    every = F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))
    spread = c.withColumn("slot", F.explode(every))
    tiles = spread.join(q, (spread["slot"] == q["slot"]) & (spread["dim"] == q["q_dim"])) \
        .select("dim", "block", "ids", "matrix", "q_block", "q_ids", "q_matrix")
    lists = cut(tiles.mapInPandas(lambda bs: _tiles(bs, k), _LISTS), "topk-tiles")
    width = max(1, c.count())
    merged = lists.select("query_id", "q_block", "q_row",
                          F.pmod(F.xxhash64("tile"), F.lit(width)).alias("tile"),
                          F.struct((-F.col("score")).alias("down"), "vec_id").alias("b"))
    while True:  # one round at least, until a query's lists are one
        width = -(-width // FAN)
        merged = merged.groupBy("query_id", "q_block", "q_row",
                                F.floor(F.col("tile") / FAN).alias("tile")) \
            .agg(F.slice(F.sort_array(F.collect_list("b")), 1, k).alias("best"))
        if width == 1:
            break
        merged = merged.select("query_id", "q_block", "q_row", "tile", F.explode("best").alias("b"))
    out = merged.select("query_id", F.posexplode("best").alias("p", "b"))
    return out.select("query_id", (F.col("p") + 1).cast("int").alias("rank"),
                      F.col("b.vec_id").alias("vec_id"), (-F.col("b.down")).alias("score"))
