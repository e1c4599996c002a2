"""Packing documents into sequences of ``WINDOW`` tokens by non-negative least squares.

1. Every document is tokenised and cut into whole windows and a remainder.  The pieces are
   written with their rank among the pieces of that length in their task.
2. The histogram of remainder lengths (one number per length below the window) goes to the
   driver, where shallow combinations of two to four lengths that fill a window exactly are
   enumerated and repeat counts are solved: minimise |A x - histogram|, x >= 0.  Counts are
   rounded down to what the histogram holds.
3. A piece's rank among all of its length picks its place in a combination, by arithmetic on
   numbers of pieces alone.
4. Pieces that no combination takes are packed greedily: laid end to end, longest first, and
   cut at each window, so only the very last sequence may be short.

A sequence is padded to the window unless its length is a power of two.

Defined cases: null text is empty (its id 0 alone); repeated rows are documents of their own;
long documents are cut into as many windows as they need; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import cut

WINDOW = 1024
END_ID = 0
#: Combinations of three and four lengths that are tried for each longest length.
SHALLOW = 8
_PIECES = ("doc_id string, task int, start long, length int, ids_crc32 long, doc_tokens long, "
           "nth long, ids binary")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


# How a byte-level vocabulary writes bytes as characters (the printable ones as
# they are, the others from U+0100 on), and the pattern that cuts texts before merging.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_OF = {chr(b): b for b in _PRINTABLE} | {
    chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Below this character all libraries agree on what is a letter, a number or a blank.
_PLAIN_BELOW = "\u0250"


def _by_rank(path: str):
    """The vocabulary as a merger by rank, which gives the same ids several times faster; None
    if the file's merges aren't in the order of their ids."""
    import tiktoken
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocabulary = model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
    if any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return None
    ranks = {bytes(_BYTE_OF[c] for c in token): i for token, i in vocabulary.items()
             if i < 256 + len(pairs)}
    return tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Texts to little-endian 32-bit ids.

    A text whose characters are all below ``_PLAIN_BELOW`` is merged by rank; others, and those
    that hold one of the file's added tokens (which get their own id there), go through
    ``tokenizers`` itself.
    """

    _other = re.compile(f"[{_PLAIN_BELOW}-\U0010ffff]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._ranks = _by_rank(path)

    def ids(self, text: str) -> bytes:
        if self._ranks is not None and (text.isascii() or not self._other.search(text)) \
                and not any(t in text for t in self._added):
            found = self._ranks.encode_ordinary(text)
        else:
            found = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(found, "<u4").tobytes()

    def batch(self, texts: list[str]) -> list[bytes]:
        return [self.ids(t) for t in texts]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _pieces(batches: Iterator[pd.DataFrame], path: str, window: int) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext
    task = TaskContext.get().partitionId()
    seen = np.zeros(window + 1, np.int64)
    end = np.array([END_ID], "<u4").tobytes()
    enc = encoder(path)
    for b in batches:
        out = []
        for at in range(0, len(b), 64):  # so many texts' ids are held at once
            part = b.iloc[at:at + 64]
            texts = [t or "" for t in part["text"]]
            for doc_id, ids in zip(part["doc_id"], enc.batch(texts)):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, window):
                    piece = ids[4 * start:4 * (start + window)]
                    length = len(piece) // 4
                    out.append((doc_id, task, start, length, zlib.crc32(piece), n, seen[length],
                                piece if length < window else None))
                    seen[length] += 1
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _PIECES.split(", ")])


def _two(have: np.ndarray, total: int, most: int) -> np.ndarray:
    """The larger lengths c <= most for which c and total - c <= c are both there."""
    c = np.arange(-(-total // 2), min(most, total - 1) + 1)
    return c[have[c] & have[total - c]] if len(c) else c


def _spread(values: np.ndarray, n: int) -> list[int]:
    """Up to ``n`` of the values, evenly spaced."""
    at = np.linspace(0, len(values) - 1, min(n, len(values))).round().astype(int)
    return values[np.unique(at)].tolist()


def combinations(lengths: np.ndarray, window: int = WINDOW, shallow: int = SHALLOW) -> list[tuple]:
    """Two to four of ``lengths``, repeats allowed, that fill the window (falling order): every
    pair, and for each longest length up to ``shallow`` sets of three and of four, with the
    others evenly spaced."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    out = [(a, window - a) for a in _two(have, window, window - 1).tolist()]
    for a in sorted(lengths.tolist(), reverse=True):
        rest = window - a
        out += [(a, b, rest - b) for b in _spread(_two(have, rest, a), shallow)]
        second = lengths[(lengths <= min(a, rest - 2)) & (3 * lengths >= rest)]
        for b in _spread(second, shallow):
            out += [(a, b, c, rest - b - c) for c in _spread(_two(have, rest - b, b), 1)]
    return list(dict.fromkeys(out))


def nnls(columns: list[dict[int, int]], b: list[float], sweeps: int = 60) -> list[float]:
    """x >= 0 that (nearly) minimises |A x - b|, by exact steps along one coordinate after
    another.  ``columns``: the few entries of each column of A."""
    x, rest = [0.0] * len(columns), list(b)
    entries = [(tuple(c.items()), sum(v * v for v in c.values())) for c in columns]
    for _ in range(sweeps):
        moved = 0.0
        for j, (column, norm) in enumerate(entries):
            old = x[j]
            new = old + sum(v * rest[i] for i, v in column) / norm
            new = new if new > 0.0 else 0.0
            if new != old:
                x[j] = new
                for i, v in column:
                    rest[i] -= v * (new - old)
                moved = max(moved, abs(new - old))
        if moved < 0.5:
            break
    return x


def solve(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[tuple, int]]:
    """(combination, repeats) that the histogram of lengths below the window can serve: the
    solved counts rounded to what is left of it, then as many more as fit (longest first)."""
    left = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    lengths = np.flatnonzero(left[:window])
    if not len(lengths):
        return []
    sets = combinations(lengths, window)
    x = nnls([{n: c.count(n) for n in c} for c in sets], left.astype(float).tolist())
    counts = np.zeros(len(sets), np.int64)

    def take(j: int, most: int) -> None:
        need = {n: sets[j].count(n) for n in set(sets[j])}
        got = min([most, *(int(left[n]) // m for n, m in need.items())])
        if got > 0:
            counts[j] += got
            for n, m in need.items():
                left[n] -= got * m

    for j in sorted(range(len(sets)), key=lambda j: -x[j]):
        take(j, int(x[j] + 1e-6))
    for j in range(len(sets)):
        take(j, int(left.sum()))
    return [(sets[j], int(counts[j])) for j in range(len(sets)) if counts[j]]


def layout(histogram: dict[int, int], window: int = WINDOW) -> tuple[list[tuple], list[tuple], int]:
    """Where the pieces go, by length and rank.

    ``slots``: (length, from_rank, pieces, per_sequence, first_sequence, offset): the ranks
    from ``from_rank`` on, ``per_sequence`` to a sequence, start at ``offset`` in it.
    ``tails``: (length, from_rank, token): later ranks lie end to end from that token on.
    Then the first sequence that the tails use.
    """
    slots, used, sequence = [], dict.fromkeys(histogram, 0), 0
    if histogram.get(window):
        slots.append((window, 0, histogram[window], 1, 0, 0))
        sequence = used[window] = histogram[window]
    for c, repeats in solve({n: k for n, k in histogram.items() if n < window}, window):
        offset = 0
        for length in dict.fromkeys(c):
            per = c.count(length)
            slots.append((length, used[length], repeats * per, per, sequence, offset))
            used[length] += repeats * per
            offset += length * per
        sequence += repeats
    tails, token = [], 0
    for length in sorted(histogram, reverse=True):
        if used[length] < histogram[length]:
            tails.append((length, used[length], token))
            token += (histogram[length] - used[length]) * length
    return slots, tails, sequence


def _cut_tail(batches: Iterator[pd.DataFrame], window: int) -> Iterator[pd.DataFrame]:
    """Pieces laid from ``token`` on, cut at the windows' ends."""
    for b in batches:
        out = []
        for r in b.itertuples(index=False):
            at = 0
            while at < r.length:
                room = window - (r.token + at) % window
                part = r.ids[4 * at:4 * min(at + room, r.length)]
                out.append((r.doc_id, r.start + at, len(part) // 4, zlib.crc32(part),
                            r.doc_tokens, r.first + (r.token + at) // window,
                            (r.token + at) % window))
                at += len(part) // 4
        yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                         "sequence_id", "offset"])


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW) -> DataFrame:
    """(doc_id, text) -> a row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    spark = docs.sparkSession
    path = path or tokenizer_path()
    # Ids travel through pandas as text: a null beside them would make them floats.
    d = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    pieces = cut(d.mapInPandas(lambda bs: _pieces(bs, path, window), _PIECES), "packing-pieces")
    # Ranks among all pieces of a length: the tasks' counts are summed in order of task.
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in
                 per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots, tails, first = layout(histogram, window)
    before = Window.partitionBy("length").orderBy("task") \
        .rowsBetween(Window.unboundedPreceding, -1)
    ranks = per_task.select(F.col("length").alias("o_length"), F.col("task").alias("o_task"), "n",
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    same = (F.col("length") == F.col("o_length")) & (F.col("task") == F.col("o_task"))
    ranked = pieces.drop("ids").join(ranks, same) \
        .withColumn("rank", F.col("earlier") + F.col("nth"))
    # As many rows as the combinations used, a number that the window bounds.
    places = F.broadcast(spark.createDataFrame(
        slots, "s_length int, s_rank long, s_pieces long, s_per long, s_first long, s_offset long"))
    nth = F.col("rank") - F.col("s_rank")
    whole = ranked.join(places, (F.col("length") == F.col("s_length")) & (nth >= 0)
                        & (nth < F.col("s_pieces"))).select(
        F.col("doc_id").cast("long").alias("doc_id"), "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("s_first") + F.floor(nth / F.col("s_per"))).cast("long").alias("sequence_id"),
        (F.col("s_offset") + nth % F.col("s_per") * F.col("length")).cast("long").alias("offset"))
    if not tails:
        return whole
    # Tails have the highest ranks of their lengths: few tasks' pieces, and only theirs need ids.
    rest = F.broadcast(spark.createDataFrame(tails, "r_length int, r_rank long, r_token long"))
    late = ranks.join(rest, (F.col("o_length") == F.col("r_length"))
                      & (F.col("earlier") + F.col("n") > F.col("r_rank")))
    rank = F.col("earlier") + F.col("nth")
    tail = pieces.join(late, same).filter(rank >= F.col("r_rank")).select(
        "doc_id", "start", "length", "doc_tokens", "ids", F.lit(first).alias("first"),
        (F.col("r_token") + (rank - F.col("r_rank")) * F.col("length")).alias("token"))
    tail = tail.mapInPandas(
        lambda bs: _cut_tail(bs, window), "doc_id string, start long, length long, ids_crc32 long, "
        "doc_tokens long, sequence_id long, offset long")
    return whole.unionByName(tail.withColumn("doc_id", F.col("doc_id").cast("long")))
