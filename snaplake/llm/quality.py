"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer
network with temperature-calibrated probabilities.

A token's type is its lower-cased form if it is a plain word (small letters, maybe a capital first,
maybe punctuation last), else its shape (runs of capitals, small letters and digits as ``A a 9``,
other characters as they are, each run once); a token equal to the one before it has the type
``=``.  Types are hashed to ``ROWS`` rows, so no type is left out and the table has a fixed size;
types that share a row share its vectors.  Each row has a sparse random index vector; its word
vector adds up the index vectors of its tokens' neighbours over all documents, labelled or not,
plus its own.  A document is the mean of its tokens' vectors and its log length.  The network learns
on most of the learning rows; one temperature, fitted on the others, makes its outputs
probabilities.

The network's learning rows are a documented sample: about ``SAMPLE`` labelled rows that aren't
held out.  Vectors are added up over the whole text of every document, and every document is scored
from its whole text.  What the driver collects, broadcasts and every worker holds is bounded:
``ROWS * DIM`` numbers (8 MB in half precision, 16 MB while they are added up).

Defined cases: null texts are empty; an empty text is scored from the zero vector; without
learning rows, or with one label only, every score is the smoothed share of label 1.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import fold, own_columns
from snaplake.llm.labelled import learning_rows

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.5
SAMPLE = 10_000
SEED = 10
DIM = 64
NONZERO = 8
REACH = 2
#: Rows that the types are hashed to: a row's number is 16 bits.
ROWS = 1 << 16
HIDDEN = 24
STEPS = 400
#: Rows whose sums travel together, tokens whose neighbours are added up at once, and the lists
#: into which the tasks' sums of a slice are dealt before they meet.
SLICE, TOKENS, DEALT = 1024, 1 << 16, 32
KNOWN_WORDS = 200_000
#: What may follow a plain word.
_MARKS = ".,;:!?)\"'\u201d\u00bb\u2019"


def shape(word: str) -> str:
    out, last = [], ""
    for ch in word:
        c = "a" if ch.islower() else "A" if ch.isupper() else "9" if ch.isdigit() else ch
        if c != last:
            out.append(c)
            last = c
    return "".join(out)


def type_of(word: str) -> str:
    bare = word.rstrip(_MARKS)
    plain = bare.isalpha() and len(word) - len(bare) < 3 and bare[1:] == bare[1:].lower()
    return "w" + word.lower() if plain else "s" + shape(word)


def row_of(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode("utf-8", "surrogatepass"),
                                          digest_size=8).digest(), "little") % ROWS


AGAIN = row_of("=")


class Types(dict):
    """Token -> row of its type, remembered for up to ``KNOWN_WORDS`` tokens."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        got = self[word] = row_of(type_of(word))
        return got

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        rows = np.fromiter(map(self.__getitem__, words), np.uint16, len(words))
        if len(words) > 1:
            rows[1:][np.fromiter(map(eq, words[1:], words), bool, len(words) - 1)] = AGAIN
        return rows


@functools.cache
def index_vectors() -> np.ndarray:
    """The rows' sparse random index vectors: ``NONZERO`` places with 1 and -1 by turns.  Made a
    slice of the rows at a time, so a worker never holds more than the table itself."""
    out = np.zeros((ROWS, DIM), np.int8)
    for at in range(0, ROWS, SLICE):
        x = np.arange(at + 1, at + SLICE + 1, dtype=np.uint64)[:, None] \
            * np.uint64(0xD1342543DE82EF95) \
            + np.arange(1, DIM + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
        places = np.argsort(x, axis=1)[:, :NONZERO]
        np.put_along_axis(out[at:at + SLICE], places[:, ::2], 1, axis=1)
        np.put_along_axis(out[at:at + SLICE], places[:, 1::2], -1, axis=1)
    return out


def _add_neighbours(total: np.ndarray, parts: list[tuple[np.ndarray, int, int]]) -> None:
    """``parts``: (rows, first, last) of stretches of texts.  For the tokens first to last (not
    included) of each, adds the index vectors of their neighbours to their rows of ``total``."""
    index, gap = index_vectors(), np.zeros((REACH, DIM), np.int8)
    vectors = np.concatenate([x for rows, _, _ in parts for x in (index[rows], gap)])
    context = np.zeros_like(vectors)
    for d in range(1, REACH + 1):
        context[:-d] += vectors[d:]
        context[d:] += vectors[:-d]
    starts = np.cumsum([0] + [len(rows) + REACH for rows, _, _ in parts])
    at = np.concatenate([np.arange(s + first, s + last)
                         for s, (_, first, last) in zip(starts, parts)])
    rows = np.concatenate([rows[first:last] for rows, first, last in parts])
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    runs = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    total[rows[runs]] += np.add.reduceat(context[at[order]], runs, axis=0, dtype=np.int32)


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's sums, by slices of the rows."""
    from pyspark import TaskContext
    types, total = Types(), np.zeros((ROWS, DIM), np.int32)
    held, n = [], 0
    for b in batches:
        for text in b["text"]:
            rows = types.of(text)
            for at in range(0, len(rows), TOKENS):
                # With the neighbours of its ends: a long text is added up stretch by stretch.
                low, end = max(0, at - REACH), min(len(rows), at + TOKENS)
                held.append((rows[low:end + REACH], at - low, end - low))
                n += end - at
                if n >= TOKENS:
                    _add_neighbours(total, held)
                    held, n = [], 0
    if held:
        _add_neighbours(total, held)
    dealt = TaskContext.get().partitionId() % DEALT
    for at in range(0, ROWS, SLICE):
        part = total[at:at + SLICE]
        if part.any():
            yield pd.DataFrame({"slice": [at // SLICE], "dealt": [dealt],
                                "sums": [zlib.compress(part.tobytes(), 1)]})


def _merged(batches: Iterator[pd.DataFrame], word: str) -> Iterator[pd.DataFrame]:
    """Sums of equal (slice, dealt), which follow each other, added up: one is held at a time."""
    key, total = None, None

    def row() -> pd.DataFrame:
        return pd.DataFrame({"slice": [key[0]], "dealt": [key[1]],
                             "sums": [zlib.compress(total.tobytes(), 1)]})

    for b in batches:
        for k, sums in zip(zip(b["slice"], b["dealt"]), b["sums"]):
            got = np.frombuffer(zlib.decompress(sums), word).astype(np.int64)
            if k == key:
                total += got
            else:
                if key is not None:
                    yield row()
                key, total = k, got
    if key is not None:
        yield row()


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Random indexing over all documents: each task adds up its part; the sums, whole numbers,
    are added up by slices of the rows, in two steps however many tasks there are."""
    columns = "slice int, dealt int, sums binary"
    rows, word = docs.select("text").mapInPandas(_sums, columns), "<i4"
    for dealt in (F.col("dealt"), F.lit(0)):
        rows = rows.select("slice", dealt.alias("dealt"), "sums").repartition("slice", "dealt") \
            .sortWithinPartitions("slice", "dealt") \
            .mapInPandas(lambda bs, word=word: _merged(bs, word), columns)
        word = "<i8"
    context = np.zeros((ROWS, DIM))
    for r in rows.collect():
        got = np.frombuffer(zlib.decompress(r["sums"]), "<i8").reshape(-1, DIM)
        context[r["slice"] * SLICE:r["slice"] * SLICE + len(got)] = got
    context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)
    return (context + index_vectors() * NONZERO ** -0.5).astype(np.float16)


class Pool:
    """Texts to document vectors."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self._types, self._wide = vectors, None, None

    def __getstate__(self):
        return self.__dict__ | {"_types": None, "_wide": None}

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if self._types is None:
            self._types, self._wide = Types(), self.vectors.astype(np.float32)
        out = np.zeros((len(texts), DIM + 1), np.float32)
        for row, text in zip(out, texts):
            rows = self._types.of(text)
            for at in range(0, len(rows), TOKENS):
                row[:DIM] += self._wide[rows[at:at + TOKENS]].sum(axis=0)
            row[:DIM] /= max(1, len(rows))
            row[DIM] = np.log1p(len(rows)) / 8
        return out


class Network:
    """Two layers: tanh, then a logit, divided by the temperature."""

    def __init__(self, inputs: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.w = [rng.normal(0, inputs ** -0.5, (inputs, HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        self.shift, self.scale, self.temperature = np.zeros(inputs), np.ones(inputs), 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.w
        return np.tanh((x - self.shift) / self.scale @ a + b) @ c + d[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS) -> None:
        self.shift, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = (x - self.shift) / self.scale
        first, second = ([np.zeros_like(w) for w in self.w] for _ in range(2))
        rng = np.random.default_rng(SEED)
        for step in range(1, steps + 1):
            some = rng.integers(0, len(z), min(len(z), 1024))
            zs, ys = z[some], y[some]
            a, b, c, d = self.w
            h = np.tanh(zs @ a + b)
            off = (1 / (1 + np.exp(-np.clip(h @ c + d[0], -40, 40))) - ys) / len(zs)
            back = np.outer(off, c) * (1 - h * h)
            grads = [zs.T @ back + 1e-4 * a, back.sum(axis=0), h.T @ off + 1e-4 * c,
                     np.array([off.sum()])]
            for w, g, m, v in zip(self.w, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least log loss."""
        raw = self.logits(x)
        grid = np.geomspace(0.25, 16, 60)
        loss = [np.logaddexp(0, np.where(y == 1, -raw, raw) / t).mean() for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])


class Classifier:
    def __init__(self, pool: Pool | None, network: Network | None, share: float):
        self.pool, self.network, self.share = pool, network, share

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.share)
        return self.network.probability(self.pool(texts))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    rows = learning_rows(docs, labels, "quality", FOLDS, HELD_OUT, sample, SEED)
    count = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = (count.get(1, 0) + 1) / (sum(count.values()) + 2)
    if not count.get(0) or not count.get(1):
        return Classifier(None, None, share)
    pool = Pool(word_vectors(docs))
    shared = docs.sparkSession.sparkContext.broadcast(pool)

    def pooled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool = shared.value
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "y": b["y"],
                                "x": [r.tobytes() for r in pool(list(b["text"]))]})

    got = rows.mapInPandas(pooled, "doc_id long, y int, x binary").collect()
    shared.destroy()
    got.sort(key=lambda r: (r["doc_id"], r["x"]))  # the same order on every run
    x = np.array([np.frombuffer(r["x"], np.float32) for r in got], np.float64)
    y = np.array([r["y"] for r in got], np.float64)
    aside = np.array([zlib.crc32(f"t{r['doc_id']}".encode()) % 5 == 0 for r in got])
    net = Network(x.shape[1])
    net.fit(x[~aside] if (~aside).sum() > 1 else x, y[~aside] if (~aside).sum() > 1 else y)
    if aside.any():
        net.calibrate(x[aside], y[aside])
    return Classifier(pool, net, share)


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """``docs`` with the score as the last column, under a name that it doesn't have."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = own_columns(docs, "quality_", "score")[0]

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(list(texts)), dtype="float64")

    return docs.withColumn(name, of(F.col("text")))


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    model = learn(docs, labels)
    s = score(docs.select("doc_id", "text"), model)
    return s.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                    F.col("quality_score").alias("score"),
                    (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score ``THRESHOLD`` or more, their columns unchanged."""
    s = score(docs, learn(docs, labels))
    return s.filter(F.col(s.columns[-1]) >= THRESHOLD).select(docs.columns)
