"""Language identification as a mixture: expectation-maximisation estimates each document's
language proportions from n-gram likelihoods; the set of languages is chosen by penalised
likelihood.

The model counts hashed byte trigrams of the lower-cased texts of all learning rows, per
language: ``BINS`` numbers a language, gathered by one aggregation.  A document starts with its
likeliest single language; the next by proportion joins while its gain in log-likelihood beats
``PENALTY * log(n)``.  The prediction is the largest proportion, which is also the score.

Defined cases: null texts and texts without a letter are ``und`` with score 0; so is every text
if nothing can be learned; equal proportions go to the first language by name; texts of any
length are used whole, as counts per bin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import fold, own_columns

BINS = 1 << 16
SMOOTHING = 0.2
ROUNDS = 12
PENALTY = 3.0
UNKNOWN = "und"
FOLDS, HELD_OUT = 3, 1
#: The pipeline keeps a document if one language holds this share of it.
LEAST_SHARE = 0.4
_PORTION = 1 << 20


def grams(raw: np.ndarray) -> np.ndarray:
    """Bins of the byte trigrams."""
    a = raw.astype(np.uint32)
    code = (a[:-2] << 16) | (a[1:-1] << 8) | a[2:]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int32)


def counted(text: str) -> np.ndarray:
    """How often each bin is in the text (a blank at either end).  Long texts are counted in
    portions that share two bytes, so every trigram counts once."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8)
    total = np.zeros(BINS, np.int64)
    for at in range(0, len(raw) - 2, _PORTION):
        total += np.bincount(grams(raw[at:at + _PORTION + 2]), minlength=BINS)
    return total


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: dict[str, np.ndarray] = {}
    for b in batches:
        for lang, text in zip(b["lang"], b["text"]):
            total = seen.setdefault(lang, np.zeros(BINS, np.int64))
            total += counted(text)
    for lang, total in seen.items():
        at = np.flatnonzero(total)
        yield pd.DataFrame({"lang": lang, "bin": at, "n": total[at]})


class Model:
    """Languages by name, and the probability of each bin in each of them."""

    def __init__(self, counts: pd.DataFrame):
        self.languages = sorted(set(counts["lang"]))
        table = np.full((BINS, len(self.languages)), SMOOTHING)
        column = counts["lang"].map({x: i for i, x in enumerate(self.languages)})
        if len(counts):
            table[counts["bin"], column] += counts["n"].to_numpy()
        self.chance = (table / table.sum(axis=0)).astype(np.float32)

    def mixture(self, text: str | None) -> dict[str, float]:
        """Proportions of the chosen languages; empty if there is no letter or no model."""
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return {}
        count = counted(text)
        bins = np.flatnonzero(count)
        weight = count[bins].astype(np.float32)
        p, n = self.chance[bins], float(count.sum())

        def loglik(x: np.ndarray) -> float:
            return float(np.log(x) @ weight)

        def fit(q: np.ndarray, rounds: int) -> np.ndarray:
            share = np.full(q.shape[1], 1.0 / q.shape[1], np.float32)
            for _ in range(rounds):
                share = share * (q.T @ (weight / (q @ share))) / n
            return share

        order = np.argsort(-fit(p, ROUNDS), kind="stable")
        chosen, share = order[:1], np.ones(1, np.float32)
        best = loglik(p[:, chosen[0]])
        for size in range(2, len(order) + 1):
            q = p[:, order[:size]]
            more = fit(q, ROUNDS)
            got = loglik(q @ more)
            if got - best <= PENALTY * np.log(max(n, 2.0)):
                break
            chosen, share, best = order[:size], more, got
        return {self.languages[c]: float(s) for c, s in zip(chosen, share / share.sum())}

    def predict(self, text: str | None) -> tuple[str, float]:
        found = self.mixture(text)
        if not found:
            return UNKNOWN, 0.0
        lang = min(found, key=lambda x: (-found[x], x))
        return lang, min(1.0, found[lang])


def learn(docs: DataFrame, rows: Column) -> Model:
    """The model of the (text, lang) rows that ``rows`` selects, all of them."""
    d = docs.filter(rows & F.col("lang").isNotNull() & F.col("text").isNotNull()) \
        .select(F.col("lang").cast("string").alias("lang"), "text")
    counts = d.mapInPandas(_count, "lang string, bin int, n long") \
        .groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    return Model(counts.toPandas())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` followed by the language and its share, under names that
    ``docs`` doesn't have (``lang_pred``, ``lang_score``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    pred, score = own_columns(docs, "lang_", "pred", "score")

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts],
                            columns=["lang", "score"])

    found = own_columns(docs, "lang_", "found")[0]
    out = docs.withColumn(found, predict(F.col("text")))
    return out.select(*docs.columns, F.col(f"{found}.lang").alias(pred),
                      F.col(f"{found}.score").alias(score))


def predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that aren't held out."""
    held = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    model = learn(docs, ~held)
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has one language for ``LEAST_SHARE`` of it or more."""
    model = learn(docs, fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    out = identify(docs, model)
    pred, score = out.columns[-2:]
    return out.filter((F.col(pred) != UNKNOWN) & (F.col(score) >= LEAST_SHARE)) \
        .select(docs.columns)
