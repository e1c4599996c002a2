"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words are read as classes (insult, threat, target, negation, report, other).  Five transducers, each
a table (state, class) -> (state, mark), read them side by side: insults mark themselves and the
first target behind them; threats mark themselves once a target was seen, else the target that they
waited for; the target transducer marks what a target stands before, the negation transducer the
``NEGATED`` words behind a negation, and the reported-speech transducer what follows a reporting
verb or an opening quotation mark.  ``compose`` multiplies them out into one machine whose arcs carry
the marks together: an arc with a core mark (insult, threat, aimed) is an event, like a negated
insult after a target.  A clause weighs the sum of its events, each with its own weight; a
document's features are its worst clause, the sum over clauses and the number of clauses hit,
which a logistic function turns into a score between 0 and 1.

The events' weights start from ``PRIOR`` factors and are fitted to the learning rows by a logistic
regression drawn to them; so are the coefficients of the features.  Insults are a short fixed list,
and words and word beginnings learned from the learning rows: those that stand out in toxic ones by
more than chance allows -- of all features in as many documents, at most ``FALSE_MARKS`` should
pass by chance -- and are seldom elsewhere; an insult's amount is its log odds.  The learning rows
are a documented sample: about ``SAMPLE`` labelled rows that aren't held out.  Every document is
scored from its whole text.

Defined cases: null texts are empty; texts without a hit get the logistic function's value at
zero; learning texts without a word teach nothing; without learning rows, or with one label only,
the prior weights, fixed coefficients and the fixed list serve.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import fold
from snaplake.llm.labelled import learning_rows

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
SAMPLE = 20_000
SEED = 1
#: A learned entry: in so many toxic documents at least, with this precision, and so many of its
#: kind may pass by chance.
LEAST_DOCS, LEAST_PRECISION, FALSE_MARKS = 3, 0.95, 0.5
BEGINNINGS = (4, 5, 6, 7, 8)
NEGATED = 3
#: Features that a task hands on at once.
_HANDED_ON = 100_000

# The words of the grammar.
INSULTS = ("idiot idiots moron morons stupid scum trash clown loser losers pathetic worthless "
           "disgusting filth vermin imbecile dumb ugly bastard").split()
THREATS = ("kill murder hurt destroy shoot stab strangle beat burn hang").split()
TARGETS = ("you your yours he she they them him her these those people everyone "
           "du ihr euch dich sie tu vous toi eux usted tú ellos vosotros").split()
NEGATIONS = ("not no never none nobody isn't aren't wasn't don't doesn't didn't "
             "nicht kein keine nie ne pas jamais aucun nunca ningún jamás").split()
REPORTING = ("said says say told wrote writes called claimed reported quoted according "
             "sagte schrieb meinte dit écrit appelé dijo escribió llamó").split()
INSULT_WEIGHT, THREAT_WEIGHT = 4.0, 4.0
TARGETED, DAMPED, REPORTED = 1.5, 0.4, 0.6
#: Factors of the marks, from which the events' weights start.
PRIOR = {"targeted": TARGETED, "negated": DAMPED, "reported": REPORTED}
#: What a core mark counts; an insult counts its own weight.
AMOUNT = {"threat": THREAT_WEIGHT, "aimed": INSULT_WEIGHT * (TARGETED - 1)}
#: score = logistic(bias + sum of coefficient * feature), where nothing can be learned.
COEFFICIENTS = (-3.0, 0.6, 0.1, 0.1)

_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?|[\"“„«]")
_CLAUSE = re.compile(r"[.!?;:\n]+")


def features_of(text: str) -> set[str]:
    """Words (``w``) and word beginnings (``b``) of a text, each once."""
    words = {w for w in _WORD.findall(text.lower()) if len(w) > 2}
    return {"w" + w for w in words} | {"b" + w[:k] for w in words for k in BEGINNINGS
                                       if len(w) > k}


CLASSES = ("other", "insult", "threat", "target", "negation", "report")


class Transducer:
    """(state, class) -> (state, mark or None).  Classes that a state doesn't name lead back to it
    without a mark; state 0 is the first."""

    def __init__(self, arcs: dict[tuple[int, str], tuple[int, str | None]]):
        self.states = 1 + max(s for s, _ in arcs)
        self.table = [[arcs.get((s, c), (s, None)) for c in CLASSES] for s in range(self.states)]

    def run(self, classes: list[int]) -> list[str | None]:
        state, out = 0, []
        for c in classes:
            state, mark = self.table[state][c]
            out.append(mark)
        return out


def _everywhere(state: int, to: int, mark: str | None, but: dict | None = None) -> dict:
    return {(state, c): (to, mark) for c in CLASSES} | {(state, c): v for c, v in (but or {}).items()}


INSULT = Transducer({(0, "insult"): (1, "insult"), (1, "insult"): (1, "insult"),
                     (0, "target"): (2, None), (1, "target"): (2, "aimed"),
                     (2, "insult"): (2, "insult")})
THREAT = Transducer({(0, "threat"): (1, None), (0, "target"): (2, None),
                     (1, "target"): (2, "threat"), (2, "threat"): (2, "threat")})
TARGET = Transducer({(0, "target"): (1, None), **_everywhere(1, 1, "targeted")})
NEGATION = Transducer({(0, "negation"): (NEGATED, None), **{
    k: v for n in range(1, NEGATED + 1)
    for k, v in _everywhere(n, n - 1, "negated", {"negation": (NEGATED, "negated")}).items()}})
REPORT = Transducer({(0, "report"): (1, None), **_everywhere(1, 1, "reported")})
#: The first two give an event its core; a "threat" or "aimed" is targeted by itself.
CORES, OTHERS = (INSULT, THREAT), (TARGET, NEGATION, REPORT)


def event(marks: list[str | None]) -> tuple[str, ...] | None:
    """The marks of the five transducers on one word -> the event, if a core mark is among them."""
    core = marks[1] or marks[0]
    if core is None:
        return None
    return (core, *(m for m in marks[2:] if m and not (core != "insult" and m == "targeted")))


def compose(machines: tuple[Transducer, ...] = (*CORES, *OTHERS)
            ) -> tuple[list[list[tuple[int, int]]], list[tuple[str, ...]]]:
    """The product of the machines, of the states that can be reached: table[state][class] ->
    (state, number of the event or -1), and the events."""
    number, queue, table, events = {(0,) * len(machines): 0}, [(0,) * len(machines)], [], {}
    for states in queue:  # grows as states are found
        row = []
        for c in range(len(CLASSES)):
            arcs = [m.table[s][c] for m, s in zip(machines, states)]
            to = tuple(s for s, _ in arcs)
            if to not in number:
                number[to] = len(number)
                queue.append(to)
            e = event([mark for _, mark in arcs])
            row.append((number[to], -1 if e is None else events.setdefault(e, len(events))))
        table.append(row)
    return table, list(events)


MACHINE, EVENTS = compose()
_CLASS = {c: i for i, c in enumerate(CLASSES)}


def prior(e: tuple[str, ...]) -> float:
    return float(np.prod([PRIOR.get(m, 1.0) for m in e]))


class Grammar:
    """The composed machine with its lexicon and weights."""

    def __init__(self, words: dict[str, float] | None = None,
                 beginnings: dict[str, float] | None = None,
                 coefficients: tuple[float, ...] = COEFFICIENTS):
        self.insults = dict.fromkeys(INSULTS, INSULT_WEIGHT) | (words or {})
        self.beginnings = beginnings or {}
        self.coefficients = coefficients
        self.weights = [prior(e) for e in EVENTS]
        self._amounts = [AMOUNT.get(e[0]) for e in EVENTS]
        self._fixed = {w: _CLASS[s] for s, ws in (("threat", THREATS), ("target", TARGETS),
                                                  ("negation", NEGATIONS), ("report", REPORTING))
                       for w in ws} | dict.fromkeys("\"“„«", _CLASS["report"])
        self._finder = None

    def __getstate__(self):
        return self.__dict__ | {"_finder": None}

    def read(self, word: str) -> tuple[int, float]:
        """Class of a word, and an insult's weight."""
        weight = self.insults.get(word, 0.0)
        for k in BEGINNINGS:
            weight = max(weight, self.beginnings.get(word[:k], 0.0))
        return (_CLASS["insult"], weight) if weight else (self._fixed.get(word, 0), 0.0)

    def events(self, words: list[str]) -> dict[int, float]:
        """Amounts of the events on a clause's path through the machine."""
        state, out = 0, {}
        for word in words:
            c, weight = self.read(word)
            state, e = MACHINE[state][c]
            if e >= 0:
                out[e] = out.get(e, 0.0) + (self._amounts[e] or weight)
        return out

    def clause(self, words: list[str]) -> float:
        return sum(self.weights[e] * x for e, x in self.events(words).items())

    def _starts(self):
        """Finds where a word may be an insult or a threat, without a look at other words."""
        if self._finder is None:
            finder = ahocorasick.Automaton()
            for term in {*self.insults, *self.beginnings, *THREATS}:
                finder.add_word(term, len(term))
            finder.make_automaton()
            self._finder = finder
        return self._finder

    def clauses(self, text: str | None) -> Iterator[list[str]]:
        """The words of the clauses that may have an event."""
        low = (text or "").lower()
        at = [end - n + 1 for end, n in self._starts().iter(low)]
        at = sorted({i for i in at if i == 0 or not low[i - 1].isalnum()})
        start, k = 0, 0
        if at:
            for end in [m.start() for m in _CLAUSE.finditer(low)] + [len(low)]:
                if k < len(at) and at[k] < end:
                    yield _WORD.findall(low[start:end])
                    while k < len(at) and at[k] < end:
                        k += 1
                start = end

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Worst clause, sum over clauses (as a logarithm), clauses hit (likewise)."""
        scores = [s for s in map(self.clause, self.clauses(text)) if s > 0]
        return (max(scores, default=0.0), float(np.log1p(sum(scores))),
                float(np.log1p(len(scores))))

    def amounts(self, text: str | None) -> list[float]:
        """Each event's amount in the text (as a logarithm)."""
        out = np.zeros(len(EVENTS))
        for words in self.clauses(text):
            for e, x in self.events(words).items():
                out[e] += x
        return np.log1p(out).tolist()

    def scores(self, features: np.ndarray) -> np.ndarray:
        bias, *w = self.coefficients
        return 1 / (1 + np.exp(-np.clip(bias + features @ np.array(w), -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05,
              around: np.ndarray | None = None) -> np.ndarray:
    """Coefficients (bias first) by Newton steps, drawn to those of ``around`` by a ridge."""
    z = np.c_[np.ones(len(x)), x]
    start = np.zeros(z.shape[1]) if around is None else np.r_[0.0, around]
    w, pull = start.copy(), np.diag([1e-3] + [ridge] * x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + pull @ (w - start)
        hess = (z * (p * (1 - p))[:, None]).T @ z + pull
        w = w - np.clip(np.linalg.solve(hess, grad), -4, 4)
    return w


def _counted(rows: DataFrame) -> DataFrame:
    """(feature, toxic, clean): documents of either label that have the feature."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        for b in batches:
            for y, text in zip(b["y"], b["text"]):
                seen[int(y > 0)].update(features_of(text))
        for y, counts in enumerate(seen):
            names = sorted(counts)
            for at in range(0, len(names), _HANDED_ON):
                part = names[at:at + _HANDED_ON]
                n = np.array([counts[f] for f in part], np.int64)
                yield pd.DataFrame({"feature": part, "toxic": n * y, "clean": n * (1 - y)})
    return rows.select("y", "text").mapInPandas(count, "feature string, toxic long, clean long") \
        .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _information(k: Column, n: Column, share: Column) -> Column:
    """n times the divergence (nats) of k of n from ``share``: chance gives k or more with a
    probability of exp of minus this at most."""
    def part(x: Column, expected: Column) -> Column:
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)
    return part(k, n * share) + part(n - k, n * (1 - share))


def lexicon(counts: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """(feature, weight) of the words and beginnings that mark toxic documents; the weight is
    their log odds."""
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    seen, share = a + b, F.lit(n_toxic / (n_toxic + n_clean))
    odds = F.log((a + 0.5) / (n_toxic + 1)) - F.log((b + 0.5) / (n_clean + 1))
    alike = counts.groupBy((F.col("toxic") + F.col("clean")).alias("of")) \
        .agg(F.count("*").alias("tests"))
    good = counts.filter((a >= LEAST_DOCS) & (a >= LEAST_PRECISION * seen) & (odds > 0)) \
        .join(alike, F.col("toxic") + F.col("clean") == F.col("of"))
    return good.filter(F.log("tests") - _information(a, seen, share) <= float(np.log(FALSE_MARKS))) \
        .select("feature", odds.alias("weight"))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Grammar:
    rows = learning_rows(docs, labels, "toxic", FOLDS, HELD_OUT, sample, SEED)
    count = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not count.get(0) or not count.get(1):
        return Grammar()
    marks = lexicon(_counted(rows), count[1], count[0]).collect()
    words, beginnings = ({r["feature"][1:]: r["weight"] for r in marks if r["feature"][0] == kind}
                         for kind in "wb")
    grammar = Grammar(words, beginnings)

    def measured(of, names: list[str]) -> np.ndarray:
        """y and what ``of`` makes of a text, of every learning row, in an order of its own."""
        def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                got = [(float(y), *of(t)) for y, t in zip(b["y"], b["text"])]
                yield pd.DataFrame(got, columns=["y", *names])
        columns = ", ".join(f"{n} double" for n in ["y", *names])
        return np.array(sorted(tuple(r) for r in rows.mapInPandas(rows_of, columns).collect()))

    x = measured(grammar.amounts, [f"e{i}" for i in range(len(EVENTS))])
    fitted = _logistic(x[:, 1:], x[:, 0], 1.0, np.array(grammar.weights))[1:]
    grammar.weights = np.maximum(fitted, 0.0).tolist()
    x = measured(grammar.features, ["worst", "total", "hits"])
    grammar.coefficients = tuple(float(v) for v in _logistic(x[:, 1:], x[:, 0]))
    return grammar


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        g = shared.value
        return pd.Series(g.scores(np.array([g.features(t) for t in texts]).reshape(-1, 3)))

    return docs.select("doc_id", of(F.col("text")).alias("score"))


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    s = score(docs.select("doc_id", "text"), learn(docs, labels))
    return s.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                    "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
