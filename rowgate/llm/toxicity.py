"""Toxicity scores from a counterfactual-regularised logistic classifier.

Features of a text are its distinct lower-cased words and their prefixes; only
those that toxic training texts use significantly more often are kept.  The fit
minimises log loss plus a ridge plus a *counterfactual penalty*: in sentences
of the training texts that name an identity group, the term is swapped for each
other term of its group, and squared changes of the score (log-odds) are
penalised.  A mere mention of a group thus carries little weight.

The fit uses at most ``per_class`` labelled texts of either class (those with the
smallest hash of doc_id) and runs on the driver over their distinct words.  The
texts of a class weigh as much as all its usable labels, so the cut doesn't shift
the mix of classes that scores stand for.
Every document is scored whole.

A null or empty text has no features and gets the intercept's score.  Without
both classes among the labels every score is (toxic + 0.5) / (labelled + 1).
Labels that are null are left out; if a doc_id has several, any toxic one
counts; rows repeated in the documents are scored alike.  Empty tables are fine.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import annotate, folded_words, utf8

# Terms of one group are swapped for one another.  A parameter; these are the default.
IDENTITY = (
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("women", "men"),
    ("woman", "man"),
    ("black", "white", "asian", "latino"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)
PREFIXES = (4, 5, 6)
_SENTENCE = re.compile(rb"[.!?\n]+")


def features(word: str) -> list[str]:
    """A word's features: itself and its proper prefixes."""
    return [f"={word}", *(f"^{word[:n]}" for n in PREFIXES if len(word) > n)]


def swaps(words: list[str], identity) -> list[list[str]]:
    """Word lists in which each identity term is replaced by its group's next,
    next but one, ...; empty if there is none."""
    at = {t: (g, i) for g in identity for i, t in enumerate(g)}
    if not any(w in at for w in words):
        return []
    turns = max(len(at[w][0]) for w in words if w in at)
    return [[at[w][0][(at[w][1] + k) % len(at[w][0])] if w in at else w for w in words] for k in range(1, turns)]


@dataclass
class Model:
    intercept: float
    weights: dict[str, float] = field(default_factory=dict)

    def word(self, word: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(word))

    def logit(self, words) -> float:
        return self.intercept + sum(map(self.word, sorted(set(words))))


def _matrix(rows: list[list[str]], column: dict[str, int]) -> np.ndarray:
    x = np.zeros((len(rows), len(column)), np.float32)
    for i, words in enumerate(rows):
        for w in set(words):
            for f in features(w):
                j = column.get(f)
                if j is not None:
                    x[i, j] += 1
    return np.minimum(x, 8)


def select(rows: list[list[str]], y: np.ndarray, least: int, z: float, ratio: float, most: int) -> dict[str, int]:
    """Columns of features that make up ``ratio`` times the share of toxic texts'
    words that they make up of the others', and significantly (``z``) so."""
    by = (Counter(), Counter())
    for words, label in zip(rows, y):
        for w in set(words):
            by[int(label)].update(features(w))
    total = [max(1, sum(c.values())) for c in by]
    share = total[1] / (total[0] + total[1])
    found = []
    for f, pos in by[1].items():
        n = pos + by[0][f]
        score = (pos - n * share) / np.sqrt(n * share * (1 - share))
        often = pos * total[0] >= ratio * (by[0][f] + 0.5) * total[1]
        if pos >= least and score > z and often:
            found.append((-score, f))
    return {f: i for i, (_, f) in enumerate(sorted(found)[:most])}


def fit(rows: list[list[str]], y: np.ndarray, sentences: list[list[str]], identity=IDENTITY, penalty: float = 1.0, ridge: float = 1e-5, balance: float = 0.5, least: int = 3, z: float = 4.0, ratio: float = 5.0, most: int = 2000, steps: int = 400, totals: tuple[int, int] | None = None) -> Model:
    """Fit on word lists ``rows`` with labels ``y``; ``sentences`` are those whose
    identity terms are swapped.  ``totals``: how many clean and toxic labels the rows
    stand for (default: as many as there are)."""
    y = np.asarray(y, np.float64)
    n, pos = len(y), float(y.sum())
    clean, toxic = totals or (n - pos, pos)
    prior = (toxic + 0.5) / (clean + toxic + 1)
    model = Model(float(np.log(prior / (1 - prior))))
    column = select(rows, y, least, z, ratio, most) if 0 < pos < n else {}
    if not column:
        return model
    x = _matrix(rows, column)
    pairs = [(s, c) for s in sentences for c in swaps(s, identity)]
    gap = _matrix([a for a, _ in pairs], column) - _matrix([b for _, b in pairs], column) if pairs else None
    # the rarer class counts more, by its odds to the power ``balance``
    weight = np.where(y == 1, (clean / toxic) ** balance * (toxic / pos), clean / (n - pos))
    weight /= weight.mean()
    w, b = np.zeros(len(column), np.float32), model.intercept
    m, v = np.zeros(len(column) + 1), np.zeros(len(column) + 1)
    for step in range(1, steps + 1):  # Adam, whole batch
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        miss = weight * (p - y)
        g = np.append(x.T @ miss.astype(np.float32) / n + 2 * ridge * w, miss.mean())
        if gap is not None:
            g[:-1] += 2 * penalty * (gap.T @ (gap @ w)) / len(gap)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        d = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = (w - d[:-1]).astype(np.float32), b - d[-1]
    return Model(float(b), {f: float(w[i]) for f, i in column.items()})


class _Words:
    """Sampled texts as distinct words, and their sentences with identity terms."""

    def __init__(self, identity):
        self.terms = {t.encode() for g in identity for t in g}

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, sentences = [], []
            for t in utf8(batch, "text"):
                words.append(" ".join(w.decode("utf-8", "replace") for w in sorted(set(folded_words(t)))))
                found = (folded_words(s) for s in _SENTENCE.split(t))
                sentences.append([b" ".join(s).decode("utf-8", "replace") for s in found if not self.terms.isdisjoint(s)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(words, pa.string()), pa.array(sentences, pa.list_(pa.string()))], names=["toxic", "words", "sentences"]
            )


def train(docs: DataFrame, labels: DataFrame, identity=IDENTITY, per_class: int = 3000, **options) -> Model:
    """Fit on ``labels`` (doc_id, toxic) joined with ``docs`` (doc_id, text).  Of several texts
    with one id the first in byte order is read; an id is toxic if any of its labels says so."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    have = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    count = {r["toxic"]: r["count"] for r in have.groupBy("toxic").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = have.where("toxic = 1").orderBy(*order).limit(per_class).unionByName(have.where("toxic = 0").orderBy(*order).limit(per_class))
    # at most 2 * per_class rows of two numbers: the bound of the broadcast
    rows = (
        docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("toxic", "text")
        .mapInArrow(_Words(identity), "toxic int, words string, sentences array<string>").collect()
    )
    rows = sorted(((r[0], r[1], r[2]) for r in rows), key=lambda r: (r[0], r[1]))  # the same order whatever the partitions
    sentences = [s.split(" ") for r in rows for s in r[2]]
    return fit([r[1].split(" ") for r in rows], np.array([r[0] for r in rows], np.float64), sentences, identity, totals=(count.get(0, 0), count.get(1, 0)), **options)


class _Scorer(dict):
    """Sum of weights by word, remembered up to a bound."""

    def __init__(self, model: Model, most: int = 500_000):
        super().__init__()
        self.model, self.most = model, most

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.most:
            self.clear()
        got = self[word] = self.model.word(word.decode("utf-8", "replace"))
        return got

    def __call__(self, texts: list[bytes]) -> list[list]:
        out = []
        for t in texts:
            # rounded: the order in which a set is summed must not matter
            logit = self.model.intercept + sum(round(x, 9) for x in map(self.__getitem__, set(folded_words(t))) if x)
            out.append(round(float(1 / (1 + np.exp(-np.clip(logit, -60, 60)))), 9))
        return [out]


def score(docs: DataFrame, model: Model, text_col: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a struct ``into`` whose ``score`` is from 0 to 1."""
    return annotate(docs, text_col, into, "score double", _Scorer, model)


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are kept for evaluation; a null id is not among them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))
