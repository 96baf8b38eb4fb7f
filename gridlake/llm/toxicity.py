"""Severity of toxicity by cumulative-link ordinal regression on sparse text features.

A text is the set of its hashed words, their beginnings of three to seven bytes, and pairs of
neighbouring words. Fitting keeps the features whose documents lie above some cut clearly more or
less often than others. One weight vector is shared by
all grades: the probability of a grade above ``k`` is the logistic function of ``score - cut[k]``, with
ascending cuts. The expected severity is the sum of these probabilities over the cuts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import null_to_empty
from gridlake.llm.labelled import sample
from gridlake.llm.shingles import batches, mixed, range_hashes

TRAIN_ROWS = 8000  # at most so many labelled documents are fitted
BITS = 20
BEGINNINGS = (3, 4, 5, 6, 7)  # bytes
MIN_DOCS = 5  # a feature counts if so many of them have it
MIN_SCORE = 4.0  # and their share above a cut is off by so many standard errors
ROUNDS, RATE, SHRINK = 300, 0.05, 1e-4

_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[97:123] = _LETTER[128:] = True


def features(texts: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``doc, feature``: the distinct features of each text, sorted; only the ``wanted`` ones if given."""
    parts = [t.lower().encode("utf-8", "replace") + b"\n" for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    letter = _LETTER[data]
    before = np.concatenate(([False], letter[:-1]))
    start, end = np.flatnonzero(letter & ~before), np.flatnonzero(~letter & before)
    word, doc = range_hashes(data, start, end), np.searchsorted(ends, start, side="right")
    near = np.flatnonzero(doc[1:] == doc[:-1])
    pair = mixed(word[near] * np.uint64(31) + word[near + 1])
    every, of = [word, pair], [doc, doc[near]]
    for n in BEGINNINGS:
        longer = np.flatnonzero(end - start > n)
        every.append(mixed(range_hashes(data, start[longer], start[longer] + n) + np.uint64(1)))
        of.append(doc[longer])
    feature, doc = (np.concatenate(every) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(of)
    if wanted is not None:
        some = wanted[feature]
        doc, feature = doc[some], feature[some]
    both = np.unique((doc << BITS) | feature)
    return both >> BITS, both & ((1 << BITS) - 1)


class OrdinalModel:
    """``grades`` are the ascending labels; ``cuts`` has one cut fewer."""

    def __init__(self, grades: np.ndarray, weights: np.ndarray, cuts: np.ndarray):
        self.grades, self.cuts = grades, cuts
        self.known = np.flatnonzero(weights)
        self.values = weights[self.known].astype(np.float32)

    def above(self, texts: list[str]) -> np.ndarray:
        """For each text and cut, the probability of a grade above it."""
        weights = self.table()
        score = np.zeros(len(texts))
        for lo, hi in batches(texts):
            doc, feature = features(texts[lo:hi], weights != 0)
            score[lo:hi] = np.bincount(doc, weights[feature], hi - lo)
        return _logistic(score[:, None] - self.cuts)

    def table(self) -> np.ndarray:
        if getattr(self, "_table", None) is None:
            self._table = np.zeros(1 << BITS, np.float32)
            self._table[self.known] = self.values
        return self._table

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_table"}


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def fit(rows: list[np.ndarray], labels: np.ndarray) -> OrdinalModel:
    """Adam on the likelihood of ``labels`` with shrunken weights, over all rows in each round.

    ``rows`` are the distinct features of each row, which are counted a few hundred rows at a time. Cuts are a first one and positive steps
    (logarithms are fitted), so they stay in order.
    """
    grades, y = np.unique(labels, return_inverse=True)
    k = len(grades) - 1
    n, off = np.zeros(1 << BITS), np.zeros((k, 1 << BITS))
    over = (y[:, None] > np.arange(k)).astype(float)
    for lo in range(0, len(rows), 500):
        part = np.concatenate(rows[lo : lo + 500])
        of = np.repeat(np.arange(lo, min(lo + 500, len(rows))), [len(r) for r in rows[lo : lo + 500]])
        n += np.bincount(part, minlength=1 << BITS)
        for i in range(k):
            off[i] += np.bincount(part, (over[:, i] - over[:, i].mean())[of], 1 << BITS)
    clear = (np.abs(off) >= MIN_SCORE * over.std(axis=0)[:, None] * np.sqrt(n)).any(axis=0) & (n >= MIN_DOCS)
    kept = [r[clear[r]] for r in rows]
    doc, feature = np.repeat(np.arange(len(rows)), [len(r) for r in kept]), np.concatenate(kept)
    names, column = np.unique(feature, return_inverse=True)
    share = np.array([(y > i).mean() for i in range(k)])
    start = -np.log(share / (1 - share))
    free = np.concatenate((start[:1], np.log(np.maximum(np.diff(start), 1e-3)), np.zeros(len(names))))
    m, v = np.zeros_like(free), np.zeros_like(free)
    for turn in range(1, ROUNDS + 1):
        cuts = np.cumsum(np.concatenate((free[:1], np.exp(free[1:k]))))
        score = np.bincount(doc, free[k:][column], len(y))
        over = np.column_stack((np.ones(len(y)), _logistic(score[:, None] - cuts), np.zeros(len(y))))
        at = np.arange(len(y))
        p = np.maximum(over[at, y] - over[at, y + 1], 1e-12)
        slope = over * (1 - over)
        d_score = -(slope[at, y] - slope[at, y + 1]) / p
        d_cut = np.zeros((len(y), k + 2))
        d_cut[at, y] += slope[at, y] / p
        d_cut[at, y + 1] -= slope[at, y + 1] / p
        g_cut = d_cut[:, 1:-1].sum(axis=0)
        tail = np.cumsum(g_cut[::-1])[::-1]
        step = np.concatenate((tail[:1], tail[1:] * np.exp(free[1:k])))
        g = np.concatenate((step, np.bincount(column, d_score[doc], len(names)))) / len(y)
        g[k:] += SHRINK * free[k:]
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        free -= RATE * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-9)
    weights = np.zeros(1 << BITS)
    weights[names] = free[k:]
    return OrdinalModel(grades, weights, np.cumsum(np.concatenate((free[:1], np.exp(free[1:k])))))


def fitted(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS) -> OrdinalModel | float:
    """A model fitted on at most ``rows`` labelled documents; their only grade (or 0) where there is one."""

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            doc, feature = features(list(frame["text"]))
            cuts = np.searchsorted(doc, np.arange(1, len(frame)))
            found = [f.tobytes() for f in np.split(feature.astype(np.int32), cuts)]
            yield frame[["_id", "label"]].assign(features=found)

    known = sample(docs, labels, label, rows).mapInPandas(found, "_id long, label int, features binary")
    known = known.toPandas().sort_values(["_id", "label"])
    if known["label"].nunique() < 2:
        return float(known["label"].iloc[0]) if len(known) else 0.0
    rows = [np.frombuffer(f, np.int32) for f in known["features"]]
    return fit(rows, known["label"].to_numpy())


def graded(docs: DataFrame, model: OrdinalModel | float) -> DataFrame:
    """``doc_id, severity, grade``: the expected grade and the likeliest one. A null text is empty."""

    def answered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if isinstance(model, float):
                yield frame[["doc_id"]].assign(severity=model, grade=int(model))
                continue
            above = model.above(null_to_empty(frame["text"]))
            steps = np.diff(model.grades)
            chance = -np.diff(np.column_stack((np.ones(len(above)), above, np.zeros(len(above)))), axis=1)
            yield frame[["doc_id"]].assign(
                severity=model.grades[0] + (above * steps).sum(axis=1), grade=model.grades[chance.argmax(axis=1)]
            )

    return docs.select("doc_id", "text").mapInPandas(answered, "doc_id long, severity double, grade int")
