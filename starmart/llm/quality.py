"""Quality classifier: a support vector machine on indicators scaled by naive Bayes log-count ratios.

Features are indicators of hashed n-grams: words, and one to three successive word shapes. A shape keeps the class of
letters, digits and signs of a word, with runs shortened, and says whether the word repeats the one before, so that
tables, shouting, sign noise and repeated words are seen in any language. An indicator of feature j has the value
``log((p_j / |p|) / (q_j / |q|))`` of the smoothed counts in good and bad documents; a squared-hinge model is fitted on
the scaled rows by dual coordinate descent, and Platt scaling on rows kept apart turns its margin into a probability.

Defined cases: null and empty texts are scored as texts without words; repeated rows get equal scores; without labelled
documents of both classes all scores are the smoothed share of good ones (0.5 without labels); other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from starmart.llm import linear
from starmart.llm.labelled import SAMPLE_ROWS, indices, sample_features, sample_labels
from starmart.llm.text import CACHE_WORDS, WordHashes, is_held_out, words

BITS = 18
CUT = 0.7
COST, SMOOTHING, MIXING = 1.0, 1.0, 0.5

_SHAPES = ((regex.compile(r"\p{Lu}+"), "A"), (regex.compile(r"\p{L}+"), "a"), (regex.compile(r"\p{N}+"), "0"))
_RUN = regex.compile(r"(.)\1+")


class _Shapes(dict):
    """Hash of the shape of each word, for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        text = word.decode("utf-8", "replace")
        for pattern, sign in _SHAPES:
            text = pattern.sub(sign, text)
        value = self[word] = _HASHES[_RUN.sub(r"\1\1", text).encode()]
        return value


_HASHES, _SHAPE_OF = WordHashes(1), _Shapes()
_ODD = np.uint64(0x9E3779B97F4A7C15)


def features(text: str | None) -> np.ndarray:
    """Sorted bucket numbers of the n-grams of a text."""
    tokens = words(text)
    if not tokens:
        return np.empty(0, np.int32)
    w = _HASHES.of([t.lower() for t in tokens])
    s = np.fromiter(map(_SHAPE_OF.__getitem__, tokens), np.uint64, len(tokens))
    s[1:] += (w[1:] == w[:-1]).astype(np.uint64)
    grams = [w, s * _ODD + np.uint64(1)]
    two = s[:-1] * _ODD + s[1:]
    grams += [two * _ODD + np.uint64(2), (two[:-1] * _ODD + s[2:]) * _ODD + np.uint64(3)]
    return np.unique(np.concatenate(grams) * _ODD >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, text: str | None) -> float:
        margin = self.weights[features(text)].sum() + self.bias
        return float(linear.sigmoid(self.slope * margin + self.offset))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    """Model from a bounded sample of labelled documents; one in five of them calibrates the probability."""
    sample = sample_features(docs, sample_labels(labels, label, rows), lambda t: (features(t).tobytes(),), ("grams",), rows)
    y = sample["sample_label"].to_numpy(np.int64)
    size = 2**BITS
    if len(set(y)) < 2:
        share = (y.sum() + 1.0) / (len(y) + 2.0)
        return Model(np.zeros(size, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    grams = [indices(b) for b in sample["grams"]]
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held[:] = False
    fitted = np.flatnonzero(~held)
    counts = np.full((2, size), SMOOTHING)
    for i in fitted:
        counts[y[i], grams[i]] += 1.0
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    bias = np.array([size], np.int32)
    data = [(np.append(grams[i], bias), np.append(ratio[grams[i]], 1.0)) for i in fitted]
    norm = [max(float(np.sqrt(x @ x)), 1e-9) for _, x in data]
    data = [(i, x / n) for (i, x), n in zip(data, norm)]
    share = y[fitted].mean()
    cost = np.where(y[fitted] == 1, 0.5 / share, 0.5 / (1 - share)) * COST
    w = linear.fit_hinge(data, np.where(y[fitted] == 1, 1.0, -1.0), size + 1, cost)
    w[:size] = (1 - MIXING) * np.abs(w[:size]).mean() + MIXING * w[:size]
    model = Model((w[:size] * ratio).astype(np.float32), float(w[size]), 1.0, 0.0)
    rest = np.flatnonzero(held) if held.any() else fitted
    margins = np.array([model.weights[grams[i]].sum() + model.bias for i in rest])
    model.slope, model.offset = linear.fit_platt(margins, y[rest])
    return model


def with_score(docs: DataFrame, model: Model, text: str = "text", into: str = "quality_score") -> DataFrame:
    """All rows with their probability of being good in the column ``into``."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([model.score(t) for t in part], dtype=float)

    return docs.withColumn(into, score(F.col(text)))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Query form: one row per document with fold, score and decision."""
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels), into="score")
    return scored.select(
        "doc_id", is_held_out().alias("held_out"), "score", F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"))
