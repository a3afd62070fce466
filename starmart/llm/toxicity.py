"""Toxicity: a sparse logistic classifier that must score counterfactual texts alike.

Features are indicators of hashed words and of character n-grams at word starts. For a labelled text that names groups
of people, a counterpart is made by swapping each identity term for the next one of its kind; the loss adds the squared
difference of both scores, so weight that sits on the terms themselves vanishes and neutral mentions are not flagged.
Fitted by follow-the-regularised-leader steps with an elastic net; Platt scaling on rows kept apart.

Defined cases: null and empty texts are scored as texts without words; repeated rows get equal scores; without labelled
documents of both classes every score is the smoothed share of toxic ones (0.5 without labels); other columns are kept.
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
from starmart.llm.text import CACHE_WORDS, WordHashes, is_held_out

BITS = 20
CUT = 0.3
PENALTY = 1.0
# Identity terms by kind; a term is swapped for the next one of its kind.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("she", "he"), ("female", "male"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"), ("black", "white", "asian", "latino", "arab"),
    ("disabled", "deaf", "blind", "autistic"), ("immigrants", "refugees", "locals"), ("old", "young"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)
SWAPS = {a: kind[(i + 1) % len(kind)] for kind in IDENTITY for i, a in enumerate(kind)}

_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_HASH = WordHashes(2)


class _Grams(dict):
    """Bucket numbers of a word: the word, and its starts of four to six letters."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE_WORDS // 2:
            self.clear()
        starts = {f"{word[:k]}^" for k in (4, 5, 6) if len(word) > k}
        value = self[word] = tuple(_HASH[g.encode()] >> (64 - BITS) for g in (word, *sorted(starts)))
        return value


_GRAMS = _Grams()


def _buckets(tokens: set[str]) -> np.ndarray:
    return np.array(sorted({b for t in tokens for b in _GRAMS[t]}), np.int32)


def features(text: str | None) -> np.ndarray:
    return _buckets(set(_WORD.findall((text or "").lower())))


def counterfactual(text: str | None) -> np.ndarray | None:
    """Features of the text with swapped identity terms; None if it has no such term."""
    tokens = set(_WORD.findall((text or "").lower()))
    if tokens.isdisjoint(SWAPS):
        return None
    return _buckets({SWAPS.get(t, t) for t in tokens})


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, text: str | None) -> float:
        z = self.weights[features(text)].sum() + self.bias
        return float(linear.sigmoid(self.slope * z + self.offset))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS, penalty: float = PENALTY
) -> Model:
    """Model from a bounded sample of labelled documents; one in five of them calibrates the probability."""

    def both(text: str | None) -> tuple[bytes, bytes | None]:
        other = counterfactual(text)
        return features(text).tobytes(), None if other is None else other.tobytes()

    sample = sample_features(docs, sample_labels(labels, label, rows), both, ("grams", "swapped"), rows)
    y, size = sample["sample_label"].to_numpy(np.int64), 2**BITS
    if len(set(y)) < 2:
        share = (y.sum() + 1.0) / (len(y) + 2.0)
        return Model(np.zeros(size, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held[:] = False

    def row(blob: bytes) -> linear.Row:
        index = np.append(indices(blob), np.int32(size))
        return index, np.ones(len(index))

    rows_of = [row(b) for b in sample["grams"]]
    swapped = [None if b is None else row(b) for b in sample["swapped"]]
    fitted = np.flatnonzero(~held)
    w = linear.fit_paired_logistic(
        [rows_of[i] for i in fitted], [swapped[i] for i in fitted], y[fitted], size + 1, penalty)
    model = Model(w[:size].astype(np.float32), float(w[size]), 1.0, 0.0)
    rest = np.flatnonzero(held) if held.any() else fitted
    z = np.array([model.weights[rows_of[i][0][:-1]].sum() + model.bias for i in rest])
    model.slope, model.offset = linear.fit_platt(z, y[rest])
    return model


def with_score(docs: DataFrame, model: Model, text: str = "text", into: str = "toxic_score") -> DataFrame:
    """All rows with their probability of being toxic in the column ``into``."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([model.score(t) for t in part], dtype=float)

    return docs.withColumn(into, score(F.col(text)))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Query form: one row per document with fold, score and decision."""
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels), into="score")
    return scored.select(
        "doc_id", is_held_out().alias("held_out"), "score", F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"))
