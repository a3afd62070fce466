"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Character n-grams of one to four letters are hashed into buckets. Document frequencies of the buckets are counted over
all training documents, and so are the languages; the model is fitted on a bounded sample that holds rows of each of them,
by follow-the-regularised-leader steps with an elastic net. A temperature fitted on every fifth sample row of a language,
kept apart, turns its scores into calibrated probabilities.

Defined cases: a null text, or one without any letter, is ``und`` with score 0; repeated rows get equal predictions;
without labelled training documents every text is ``und`` with score 0; with one label only it is that label; other
columns pass through ``with_language``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from starmart.llm import linear
from starmart.llm.labelled import sample_features, sample_of_each
from starmart.llm.text import char_grams, is_held_out

BITS, SIZES = 15, (1, 2, 3, 4)
#: So many labelled rows fit the model, in proportion to the languages; document frequencies are counted over all of them.
SAMPLE_ROWS = 4_000
#: A language has at least so many rows in the sample, or all its rows if it has fewer.
LEAST_ROWS = 40
PIECE = 1 << 20


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def counts(text: str) -> np.ndarray:
    """Counts of all buckets, in pieces that overlap so that no n-gram is lost and memory is bounded."""
    text = f" {' '.join(text.lower().split())} "
    total = np.zeros(2**BITS, np.int64)
    for at in range(0, len(text), PIECE):
        lead = max(SIZES) - 1 if at else 0
        piece = text[at - lead:at + PIECE]
        total += np.bincount(char_grams(piece, SIZES, BITS), minlength=2**BITS)
        if lead:
            total -= np.bincount(char_grams(piece[:lead], SIZES, BITS), minlength=2**BITS)
    return total


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """(documents, documents that hold each bucket) over all rows with a letter; tasks add up before the shuffle."""

    def per_task(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, n = np.zeros(2**BITS, np.int64), 0
        for part in parts:
            for t in part["text"]:
                if has_letter(t):
                    found += counts(t) > 0
                    n += 1
        index = np.append(np.flatnonzero(found), -1)
        yield pd.DataFrame({"bucket": index, "n": np.append(found[index[:-1]], n)})

    summed = docs.select("text").mapInPandas(per_task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    rows = summed.toPandas()  # one row per bucket at most
    total = np.zeros(2**BITS, np.int64)
    known = rows[rows["bucket"] >= 0]
    total[known["bucket"].to_numpy()] = known["n"].to_numpy()
    return int(rows.loc[rows["bucket"] < 0, "n"].sum()), total


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def row(self, text: str) -> linear.Row:
        """Unit-length TF-IDF row, with logarithmic term frequencies."""
        n = counts(text)
        index = np.flatnonzero(n)
        x = (1.0 + np.log(n[index])) * self.idf[index]
        return index, x / max(float(np.sqrt(x @ x)), 1e-12)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return "und", 0.0
        index, x = self.row(text)
        p = linear.softmax((x @ self.weights[index] + self.bias) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Model from the documents outside the held-out fold that have a language and a letter."""
    training = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out())
    n, df = document_frequencies(training)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0

    def blobs(text: str | None) -> tuple[bytes, bytes]:
        if not has_letter(text):
            return b"", b""
        c = counts(text)
        index = np.flatnonzero(c)
        return index.astype(np.int32).tobytes(), c[index].astype(np.int32).tobytes()

    chosen, most = sample_of_each(training.where(F.col("text").rlike(r"\p{L}")), "lang", rows, LEAST_ROWS)
    sample = sample_features(training, chosen, blobs, ("buckets", "counts"), most)
    sample = sample[sample["buckets"].str.len() > 0]
    languages = sorted(set(sample["sample_label"]))
    model = Model(languages, idf, np.zeros((2**BITS, len(languages))), np.zeros(len(languages)), 1.0)
    if len(languages) < 2:
        return model
    y = sample["sample_label"].map({c: i for i, c in enumerate(languages)}).to_numpy()
    data = []
    for b, c in zip(sample["buckets"], sample["counts"]):
        index = np.frombuffer(b, np.int32)
        x = (1.0 + np.log(np.frombuffer(c, np.int32))) * idf[index]
        data.append((np.append(index, 2**BITS), np.append(x / np.sqrt(x @ x), 0.2)))
    held = sample.groupby("sample_label").cumcount().to_numpy() % 5 == 4
    fitted = np.flatnonzero(~held)
    w = linear.fit_multinomial([data[i] for i in fitted], y[fitted], 2**BITS + 1, len(languages))
    model.weights, model.bias = w[:-1].astype(np.float32), w[-1] * 0.2
    rest = np.flatnonzero(held)
    scores = np.array([data[i][1] @ w[data[i][0]] for i in rest]).reshape(-1, len(languages))
    model.temperature = linear.fit_temperature(scores, y[rest])
    return model


def with_language(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """All rows with the struct column ``into`` of predicted language and probability."""

    @F.pandas_udf("lang_pred string, score double")
    def predicted(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame([model.predict(t) for t in part], columns=["lang_pred", "score"])

    return docs.withColumn(into, predicted(F.col(text)))


def languages(docs: DataFrame) -> DataFrame:
    """Query form: one row per document with fold, language and score."""
    out = with_language(docs.select("doc_id", "text"), fit(docs), into="found")
    return out.select("doc_id", is_held_out().alias("held_out"), "found.lang_pred", "found.score")
