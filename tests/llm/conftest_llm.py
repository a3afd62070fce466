"""Small document tables with the awkward rows that every operator has to stand."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, letters: str = "abcdefghij") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))


def table(spark, texts: dict[int | None, str | None] | list[tuple[int | None, str | None]]):
    pairs = list(texts.items()) if isinstance(texts, dict) else texts
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], SCHEMA)


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, an empty and a very long text, and a repeated row."""
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, prose(3, 30_000), "en", "s", 9), (None, "no id", None, None, 5),
        (4, "twice the same row", "en", "s", 18), (4, "twice the same row", "en", "s", 18), (5, " \t\n ", "de", "s", 4)]
    return spark.createDataFrame(rows, SCHEMA)
