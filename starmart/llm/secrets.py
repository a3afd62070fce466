"""Secret scan: fixed patterns, and sliding-window Shannon entropy per character class.

Candidate strings are maximal runs of key characters. Over each run a window of ``window`` characters slides; the
counts of its characters are updated by one in and one out per step, and with them the sum of ``n log2 n`` that gives
the entropy. A window counts if its class (hex digits, mixed letters and digits, or letters of both cases) reaches the
threshold of that class; the letters class has a longer window of its own, both cases of which must be frequent. Windows that overlap or touch are merged. Runs on the allow-list are not looked at.

Of random keys of 40 letters 0.03 % are missed (20,000 drawn). Names of words in humps raise no alarm; of names of 24
letters and more that hold an acronym, two in three do.

Defined cases: null and empty texts have no spans; repeated rows are scanned one by one; other columns, also with the
names of results, pass through ``scan`` untouched, because its results come as the named struct column.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import log2

import pandas as pd
from pyspark.sql import DataFrame, functions as F

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "entropy")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
# Bits per character that a window of the class must reach.
THRESHOLDS = {"hex": 3.0, "mixed": 3.6, "letters": 3.8}
# Runs of letters alone need a longer window, in which this share at least is upper case and as much is lower case.
LETTERS_WINDOW, CASE_SHARE = 24, 0.25
# What looks random and is public. UUIDs, dates and times, version strings, paths, words joined by signs;
# words are of upper case, or of lower case with a capital ahead or for each hump.
_WORD = r"(?:[A-Z]?[a-z]+(?:[A-Z][a-z]+)*|[A-Z]+)"
ALLOWED = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"[0-9_/-]+",
    rf"{_WORD}([_/=+-]+{_WORD})*[_/=+-]*",
    rf"({_WORD}|[0-9]{{1,4}})([_/-]+({_WORD}|[0-9]{{1,4}}))*",
)
SCHEMA = "n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string"


def _class_of(run: str) -> str | None:
    """Character class of a run: None if it has digits only, or letters of one case only, so that words are no candidates."""
    digit, upper, lower = any(c.isdigit() for c in run), any(c.isupper() for c in run), any(c.islower() for c in run)
    if not digit:
        return "letters" if upper and lower else None
    if not upper and not lower:
        return None
    return "hex" if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", run) else "mixed"


def entropy_windows(
    run: str, window: int = WINDOW, thresholds: dict[str, float] = THRESHOLDS, letters_window: int = LETTERS_WINDOW
) -> list[tuple[int, int]]:
    """Merged (start, end) of the windows of one run whose entropy reaches the threshold of its class."""
    kind = _class_of(run)
    if kind == "letters":
        window = letters_window
    if kind not in thresholds or len(run) < window:
        return []
    terms = [0.0] + [n * log2(n) for n in range(1, window + 2)]
    counts: dict[str, int] = {}
    total, base, upper, lower, spans = 0.0, log2(window), 0, 0, []
    for i, c in enumerate(run):
        n = counts.get(c, 0)
        total += terms[n + 1] - terms[n]
        counts[c] = n + 1
        upper, lower = upper + c.isupper(), lower + c.islower()
        if i >= window:
            old = run[i - window]
            n = counts[old]
            total += terms[n - 1] - terms[n]
            counts[old] = n - 1
            upper, lower = upper - old.isupper(), lower - old.islower()
        even = kind != "letters" or min(upper, lower) >= CASE_SHARE * window
        if i >= window - 1 and even and base - total / window >= thresholds[kind] - 1e-9:
            start = i - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def find_spans(
    text: str | None, window: int = WINDOW, thresholds: dict[str, float] = THRESHOLDS, allowed: re.Pattern | None = None
) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all secrets of one text, by start and then kind; code points, end exclusive."""
    if not text:
        return []
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    for m in CANDIDATE.finditer(text):
        if not (allowed and allowed.fullmatch(m[0])):
            found += [(m.start() + a, m.start() + b, "entropy") for a, b in entropy_windows(m[0], window, thresholds)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(
    docs: DataFrame, text: str = "text", into: str = "secrets", window: int = WINDOW,
    thresholds: dict[str, float] = THRESHOLDS, allow: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """All rows with the struct column ``into``: counts by kind, digest of the pattern spans, and all spans as text."""
    allowed = re.compile("|".join(f"(?:{p})" for p in allow)) if allow else None

    def summary(t: str | None) -> tuple:
        spans = find_spans(t, window, thresholds, allowed)
        n = {k: sum(s[2] == k for s in spans) for k in KINDS}
        base = _joined([s for s in spans if s[2] != "entropy"])
        return (*n.values(), hashlib.sha256(base.encode()).hexdigest(), _joined(spans))

    @F.pandas_udf(SCHEMA)
    def scanned(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame([summary(t) for t in part], columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return docs.withColumn(into, scanned(F.col(text)))


def secret_spans(spark, docs: DataFrame) -> DataFrame:
    """Query form: one row per document with its counts, digest and spans."""
    out = scan(docs.select("doc_id", "text"), into="found_secrets")
    return out.select("doc_id", *(f"found_secrets.{c}" for c in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy")))


def mask(docs: DataFrame, text: str = "text", word: str = "[SECRET]") -> DataFrame:
    """Documents with every span of their text replaced by ``word``; texts without spans stay as they are.

    A column ``n_chars`` follows the new text. Overlapping spans become one.
    """
    allowed = re.compile("|".join(f"(?:{p})" for p in ALLOWED))

    def masked(t: str | None) -> str | None:
        spans = find_spans(t, allowed=allowed)
        if not spans:
            return t
        out, at = [], 0
        for a, b, _ in spans:
            if a >= at:
                out += [t[at:a], word]
            at = max(at, b)
        return "".join(out) + t[at:]

    @F.pandas_udf("string")
    def masked_texts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([masked(t) for t in part], dtype=object)

    out = docs.withColumn(text, masked_texts(F.col(text)))
    return out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
