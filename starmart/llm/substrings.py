"""Substring dedup: removes words covered by long word windows that also start elsewhere, found by level-wise doubling.

Lengths double from about half the window (18, 35 for the default). A window can only repeat if the shorter windows in
it repeat, so only windows that repeat at one length are extended to twice that length.

At the first length not every window is needed: of all short windows inside a long one, the one with the smallest hash
(its anchor) is chosen by content alone, so equal long windows have equal anchors, and no repeat is lost. At the further
lengths every window whose parts repeat is counted. Per length one aggregate by window hash counts occurrences and keeps
the owner, which is exact for windows that occur once; those go back to their documents and end the search there. Counts
are folded before the shuffle, so a passage of a third of all rows costs one row per task, and nothing is joined by
window. Windows are compared by 64-bit hashes.

Defined cases: null and empty texts have no words and keep the empty text; a text shorter than the window is kept; rows
that repeat a whole document, also with its id, are copies of each other; a null id is an id of its own; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmart.llm.text import WordHashes, window_hashes, words

WIDTH, SHORTEST = 35, 20
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"
FOUND = "window long, owner long, position int"
_HASHES = WordHashes(3)


def lengths(width: int) -> list[int]:
    """Window lengths, each at most twice the one before, ending with ``width``."""
    out = [width]
    while out[0] > SHORTEST:
        out.insert(0, -(-out[0] // 2))
    return out


def anchors(hashes: np.ndarray, reach: int) -> np.ndarray:
    """For each run of ``reach`` neighbouring short windows, the position of its smallest hash (the first of ties)."""
    if len(hashes) < reach:
        return np.empty(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(hashes, reach)
    return view.argmin(axis=1) + np.arange(len(view))


class Search:
    """Candidate windows of one document, level by level."""

    def __init__(self, tokens: list[bytes], levels: list[int]):
        self.levels = levels
        self.words = _HASHES.of(tokens)

    def first(self) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the anchors."""
        short = window_hashes(self.words, self.levels[0])
        if len(self.levels) == 1:
            return np.arange(len(short)), short
        at = np.unique(anchors(short, self.levels[1] - self.levels[0] + 1))
        return at, short[at]

    def starts(self, singles: list[np.ndarray]) -> np.ndarray:
        """Starts at level ``len(singles)`` of the windows whose parts repeat, given what occurs once at each level."""
        level, n = len(singles), len(self.words)
        if len(self.levels) == 1:
            alive = np.ones(max(0, n - self.levels[0] + 1), bool)
            alive[singles[0]] = False
            return np.flatnonzero(alive)
        short = window_hashes(self.words, self.levels[0])
        at = anchors(short, self.levels[1] - self.levels[0] + 1)
        single = np.zeros(len(short), bool)
        single[singles[0]] = True
        alive = ~single[at]
        for k in range(1, level):
            alive[singles[k]] = False
            if k + 1 < len(self.levels):
                step = self.levels[k + 1] - self.levels[k]
                alive = alive[:-step] & alive[step:] if len(alive) > step else alive[:0]
        return np.flatnonzero(alive)


def _positions(value: pa.Scalar) -> np.ndarray:
    return np.asarray(value.as_py() or [], np.int64)


def _batch(parts: list[tuple[np.ndarray, np.ndarray, int]]) -> pa.RecordBatch:
    at = np.concatenate([p[0] for p in parts]).astype(np.int32)
    h = np.concatenate([p[1] for p in parts]).view(np.int64)
    owner = np.repeat(np.array([p[2] for p in parts], np.int64), [len(p[0]) for p in parts])
    return pa.RecordBatch.from_arrays([pa.array(h), pa.array(owner), pa.array(at)], names=["window", "owner", "position"])


def _singles(found: DataFrame, name: str) -> DataFrame:
    """Positions of the windows that occur once, by document."""
    counted = found.groupBy("window").agg(
        F.count(F.lit(1)).alias("n"), F.min("owner").alias("owner"), F.min("position").alias("position"))
    return counted.where("n = 1").groupBy("owner").agg(F.collect_list("position").alias(name))


def deduplicated(docs: DataFrame, width: int = WIDTH, keep_text: bool = False) -> DataFrame:
    """One row per document: words, removed words and the digest of the kept ones (with ``keep_text`` also the text)."""
    levels = lengths(width)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "key", F.xxhash64("doc_id", "text"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
                tokens = words(text.as_py())
                if len(tokens) >= width:
                    parts.append((*Search(tokens, levels).first(), key))
            if parts:
                yield _batch(parts)

    def further(level: int):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts = []
                known = [batch.column(f"single{k}") for k in range(level)]
                for i, (key, text) in enumerate(zip(batch.column("key").to_pylist(), batch.column("text"))):
                    tokens = words(text.as_py())
                    if len(tokens) < width:
                        continue
                    search = Search(tokens, levels)
                    at = search.starts([_positions(c[i]) for c in known])
                    if len(at):
                        parts.append((at, window_hashes(search.words, levels[level])[at], key))
                if parts:
                    yield _batch(parts)
        return task

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in schema.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()][:len(names)]
        for batch in batches:
            out = []
            known = [batch.column(f"single{k}") for k in range(len(levels))]
            for i, (key, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text"))):
                tokens = words(text.as_py())
                kept, removed = tokens, 0
                if len(tokens) >= width:
                    starts = Search(tokens, levels).starts([_positions(c[i]) for c in known])
                    edge = np.zeros(len(tokens) + 1, np.int64)
                    edge[starts] += 1
                    edge[starts + width] -= 1
                    covered = np.cumsum(edge[:-1]) > 0
                    removed = int(covered.sum())
                    if removed:
                        kept = [t for t, c in zip(tokens, covered) if not c]
                body = b" ".join(kept)
                row = (key, len(tokens), removed, hashlib.sha256(body).hexdigest())
                out.append((*row, body.decode("utf-8", "replace")) if keep_text else row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    schema = SCHEMA + (", kept_text string" if keep_text else "")
    state = keyed
    found = keyed.select("key", "text").mapInArrow(first, FOUND)
    for level in range(len(levels)):
        singles = _singles(found, f"single{level}").withColumnRenamed("owner", f"owner{level}")
        state = state.join(singles, F.col("key") == F.col(f"owner{level}"), "left").drop(f"owner{level}")
        if level + 1 < len(levels):
            found = state.mapInArrow(further(level + 1), FOUND)
    return state.mapInArrow(finish, schema)
