"""Benchmark decontamination by spaced-seed hashing.

Words are lower-cased and stripped of signs at both ends. A fixed mask of given span looks at some positions of a window
of words and ignores the others, so a hash of it survives substitutions at the ignored ones. The hashes of the benchmark
items under all masks are matched with those of every document; around each hit document and item are laid side by
side, and the longest stretch in which at least four of five words agree is taken. A stretch with enough agreeing words
is an overlap.

Both sides are hashed where they lie. A bitmap of fixed size, made of the benchmark's seeds, drops nearly all seeds of the
documents at once; the rest is joined with the benchmark's by hash, and every (document, item, displacement) that results
is verified once, with the document's text read once for all its items. Documents without a hit are not moved. Nothing
of the benchmark but the bitmap goes to the driver or to every task.

Items of ``FEWEST`` to ``SPAN - 1`` words are too short for the masks and are found by the hash of the whole item, so
they must occur word for word. Items of fewer words say too little about a document and are not looked for.

Defined cases: null and empty texts overlap with nothing; an item shorter than ``LEAST`` words must agree in whole;
repeated documents are judged one by one; items that repeat an id are reported once under it; an item without an id or a
text is left out; an empty benchmark finds nothing; other columns are kept by ``with_overlaps``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmart.llm.families import narrowed
from starmart.llm.tables import Stored
from starmart.llm.text import CACHE_WORDS, WordHashes, mix, words

# 1: the position counts, 0: it is ignored.
MASKS = ("111011", "1101100011", "1011010101")
SPAN = min(map(len, MASKS))
#: Agreeing words that make an overlap, and the share of agreeing words in a stretch.
LEAST, SHARE = 12, 0.8
#: Words of the shortest item that is looked for.
FEWEST = 3
FOUND = "array<struct<item_id:long,start:int,end:int,matched:int>>"
#: Bits of a seed that number a place of the bitmap.
BITS = 26
_SIGNS = b".,;:!?\"'()[]{}<>|*#$%&-_/\\"


class _Normal(dict):
    """Hash of a word without signs at its ends; 0 for signs alone."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        bare = word.strip(_SIGNS)
        value = self[word] = (_HASHES[bare] | 1) if bare else 0
        return value


_HASHES, _NORMAL = WordHashes(4), _Normal()


def hashed_words(text: str | None) -> np.ndarray:
    tokens = words((text or "").lower())
    h = np.fromiter(map(_NORMAL.__getitem__, tokens), np.uint64, len(tokens))
    return h[h != 0]


def seeds(h: np.ndarray, mask: str, number: int) -> np.ndarray:
    """Hash of the counted positions of each window."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, number + 1, np.uint64)
    for k, used in enumerate(mask):
        if used == "1":
            total = total * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
    return mix(total)


def all_seeds(h: np.ndarray, shorts: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(seed, first word) of every window under every mask, and of all windows of the short lengths."""
    masks = [*enumerate(MASKS), *((len(MASKS) + n, "1" * n) for n in shorts)]
    found = [seeds(h, mask, number) for number, mask in masks]
    return np.concatenate(found), np.concatenate([np.arange(len(f)) for f in found])


def verified(h: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """(first word, end, agreeing words) of the overlap of a document and an item at a displacement; all 0 if there is none."""
    lo, hi = max(0, -shift), min(len(item), len(h) - shift)
    if hi <= lo:
        return 0, 0, 0
    a, b, matched = longest_agreement(h[lo + shift:hi + shift] == item[lo:hi])
    return (lo + shift + a, lo + shift + b, matched) if matched >= min(LEAST, len(item)) else (0, 0, 0)


def longest_agreement(equal: np.ndarray, share: float = SHARE) -> tuple[int, int, int]:
    """(start, end, agreeing) of the stretch with most agreeing words among those with at least ``share`` of them.

    The first of the longest on ties. Stretches begin and end with agreeing words.
    """
    at = np.flatnonzero(equal)
    if not len(at):
        return 0, 0, 0
    # From agreeing word i to j: j - i + 1 agree of at[j] - at[i] + 1; both sides in one value per word.
    key = np.arange(len(at)) - share * at
    best = (0, 0, 0)
    lowest = np.minimum.accumulate(key)
    for j in range(len(at) - 1, -1, -1):
        if j + 1 <= best[2]:
            break
        i = int(np.searchsorted(-lowest[:j + 1], -(key[j] + 1 - share) - 1e-9))
        if i <= j and j - i + 1 > best[2]:
            best = (int(at[i]), int(at[j]) + 1, j - i + 1)
    return best


def _batch(parts: list[tuple[int, np.ndarray, np.ndarray]], owner: str) -> pa.RecordBatch:
    seed = np.concatenate([p[1] for p in parts]).view(np.int64)
    at = np.concatenate([p[2] for p in parts]).astype(np.int32)
    own = np.repeat(np.array([p[0] for p in parts], np.int64), [len(p[1]) for p in parts])
    return pa.RecordBatch.from_arrays([pa.array(seed), pa.array(own), pa.array(at)], names=["seed", owner, f"{owner}_at"])


def _item_seeds(items: DataFrame) -> DataFrame:
    """(seed, item, item_at) of the benchmark."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text")):
                h = hashed_words(text.as_py())
                if len(h) >= SPAN:
                    parts.append((item, *all_seeds(h, ())))
                elif len(h) >= FEWEST:
                    found = seeds(h, "1" * len(h), len(MASKS) + len(h))
                    parts.append((item, found, np.zeros(1, np.int64)))
            if parts:
                yield _batch(parts, "item")

    return items.mapInArrow(task, "seed long, item long, item_at int")


def _bitmap(found: DataFrame) -> np.ndarray:
    """Bitmap of the first ``BITS`` bits of the seeds, 64 places a word; at most ``2 ** (BITS - 6)`` rows on the driver."""
    place = F.shiftrightunsigned("seed", 64 - BITS)
    bits = found.select(F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {64 - BITS}) & 63 as int))").alias("bit"))
    rows = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def _document_seeds(docs: DataFrame, bitmap: np.ndarray, shorts: tuple[int, ...]) -> DataFrame:
    """(seed, row, row_at) of the documents' seeds that the bitmap does not exclude."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            parts = []
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text")):
                seed, at = all_seeds(hashed_words(text.as_py()), shorts)
                place = seed >> np.uint64(64 - BITS)
                hit = np.flatnonzero(bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1))
                if len(hit):
                    parts.append((row, seed[hit], at[hit]))
            if parts:
                yield _batch(parts, "row")

    return docs.select("row", "text").mapInArrow(task, "seed long, row long, row_at int")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(row, item_id, start, end, matched): the best overlap of each distinct (doc_id, text) with each item.

    ``row`` is ``xxhash64(doc_id, text)``; ties go to the first displacement.
    """
    stored = Stored(docs.sparkSession, "decontamination")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        "item_id is not null and text is not null").select("item_id", "text", F.xxhash64("item_id", "text").alias("item"))
    found = stored.keep(_item_seeds(items), "item-seeds")
    lengths = found.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where("n = 1").join(items, "item").select("text").mapInArrow(
        _short_lengths, "n int").distinct().collect()  # fewer than SPAN rows
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("row"), "text")
    hits = _document_seeds(keyed, _bitmap(found), tuple(sorted(r.n for r in lengths)))
    lines = stored.keep(hits.join(found.hint("merge"), "seed").select(
        "row", "item", (F.col("row_at") - F.col("item_at")).alias("shift")).distinct(), "lines")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, item, last = np.empty(0, np.uint64), np.empty(0, np.uint64), None
        for batch in batches:
            out = []
            for row, side, number, item_id, shift, text in zip(
                    *(batch.column(c).to_pylist() for c in ("row", "side", "item", "item_id", "shift")), batch.column("text")):
                if side == 0:
                    h = hashed_words(text.as_py())
                    continue
                if number != last:
                    item, last = hashed_words(text.as_py()), number
                start, end, matched = verified(h, item, shift)
                if matched:
                    out.append((row, item_id, shift, start, end, matched))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], _CHECKED)

    touched = lines.select("row").distinct()
    texts = narrowed(keyed, "row", touched).join(touched.hint("merge"), "row", "left_semi").dropDuplicates(["row"])
    empty = F.lit(None).cast("long")
    together = texts.select("row", F.lit(0).alias("side"), empty.alias("item"), empty.alias("item_id"), F.lit(0).alias("shift"), "text").unionByName(
        lines.join(items, "item").select("row", F.lit(1).alias("side"), "item", "item_id", "shift", "text"))
    checked = together.repartition("row").sortWithinPartitions("row", "side", "item", "shift").mapInArrow(
        task, "row long, item_id long, shift int, start int, end int, matched int")
    best = F.min(F.struct((-F.col("matched")).alias("less"), "shift", "start", "end", "matched")).alias("best")
    kept = stored.keep(checked.groupBy("row", "item_id").agg(best).select("row", "item_id", "best.start", "best.end", "best.matched"), "found")
    stored.drop(found, lines)
    return kept


_CHECKED = pa.schema([("row", pa.int64()), ("item_id", pa.int64()), ("shift", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("matched", pa.int32())])


def _short_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of words of the items that are found as a whole."""
    seen = {len(hashed_words(text.as_py())) for batch in batches for text in batch.column("text")}
    yield pa.RecordBatch.from_arrays([pa.array(sorted(n for n in seen if FEWEST <= n < SPAN), pa.int32())], names=["n"])


def with_overlaps(docs: DataFrame, benchmark: DataFrame, into: str = "overlaps") -> DataFrame:
    """All documents with the array column ``into`` of their overlaps with benchmark items."""
    key = _unused(docs.columns, "row_key")
    listed = overlaps(docs, benchmark).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("item_id", "start", "end", "matched"))).alias(into)).withColumnRenamed("row", key)
    joined = docs.withColumn(key, F.xxhash64("doc_id", "text")).join(listed, key, "left")
    return joined.withColumn(into, F.coalesce(into, F.array()).cast(FOUND)).select(*(c for c in docs.columns if c != into), into)


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, without those that overlap with an item. Only documents with an overlap are moved."""
    key = _unused(docs.columns, "row_key")
    bad = overlaps(docs, benchmark).select(F.col("row").alias(key)).distinct()
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    unsure = narrowed(keyed, key, bad).join(bad.hint("merge"), key, "left_anti")
    return narrowed(keyed, key, bad, other=True).select(*docs.columns).unionByName(unsure.select(*docs.columns))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Query form: one row per document and item that overlap."""
    found = overlaps(docs, benchmark)
    rows = narrowed(docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row")), "row", found)
    return rows.join(found.hint("merge"), "row").select(
        "doc_id", "item_id", F.col("start").cast("long").alias("start_word"), F.col("end").cast("long").alias("end_word"),
        F.col("matched").cast("long").alias("n_matched"))


def _unused(columns: list[str], name: str) -> str:
    while name in columns:
        name += "_"
    return name
