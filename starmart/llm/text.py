"""Words, hashes and hashed n-gram features of texts; helpers that run inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

# Words end at the ASCII white space of these ranges: space and tab to carriage return, which is what bytes.split() uses.
CACHE_WORDS = 120_000


def words(text: str | None) -> list[bytes]:
    """UTF-8 words between ASCII white space; no words for a null text."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def lower_words(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased and all other letters as they are."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


class WordHashes(dict):
    """64-bit hash of each word, remembered for a bounded number of words."""

    def __init__(self, seed: int = 0):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return value

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (splitmix finaliser), so that equal bits of sums do not survive."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def window_hashes(h: np.ndarray, width: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Polynomial hashes of all windows of ``width`` values, built by doubling: a window of 2k is two of k.

    An empty array if there are fewer values than ``width``.
    """
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    size, level, power = 1, h.astype(np.uint64), base & (2**64 - 1)
    result, done = None, 0
    while True:
        if width & size:
            part = level[done:done + n]
            result = part.copy() if result is None else result * np.uint64(power) + part
            done += size
        size *= 2
        if size > width:
            return mix(result)
        half = size // 2
        level = level[:-half] * np.uint64(power) + level[half:]
        power = power * power & (2**64 - 1)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def char_grams(text: str, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """Hashed character n-grams of all ``sizes``, as bucket numbers below ``2 ** bits``, with repeats."""
    points = code_points(text).astype(np.uint64) + np.uint64(1)
    shift = np.uint64(64 - bits)
    out, h = [], np.zeros(len(points), np.uint64)
    for k in range(1, max(sizes) + 1):
        if len(points) < k:
            break
        h = h[:len(points) - k + 1] * np.uint64(0x100000001B3) + points[k - 1:]
        if k in sizes:
            out.append(((h + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)) >> shift)
    return np.concatenate(out).astype(np.int64) if out else np.empty(0, np.int64)


def is_held_out(folds: int = 4, fold: int = 2, column: str = "doc_id"):
    """Column: whether crc32 of the id as text falls into the held-out fold; false for a null id."""
    from pyspark.sql import functions as F

    key = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce(F.pmod(key, F.lit(folds)) == fold, F.lit(False))
