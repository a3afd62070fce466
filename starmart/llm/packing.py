"""Packing of tokenised documents into windows by Karmarkar-Karp multiway differencing.

Each task reads its documents once, in blocks. A document's tokens (with an end token) are cut into full windows, which
stand alone, and a rest, cut into pieces of bounded length. The rests of a block are spread over k windows by differencing: every rest starts as a partial
partition of its own, and the two partitions with the largest imbalance are merged again and again, the heavy windows
of one with the light windows of the other, until one near-equal partition is left. k starts at the fewest windows that
could hold the block, and rises by one whenever the heaviest window exceeds the capacity. A block holds a bounded number
of rests, so memory does not depend on the input, nothing is shuffled, and a lost task is simply run again.

A window number is the task's number times 2**40 plus a count in the task.

Defined cases: a null text is empty and has the end token only; an empty table gives no rows; repeated rows are packed
one by one; a null id stays null; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW, END = 4096, 2
TOKENIZER = "word_bpe_49k.json"
#: Rests that are packed together.
BLOCK = 768
#: Words whose ids a worker remembers.
CACHED = 400_000
#: A rest is cut at multiples of this length, because small pieces even out where large ones do not.
CUT = 1024
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


# The byte alphabet of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_AFTER_LETTER = re.compile(rb"[.,](?=\s)(?<=[a-z].)")


class WordIds(dict):
    """Token ids (little-endian unsigned 32-bit) of each word between ASCII white space.

    The tokenizer lower-cases, drops white space and merges within words only, so the ids of a text are those of its
    words. A comma or stop between a letter and white space is a word of its own to it, and is split off here, so that
    fewer different words have to be merged. Special tokens are found by their exact spelling, so texts that may hold
    one keep their case.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHED:
            self.clear()
        text = word.decode("utf-8")
        if text.islower() and text.isalpha() and max(text) < "\u0100" and not {"\u00aa", "\u00ba"} & set(text):
            # One word of composed lower-case letters: the merges are all that is left to do.
            ids = [t.id for t in self.tokenizer.model.tokenize("".join(map(_ALPHABET.__getitem__, word)))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        value = self[word] = np.array(ids, "<u4").tobytes()
        return value

    def of(self, text: str | None) -> bytes:
        data = (text or "").encode("utf-8", "replace")
        if b"<|" not in data:
            data = _AFTER_LETTER.sub(rb" \g<0>", data.lower())
        return b"".join(map(self.__getitem__, data.split()))


_TOKENIZERS: dict[str, WordIds] = {}


def word_ids(path: str | None = None) -> WordIds:
    """The worker's tokenizer; ``path`` defaults to the public file."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordIds(path)
    return _TOKENIZERS[path]


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Item numbers of each of ``k`` near-equal parts.

    Merges keep sums only, sorted from heavy to light, and who was merged in which order; the parts are read off at the
    end, from the last merge back to the single items.
    """
    parts: list[list[int]] = [[] for _ in range(k)]
    if not sizes:
        return parts
    heap = [(-size, i) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    sums: dict[int, np.ndarray] = {}
    merges: list[tuple[int, int, np.ndarray]] = []

    def taken() -> tuple[int, np.ndarray]:
        _, node = heapq.heappop(heap)
        if node >= len(sizes):
            return node, sums.pop(node)
        start = np.zeros(k, np.int64)
        start[0] = sizes[node]
        return node, start

    while len(heap) > 1:
        (i, a), (j, b) = taken(), taken()
        both = a + b[::-1]  # both fall, so the heaviest of one meets the lightest of the other
        order = np.argsort(-both, kind="stable")
        node = len(sizes) + len(merges)
        sums[node] = both[order]
        merges.append((i, j, order))
        heapq.heappush(heap, (int(sums[node][-1] - sums[node][0]), node))
    place = {heap[0][1]: np.arange(k)}  # for each sorted slot of a node, the part it ends in
    for n in range(len(merges) - 1, -1, -1):
        i, j, order = merges[n]
        slots = np.empty(k, np.int64)
        slots[order] = place.pop(len(sizes) + n)
        place[i], place[j] = slots, slots[::-1]
    for item in range(len(sizes)):
        parts[int(place[item][0])].append(item)
    return parts


def pack(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """Item numbers of the fewest windows that differencing keeps within the capacity; no item exceeds it."""
    if not sizes:
        return []
    k = max(1, -(-sum(sizes) // window))
    while True:
        parts = differencing(sizes, k)
        if max(sum(sizes[i] for i in p) for p in parts) <= window:
            return [p for p in parts if p]
        k += 1


def packed(
    docs: DataFrame, window: int = WINDOW, block: int = BLOCK, cut: int = CUT, tokenizer: str | None = None
) -> DataFrame:
    """One row per piece of a document: where it starts, its length and digest, and its place in a window."""
    end = np.array([END], "<u4").tobytes()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(tokenizer)
        first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        done, rests = 0, []

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*pieces)) if pieces else [()] * 7
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal done, rests
            out = []
            for part in pack([r[2] for r in rests], window):
                offset = 0
                for i in part:
                    out.append((*rests[i], first + done, offset))
                    offset += rests[i][2]
                done += 1
            rests = []
            yield rows(out)

        for batch in batches:
            full = []
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = ids_of.of(text.as_py()) + end
                n = len(ids) // 4
                whole = n - n % window
                for at in (*range(0, whole, window), *range(whole, n, cut)):
                    size = window if at < whole else min(cut, n - at)
                    piece = (key, at, size, zlib.crc32(ids[4 * at:4 * (at + size)]), n)
                    if piece[2] == window:
                        full.append((*piece, first + done, 0))
                        done += 1
                    else:
                        rests.append(piece)
                        if len(rests) >= block:
                            yield from flush()
            if full:
                yield rows(full)
        if rests:
            yield from flush()

    return docs.select("doc_id", "text").mapInArrow(task, SCHEMA)
