"""Language-model scores: bit predictors by hashed context, mixed by gated logistic weights, and an add-one word baseline.

The model reads the lower-cased words of a text with one space between them and an end sign, byte by byte, each byte as
eight binary decisions. Seven predictors know how often a 0 and a 1 followed (context, bits of the byte so far) in the
training texts; their contexts are nothing, the last one to four bytes, the word so far, and the word so far with the kind
of the text. The last bytes are those of the running text: at the beginning of a word they are the space and the end of
the word before it. The kind is which of the most frequent training words occurs most often in the text; it costs the
bits that its share of the training texts asks for, and mostly tells the language. The predictions are mixed in the
logistic domain by weights that a gate chooses: whether the byte is one of a word's first, the longest contexts that are
known and how well they are. The weights, and a last table that refines each mixed probability, adapt online over all
training bytes, each being held back from the counts that predict it. A word's first bytes weigh with their occurrences,
later ones with the root of their word's, so that neither few frequent words nor the many rare ones decide alone. Every
task adapts on its share, and the results are averaged, later steps counting for more. A text's score is the sum of the
log10 probabilities of its bits.

The last four bytes of a word's fourth byte and of all later ones lie in the word and the space ahead of it. So a word's
first ``HEAD`` bytes are judged with the word before them, as they stand in the text, and its other bytes once per word
and kind; bytes of one kind with the same beginning of a word are judged once where they meet. Words are counted by Spark and dealt by
their first bytes, by one more wherever more than ``CROWD`` rows share these; a task so sees all words that share a longer
beginning, few enough to hold, and counts in contexts of a word's beginning exactly (by 56-bit hashes). Counts in the other
contexts are a table: those of up to two bytes are told apart, those of three and four bytes share ``2 ** PLACES`` places
each, a word's first bytes are as many as texts have, and the beginnings that crowds share are as many as those have next
bytes. Workers read the table from a broadcast, keep it as sums ahead of each key, and hold it once for all their tasks.
Orders and predictors are the same at every size. Texts are cut once and kept as numbers of words in chunks of bounded size;
scores of a chunk's words come back under those numbers.

Defined cases: a null text is empty and has the end token only; repeated rows are scored and counted each; with no
training texts all counts are zero and bits cost about one bit each; a null id is not held out; other columns are not read.
"""

from __future__ import annotations

import ctypes
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.tables import Stored
from starmart.llm.text import is_held_out, mix

#: Frequent words that name the kinds of texts; a text without any of them has the kind ``KINDS``.
KINDS = 16
RATE, REFINE_RATE, STEPS, PRIOR = 0.03, 0.005, 33, 0.1
#: Known gates: how well the longest known context is known.
LEVELS = np.array([2.0, 8.0, 64.0])
#: Longest context of last bytes; contexts of more than two bytes are hashed to that many bits.
ORDER, PLACES = 4, 20
PREDICTORS, GATES = ORDER + 3, (ORDER + 3) * (len(LEVELS) + 1)
#: Words of a piece of texts that the search for the most frequent ones counts.
MOST = 20_000
#: Scored words held before they are passed on, words that a task adapts to, words that are dealt with together, bytes
#: of one step, bytes looked up at a time (whole steps, few enough to stay near the processor), characters of a chunk, and
#: words of texts looked at together.
HELD, SHARE, GROUP, STEP, ROWS, CHUNK, PIECE = 200_000, 400_000, 20_000, 512, 32 * 512, 40_000_000, 300_000
#: First bytes of a word that the words of all tasks know about; the contexts of last bytes of later ones lie in the word.
HEAD = ORDER - 1
#: Rows of words that share their first bytes, and bytes of these words, beyond which they are dealt by one byte more; no more
#: than so many bytes; bytes that one pass over the words looks ahead.
CROWD, CROWD_BYTES, DEEPEST, AHEAD = 40_000, 1_000_000, 40, 2
FOLDS, FOLD = 7, 2
_END = b"\n"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.multiply.accumulate(np.append(np.uint64(1), np.full(255, _BASE)))


def _powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base of the hash."""
    if n <= len(_POWERS):
        return _POWERS[:n]
    return np.multiply.accumulate(np.append(np.uint64(1), np.full(n - 1, _BASE)))


def last_keys(k: int, behind: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The context of the last ``k`` of the bytes ``behind`` above the byte in the lowest 8 bits."""
    last = behind & np.uint64((1 << 8 * k) - 1)
    if k >= 3:
        last = mix(last) >> np.uint64(64 - PLACES)
    return np.uint64(k) << np.uint64(60) | last << np.uint64(8) | data


def beginning_keys(prefix: np.ndarray, data: np.ndarray, kind: np.ndarray | None = None) -> np.ndarray:
    """The context of a word so far, and of the kind if given, above the byte in the lowest 8 bits."""
    h = prefix + np.uint64(7)
    if kind is not None:
        h = h * _BASE + kind + np.uint64(1)
    return mix(h) & ~np.uint64(255) | data


def _new(keys: np.ndarray) -> np.ndarray:
    """Which of sorted keys are the first of their kind."""
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return new


class Grams:
    """The bytes of words, each with the space behind it (the end sign has none), and the contexts that they stand in.

    ``tails`` are the last three bytes ahead of the space before a word, nothing if not given. ``depths`` tells how many
    bytes of a word others than those given may share; not fewer than ``HEAD``, which holds if it is not given.
    """

    def __init__(self, words: list[bytes], kinds: np.ndarray, tails: np.ndarray | None = None, depths: np.ndarray | None = None):
        bodies = [w if w == _END else w + b" " for w in words]
        self._fill(np.fromiter(map(len, bodies), np.int64, len(bodies)), np.frombuffer(b"".join(bodies), np.uint8), kinds, tails)
        if depths is not None:
            self.short = self.place < depths[self.word]

    @classmethod
    def of_bytes(cls, sizes: np.ndarray, data: np.ndarray, kinds: np.ndarray, tails: np.ndarray | None = None) -> Grams:
        """Those of given bytes, without more of them."""
        grams = cls.__new__(cls)
        grams._fill(sizes, data, kinds, tails)
        return grams

    def _fill(self, sizes: np.ndarray, data: np.ndarray, kinds: np.ndarray, tails: np.ndarray | None) -> None:
        self.sizes = sizes
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = data.astype(np.uint64)
        self.word = np.repeat(np.arange(len(sizes), dtype=np.int32), self.sizes)
        self.place = np.arange(len(self.data)) - self.starts[self.word]
        self.kind = kinds.astype(np.uint64)[self.word]
        self.tail = None if tails is None else tails.astype(np.uint64)[self.word]
        value = (self.data + np.uint64(1)) * _powers(int(self.sizes.max(initial=1)))[self.place]
        before = np.cumsum(value) - value
        self.prefix = before - before[self.starts[self.word]]
        self.after = self.prefix + value
        # Of its first bytes the words of all tasks know: those contexts come from the table.
        self.short = self.place < HEAD

    def later(self) -> np.ndarray:
        """The bytes behind a word's first ones."""
        return np.flatnonzero(self.place >= HEAD)

    def behind(self, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        """The last ``ORDER`` bytes, with the space ahead of the word and what stands before that; the last one lowest."""
        at = np.arange(len(self.data))[rows] if isinstance(rows, slice) else rows
        place, out = self.place[at], np.zeros(len(at), np.uint64)
        for j in range(1, ORDER + 1):
            byte = np.where(place >= j, self.data[at - np.minimum(j, place)], np.where(place == j - 1, np.uint64(32), np.uint64(0)))
            if self.tail is not None and j > 1:
                far = np.clip(j - 2 - place, 0, 7).astype(np.uint64)
                byte = np.where(place < j - 1, self.tail[at] >> np.uint64(8) * far & np.uint64(255), byte)
            out |= byte << np.uint64(8 * (j - 1))
        return out

    def keys(self, k: int, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        """The context of predictor ``k`` above the byte in the lowest 8 bits."""
        data = self.data[rows]
        if k <= ORDER:
            return last_keys(k, self.behind(rows), data)
        return beginning_keys(self.prefix[rows], data, self.kind[rows] if k == ORDER + 2 else None)

    def nodes(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(one of the bytes for each byte and all that it depends on, the number of that byte for each row)."""
        h = mix(self.after[rows]) + self.kind[rows]
        if self.tail is not None:
            h = mix(h) + self.tail[rows]
        order = np.argsort(h)
        new = _new(h[order])
        back = np.empty(len(h), np.int64)
        back[order] = np.cumsum(new) - 1
        first = np.minimum.reduceat(order, np.flatnonzero(new)) if len(h) else order
        return rows[first], back


#: Number of leading bits, of eight, that a byte's zeros leave equal.
_SHARED = np.array([8 - x.bit_length() for x in range(256)])


class Paths:
    """How often the first 0 to 8 bits of each key's byte followed its context; the keys must be all of their contexts.

    Kept are the sums ahead of every key, and how many keys before and behind it share so many bits.
    """

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self._fill(*_folded([keys], [n]))

    @classmethod
    def of_sorted(cls, keys: np.ndarray, n: np.ndarray) -> Paths:
        """Those of keys that come once each and in order."""
        paths = cls.__new__(cls)
        paths._fill(keys, n)
        return paths

    def _fill(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.keys, self.spans = keys, None  # the driver, which looks nothing up, needs no spans
        self.ahead = np.zeros(len(keys) + 1, np.int32 if n.sum() < 2**31 else np.int64)
        np.cumsum(n, out=self.ahead[1:])

    def _span(self) -> None:
        keys, size, low = self.keys, len(self.keys), 0
        self.spans = np.empty((size, 16), np.uint8)
        while low < size:  # pieces of whole contexts
            high = min(low + 4 * ROWS, size)
            high = high if high == size else int(np.searchsorted(keys, keys[high] | np.uint64(255), "right"))
            part, at = keys[low:high], np.arange(high - low)
            for bits in range(8):
                start = np.flatnonzero(_new(part >> np.uint64(8 - bits)))
                many = np.diff(start, append=len(part))
                before = at - start.repeat(many)
                self.spans[low:high, bits] = before
                self.spans[low:high, 8 + bits] = many.repeat(many) - 1 - before
            low = high

    def __reduce__(self):
        return Paths.of_sorted, (self.keys, np.diff(self.ahead))

    def _shared(self, keys: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leading bits of the byte that are equal; -1 in another context."""
        apart = keys ^ self.keys[at]
        return np.where(apart < np.uint64(256), _SHARED[(apart & np.uint64(255)).astype(np.int64)], -1)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """(bits, key); the path of a key that was never counted ends where its byte leaves the known ones."""
        if not len(self.keys):
            return np.zeros((9, len(keys)), np.int64)
        if self.spans is None:
            self._span()
        order, at = np.argsort(keys), np.empty(len(keys), np.int64)  # keys in order are found faster
        at[order] = np.minimum(np.searchsorted(self.keys, keys[order]), len(self.keys) - 1)
        shared = self._shared(keys, at)
        other = np.flatnonzero(shared < 8)
        if len(other):
            left = np.maximum(at[other] - 1, 0)
            also = self._shared(keys[other], left)
            better = also > shared[other]
            at[other[better]], shared[other[better]] = left[better], also[better]
        spans, out = self.spans[at].T, np.empty((9, len(keys)), self.ahead.dtype)
        for bits in range(8):
            np.subtract(self.ahead[at + spans[8 + bits] + 1], self.ahead[at - spans[bits]], out=out[bits])
        np.subtract(self.ahead[at + 1], self.ahead[at], out=out[8])
        if len(other):
            out[:, other] *= np.arange(9)[:, None] <= shared[other]
        return out


class Mixer:
    """Mixing of the counts into a probability that the next bit is 1."""

    def __init__(self, weights: np.ndarray | None = None, refined: np.ndarray | None = None):
        self.weights = np.full((GATES, PREDICTORS), 0.3) if weights is None else weights
        self.steep = np.zeros((GATES, PREDICTORS))  # squared slopes so far, which shorten the steps
        grid = np.linspace(-8, 8, STEPS)
        self.refined = np.tile(1 / (1 + np.exp(-grid)), (GATES, 1)) if refined is None else refined

    def inputs(self, paths: list[np.ndarray], data: np.ndarray, bit: int, held_back: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(stretched predictions, gates, bits); ``paths`` has the counts (bits, byte) of every predictor."""
        y = (data >> np.uint64(7 - bit) & np.uint64(1)).astype(np.int64)
        kind = np.float32 if held_back else np.float64  # learning needs no more
        x, depth, known = np.empty((PREDICTORS, len(data)), kind), np.zeros(len(data), np.int64), np.zeros(len(data), kind)
        sign = (2 * y - 1).astype(kind)
        for k, path in enumerate(paths):
            all_of, same = path[bit], path[bit + 1].astype(kind)
            other = (all_of - path[bit + 1]).astype(kind)
            if held_back:
                same = np.maximum(same - kind(1), kind(0))
            x[k] = sign * np.log((same + kind(PRIOR)) / (other + kind(PRIOR)))
            seen = (same + other if held_back else all_of) > 0
            depth[seen] = k
            np.copyto(known, same + other, where=seen)
        level = sum((known >= low).astype(np.int64) for low in LEVELS)
        return x.T, depth * (len(LEVELS) + 1) + level, y

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probability before and after refinement, cell of the refinement)."""
        p, cell = self._before(x, gate)
        return p, (p + self.refined.take(gate * STEPS + cell)) / 2, cell

    def _before(self, x: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = np.einsum("ij,ij->i", x, self.weights.take(gate, axis=0))
        np.minimum(np.maximum(z, -12, out=z), 12, out=z)
        cell = np.rint((z + 8) * ((STEPS - 1) / 16))
        np.minimum(np.maximum(cell, 0, out=cell), STEPS - 1, out=cell)
        return 1 / (1 + np.exp(-z)), cell.astype(np.int64)

    def learn(self, paths: list[np.ndarray], data: np.ndarray, count: np.ndarray) -> None:
        """One online step over a small group of bytes: weights against the coding loss, cells towards their bits."""
        for _ in self.steps(paths, data, count, max(1, len(data))):
            pass

    def steps(self, paths: list[np.ndarray], data: np.ndarray, count: np.ndarray, step: int) -> Iterator[None]:
        """Online steps of ``step`` bytes each, one after the other; what they do not change is worked out for all at once."""
        bits = []
        for bit in range(8):
            x, gate, y = self.inputs(paths, data, bit, True)
            bits.append((np.ascontiguousarray(x, np.float64), gate, y, gate[:, None] * PREDICTORS + np.arange(PREDICTORS)))
        for low in range(0, len(data), step):
            part = slice(low, low + step)
            for inputs in bits:
                self._step(count[part], *(v[part] for v in inputs))
            yield

    def _step(self, count: np.ndarray, x: np.ndarray, gate: np.ndarray, y: np.ndarray, of_weight: np.ndarray) -> None:
        p, cell = self._before(x, gate)
        x *= (count * (y - p))[:, None]
        slope = np.bincount(of_weight.ravel(), x.ravel(), GATES * PREDICTORS).reshape(GATES, PREDICTORS)
        slope /= np.maximum(np.bincount(gate, count, GATES), 1e-9)[:, None]
        self.steep += slope * slope
        self.weights += RATE * slope / np.sqrt(self.steep + 1e-8)
        np.minimum(np.maximum(self.weights, -1.0, out=self.weights), 4.0, out=self.weights)
        flat = gate * STEPS + cell
        hits, ones = np.bincount(flat, count, GATES * STEPS), np.bincount(flat, count * y, GATES * STEPS)
        hit = np.flatnonzero(hits)
        hits, refined = hits[hit], self.refined.reshape(-1)
        before = refined[hit]
        refined[hit] = before + (1 - (1 - REFINE_RATE) ** np.minimum(hits, 64)) * (ones[hit] / np.maximum(hits, 1e-9) - before)

    def log10(self, paths: list[np.ndarray], data: np.ndarray) -> np.ndarray:
        """log10 probability of every byte."""
        out = np.zeros(len(data))
        for bit in range(8):
            x, gate, y = self.inputs(paths, data, bit, False)
            p = np.clip(self.mixed(x, gate)[1], 1e-6, 1 - 1e-6)
            out += np.log10(np.where(y == 1, p, 1 - p))
        return out


class Counts:
    """Counts of all predictors for words that include all those with their first bytes."""

    def __init__(self, grams: Grams, n: np.ndarray, table: Paths):
        self.table = table
        kept = np.flatnonzero((n[grams.word] > 0) & ~grams.short)
        own = n[grams.word[kept]]
        self.deep = [Paths(grams.keys(k, kept), own) for k in range(ORDER + 1, PREDICTORS)]

    def of(self, grams: Grams, rows: np.ndarray | slice) -> list[np.ndarray]:
        """Per predictor the counts (bits, byte) of the chosen bytes."""
        short = grams.short[rows]
        windows, back = np.unique(grams.behind(rows) << np.uint64(8) | grams.data[rows], return_inverse=True)
        behind, data = windows >> np.uint64(8), windows & np.uint64(255)
        out = [self.table.of(last_keys(k, behind, data)).take(back, axis=1) for k in range(ORDER + 1)]
        for k, deep in enumerate(self.deep, ORDER + 1):
            keys = grams.keys(k, rows)
            found = np.empty((9, len(keys)), np.int64)
            found[:, short], found[:, ~short] = self.table.of(keys[short]), deep.of(keys[~short])
            out.append(found)
        return out


def kind_of(counts: Counter, frequent: dict[bytes, int]) -> int:
    """The frequent word that occurs most often in a text (ties: the more frequent one overall)."""
    best, most = KINDS, 0
    for word, number in frequent.items():
        n = counts.get(word, 0)
        if n > most:
            best, most = number, n
    return best


def _release() -> None:
    """Hand free memory back to the system, as processes stay for other tasks and would keep it beside theirs."""
    pa.default_memory_pool().release_unused()
    # Without it the C library keeps what arrays of many sizes have left.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts, one after the other, and their number in every text; none in a null text."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = cut.flatten().cast(pa.binary())
    kept = pc.greater(pc.binary_length(words), 0)  # the split leaves empty words at both ends of a text
    ends = np.append(0, np.cumsum(kept.to_numpy(zero_copy_only=False)))[np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(cut), 0)))]
    return words.filter(kept), np.diff(ends)


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Rows that follow each other, of about ``PIECE`` words in all, and the number of their letters."""
    sizes = np.cumsum(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    low = 0
    while low < batch.num_rows:
        before = sizes[low - 1] if low else 0
        high = min(int(np.searchsorted(sizes, before + min(6 * PIECE, CHUNK))) + 1, batch.num_rows)
        yield batch.slice(low, high - low), int(sizes[high - 1] - before)
        low = high


def _word_counts(keyed: DataFrame, most: int | None = None) -> DataFrame:
    """(word, c, cut) over the training texts; a null word has the number of all tokens.

    With ``most``, only so many words of a piece of texts are counted, the frequent ones; ``cut`` sums over the pieces how
    often a word may occur in them and not be counted (null word: in all pieces, others: in those that count the word).
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _ in _pieces(batch):
                words, lengths = cut_words(part.column("text"))
                words, n = pc.value_counts(words).flatten()
                counts, limit = n.to_numpy(), 0
                if most is not None and len(n) > most:
                    order = np.argsort(-counts)
                    limit, order = counts[order[most]], pa.array(order[:most])
                    words, n = words.take(order), n.take(order)
                rows = len(n) + 1
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([pa.nulls(1, pa.binary()), words]), pa.concat_arrays([pa.array([int(lengths.sum()) + len(lengths)]), n]),
                    pa.array(np.full(rows, limit, np.int64))], names=["word", "n", "cut"])
        batch = part = words = n = None
        _release()

    counted = keyed.where(~F.col("held_out")).select("text").mapInArrow(task, "word binary, n long, cut long")
    return counted.groupBy("word").agg(F.sum("n").alias("c"), F.sum("cut").alias("cut"))


def _frequent(keyed: DataFrame) -> tuple[list[bytes], int]:
    """The most frequent words of the training texts, ties in the order of bytes, and the number of all tokens.

    The frequent words of pieces tell which words may be among them. Those that some piece did not count are counted again,
    and all words are if there may be others.
    """
    for most in (MOST, None):
        first = (F.col("word").isNotNull(), F.desc(F.col("c") - F.col("cut")), "cut", "word")
        top = _word_counts(keyed, most).orderBy(*first).limit(2 * KINDS + 2).collect()
        whole = next((r for r in top if r.word is None), None)
        words = {bytes(r.word): (r.c, r.c + whole.cut - r.cut) for r in top if r.word is not None}
        # So often the last of the frequent words occurs at least; words that are not here occur less often.
        least = sorted((c for c, _ in words.values()), reverse=True)[KINDS - 1] if len(words) >= KINDS else 0
        if whole is None or whole.cut == 0 or all(high == low for low, high in list(words.values())[:KINDS]):
            counts = {word: c for word, (c, _) in words.items()}
        elif whole.cut < least and (len(top) < 2 * KINDS + 2 or min(high for _, high in words.values()) < least):
            counts = _counts_of(keyed, [word for word, (_, high) in words.items() if high >= least])
        else:
            continue
        return sorted(counts, key=lambda word: (-counts[word], word))[:KINDS], whole.c if whole else 0
    raise AssertionError("all words were counted")


def _counts_of(keyed: DataFrame, words: list[bytes]) -> dict[bytes, int]:
    """How often the given words occur in the training texts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, n = pa.array(words, pa.binary()), np.zeros(len(words), np.int64)
        for batch in batches:
            for part, _ in _pieces(batch):
                n += np.bincount(pc.index_in(cut_words(part.column("text"))[0], wanted).drop_null().to_numpy(), minlength=len(words))
        batch = part = None
        _release()
        yield pa.RecordBatch.from_arrays([wanted, pa.array(n)], names=["word", "n"])

    counted = keyed.where(~F.col("held_out")).select("text").mapInArrow(task, "word binary, n long")
    return {bytes(r.word): r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def ends_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The first bytes of words with their space, their number above them, and the last ones with the space ahead of a word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    start = np.cumsum(sizes + 1) - sizes
    size = np.minimum(sizes + 1, HEAD)
    # The end sign has no space behind it.
    first = np.where((sizes == 1) & (data[start] == _END[0]), 1, size)
    heads, tails = first.copy(), np.zeros(len(words), np.int64)
    for place in range(HEAD):
        heads = np.where(first > place, heads << 8 | data[np.minimum(start + place, len(data) - 1)], heads)
        far = HEAD - 1 - place
        tails = np.where(size > far, tails << 8 | data[np.maximum(start + sizes - 1 - far, 0)], tails)
    return heads + (first << 8 * HEAD) - (first << 8 * first), tails


def windows_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For the bytes of words behind their first ones, the space behind the word included: its word, the last bytes and it."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint64)
    start, rest = np.cumsum(sizes + 1) - sizes, np.maximum(sizes + 1 - HEAD, 0)
    row = np.repeat(np.arange(len(words)), rest)
    at = np.arange(len(row)) + (start + HEAD - np.cumsum(rest) + rest)[row]
    windows = np.zeros(max(0, len(data) - ORDER), np.uint64)
    for place in range(ORDER + 1):
        windows = windows << np.uint64(8) | data[place:place + len(windows)]
    return row, windows[at - ORDER]


def shared_beginnings(words: list[bytes], kinds: np.ndarray, m: np.ndarray, depths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys, and their numbers, in contexts of a word's beginning of the bytes behind its first ones that crowds share."""
    rows = np.flatnonzero(depths > HEAD)
    words, kinds, m = [words[row] for row in rows], kinds[rows].astype(np.uint64), m[rows]
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    data, starts, sizes = np.frombuffer(b" ".join([*words, b""]), np.uint8), np.cumsum(sizes) - sizes, np.minimum(sizes, depths[rows])
    prefix, keys, n = np.zeros(len(words), np.uint64), [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for place in range(sizes.max(initial=0)):
        row = np.flatnonzero(sizes > place)
        byte = data[starts[row] + place].astype(np.uint64)
        if place >= HEAD:
            keys += beginning_keys(prefix[row], byte), beginning_keys(prefix[row], byte, kinds[row])
            n += m[row], m[row]
        prefix[row] += (byte + np.uint64(1)) * _POWERS[place]
    return _folded(keys, n)


def _head_pairs(numbers: np.ndarray, starts: np.ndarray, kinds: np.ndarray, heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """For each word of texts one after the other: kind, end of the word before, first bytes; ``kinds`` has one per word."""
    before = np.zeros(len(numbers), np.int64)
    before[1:] = tails[numbers[:-1]]
    before[starts] = 0
    return kinds << 8 * HEAD + 2 + 8 * HEAD | before << 8 * HEAD + 2 | heads[numbers]


def _head_bytes(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of each of the first bytes, without what ``ORDER`` last bytes do not reach: as a pair, the byte its last."""
    rows, keys = zip(*(_head_bytes_at(pairs, place) for place in range(HEAD)))
    return np.concatenate(rows), np.concatenate(keys)


def _head_bytes_at(pairs: np.ndarray, place: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of one place."""
    size, full = pairs >> 8 * HEAD & 3, pairs & (1 << 8 * HEAD) - 1
    row = np.flatnonzero(size > place)
    far = pairs[row] >> 8 * HEAD + 2
    tail, kind = far & (1 << 8 * (HEAD - place)) - 1, far >> 8 * HEAD
    head = full[row] >> 8 * (size[row] - 1 - place)
    return row, kind << 8 * HEAD + 2 + 8 * HEAD | tail << 8 * HEAD + 2 | (place + 1) << 8 * HEAD | head


def _head_grams(keys: np.ndarray) -> tuple[Grams, np.ndarray]:
    """The bytes of keys, and which of them are the last ones."""
    sizes, shifts = keys >> 8 * HEAD & 3, 8 * np.arange(HEAD - 1, -1, -1)
    data = (keys[:, None] >> shifts & 255)[np.arange(HEAD - 1, -1, -1) < sizes[:, None]]
    grams = Grams.of_bytes(sizes, data, keys >> 2 * 8 * HEAD + 2, keys >> 8 * HEAD + 2 & (1 << 8 * HEAD) - 1)
    return grams, grams.starts + grams.sizes - 1


def _folded(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Keys, each once, and the sums of their numbers."""
    keys, n = np.concatenate(keys), np.concatenate(n).astype(np.int64)
    if not len(keys):
        return keys, n
    order = np.argsort(keys)
    keys = keys[order]
    start = np.flatnonzero(_new(keys))
    return keys[start], np.add.reduceat(n[order], start)


class _Sums:
    """Keys and the sums of their numbers, folded whenever as many have come as there are."""

    def __init__(self, kind: type):
        self.keys, self.n, self.held = [np.empty(0, kind)], [np.empty(0, np.int64)], 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.keys.append(keys)
        self.n.append(n)
        self.held += len(keys)
        if self.held > max(HELD, len(self.keys[0])):
            self.all()

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if self.held:
            (self.keys, self.n), self.held = ([x] for x in _folded(self.keys, self.n)), 0
        return self.keys[0], self.n[0]


_CUT = ("chunk long, kind short, number int, word binary, m long, head_key long, is_text boolean, doc_id long, held_out boolean, "
        "bytes long, numbers binary")
_CUT_ARROW = pa.schema([
    ("chunk", pa.int64()), ("kind", pa.int16()), ("number", pa.int32()), ("word", pa.binary()), ("m", pa.int64()),
    ("head_key", pa.int64()), ("is_text", pa.bool_()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("bytes", pa.int64()),
    ("numbers", pa.binary())])


def _cut_rows(n: int, **given) -> pa.RecordBatch:
    columns = [given.get(f.name) for f in _CUT_ARROW]
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, f.type) if c is None else c if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in zip(_CUT_ARROW, columns)],
        schema=_CUT_ARROW)


def _cut(keyed: DataFrame, frequent: list[bytes]) -> DataFrame:
    """Texts as numbers of words, and per chunk of texts that follow each other in a task three kinds of rows.

    Texts have ``is_text``; words of a kind have their number, ``m`` counting them in training rows; first bytes after the
    end of another word have ``head_key`` and ``m``, in training rows only. Texts of a kind and their words have a number of
    the chunk of their own, as they need no others' scores; words have the same number in all kinds of a chunk.
    """

    # The frequent words have the numbers of their kinds; numbers of kinds that no word has stay free.
    fixed = pa.array([frequent[k] if k < len(frequent) else b" %d" % k for k in range(KINDS)] + [_END], pa.binary()).dictionary_encode()

    def rows(chunk: int, texts: list[pa.Table], cut: list[tuple[pa.DictionaryArray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        numbers = pa.chunked_array([fixed, *(words for words, _ in cut)]).unify_dictionaries().chunks
        words, numbers, lengths_of = numbers[-1].dictionary, [n.indices.to_numpy() for n in numbers[1:]], [n for _, n in cut]
        cut.clear()
        heads, tails = (np.concatenate(ends).astype(np.int32) for ends in zip(*(
            ends_of(words.slice(low, GROUP).to_numpy(zero_copy_only=False).tolist()) for low in range(0, len(words), GROUP))))
        texts, low, of_words, of_heads = pa.concat_tables(texts), 0, _Sums(np.int64), _Sums(np.int64)
        width = pc.binary_length(words).to_numpy().astype(np.int64) + 1
        for number, lengths in zip(numbers, lengths_of):
            part, low = texts.slice(low, len(lengths)), low + len(lengths)
            held_out = part.column("held_out").to_numpy()
            text = np.repeat(np.arange(len(lengths)), lengths)
            often = np.flatnonzero(number < KINDS)
            often = np.bincount(text[often] * KINDS + number[often], minlength=len(lengths) * KINDS).reshape(-1, KINDS)
            kinds = np.where(often.any(axis=1), often.argmax(axis=1), KINDS)
            # Every text has its end sign behind its words.
            ends = np.cumsum(lengths)
            number = np.insert(number.astype(np.int64), ends, KINDS)
            ends += np.arange(1, len(ends) + 1)
            starts, of_word, trained = ends - lengths - 1, kinds.repeat(lengths + 1), (~held_out).repeat(lengths + 1)
            of_words.add(*_folded([of_word << 32 | number], [trained]))
            pairs = np.sort(_head_pairs(number, starts, of_word, heads, tails)[trained])
            start = np.flatnonzero(_new(pairs)) if len(pairs) else np.empty(0, np.int64)
            row, keys = _head_bytes(pairs[start])
            of_heads.add(*_folded([keys], [np.diff(start, append=len(pairs))[row]]))
            blobs = [np.ascontiguousarray(n.view(np.uint8).reshape(-1, 4).T).tobytes() for n in np.split(number.astype("<u4"), ends[:-1])]
            yield _cut_rows(
                len(lengths), chunk=chunk << 5 | kinds, kind=kinds, is_text=np.ones(len(lengths), bool),
                doc_id=part.column("doc_id").combine_chunks(), held_out=part.column("held_out").combine_chunks(),
                bytes=np.add.reduceat(width[number], starts) - 1, numbers=blobs)
        numbers = number = None
        for column, sums in (("word", of_words), ("head_key", of_heads)):
            found, m = sums.all()
            for low in range(0, len(found), ROWS):
                some, number = found[low:low + ROWS], found[low:low + ROWS] & 0xFFFFFFFF
                given = {column: some} if column != "word" else {
                    "word": words.take(pa.array(number)), "kind": some >> 32, "number": number, "chunk": chunk << 5 | some >> 32}
                yield _cut_rows(len(some), is_text=np.zeros(len(some), bool), m=m[low:low + ROWS], **given)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, size, texts, cut = TaskContext.get().partitionId() << 28, 0, [], []
        for batch in batches:
            for part, n in _pieces(batch):
                texts.append(pa.Table.from_batches([part.select(["doc_id", "held_out"])]))
                words, lengths = cut_words(part.column("text"))
                cut.append((words.dictionary_encode(), lengths))
                size += n
                if size > CHUNK:
                    yield from rows(chunk, texts, cut)
                    _release()
                    chunk, size, texts, cut = chunk + 1, 0, [], []
        batch = part = words = None
        _release()
        if cut:
            yield from rows(chunk, texts, cut)
        texts = cut = None
        _release()

    return keyed.select("doc_id", "held_out", "text").mapInArrow(task, _CUT)


def _table(words: DataFrame, heads: DataFrame) -> Paths:
    """Counts in all contexts but a word's beginning of three and more bytes. The number of contexts is bounded."""
    schema = "slot long, n long"

    def folded(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(np.uint64)
        for new in parts:
            sums.add(*new)
        found, total = sums.all()
        sums = new = None
        _release()
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(total)], names=["slot", "n"])

    def lasts(longest: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Contexts of last bytes of all orders, from the longest ones with their byte, each once."""
        longest, n = _folded([longest], [n])
        behind, data = longest >> np.uint64(8), longest & np.uint64(255)
        found, total = zip(*(_folded([last_keys(k, behind, data)], [n]) for k in range(ORDER + 1)))
        return np.concatenate(found), np.concatenate(total)

    def of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def beginnings(keys: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            grams, _ = _head_grams(keys)
            return _folded([grams.keys(k) for k in range(ORDER + 1, PREDICTORS)], [m[grams.word]] * 2)

        def parts():
            begin, longest, held = ([], []), ([], []), 0
            for batch in batches:
                words = batch.column("word").to_numpy(zero_copy_only=False).tolist()
                kinds, m = batch.column("kind").to_numpy().astype(np.int64), batch.column("m").to_numpy()
                yield shared_beginnings(words, kinds, m, batch.column("depth").to_numpy())
                row, windows = windows_of(words)
                for part, new in zip((*begin, *longest), (*_folded([kinds << 2 * 8 * HEAD + 2 | ends_of(words)[0]], [m]), windows, m[row])):
                    part.append(new)
                held += len(words) + len(windows)
                if held > PIECE:
                    yield lasts(*map(np.concatenate, longest))
                    yield beginnings(*_folded(*begin))
                    begin, longest, held = ([], []), ([], []), 0
            if held:
                yield lasts(*map(np.concatenate, longest))
                yield beginnings(*_folded(*begin))
        return folded(parts())

    def of_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                for at in range(0, batch.num_rows, GROUP):
                    part = batch.slice(at, GROUP)
                    grams, rows = _head_grams(part.column("head_key").to_numpy())
                    yield lasts(grams.behind(rows) << np.uint64(8) | grams.data[rows], part.column("m").to_numpy())
        return folded(parts())

    slots = words.where("m > 0").select("kind", "word", "m", "depth").mapInArrow(of_words, schema).unionByName(
        heads.select("head_key", "m").mapInArrow(of_heads, schema))
    summed = slots.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    return Paths(summed.column("slot").to_numpy().astype(np.int64).view(np.uint64), summed.column("n").to_numpy())


def _begins(depth: int) -> Column:
    """A number of the first bytes of a word."""
    return F.xxhash64(F.substring("word", 1, depth))


def _crowds(words: DataFrame) -> tuple[int, dict[int, list[int]]]:
    """The number of rows, and numbers of the first bytes that too many rows share, by how many bytes these are."""
    crowd = (F.col("n") > CROWD) | (F.col("bytes") > CROWD_BYTES)
    counts = F.count(F.lit(1)).alias("n"), F.sum(F.length("word")).alias("bytes")
    found: dict[int, list[int]] = {}
    whole = words.groupBy(F.substring("word", 1, HEAD).alias("word")).agg(*counts).agg(
        F.sum("n").alias("n"), F.collect_list(F.when((F.length("word") >= HEAD) & crowd, _begins(HEAD))).alias("crowds")).first()
    depth, crowds = HEAD, {HEAD: list(whole.crowds)}
    while crowds.get(depth) and depth < DEEPEST:
        found |= crowds
        low, high = depth + 1, min(depth + AHEAD, DEEPEST)
        longer = words.where((F.length("word") >= low) & _begins(depth).isin(crowds[depth])).groupBy(
            F.substring("word", 1, high).alias("word")).agg(*counts)
        sized = longer.select("n", "bytes", F.explode(F.sequence(F.lit(low), F.least(F.lit(high), F.length("word")))).alias("depth"), "word")
        summed = sized.groupBy("depth", F.substring("word", F.lit(1), F.col("depth")).alias("word")).agg(
            F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
        crowds, depth = {}, high
        for r in summed.where(crowd).select("depth", F.xxhash64("word").alias("begins")).collect():
            crowds.setdefault(r.depth, []).append(r.begins)
    return whole.n or 0, {depth: sorted(begins) for depth, begins in (found | crowds).items() if begins}


def _depth(crowds: dict[int, list[int]]) -> Column:
    """The number of first bytes that a word is dealt by."""
    out = F.lit(HEAD + len(crowds))
    for depth in sorted(crowds, reverse=True):
        out = F.when((F.length("word") >= depth) & _begins(depth).isin(crowds[depth]), out).otherwise(F.lit(depth))
    return out.cast("short")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of whole first bytes, from rows that come sorted by a number of these; ``GROUP`` or more at a time, or long words."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in _by_bytes(batches):
        if rows >= GROUP or size >= CROWD_BYTES:
            other = np.flatnonzero(batch.column("first").to_numpy() != held[-1].column("first")[-1].as_py())
            edge = int(other[0]) if len(other) else batch.num_rows
            if edge:
                held.append(batch.slice(0, edge))
            batch = batch.slice(edge)
            if batch.num_rows:
                group, held, rows, size = pa.Table.from_batches(held), [], 0, 0
                yield group
                del group
        if batch.num_rows:
            held.append(batch)
        rows += batch.num_rows
        size += pc.sum(pc.binary_length(batch.column("word"))).as_py() or 0
    if held:
        yield pa.Table.from_batches(held)


def _by_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with rows, cut where their words are long."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column("word")).to_numpy())
        edges = [0, *np.flatnonzero(np.diff(sizes // CROWD_BYTES)) + 1, batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            if low < high:
                yield batch.slice(low, high - low)


def _depths(group: pa.Table, unit: np.ndarray, n: int) -> np.ndarray:
    """How many first bytes the words of the units are dealt by."""
    depths = np.full(n, HEAD)
    depths[unit] = group.column("depth").to_numpy()
    return depths


def _units(table: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, kinds, m) of words of a kind in their order, and (its unit, the count of its word) of every row."""
    words, kinds, m = table.column("word").combine_chunks().dictionary_encode(), table.column("kind").to_numpy(), table.column("m").to_numpy()
    order = pc.array_sort_indices(words.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    number = place[words.indices.to_numpy()]
    counts = np.bincount(number, m).astype(np.int64)[number]
    units, unit = np.unique(number * (KINDS + 1) + kinds, return_inverse=True)
    number, kinds = np.divmod(units, KINDS + 1)
    found = words.dictionary.take(order.take(pa.array(number))).to_numpy(zero_copy_only=False).tolist()
    return found, kinds, np.bincount(unit, m).astype(np.int64), unit, counts


def _by_piece(counts: Counts, grams: Grams, at: np.ndarray) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Bytes, and their counts, in pieces of bounded size."""
    for low in range(0, len(at), ROWS):
        yield at[low:low + ROWS], counts.of(grams, at[low:low + ROWS])


def _scored(mixer: Mixer, counts: Counts, grams: Grams, rows: np.ndarray) -> np.ndarray:
    """The sum of log10 probabilities of the chosen bytes of every word."""
    at, back = grams.nodes(rows)
    found = [mixer.log10(paths, grams.data[piece]) for piece, paths in _by_piece(counts, grams, at)]
    return np.bincount(grams.word[rows], np.concatenate([*found, np.empty(0)])[back], len(grams.sizes))


def _dealt(words: DataFrame, tasks: int, *columns: str) -> DataFrame:
    """Words dealt by their first bytes and sorted by a number of these, which costs less than an order of words."""
    if "depth" not in words.columns:
        words = words.withColumn("depth", _depth({}))
    # Kind and depth travel as one number, as every column of a dealt row takes eight bytes.
    depth = F.shiftright("kind", 5)
    first = F.substring("word", F.lit(1), depth)
    both = (F.col("kind") + F.col("depth") * 32).cast("short")
    dealt = words.select(both.alias("kind"), "word", "m", *columns).repartition(tasks, first)
    return dealt.withColumns({"first": F.xxhash64(first), "depth": depth.cast("short"), "kind": F.col("kind").bitwiseAND(F.lit(31).cast("short"))}
                             ).sortWithinPartitions("first")


def _read(table: Paths | Broadcast) -> Paths:
    return table.value if isinstance(table, Broadcast) else table


def _learnt(words: DataFrame, heads: DataFrame, tasks: int, table: Paths | Broadcast) -> tuple[pa.Table, int]:
    """Sums of what the tasks' online steps over all training bytes lead to, and the number of distinct training words."""

    def learn(mixer: Mixer, sofar: list, counts: Counts, grams: Grams, rows: np.ndarray, m: np.ndarray) -> None:
        at, back = grams.nodes(rows)
        n = np.bincount(back, m[grams.word[rows]], len(at))
        order = np.argsort(mix(grams.after[at] + at.astype(np.uint64)))
        at, n, done = at[order], n[order], 0
        for piece, paths in _by_piece(counts, grams, at):
            for _ in mixer.steps(paths, grams.data[piece], n[done:done + len(piece)], STEP):
                sofar[0] += 1
                sofar[1] = sofar[1] + sofar[0] * np.concatenate([mixer.weights.ravel(), mixer.refined.ravel()])
            done += len(piece)
        sofar[2] += len(at)

    def result(sofar: list, later: bool) -> Iterator[pa.RecordBatch]:
        steps, total, rows = sofar
        if steps:
            values = np.append(total / (steps * (steps + 1) / 2) * rows, float(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(values), later)), pa.array(np.arange(len(values))), pa.array(values)], names=["later", "at", "value"])

    def by_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, sofar, types = Mixer(), [0, 0.0, 0], 0
        for group in _groups(batches):
            words, kinds, m, unit, _ = _units(group)
            grams, types = Grams(words, kinds, depths=_depths(group, unit, len(words))), types + len(set(words))
            learn(mixer, sofar, Counts(grams, m, _read(table)), grams, grams.later(), np.sqrt(m))
            group = words = unit = grams = None  # before the next one is there
        yield pa.RecordBatch.from_arrays([pa.array([True]), pa.array([-1]), pa.array([float(types)])], names=["later", "at", "value"])
        _release()
        yield from result(sofar, True)

    def by_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, sofar = Mixer(), [0, 0.0, 0]
        for batch in batches:
            m, (grams, rows) = batch.column("m").to_numpy(), _head_grams(batch.column("head_key").to_numpy())
            learn(mixer, sofar, Counts(grams, m, _read(table)), grams, rows, m)
        _release()
        yield from result(sofar, False)

    schema = "later boolean, at long, value double"
    values = _dealt(words.where("m > 0"), tasks).mapInArrow(by_words, schema).unionByName(
        heads.select("head_key", "m").mapInArrow(by_heads, schema)).groupBy("later", "at").agg(F.sum("value").alias("value")).orderBy("at").toArrow()
    types = values.filter(pc.less(values.column("at"), 0)).column("value").to_pylist()
    return values.filter(pc.greater_equal(values.column("at"), 0)), int(types[0]) if types else 0


def _adapted(learnt: pa.Table) -> tuple[tuple, tuple]:
    """Averages of weights and refinement over the tasks: for a word's first bytes and for later ones."""
    part, values = (learnt.column(c).to_numpy(zero_copy_only=False) for c in ("later", "value"))
    cut = GATES * PREDICTORS
    first, later = (v[:-1] / v[-1] if len(v) and v[-1] > 0 else None for v in (values[~part], values[part]))
    return tuple((None, None) if v is None else (v[:cut].reshape(-1, PREDICTORS), v[cut:].reshape(-1, STEPS)) for v in (first, later))


#: What a chunk gets of each of its words.
_SCORED = np.dtype([("number", "<i4"), ("kind", "u1"), ("c", "<i8"), ("head", "<i4"), ("tail", "<i4"), ("score", "<f8")])


def _packed(rows: np.ndarray) -> bytes:
    """Rows as bytes, those of one place together, which compress better."""
    return rows.view(np.uint8).reshape(len(rows), -1).T.tobytes()


def _unpacked(blob: pa.Buffer) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(_SCORED.itemsize, -1).T).view(_SCORED).ravel()


def _word_scores(words: DataFrame, tasks: int, table: Paths | Broadcast, model: tuple) -> DataFrame:
    """Per chunk, for many of its words at a time: score of the word's later bytes, its count, and its ends."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, held = Mixer(*model[1]), []

        def out() -> pa.RecordBatch:
            chunk, rows = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.argsort(chunk, kind="stable")
            chunk, rows = chunk[order], rows[order]
            start = np.flatnonzero(_new(chunk))
            packed = [_packed(rows[low:high]) for low, high in zip(start, [*start[1:], len(rows)])]
            return pa.RecordBatch.from_arrays([pa.array(chunk[start]), pa.array(packed, pa.binary())], names=["chunk", "rows"])

        for group in _groups(batches):
            words, kinds, m, unit, c = _units(group)
            grams, rows = Grams(words, kinds, depths=_depths(group, unit, len(words))), np.empty(group.num_rows, _SCORED)
            rows["score"] = _scored(mixer, Counts(grams, m, _read(table)), grams, grams.later())[unit]
            rows["head"], rows["tail"] = (ends[unit] for ends in ends_of(words))
            rows["number"], rows["kind"], rows["c"] = group.column("number").to_numpy(), group.column("kind").to_numpy(), c
            held.append((group.column("chunk").to_numpy(), rows))
            group = words = unit = c = grams = rows = None  # before the next one is there
            if sum(len(x) for _, x in held) >= HELD:
                yield out()
        if held:
            yield out()
        _release()

    return _dealt(words, tasks, "chunk", "number").mapInArrow(task, "chunk long, rows binary")


def _text_scores(texts: DataFrame, known: DataFrame, table: Paths | Broadcast, model: tuple, cost: dict[int, float]) -> DataFrame:
    """Sums over the words of every text, where the texts of a chunk, all of one kind, and the scores of its words meet."""
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, bytes long"

    def task(texts: pa.Table, found: pa.Table) -> pa.Table:
        out = scored(texts, found)
        _release()
        return out

    def scored(texts: pa.Table, found: pa.Table) -> pa.Table:
        blobs = [b.as_buffer() for b in found.column("rows")]
        rows, low = np.empty(sum(map(len, blobs)) // _SCORED.itemsize, _SCORED), 0
        for blob in blobs:
            high = low + len(blob) // _SCORED.itemsize
            rows[low:high], low = _unpacked(blob), high
        number = rows["number"]
        log, score, (heads, tails) = *np.zeros((2, number.max() + 1)), np.zeros((2, number.max() + 1), np.int32)
        log[number], score[number], heads[number], tails[number] = np.log10(rows["c"] + 1.0), rows["score"], rows["head"], rows["tail"]
        del blobs, rows, number
        planes = [np.frombuffer(b.as_buffer(), np.uint8).reshape(4, -1) for b in texts.column("numbers")]
        lengths, of_text = np.array([p.shape[1] for p in planes]), texts.column("kind").to_numpy().astype(np.int64)
        ends = np.append(np.flatnonzero(np.diff(np.cumsum(lengths) // PIECE)) + 1, len(planes))
        sums, seen = [], []
        for low, high in zip(np.append(0, ends[:-1]), ends):
            if low == high:
                continue
            starts = np.cumsum(lengths[low:high]) - lengths[low:high]
            numbers = np.concatenate([np.ascontiguousarray(p.T).view("<u4").ravel() for p in planes[low:high]]).astype(np.int64)
            kinds = np.repeat(of_text[low:high], lengths[low:high])
            pairs, back = np.unique(_head_pairs(numbers, starts, kinds, heads, tails), return_inverse=True)
            seen.append((pairs, back.astype(np.int32), starts))
            logs = log[numbers]
            sums.append([np.add.reduceat(x, starts) for x in ((logs > 0).astype(np.int64), logs, score[numbers])])
        every = np.sort(np.concatenate([pairs for pairs, _, _ in seen]))
        every = every[_new(every)]
        of_pair, mixer = np.zeros(len(every)), Mixer(*model[0])
        for place in range(HEAD):
            row, key = _head_bytes_at(every, place)
            keys, of_key = np.unique(key, return_inverse=True)
            first = np.empty(len(keys))
            for low in range(0, len(keys), GROUP):
                grams, rows = _head_grams(keys[low:low + GROUP])
                first[low:low + GROUP] = _scored(mixer, Counts(grams, np.zeros(len(grams.sizes)), _read(table)), grams, rows)
            of_pair[row] += first[of_key]
        begin = [np.add.reduceat(of_pair[np.searchsorted(every, pairs)][back], starts) for pairs, back, starts in seen]
        n_known, logs, later = (np.concatenate(x) for x in zip(*sums))
        total = later + np.concatenate(begin) + np.array([cost[k] for k in range(KINDS + 1)])[of_text]
        return pa.table([
            texts.column("doc_id"), texts.column("held_out"), pa.array(lengths, pa.int64()), pa.array(n_known), pa.array(logs),
            pa.array(total), texts.column("bytes")], names=[c.split()[0] for c in schema.split(", ")])

    return texts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(task, schema)


def scores(docs: DataFrame) -> DataFrame:
    """Query form: one row per document with fold, token counts, baseline score, model score and bits per byte."""
    stored = Stored(docs.sparkSession, "scoring")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(
        "doc_id", "text", is_held_out(FOLDS, FOLD).alias("held_out"))
    frequent, tokens = _frequent(keyed)

    parts = stored.keep(_cut(keyed, frequent), "cut")
    texts = parts.where("is_text").select("chunk", "kind", "doc_id", "held_out", "bytes", "numbers")
    words = parts.where("number is not null").select("chunk", "kind", "number", "word", "m")
    heads = stored.keep(
        parts.where("head_key is not null").groupBy("head_key").agg(F.sum("m").alias("m")), "heads")
    shares = {r.kind: r.n for r in texts.where(~F.col("held_out")).groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    whole = sum(shares.values())
    cost = {k: float(np.log10((shares.get(k, 0) + 1) / (whole + KINDS + 1))) for k in range(KINDS + 1)}
    rows, crowds = _crowds(words)
    words, tasks = words.withColumn("depth", _depth(crowds)), -(-rows // SHARE) or 1
    table = docs.sparkSession.sparkContext.broadcast(_table(words, heads))
    _release()
    learnt, types = _learnt(words, heads, tasks, table)
    model = _adapted(learnt)
    found = _text_scores(texts, _word_scores(words, tasks, table, model), table, model, cost)
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * float(np.log10(tokens + types + 1))).alias("base_score"), "score",
        (-F.col("score") * float(np.log2(10)) / F.col("bytes")).alias("bits_per_byte"))
