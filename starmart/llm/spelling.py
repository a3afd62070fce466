"""Spelling variants: words one edit apart, found by composing finite-state machines, and the form that each points to.

The words are counted over all texts. Near words come from the composition of the minimal acceptor of the vocabulary with
a transducer that makes exactly one edit (one symbol inserted, deleted or replaced) and the acceptor again. Two words of
which the shorter has m code points share their first or their last floor(m / 2) ones, so the initial state of the
composed machine is entered through such a half: a word is an arc path behind the halves (side, m, symbols) it can enter
by, read forwards or backwards. Initial states are dealt over tasks; a task builds the minimal acceptor of the words
behind its initial states and enumerates the accepted pairs of each state. As long as no edit is made, both acceptors
are in the same state; after the edit only the words common to the two states are followed, remembered per pair of states.

Words are folded in the map tasks before they are shuffled, so hot words cost one row a task. A form has at least twice
the occurrences of its word, so chains are short, and the roots follow by doubling of the step between written tables.

Defined cases: null and empty texts have no words; a null id deletes nothing, as it has no crc; rows that repeat count
each time; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmart.llm.tables import Stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: A run whose crc this divides loses one code point.
DIVISOR = 97
#: Smallest length and number of occurrences of a word.
LENGTH, OCCURRENCES = 5, 3
#: Distinct words that a task holds before it passes them on, and words whose initial states share a task's group.
HELD, GROUP = 200_000, 4000


def words_of(doc_id: int | None, text: str | None, divisor: int = DIVISOR) -> Counter:
    """Words of one text with their counts, after the deletions."""
    found = Counter(RUN.findall((text or "").translate(_LOWER)))
    if doc_id is None:
        return found
    head = crc32(f"{doc_id}:".encode())
    words: Counter = Counter()
    for run, n in found.items():
        h = crc32(run.encode(), head)
        at = h % len(run)
        words[run if h % divisor else run[:at] + run[at + 1:]] += n
    return words


def vocabulary(docs: DataFrame, length: int = LENGTH, occurrences: int = OCCURRENCES, divisor: int = DIVISOR) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                for word, n in words_of(doc_id, text.as_py(), divisor).items():
                    if len(word) >= length:
                        held[word] += n
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    counted = docs.select("doc_id", "text").mapInArrow(task, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


class Acceptor:
    """Minimal acyclic acceptor of sorted distinct words: arcs[state] maps a symbol to a state; state 0 is the end."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [True]
        self._known: dict[tuple, int] = {(True, ()): 0}
        path: list[tuple[dict[str, int], bool]] = [({}, False)]
        last = ""
        for word in words:
            k = 0
            while k < min(len(word), len(last)) and word[k] == last[k]:
                k += 1
            self._close(path, last, k)
            for _ in word[k:]:
                path.append(({}, False))
            path[-1] = (path[-1][0], True)
            last = word
        self._close(path, last, 0)
        self.start = self._state(*path[0])

    def _close(self, path: list, word: str, keep: int) -> None:
        while len(path) - 1 > keep:
            state = self._state(*path.pop())
            path[-1][0][word[len(path) - 1]] = state

    def _state(self, arcs: dict[str, int], final: bool) -> int:
        key = (final, tuple(arcs.items()))
        found = self._known.get(key)
        if found is None:
            found = self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return found


class OneEdit:
    """Composition of an acceptor with the one-edit transducer and the acceptor again."""

    def __init__(self, acceptor: Acceptor):
        self.arcs, self.final = acceptor.arcs, acceptor.final
        self._common: dict[tuple[int, int], list[str]] = {}

    def common(self, p: int, q: int) -> list[str]:
        """Symbols that lead from both states to an end: the words accepted after the edit."""
        key = (p, q) if p < q else (q, p)
        found = self._common.get(key)
        if found is None:
            found = [""] if self.final[p] and self.final[q] else []
            a, b = (self.arcs[p], self.arcs[q]) if len(self.arcs[p]) <= len(self.arcs[q]) else (self.arcs[q], self.arcs[p])
            for symbol, state in a.items():
                other = b.get(symbol)
                if other is not None:
                    found.extend(symbol + rest for rest in self.common(state, other))
            self._common[key] = found
        return found

    def pairs(self, state: int) -> set[tuple[str, str]]:
        """All pairs one edit apart among the words behind a state, the smaller word first."""
        found: set[tuple[str, str]] = set()
        open_ones = [("", state)]
        while open_ones:
            path, s = open_ones.pop()
            arcs = list(self.arcs[s].items())
            for k, (symbol, to) in enumerate(arcs):
                open_ones.append((path + symbol, to))
                for other, beside in arcs[k + 1:]:  # replaced
                    for rest in self.common(to, beside):
                        found.add((path + symbol + rest, path + other + rest))
                for rest in self.common(to, s):  # deleted on one side, inserted on the other
                    found.add((path + symbol + rest, path + rest))
        return {(min(p), max(p)) for p in found}


def entries(words: DataFrame) -> DataFrame:
    """(side, m, half, rest) of every initial state that a word can enter by; m is the length of the shorter word."""
    sides = words.select("word", F.explode(F.array(F.lit(0), F.lit(1))).alias("side")).select(
        "side", F.expr("if(side = 0, word, reverse(word))").alias("read"))
    lengths = sides.select("side", "read", F.explode(F.expr("array(char_length(read) - 1, char_length(read))")).alias("m"))
    half = F.expr("cast(m div 2 as int)")
    return lengths.withColumn("half", F.substr("read", F.lit(1), half)).select(
        "side", "m", "half", F.expr("substr(read, cast(m div 2 as int) + 1)").alias("rest"))


def near_pairs(words: DataFrame, groups: int) -> DataFrame:
    """(a, b) of all words one edit apart, a < b."""
    state = ["side", "m", "half"]
    entered = entries(words.select("word")).withColumn("part", F.pmod(F.xxhash64(*state), F.lit(groups)).cast("int"))

    def task(table: pa.Table) -> pa.Table:
        behind: dict[tuple, list[str]] = {}
        for row in zip(*(table.column(c).to_pylist() for c in (*state, "rest"))):
            behind.setdefault(row[:3], []).append(row[3])
        left, right = [], []
        for (side, _, half), rests in behind.items():
            if len(rests) < 2:
                continue
            acceptor = Acceptor(sorted(rests))
            for a, b in OneEdit(acceptor).pairs(acceptor.start):
                a, b = half + a, half + b
                if side:
                    a, b = a[::-1], b[::-1]
                left.append(min(a, b))
                right.append(max(a, b))
        return pa.table({"a": pa.array(left, pa.string()), "b": pa.array(right, pa.string())})

    found = entered.groupBy("part").applyInArrow(task, "a string, b string")
    return found.distinct()


def variants(docs: DataFrame, length: int = LENGTH, occurrences: int = OCCURRENCES, divisor: int = DIVISOR) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    stored = Stored(docs.sparkSession, "spelling")
    words = stored.keep(vocabulary(docs, length, occurrences, divisor), "words")
    pairs = stored.keep(near_pairs(words, 1 + words.count() // GROUP), "pairs")
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    best = both.join(words.withColumnRenamed("word", "b"), "b").groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("b").alias("form"))).alias("best"))
    joined = words.join(best.withColumnRenamed("a", "word"), "word", "left")
    is_form = F.coalesce(-F.col("best.less") >= 2 * F.col("n"), F.lit(False))
    formed = stored.keep(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "formed")
    # Words without a form are roots; the others step to their form, and each round doubles the step.
    steps = stored.keep(formed.where("form is not null").select("word", F.col("form").alias("root")), "steps")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stored.keep(steps.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "steps")
        stored.drop(steps)
        steps = further
        if not further.where("moved").limit(1).count():
            break
    stored.drop(words, pairs)
    return formed.join(steps.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
