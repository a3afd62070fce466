"""The language model against plain counts and sums, and as a distribution over bytes."""

from __future__ import annotations

import math
import pickle
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmart.llm import scoring
from conftest_llm import prose, table


def plain_contexts(word: bytes, kind: int):
    """For every byte of a word and its space the contexts of all predictors."""
    body = word if word == b"\n" else word + b" "
    for at, byte in enumerate(body):
        seen = (b" " + body)[:at + 1]
        yield byte, [("last", k, (bytes(8) + seen)[-k:] if k else b"") for k in range(scoring.ORDER + 1)] + [("word", body[:at]), ("kind", body[:at], kind)]


def plain_log10(words: list[tuple[bytes, int]], counts: Counter, mixer: scoring.Mixer) -> list[float]:
    """Scores of words of a kind, bit by bit, from counts kept in a plain dictionary."""
    seen = Counter()
    for (word, kind), n in counts.items():
        for byte, contexts in plain_contexts(word, kind):
            for context in contexts:
                for bits in range(9):
                    seen[context, bits, byte >> 8 - bits] += n
    out = []
    for word, kind in words:
        total = 0.0
        for byte, contexts in plain_contexts(word, kind):
            for bit in range(8):
                y, x, depth, known = byte >> 7 - bit & 1, [], 0, 0
                for k, context in enumerate(contexts):
                    n0, n1 = (seen[context, bit + 1, byte >> 8 - bit << 1 | v] for v in (0, 1))
                    x.append(math.log((n1 + scoring.PRIOR) / (n0 + scoring.PRIOR)))
                    if n0 + n1:
                        depth, known = k, n0 + n1
                gate = depth * (len(scoring.LEVELS) + 1) + sum(known >= level for level in scoring.LEVELS)
                z = max(-12.0, min(12.0, sum(w * v for w, v in zip(mixer.weights[gate], x))))
                cell = min(scoring.STEPS - 1, max(0, round((z + 8) * (scoring.STEPS - 1) / 16)))
                p = (1 / (1 + math.exp(-z)) + mixer.refined[gate, cell]) / 2
                p = min(1 - 1e-6, max(1e-6, p))
                total += math.log10(p if y else 1 - p)
        out.append(total)
    return out


def some_words(seed: int, n: int):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 7))).encode() for _ in range(n)] + [b"\n", b"x" * 700, bytes(range(128, 140))]
    return [(w, rng.randrange(3)) for w in words], [rng.choice([0, 1, 1, 2, 9]) for _ in words]


def some_mixer(seed: int) -> scoring.Mixer:
    rng = np.random.default_rng(seed)
    mixer = scoring.Mixer(rng.normal(0.3, 0.2, (scoring.GATES, scoring.PREDICTORS)))
    mixer.refined = np.clip(mixer.refined + rng.normal(0, 0.05, mixer.refined.shape), 0.01, 0.99)
    return mixer


def full_table(grams: scoring.Grams, m: np.ndarray) -> scoring.Paths:
    n, short = m[grams.word], np.flatnonzero(grams.short)
    low, deep = range(scoring.ORDER + 1), range(scoring.ORDER + 1, scoring.PREDICTORS)
    keys = np.concatenate([*(grams.keys(k) for k in low), *(grams.keys(k, short) for k in deep)])
    return scoring.Paths(keys, np.concatenate([*[n] * len(low), *[n[short]] * len(deep)]))


def test_scores_of_words_equal_plain_counts(monkeypatch):
    """Contexts of three and four bytes are told apart here, as hardly any of so few share a place."""
    monkeypatch.setattr(scoring, "PLACES", 31)
    pairs, n = some_words(1, 60)
    merged = Counter()
    for pair, k in zip(pairs, n):
        merged[pair] += k
    units = sorted(merged, key=lambda u: (u[0][:3], u[0], u[1]))
    grams = scoring.Grams([w for w, _ in units], np.array([k for _, k in units]))
    m = np.array([merged[u] for u in units])
    table = full_table(grams, m)
    mixer = some_mixer(2)
    paths = scoring.Counts(grams, m, table).of(grams, slice(None))
    found = np.add.reduceat(mixer.log10(paths, grams.data), grams.starts)
    assert found == pytest.approx(plain_log10(units, Counter(merged), mixer))


def test_bytes_of_a_context_have_probabilities_that_sum_to_one():
    pairs, n = some_words(3, 80)
    train = scoring.Grams([w for w, _ in pairs], np.array([k for _, k in pairs]))
    m = np.array(n)
    table = full_table(train, m)
    counts = scoring.Counts(train, m, table)
    for start in (b"", b"a", b"ab", b"ab" + "é".encode(), b"never"):
        # As the last byte of a word stands before a space, the byte asked for is the second last of the grams.
        words = [start + bytes([b]) for b in range(256)]
        grams = scoring.Grams(words, np.ones(256, int))
        at = grams.starts + len(start)
        p = 10 ** some_mixer(4).log10(counts.of(grams, at), grams.data[at])
        assert p.sum() == pytest.approx(1.0, abs=2e-3)  # but for the limits of single bits


def test_refinement_follows_the_given_weights():
    """Two bytes that differ in their last bit only: the refined probability of one follows their weights."""
    mixer = scoring.Mixer()
    paths = [np.full((9, 2), 10**6)] * scoring.PREDICTORS
    data, count = np.array([0x60, 0x61], np.uint64), np.array([6400.0, 64.0])
    for k in range(9):
        paths[0][k] = 10**6 // 2 ** (k // 8)
    for _ in range(600):
        mixer.learn(paths, data, count)
    _, gate, _ = mixer.inputs(paths, data, 7, held_back=True)
    _, _, cell = mixer.mixed(*mixer.inputs(paths, data, 7, True)[:2])
    assert mixer.refined[gate, cell] == pytest.approx([64 / 6464] * 2, abs=5e-3)


def test_text_scores_are_sums_over_their_words(spark):
    """Same texts have the same score, the score of a text is that of its words and its kind, and copies are learnt from."""
    docs = [(i, prose(i % 25, 50, "abcdef")) for i in range(100)] + [(200, None), (201, ""), (202, "z" * 3000), (None, "no id"), (4, prose(4, 50, "abcdef"))]
    rows = scoring.scores(table(spark, docs).withColumn("word", F.lit(1)).repartition(4)).collect()
    assert len(rows) == len(docs)
    by_text = {}
    for r in rows:
        by_text.setdefault(dict(docs)[r.doc_id], set()).add(round(r.score, 6))
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    assert all(len(v) == 1 for t, v in by_text.items() if t)
    assert by_text[""] == by_text[None]
    noise = -3000 * math.log10(256)
    assert next(iter(by_text["z" * 3000])) > noise
    seen = [r for r in rows if r.doc_id is not None and r.doc_id < 100]
    assert sum(r.score for r in seen) > sum(r.base_score for r in seen) * 1.05


def test_kind_is_the_most_frequent_of_the_frequent_words():
    frequent = {b"the": 0, b"der": 1}
    assert scoring.kind_of(Counter(b"a a a der".split()), frequent) == 1
    assert scoring.kind_of(Counter(b"der the".split()), frequent) == 0
    assert scoring.kind_of(Counter(), frequent) == scoring.KINDS


def running_contexts(words: list[bytes], kind: int):
    """As ``plain_contexts``, but last bytes are those of the text: the end of the word before stands ahead of the space."""
    for before, word in zip([b"", *words], words):
        body = word if word == b"\n" else word + b" "
        ahead = bytes(8) + (b" " + before)[-3:] if before else bytes(8)
        for (byte, own), at in zip(plain_contexts(word, kind), range(len(body))):
            seen = ahead + b" " + body[:at]
            yield byte, at >= scoring.HEAD, [("last", k, seen[-k:] if k else b"") for k in range(scoring.ORDER + 1)] + own[scoring.ORDER + 1:]


def test_text_scores_equal_plain_counts_over_the_running_text(spark, monkeypatch):
    """Every byte of a text counts and is judged with the bytes ahead of it, the word before included."""
    rng, mixers = random.Random(5), (some_mixer(6), some_mixer(7))
    monkeypatch.setattr(scoring, "PLACES", 31)
    monkeypatch.setattr(scoring, "CHUNK", 500)
    monkeypatch.setattr(scoring, "_adapted", lambda *args: tuple((m.weights, m.refined) for m in mixers))
    few = ["a", "é", "ab", "abc", "abcd", "babab", "cé", "x" * 40]
    docs = [(i, " ".join(rng.choice(few) for _ in range(rng.randint(0, 30)))) for i in range(40)] + [(50, "ab never"), (51, "never ab"), (52, None)]
    rows = {r.doc_id: r for r in scoring.scores(table(spark, docs).repartition(3)).collect()}
    held_out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    cut = {i: [*(t or "").encode().split(), b"\n"] for i, t in docs}
    total = Counter(w for i, words in cut.items() if not held_out[i] for w in words)
    frequent = sorted((w for w in total if w != b"\n"), key=lambda w: (-total[w], w))[:scoring.KINDS]
    kinds = {i: scoring.kind_of(Counter(words), {w: k for k, w in enumerate(frequent)}) for i, words in cut.items()}
    seen = Counter()
    for i, words in cut.items():
        for byte, _, contexts in running_contexts(words, kinds[i]) if not held_out[i] else ():
            seen.update((c, bits, byte >> 8 - bits) for c in contexts for bits in range(9))
    shares = Counter(kinds[i] for i in cut if not held_out[i])
    for i, words in cut.items():
        score = math.log10((shares[kinds[i]] + 1) / (sum(shares.values()) + scoring.KINDS + 1))
        for byte, later, contexts in running_contexts(words, kinds[i]):
            mixer = mixers[later]
            for bit in range(8):
                y, x, depth, known = byte >> 7 - bit & 1, [], 0, 0
                for k, context in enumerate(contexts):
                    n0, n1 = (seen[context, bit + 1, byte >> 8 - bit << 1 | v] for v in (0, 1))
                    x.append(math.log((n1 + scoring.PRIOR) / (n0 + scoring.PRIOR)))
                    if n0 + n1:
                        depth, known = k, n0 + n1
                gate = depth * (len(scoring.LEVELS) + 1) + sum(known >= level for level in scoring.LEVELS)
                z = max(-12.0, min(12.0, sum(w * v for w, v in zip(mixer.weights[gate], x))))
                cell = min(scoring.STEPS - 1, max(0, round((z + 8) * (scoring.STEPS - 1) / 16)))
                p = min(1 - 1e-6, max(1e-6, (1 / (1 + math.exp(-z)) + mixer.refined[gate, cell]) / 2))
                score += math.log10(p if y else 1 - p)
        assert rows[i].score == pytest.approx(score)
        base = sum(math.log10((total[w] + 1) / (sum(total.values()) + len(total) + 1)) for w in words)
        assert rows[i].base_score == pytest.approx(base) and rows[i].n_tokens == len(words)
        assert rows[i].n_known == sum(total[w] > 0 for w in words)


def test_steps_prepared_together_equal_steps_one_by_one():
    rng, together, single = np.random.default_rng(8), some_mixer(9), some_mixer(9)
    paths = [np.sort(rng.integers(0, 50, (9, 300)), axis=0)[::-1] for _ in range(scoring.PREDICTORS)]
    data, count = rng.integers(0, 256, 300).astype(np.uint64), rng.integers(1, 9, 300).astype(float)
    assert sum(1 for _ in together.steps(paths, data, count, 64)) == 5
    for low in range(0, 300, 64):
        single.learn([p[:, low:low + 64] for p in paths], data[low:low + 64], count[low:low + 64])
    assert together.weights == pytest.approx(single.weights) and together.refined == pytest.approx(single.refined)


def test_ends_of_words():
    heads, tails = scoring.ends_of([b"\n", b"a", b"ab", b"abcd", b"\x00"])
    first = [b"\n", b"a ", b"ab ", b"abc", b"\x00 "]
    assert heads.tolist() == [len(f) << 24 | int.from_bytes(f, "big") for f in first]
    assert tails.tolist() == [int.from_bytes(x, "big") for x in (b" \n", b" a", b" ab", b"bcd", b" \x00")]


def test_scores_of_words_come_packed_by_chunk(spark):
    """A row holds all words that a task has for a chunk, not one; every word of a kind comes once, whatever its bytes are."""
    words = [(c, k, n, f"{'éab'[n % 3]}{n}".encode(), 1) for c in (0, 7 << 32) for k in (1, 16) for n in range(300)]
    frame = spark.createDataFrame(words, "chunk long, kind short, number int, word binary, m long").repartition(5)
    rows = scoring._word_scores(frame, 2, scoring.Paths(np.empty(0, np.uint64), np.empty(0)), ((None, None),) * 2).collect()
    assert len(rows) <= 4
    found = [(r.chunk, x) for r in rows for x in scoring._unpacked(pa.py_buffer(r.rows))]
    assert sorted((c, x["kind"], x["number"]) for c, x in found) == sorted(w[:3] for w in words)
    heads, tails = scoring.ends_of([w[3] for w in words[:300]])
    assert all(x["c"] == 4 and x["head"] == heads[x["number"]] and x["tail"] == tails[x["number"]] for _, x in found)


def test_words_of_texts():
    texts = [" the  The\tdog\x0b\x1cé\x85 ÉA\n", None, "", " \r\n", "end", "x\x00y\x0cz"]
    words, lengths = scoring.cut_words(pa.array(["skipped", *texts]).slice(1))
    cut = [(t or "").encode().lower().split() for t in texts]
    assert words.to_pylist() == [w for one in cut for w in one] and lengths.tolist() == list(map(len, cut))


def test_windows_of_words_are_their_longest_contexts():
    words = [w for w, _ in some_words(9, 40)[0]]
    grams = scoring.Grams(words, np.zeros(len(words), int))
    rows = np.flatnonzero(~grams.short)
    word, windows = scoring.windows_of(words)
    assert word.tolist() == grams.word[rows].tolist()
    assert windows.tolist() == (grams.behind(rows) << np.uint64(8) | grams.data[rows]).tolist()


def test_frequent_words_pass_on_few_words_and_are_exact(spark, monkeypatch):
    """A frequent word that some piece left out is found all the same, as are ties; a piece passes on the words asked for only."""
    monkeypatch.setattr(scoring, "KINDS", 2)
    monkeypatch.setattr(scoring, "MOST", 2)
    monkeypatch.setattr(scoring, "CHUNK", 1)  # every text is a piece
    for texts in (["a a a b b c"] * 5, ["a a b b c"] * 3 + ["d d d d d d d"], ["a a c c b"] * 2 + ["b b b a a"], ["b a"], [None, ""], []):
        docs = [(7 * i, t, False) for i, t in enumerate(texts)] + [(1000, "held out " * 50, True)]
        keyed = spark.createDataFrame(docs, "doc_id long, text string, held_out boolean").coalesce(1)
        counts = Counter(w for t in texts for w in (t or "").encode().split())
        found = scoring._frequent(keyed)
        assert found == (sorted(counts, key=lambda w: (-counts[w], w))[:2], sum(counts.values()) + len(texts))
        passed = {r.word: (r.c, r.cut) for r in scoring._word_counts(keyed, 2).collect()}
        assert sum(c for w, (c, _) in passed.items() if w is not None) <= sum(
            sum(n for _, n in Counter((t or "").split()).most_common(2)) for t in texts)
        for word, n in counts.items():
            c, cut = passed.get(word, (0, 0))
            assert c <= n <= c + passed[None][1] - cut


def test_words_of_a_kind_from_rows_in_any_order():
    rows = [(b"abd", 2, 3), (b"abc", 16, 0), (b"abd", 0, 1), (b"abc", 16, 5), (b"abd", 2, 4), (b"\n", 1, 2)]
    table = pa.table({"word": pa.array([w for w, _, _ in rows], pa.binary()), "kind": pa.array([k for _, k, _ in rows], pa.int16()), "m": [m for _, _, m in rows]})
    words, kinds, m, unit, counts = scoring._units(table)
    assert list(zip(words, kinds.tolist(), m.tolist())) == [(b"\n", 1, 2), (b"abc", 16, 5), (b"abd", 0, 1), (b"abd", 2, 7)]
    assert unit.tolist() == [3, 1, 2, 1, 3, 0] and counts.tolist() == [8, 5, 8, 5, 8, 2]


def test_paths_equal_plain_counts_and_stay_small():
    """A key takes few bytes, as every worker holds the table of them all; counts beyond 32 bits are told."""
    rng = np.random.default_rng(10)
    for most in (9, 2**40):
        keys = rng.integers(0, 60, 9000).astype(np.uint64) << np.uint64(8) | rng.integers(0, 256, 9000).astype(np.uint64)
        keys, n = np.append(keys, np.uint64(2**63)), rng.integers(0, most, 9001)
        paths = pickle.loads(pickle.dumps(scoring.Paths(keys, n)))
        asked = np.append(rng.integers(0, 64, 500) << 8 | rng.integers(0, 256, 500), 7 << 8).astype(np.uint64)
        found = paths.of(asked)
        for bits in range(9):
            shift = np.uint64(8 - bits)
            assert found[bits].tolist() == [int(n[keys >> shift == key >> shift].sum()) for key in asked]
        assert paths.keys.nbytes + paths.ahead.nbytes + paths.spans.nbytes <= (28 + 4 * (most > 9)) * len(paths.keys) + 8


def crowded_words():
    """Many words with the same first bytes, one of them in many chunks."""
    rng = random.Random(11)
    words = [("und" + "".join(rng.choice("abé") for _ in range(rng.randint(0, 6)))).encode() for _ in range(300)] + [b"und", b"andere", b"\n", b"u"]
    return [(c, rng.choice([1, 16]), n, w, rng.randint(0, 2)) for n, w in enumerate(words) for c in range(2)] + [(c, 1, 300, b"und", 1) for c in range(2, 40)]


def test_crowds_of_words_are_dealt_by_more_bytes(spark, monkeypatch):
    """A task needs no more words at a time than those that share as many bytes as leave few; what one word has stays together."""
    monkeypatch.setattr(scoring, "CROWD", 25)
    rows = crowded_words()
    frame = spark.createDataFrame(rows, "chunk long, kind short, number int, word binary, m long").repartition(5)
    n, crowds = scoring._crowds(frame)
    beginnings = Counter(w[:k] for *_, w, _ in rows for k in range(scoring.HEAD, len(w) + 1))
    assert n == len(rows) and {k: len(v) for k, v in crowds.items()} == Counter(len(b) for b, n in beginnings.items() if n > 25)
    dealt = scoring._dealt(frame.withColumn("depth", scoring._depth(crowds)), 7).select("first", "word", "depth", "kind", "m").collect()
    assert sorted((r.kind, bytes(r.word), r.m) for r in dealt) == sorted((k, w, m) for _, k, _, w, m in rows)
    groups = {}
    for r in dealt:
        groups.setdefault(r.first, []).append((bytes(r.word), r.depth))
    assert all(len(g) <= 25 or len({w for w, _ in g}) == 1 for g in groups.values())
    assert len({(r.word[:r.depth]) for r in dealt}) == len(groups)
    assert all(len({(w[:d], d) for w, d in g}) == 1 for g in groups.values())


def test_scores_of_crowds_equal_those_of_words_held_together(spark, monkeypatch):
    """Counts of bytes that several groups of words share come from the table, and lead to the same scores."""
    rng, mixers = random.Random(12), (some_mixer(13), some_mixer(14))
    monkeypatch.setattr(scoring, "_adapted", lambda *args: tuple((m.weights, m.refined) for m in mixers))
    words = [w.decode() for *_, w, _ in crowded_words() if w != b"\n"]
    docs = table(spark, [(i, " ".join(rng.choice(words) for _ in range(40))) for i in range(60)]).repartition(3)

    def found():
        return {r.doc_id: (r.score, r.base_score, r.n_known) for r in scoring.scores(docs).collect()}

    together = found()
    for name in ("CROWD", "CROWD_BYTES"):
        monkeypatch.setattr(scoring, name, 9)
        assert found() == {i: pytest.approx(v) for i, v in together.items()}
        monkeypatch.undo()
        monkeypatch.setattr(scoring, "_adapted", lambda *args: tuple((m.weights, m.refined) for m in mixers))


def test_groups_of_words_are_whole_and_cut_where_words_are_long(monkeypatch):
    monkeypatch.setattr(scoring, "CROWD_BYTES", 1000)
    first = np.repeat([5, 7, 9, 11], [3, 1, 4, 2])
    for size, most in ((10, 10), (400, 6)):
        batch = pa.RecordBatch.from_arrays([pa.array(first), pa.array([b"x" * size] * 10)], names=["first", "word"])
        groups = [g.column("first").to_pylist() for g in scoring._groups(iter([batch.slice(0, 6), batch.slice(6, 0), batch.slice(6)]))]
        assert sum(groups, []) == first.tolist() and max(map(len, groups)) <= most
        assert all(not set(a) & set(b) for a, b in zip(groups, groups[1:]))


def test_chunks_have_texts_and_words_of_one_kind(spark):
    docs = [(i, f"{w} {w} other", False) for i, w in enumerate(["the", "der"] * 4)]
    rows = scoring._cut(spark.createDataFrame(docs, "doc_id long, text string, held_out boolean").coalesce(1), [b"the", b"der"])
    kinds = {}
    for r in rows.where("chunk is not null").collect():
        kinds.setdefault(r.chunk, set()).add(r.kind)
    assert sorted(map(list, kinds.values())) == [[0], [1]]
