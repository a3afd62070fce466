"""Whitening, spelling variants and MinHash near-dedup against brute-force versions, and their defined cases."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import families, minhash, spelling, whitening
from conftest_llm import prose, table

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)


# ---- whitening


def test_rank_one_updates_against_a_full_decomposition():
    rng = np.random.default_rng(3)
    for d in ([0.0, 0, 0, 0], [1.0, 1, 2, 2], [1.0, 2, 3, 4], [0.0, 0, 1e-12, 5e8]):
        for z in ([1.0, 0, 0, 0], [1e-20, 1, 1, 0], [1.0, -2, 3, 4], [0.0, 0, 0, 0], rng.normal(size=4) * 1e3):
            d, z = np.array(d), np.array(z)
            values, q = whitening.rank_one(d, np.eye(4), z)
            whole = np.diag(d) + np.outer(z, z)
            scale = max(1.0, np.abs(whole).max())
            assert np.abs(q @ np.diag(values) @ q.T - whole).max() < 1e-13 * scale
            assert np.abs(q.T @ q - np.eye(4)).max() < 1e-13
            assert np.allclose(values, np.linalg.eigvalsh(whole), rtol=0, atol=1e-13 * scale)


def test_spectra_of_parts_merge_to_the_spectrum_of_all():
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(3000, 12)) * 9 + np.arange(12)).astype(np.int64) + whitening.OFFSET
    x[:1000] = x[0]
    parts = []
    for lot in np.array_split(x, 5):
        parts.append(whitening.Spectrum(12))
        parts[-1].add(lot)
    for other in parts[1:]:
        parts[0].merge(other.n, other.sums, other.values, other.vectors)
    centred = x - x.mean(axis=0)
    assert np.allclose(parts[0].values, np.linalg.eigvalsh(centred.T @ centred), rtol=1e-11)
    assert parts[0].n == 3000 and (parts[0].sums == x.sum(axis=0)).all()


def test_whitened_rows_equal_a_plain_decomposition(spark):
    rng = np.random.default_rng(5)
    v = (rng.normal(size=(400, 40)) @ rng.normal(size=(40, 40)) / 6).astype(np.float32)
    v[:130] = v[0]
    rows = [(i, [float(c) for c in row]) for i, row in enumerate(v)]
    broken = [(900, None), (901, [None] + [1.0] * 39), (902, [float("nan")] * 40), (903, [float("inf")] * 40), (904, [1.0]), (905, []), (906, [3e38] * 40)]
    found = whitening.whitened(vectors(spark, rows + broken).repartition(7)).collect()
    x = np.floor(v.astype(float) * 64).astype(np.int64) + 1_000_000
    n, apart = len(x), len(x) * x - x.sum(axis=0)
    values, basis = np.linalg.eigh((apart / n).T @ (apart / n) / n)
    values, basis = values[::-1], basis[:, ::-1]
    plain = apart / n @ basis[:, :32] / np.sqrt(values[:32])
    assert len(found) == n * 32 and {r.vec_id for r in found} == set(range(n))
    got = np.zeros((n, 32))
    for r in found:
        got[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == int((apart[r.vec_id] ** 2).sum()) and r.identity_error < 1e-9
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-12
    assert np.abs(got * np.sign((got * plain).sum(axis=0)) - plain).max() < 1e-8


def test_whitening_of_few_and_huge_and_no_vectors(spark):
    assert whitening.whitened(vectors(spark, [])).collect() == []
    assert whitening.whitened(vectors(spark, [(1, None)])).collect() == []
    one = whitening.whitened(vectors(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, 0.0, 0.0), (2, 0, None, 0.0, 0.0)]
    # A constant entry has no variance; repeated rows and null ids are rows.
    rows = whitening.whitened(vectors(spark, [(None, [0.0, 1.0]), (None, [0.0, 1.0]), (3, [1.0, 1.0])])).collect()
    assert len(rows) == 6 and all((r.whitened is None) == (r.component == 2) for r in rows)
    far = whitening.whitened(vectors(spark, [(i, [1e12 * i, 1.0]) for i in range(3)])).collect()
    x = [int(np.floor(np.float32(1e12 * i).astype(float) * 64)) for i in range(3)]
    exact = [(3 * a - sum(x)) ** 2 for a in x]
    assert {(r.vec_id, r.deviation) for r in far} == {(i, e if e < 2**63 else None) for i, e in enumerate(exact)}


# ---- spelling variants


def brute_variants(rows, divisor):
    from zlib import crc32

    counts = Counter()
    for doc_id, text in rows:
        for run in spelling.RUN.findall(text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{doc_id}:{word}".encode())
            if doc_id is not None and h % divisor == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1:]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    by_length, beside, form = defaultdict(list), {}, {}
    for w in words:
        by_length[len(w)].append(w)
    for w in words:
        beside[w] = [u for k in (-1, 0, 1) for u in by_length[len(w) + k] if near(w, u)]
        best = min(beside[w], key=lambda u: (-words[u], u), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(beside[w]), words.get(form[w])))
    return out


@pytest.mark.parametrize("divisor", [3, 97])
def test_variants_equal_brute_force(spark, divisor):
    rng = random.Random(7)
    bases = ["".join(rng.choice("abç") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    texts = []
    for i in range(150):
        words = [rng.choice(bases[:1 + int(60 * rng.random() ** 2)]) for _ in range(60)]
        texts.append((i, rng.choice([" ", ", ", "1", "×"]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    texts += [(None, texts[0][1]), (3, texts[3][1]), (900, None), (901, ""), (902, "aaaaa aaaaaa aaaaaaa " * 40)]
    found = spelling.variants(table(spark, texts).withColumn("word", F.lit(1)).repartition(5), divisor=divisor).collect()
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found} == brute_variants(texts, divisor)
    assert len(found) == len({r.word for r in found})


def test_composition_finds_every_pair_one_edit_apart():
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 6))) for _ in range(90)})
    acceptor = spelling.Acceptor(words)

    def language(state):
        return ([""] if acceptor.final[state] else []) + [c + r for c, t in acceptor.arcs[state].items() for r in language(t)]

    assert sorted(language(acceptor.start)) == words
    rests = [frozenset(language(s)) for s in range(len(acceptor.arcs))]
    assert len(set(rests)) == len(rests)  # minimal: no two states accept the same

    def edits(w):
        return {w[:k] + c + w[k + 1:] for k in range(len(w)) for c in "ab"} | {w[:k] + w[k + 1:] for k in range(len(w))}

    expected = {(min(a, b), max(a, b)) for a in words for b in edits(a) if b in set(words) and a != b}
    assert spelling.OneEdit(acceptor).pairs(acceptor.start) == expected


def test_variants_of_empty_and_awkward_tables(spark, awkward):
    assert spelling.variants(awkward.where("false")).collect() == []
    assert spelling.variants(awkward.where("text is null or length(text) < 5")).collect() == []
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    found = spelling.variants(awkward).collect()
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found} == brute_variants(rows, 97)


# ---- MinHash near-dedup


def brute_groups(rows, width, percent):
    sets = []
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        whole = {tuple(words)} if words else set()
        sets.append((doc_id, {tuple(words[k:k + width]) for k in range(len(words) - width + 1)} or whole))
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    named = [(i, s) for i, s in sets if i is not None]
    for k, (i, s) in enumerate(named):
        for j, t in named[:k]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [(i, len(s), None if i is None else root(i) if s or any(t for j, t in sets if j == i) else i) for i, s in sets]


def family(seed: int, copies: int, edits: int):
    """Edited copies of one text; of far edited ones some link only with each other."""
    rng = random.Random(seed)
    base = prose(seed, 70).split()
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = prose(rng.randrange(10**6), 1)
        out.append(" ".join(words))
    return out


def check(spark, rows, width=4, percent=80):
    found = minhash.near_duplicates(table(spark, rows).withColumn("node", F.lit("x")).repartition(6), width, percent).collect()
    expected = brute_groups(rows, width, percent)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter(expected)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in found)
    return expected


def test_near_duplicates_equal_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(family(1, 120, 5) + family(2, 60, 2) + [prose(i, 40) for i in range(500, 560)])]
    random.Random(2).shuffle(rows)
    expected = check(spark, rows)
    assert 60 < len({c for _, _, c in expected}) < 200


def test_near_duplicates_with_repeated_ids_and_short_texts(spark):
    a, b = prose(11, 60), prose(12, 60)
    near_a = a.rsplit(" ", 1)[0] + " end"
    rows = [(9, a), (4, near_a), (4, b), (7, b + " end"), (7, ""), (2, "a b"), (5, "A  b"), (6, None), (1, ""), (None, a), (None, None),
            (8, "a b"), (8, "a b"), (3, prose(13, 30_000)), (10, prose(13, 30_000) + " more")]
    check(spark, rows)


def test_outstanding_documents_meet_their_whole_family(spark, monkeypatch):
    monkeypatch.setattr(families, "TILE", 7)
    monkeypatch.setattr(families, "MEET", 5)
    chain = []  # each text a few words further from the first, so leaders reach only their neighbours
    words = prose(21, 120).split()
    for k in range(40):
        chain.append(" ".join(words))
        for j in range(3):
            words[(3 * k + j) % 120] = prose(1000 + 3 * k + j, 1)
    rows = [(i * 17 % 101, t) for i, t in enumerate(chain)]
    assert len({c for _, _, c in check(spark, rows)}) == 1


def test_near_duplicates_of_empty_and_awkward_tables(spark, awkward):
    assert minhash.near_duplicates(awkward.where("false")).collect() == []
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    found = minhash.near_duplicates(awkward, 4, 80).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter(brute_groups(rows, 4, 80))
