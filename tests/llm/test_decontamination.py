"""Spaced-seed decontamination against exhaustive alignment, and its short and repeated items."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from starmart.llm import decontamination
from conftest_llm import prose, table


def exhaustive(text, items):
    """Items that overlap with a text at any displacement at all."""
    h, out = decontamination.hashed_words(text), {}
    for item_id, words in items:
        item = decontamination.hashed_words(words)
        if len(item) < decontamination.FEWEST:
            continue
        for shift in range(-len(item), len(h) + 1):
            found = decontamination.verified(h, item, shift)
            if found[2] > out.get(item_id, (0, 0, 0))[2] and (len(item) >= decontamination.SPAN or found[2] == len(item)):
                out[item_id] = found
    return out


def test_recall_against_exhaustive_alignment(spark):
    """With up to one word in five replaced, at least 98 % of the overlaps are found, and nothing else."""
    rng = random.Random(4)
    items = [(k, prose(3000 + k, rng.randint(12, 40))) for k in range(40)]
    docs = {}
    for i in range(160):
        words = items[i % 40][1].split()
        lo = rng.randint(0, max(0, len(words) - 14))
        words = words[lo:lo + rng.randint(12, 30)]
        for k in rng.sample(range(len(words)), int(len(words) * rng.choice([0, 0.05, 0.1, 0.15, 0.19]))):
            words[k] = "other"
        docs[i] = f"{prose(i, rng.randint(0, 30))} {' '.join(words)} {prose(900 + i, rng.randint(0, 30))}"
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = {(i, k): v for i, t in docs.items() for k, v in exhaustive(t, items).items()}
    found = {(r.doc_id, r.item_id): (r.start_word, r.end_word, r.n_matched) for r in decontamination.contaminated(table(spark, docs), bench).collect()}
    assert set(found) <= set(expected) and len(found) >= 0.98 * len(expected) > 80
    assert sum(found[k][2] == expected[k][2] for k in found) >= 0.98 * len(found)


def test_short_items_by_whole_match(spark):
    items = [(1, "one two three four five"), (2, "Six, seven eight!"), (3, "too short"), (4, "six words are enough for masks"), (4, "again five four three two")]
    docs = table(spark, [
        (1, "begin One two three four five end"), (2, "one two three four other five"), (3, "so six seven eight"), (4, "too short"),
        (5, "all six words are enough for masks here"), (6, "again five four three two"), (6, "six seven eight"), (None, "six seven eight"), (7, None), (8, "")])
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = sorted(((r.doc_id, r.item_id, r.n_matched) for r in decontamination.contaminated(docs, bench).collect()), key=repr)
    assert found == sorted([(1, 1, 5), (3, 2, 3), (5, 4, 6), (6, 4, 5), (6, 2, 3), (None, 2, 3)], key=repr)
    kept = decontamination.decontaminated(docs.withColumn("row_key", F.lit("x")), bench).collect()
    assert sorted((r.doc_id for r in kept), key=repr) == [2, 4, 7, 8] and {r.row_key for r in kept} == {"x"}
    listed = {(r.doc_id, r.text): [o.item_id for o in r.overlaps] for r in decontamination.with_overlaps(docs, bench).collect()}
    assert listed[1, "begin One two three four five end"] == [1] and listed[8, ""] == [] and len(listed) == 10


def test_a_passage_of_all_items(spark):
    passage = prose(5, 20)
    items = [(k, f"{passage} {prose(100 + k, 10)}") for k in range(60)]
    docs = table(spark, {i: f"{prose(i, 5)} {passage}" for i in range(30)} | {99: prose(99, 400)})
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contaminated(docs, bench)
    assert found.count() == 30 * 60 and {r.n_matched for r in found.select("n_matched").distinct().collect()} == {20}
    assert [r.doc_id for r in decontamination.decontaminated(docs, bench).collect()] == [99]
