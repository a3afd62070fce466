"""One document of each linked group, against brute force, with repeated ids and rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from starmart.llm import jaccard
from conftest_llm import prose, table


def brute_kept(rows, width=5, percent=80):
    """Of every linked group of distinct (id, text) all its rows, and those that may stay."""
    distinct = sorted(set(rows), key=repr)
    sets = []
    for _, text in distinct:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[k:k + width]) for k in range(len(words) - width + 1)} or ({tuple(words)} if words else set()))
    group = list(range(len(distinct)))
    for k in range(len(distinct)):
        for j in range(k):
            if sets[k] and 100 * len(sets[k] & sets[j]) >= percent * len(sets[k] | sets[j]):
                old, new = sorted((group[k], group[j]), reverse=True)
                group = [new if g == old else g for g in group]
    out = {}
    for row, g in zip(distinct, group):
        out.setdefault(g, []).append(row)
    return list(out.values())


def test_first_of_groups_equals_brute_force(spark):
    rng, rows = random.Random(5), []
    for g in range(25):
        base = prose(g, rng.choice([3, 8, 60, 150])).split()
        for _ in range(rng.randint(1, 8)):
            words = list(base)
            for _ in range(int(len(base) * rng.random() * 0.05)):
                words[rng.randrange(len(words))] = prose(rng.randrange(10**6), 1)
            rows.append((rng.choice([None, *range(60)]), " ".join(words)))
    rows += [(1, "text about rivers and the sea beyond"), (1, "unlike text about bread and butter here"), (2, "other words of no kin at all")]
    rows += [(70, None), (71, ""), (None, None), (72, ""), rows[0], rows[0], (71, "")]
    docs = table(spark, rows).withColumn("row_key", F.lit("given")).repartition(5)
    found = jaccard.first_of_groups(docs)
    assert found.columns == docs.columns and {r.row_key for r in found.collect()} == {"given"}
    kept = [(r.doc_id, r.text) for r in found.collect()]
    assert len(kept) == len(set(kept))
    for group in brute_kept(rows):
        stays = [row for row in group if row in set(kept)]
        assert len(stays) == 1
        ids = [i for i, _ in group if i is not None]
        assert stays[0][0] == (min(ids) if ids else None)
    assert len(kept) == len(brute_kept(rows))


def test_first_of_groups_of_awkward_and_empty_tables(spark, awkward):
    assert jaccard.first_of_groups(awkward.where("false")).collect() == []
    assert sorted((r.doc_id for r in jaccard.first_of_groups(awkward).collect()), key=repr) == [1, 2, 3, 4, 5, None]
