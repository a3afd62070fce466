"""Drift of two results by digests of their buckets."""

from __future__ import annotations

import random

from helpers import frame, rows

from starmart.operators import reconcile

SCHEMA = "k string, t bigint, m bigint, x double"


def side(spark, values):
    return frame(spark, SCHEMA, *values)


def drift(a, b, **more):
    return rows(reconcile.drift(a, b, ("k", "t"), ("m", "x"), **more))


def test_drift_equals_a_plain_comparison(spark):
    rng = random.Random(2)
    base = {(rng.choice(["a", "b", None]), t): (t % 7, None if t % 11 == 0 else t / 4) for t in range(300)}
    left = [(*k, *v) for k, v in base.items()]
    right = list(left)
    for _ in range(12):
        right.pop(rng.randrange(len(right)))
    for i in rng.sample(range(len(right)), 12):
        k, t, m, x = right[i]
        right[i] = (k, t, m + 1, x) if i % 2 else (k, t, m, None if x is not None else 0.5)
    right += [("new", 1, 2, 0.5), *right[:5], ("twice", 1, 1, 1.0), ("twice", 1, 1, 1.0)]
    expected = []
    for k in {(r[0], r[1]) for r in left + right}:
        a, b = ([r[2:] for r in s if (r[0], r[1]) == k] for s in (left, right))
        status = ("duplicate" if max(len(a), len(b)) > 1 else "left_only" if not b else "right_only" if not a else
                  "different" if a != b else None)
        if status:
            one = [v[0] if len(v) == 1 else (None, None) for v in (a, b)]
            expected.append((*k, status, len(a), len(b), one[0][0], one[1][0], one[0][1], one[1][1]))
    for buckets in (2, 16, reconcile.BUCKETS):
        assert drift(side(spark, left), side(spark, right), buckets=buckets) == sorted(expected, key=repr)


def test_equal_and_empty_sides_have_no_drift(spark):
    some = side(spark, [("a", 1, 2, None), ("a", 1, 2, None), (None, None, None, None)])
    assert reconcile.unequal_buckets(some.where("k is not null"), some.where("k is not null"), ["k"], ["t", "m", "x"]).count() == 0
    assert drift(some, some) == [] and drift(some.limit(0), some.limit(0)) == []
    # A copied pair of rows leaves an exclusive or of hashes as it is, but not their sum.
    assert [r[2:5] for r in drift(side(spark, [("a", 1, 2, None)]), side(spark, [("a", 1, 2, None)] * 3))] == [("duplicate", 1, 3)]
