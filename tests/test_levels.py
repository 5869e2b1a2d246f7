"""Bins in levels against all pairs, and ordinals from ranges."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helixframe.operators import intervals as oi
from helixframe.operators import reads as ro

A, B = ("c", "s", "e"), ("rc", "rs", "re")


def spans(n: int, seed: int, longest: list[int], far: int = 30_000) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for k in range(n):
        start = rng.randrange(-200, far)
        out.append((k, rng.choice(["x", "y"]), start, start + rng.choice(longest)))
    return [*out, (n, None, 1, 5), (n + 1, "x", None, 5), (n + 2, "x", 5, None), (n + 3, "x", 900, 890), (n + 4, "y", 70, 70)]


def frames(spark, left: list[tuple], right: list[tuple]):  # noqa: ANN201
    return spark.createDataFrame(left, "i long, c string, s long, e long").repartition(3), spark.createDataFrame(right, "j long, rc string, rs long, re long").repartition(2)


@pytest.mark.parametrize(("one", "two"), [([1, 5, 9], [1, 7]), ([1, 5], [5000]), ([5000], [1, 5]), ([0, 1, 10, 80, 640, 5000, 30_000], [0, 1, 10, 81, 641, 5001, 30_000]), ([10], [10]), ([100], [100]), ([3], [3, 10_000_000])])
def test_pairs_are_those_that_overlap(spark, one, two):
    left, right = spans(150, len(one), one), spans(90, 7 * len(two), two)
    a, b = frames(spark, left, right)
    got = oi.overlap_pairs(a, b, A, B, size=10)
    assert got.columns == ["i", "c", "s", "e", "j", "rc", "rs", "re"]
    want = sorted((x[0], y[0]) for x in left for y in right if None not in x and None not in y and x[1] == y[1] and x[2] < y[3] and x[3] > y[2])
    assert sorted((r.i, r.j) for r in got.collect()) == want


def test_a_long_interval_is_few_rows(spark):
    left, right = spans(300, 1, [50, 100]), spans(300, 2, [50, 1_000_000, 3_000_000, 10_000_000])
    a, b = frames(spark, left, right)
    one, two = oi.levels_there(a, b, A, B, 1000)
    assert one == [0] and two == [0, 4, 5]
    assert oi.in_levels(b, B, 1000, two, one, False).count() <= 2 * 300 + 10
    # a short one visits each level of the long ones, in two bins at most and mostly in one
    assert oi.in_levels(a, A, 1000, one, two, True).count() <= 1.3 * len(two) * 310


def test_short_intervals_have_one_level(spark):
    a, b = frames(spark, spans(100, 1, [50]), spans(100, 2, [70]))
    assert oi.levels_there(a, b, A, B, 1000) == ([0], [0])
    assert oi.in_levels(a, A, 1000, [0], [0], True).count() <= 1.2 * 105
    assert oi.overlap_pairs(*frames(spark, [], []), A, B).count() == 0


@pytest.mark.parametrize("within", [None, "c"])
def test_ordinals(spark, within):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(50)]), k % 400) for k in range(1000)]
    df = spark.createDataFrame(rows, "c string, s int, k int").repartition(5)
    order = (F.asc_nulls_last("c"), F.asc_nulls_last("s"), "k")
    got = ro.with_ordinals(df, order, within)
    assert got.columns == ["c", "s", "k", "ordinal"]
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    key = lambda r: (r[0] is None, r[0] or "", r[1] is None, r[1] or 0, r[2])
    want, n = [], {}
    for r in sorted(rows, key=key):
        n[r[0] if within else 0] = n.get(r[0] if within else 0, 0) + 1
        want.append((*r, n[r[0] if within else 0]))
    assert sorted((key(r[:3]), r[3]) for r in map(tuple, got.collect())) == sorted((key(r[:3]), r[3]) for r in want)
    assert ro.with_ordinals(df.where("false"), order, within).count() == 0


def test_a_value_of_ordinals_is_no_task_of_its_own(spark):
    df = spark.range(3000).selectExpr("concat('c', id % 2) AS c", "id AS k")
    got = ro.with_ordinals(df, ("c", "k"), "c")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert got.where("ordinal = k div 2 + 1").count() == 3000
