"""Running values across bins, against windows over whole contigs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helixframe.operators import intervals as oi
from helixframe.operators import variants as vo


@pytest.fixture(autouse=True)
def small_bins(monkeypatch):
    monkeypatch.setattr(oi, "RUN_BIN", 10)


def test_running_is_a_window(spark):
    rng = random.Random(1)
    places = [(c, p) for c in ("a", "b", None) for p in sorted(rng.sample(range(-40, 400), 60))]
    df = spark.createDataFrame([(c, p, rng.choice([None, 1, 2, -3]), rng.randrange(9)) for c, p in places], "c string, p long, x long, y long")
    got = oi.running(df, ["c"], ["p"], sums={"total": "y"}, most={"top": "x"}, last={"prev": "x"}, following={"next": "x"})
    w = Window.partitionBy("c").orderBy("p")
    want = df.select("*", F.sum("y").over(w).alias("total"), F.max("x").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("top"), F.lag("x").over(w).alias("prev"), F.lead("x").over(w).alias("next"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def points(regions, touch=False):  # noqa: ANN001, ANN201
    return {(c, p) for c, s, e in regions for p in range(s, e)}


@pytest.mark.parametrize("seed", range(4))
def test_merge_and_subtract_against_points(spark, seed):
    rng = random.Random(seed)
    some = lambda n, long: [(rng.choice("ab"), s, s + rng.randrange(0, long)) for s in (rng.randrange(0, 200) for _ in range(n))]
    t, x = some(40, 35) + some(2, 120), some(25, 12)
    df = lambda rows: spark.createDataFrame(rows, "contigName string, start long, `end` long")
    merged = [(r.contigName, r.start, r.end, r._before) for r in oi.merge(df(t + t)).orderBy("contigName", "start").collect()]
    assert points([m[:3] for m in merged]) == points(t)
    for a, b in zip(merged, merged[1:], strict=False):
        assert a[0] != b[0] or a[2] < b[1] and b[3] == a[2]
    left = [tuple(r) for r in oi.subtract(df(t), df(x)).collect()]
    assert points(left) == points(t) - points(x)
    assert sum(e - s for _, s, e in left) == len(points(left))


def test_candidate_loci_against_latest_rows(spark):
    rng = random.Random(7)
    rows = [(rng.choice("ab"), s, s + rng.choice([0, 1, 1, 5, 40]), f"S{rng.randrange(5)}", rng.random() < 0.3) for s in (rng.randrange(150) for _ in range(200))]
    df = spark.createDataFrame(rows, "contigName string, start long, `end` long, sampleId string, polymorphic boolean")
    want = set()
    for c, at in {(r[0], r[1]) for r in rows}:
        n, any_poly = 0, False
        for sample in {r[3] for r in rows if r[0] == c}:
            before = [r for r in rows if r[0] == c and r[3] == sample and r[1] <= at]
            if before:
                last = [r for r in before if r[1] == max(b[1] for b in before)]
                if max(r[2] for r in last) > at:
                    n += 1
                    any_poly |= max((r[2] for r in last if r[4]), default=-1) > at
        if any_poly:
            want.add((c, at, n))
    assert {tuple(r) for r in vo.candidate_loci(df).collect()} == want
