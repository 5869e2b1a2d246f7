"""Overlaps of regions counted and measured without pairs, against all pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helixframe.operators import intervals as oi


@pytest.mark.parametrize("size", [5, 1_000_000])
def test_totals_are_those_of_all_pairs(spark, monkeypatch, size):
    monkeypatch.setattr(oi, "RUN_BIN", size)
    rng = random.Random(7)
    one = lambda: (rng.choice(["a", "b", None]), *sorted(rng.randrange(-20, 60) for _ in range(2)))
    reads = [*(one() for _ in range(150)), ("a", 7, 7), ("a", 7, 7), ("b", None, 3), ("a", -30, 90)]
    regions = [*((*one(), k) for k in range(80)), ("a", 7, 7, 80), ("a", 5, 9, 81), ("a", 5, 9, 82), ("c", 1, 9, 83), ("a", 1, None, 84)]
    a, b = spark.createDataFrame(reads, "c string, s long, e long"), spark.createDataFrame(regions, "contig string, rs long, re long, id int")
    got = {r.id: (r.n, r.covered) for r in oi.overlap_totals(a, b, ("c", "s", "e"), ("contig", "rs", "re")).collect()}
    want: dict = {}
    for c, rs, re, k in regions:
        both = [min(e, re) - max(s, rs) for d, s, e in reads if None not in (c, d, s, e, rs, re) and c == d and s < re and e > rs]
        if both:
            want[k] = (len(both), sum(both))
    assert got == want


def test_overlaps_cost_no_rows(spark):
    """2,000 regions that each overlap 100,000 intervals: 200 million pairs, of which none is formed."""
    a = spark.range(100_000).select(F.lit("c").alias("c"), F.col("id").alias("s"), (F.col("id") + 3).alias("e"))
    b = spark.range(2_000).select(F.lit("c").alias("contig"), (-F.col("id")).alias("rs"), (F.col("id") + 200_000).alias("re"))
    totals = oi.overlap_totals(a, b, ("c", "s", "e"), ("contig", "rs", "re"))
    assert "_kind" not in totals._jdf.queryExecution().optimizedPlan().toString()
    r = totals.agg(F.sum("n").alias("n"), F.sum("covered").alias("covered")).first()
    assert (r.n, r.covered) == (200_000_000, 600_000_000)
