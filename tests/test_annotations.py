"""Raw annotations add up, and what follows from them is what pooled reads give."""

from __future__ import annotations

import math
import random

import pytest

from helixframe.operators import annotations as an
from helixframe.operators import assembly, callers, genotyping
from helixframe.sources import vcf
from tests.test_callers import TRUTH, frame, lengths, simulated


def notes(rng: random.Random, n: int) -> list[tuple]:
    out = []
    for _ in range(n):
        kind = rng.choice(["ref", "ref", "alt", "none"])
        out.append((kind == "ref", kind == "alt", (rng.random() < 0.5, rng.choice([20, 30, 40]), rng.choice([10, 60]), rng.randrange(50))))
    return out


def test_the_sum_of_parts_is_the_whole():
    rng = random.Random(1)
    for _ in range(30):
        parts = [notes(rng, rng.randrange(20)) for _ in range(4)]
        whole = an.raw_of(x for p in parts for x in p)
        added = an.combined([*map(an.raw_of, parts), dict.fromkeys(an.RAW)])
        assert added == whole and an.values_of(added) == an.values_of(whole)
    assert an.combined([]) is None and an.columns_of(None) == [None] * 9


def test_fisher_against_all_tables():
    for a, b, c, d in [(3, 1, 2, 4), (10, 0, 0, 10), (0, 0, 5, 5), (8, 2, 1, 5), (1, 1, 1, 1)]:
        row, column, n = a + b, a + c, a + b + c + d
        p = {x: math.comb(row, x) * math.comb(n - row, column - x) / math.comb(n, column) for x in range(max(0, column - (n - row)), min(row, column) + 1)}
        assert an.fisher((a, b, c, d)) == pytest.approx(sum(v for v in p.values() if v <= p[a] * (1 + 1e-7)))
    assert an.strand_odds((20, 20, 20, 20)) == pytest.approx(math.log(2)) and an.strand_odds((20, 20, 20, 0)) > 2


def test_rank_sums_against_pairs():
    rng = random.Random(2)
    for _ in range(20):
        ref, alt = ([rng.randrange(6) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        triples = [x for v in sorted({*ref, *alt}) for x in (v, ref.count(v), alt.count(v))]
        u = sum((a > r) + 0.5 * (a == r) for a in alt for r in ref)
        n = len(ref) + len(alt)
        ties = sum((ref.count(v) + alt.count(v)) ** 3 - ref.count(v) - alt.count(v) for v in {*ref, *alt})
        spread = len(ref) * len(alt) / 12 * (n + 1 - ties / (n * (n - 1)))
        assert an.rank_sum(triples) == pytest.approx((u - len(ref) * len(alt) / 2) / math.sqrt(spread) if spread > 0 else 0.0)
    assert an.rank_sum([]) is None and an.rank_sum([5, 3, 0]) is None


def test_joint_values_are_those_of_pooled_reads(spark, tmp_path):
    rng = random.Random(9)
    reads = {s: [r | {"readNegativeStrand": rng.random() < 0.5, "mappingQuality": rng.choice([40, 60]), "qualityScores": "".join(rng.choice("5?I") for _ in r["qualityScores"])} for r in simulated(rng, TRUTH, s)] for s in ("s1", "s2")}
    calls = None
    for s, rows in reads.items():
        own = assembly.call_shards(assembly.shards(frame(spark, rows), lengths(spark), 500), callers.germline_caller(s, reference_confidence=True), callers.CALLS)
        path = str(tmp_path / f"{s}.vcf")
        vcf.write_single(own, path, [s])
        back = vcf.read_vcf(spark, path)  # through the format
        calls = back if calls is None else calls.unionByName(back, allowMissingColumns=True)
    joint = {r.start: r for r in genotyping.genotype(calls, ["s1", "s2"], 700).collect()}
    import pandas as pd

    pooled = pd.DataFrame([r for rows in reads.values() for r in rows])
    reference, bases, _, told = callers.columns(pooled, 0, 3000)
    seen = 0
    for at, (_, kind, _) in TRUTH.items():
        if kind != "snv":
            assert joint[at].INFO_FS is None
            continue
        ref, alt = reference[at], joint[at].alternateAlleles[0]
        want = an.raw_of((b == ref, b == alt, x) for (b, _, _), x in zip(bases[at], told[at], strict=True))
        assert [list(joint[at][f"INFO_{n}"]) for n in an.RAW] == [want[n] for n in an.RAW]
        got = [joint[at][f"INFO_{n}"] for n in an.VALUES]
        assert all(a == b or a == pytest.approx(b) for a, b in zip(got, an.values_of(want), strict=True))
        seen += 1
    assert seen == 3
