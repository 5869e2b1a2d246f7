"""Built-in callers on simulated reads whose truth is known, through the stages that run them."""

from __future__ import annotations

import random

import pytest

from helixframe.model import READ
from helixframe.operators import assembly, callers
from helixframe.operators import variants as vo
from helixframe.plans import stages
from helixframe.sources import vcf

GENOME = "".join(random.Random(0).choice("ACGT") for _ in range(3000))
#: place: (reference allele, alternate, copies of it of two)
TRUTH = {200: ("x", "snv", 1), 700: ("x", "snv", 2), 1200: ("x", "ins", 1), 1700: ("x", "del", 2), 2500: ("x", "snv", 1)}


def other(base: str) -> str:
    return "CGTA"["ACGT".index(base)]


def simulated(rng: random.Random, truth: dict, sample: str, depth: int = 30, n: int = 100, errors: float = 0.002, share: float | None = None) -> list[dict]:
    """Reads of `n` bases with their CIGAR and MD; each comes from one of two copies of the genome."""
    rows = []
    for k in range(len(GENOME) * depth // n):
        start = rng.randrange(len(GENOME) - n - 5)
        copy = rng.randrange(2) if share is None else int(rng.random() < share)
        seq, cigar, md, run, at = [], [], [], 0, start
        while len(seq) < n:
            ref = GENOME[at]
            kind = truth.get(at, (None, None, 0))
            has = kind[2] == 2 or (kind[2] == 1 and copy == 1)
            base = other(ref) if has and kind[1] == "snv" else ref
            if rng.random() < errors:
                base = other(base)
            seq.append(base)
            cigar.append("M")
            if base == ref:
                run += 1
            else:
                md.append(f"{run}{ref}")
                run = 0
            at += 1
            if has and kind[1] == "ins" and len(seq) + 3 < n:
                seq += "GAT"
                cigar += "III"
            if has and kind[1] == "del" and len(seq) + 1 < n:
                cigar += "DD"
                md.append(f"{run}^{GENOME[at : at + 2]}")
                run, at = 0, at + 2
        md.append(str(run))
        text, last = "", ""
        for op in cigar:
            last = last if last and last[-1] == op else ""
            text += op
        runs = []
        for op in text:
            if runs and runs[-1][0] == op:
                runs[-1][1] += 1
            else:
                runs.append([op, 1])
        row = {f.name: None for f in READ.fields}
        row |= {"referenceName": "c", "start": start, "end": at, "readName": f"{sample}{k}", "readInFragment": 0, "sequence": "".join(seq), "qualityScores": "?" * n, "cigar": "".join(f"{m}{op}" for op, m in runs), "mismatchingPositions": "".join(md), "mappingQuality": 60, "readMapped": True, "readGroupSampleId": sample, "readGroupId": sample}
        row |= dict.fromkeys(("secondaryAlignment", "duplicateRead", "failedVendorQualityChecks", "supplementaryAlignment", "readNegativeStrand"), False) | {"primaryAlignment": True}
        rows.append(row)
    return rows


def frame(spark, rows):  # noqa: ANN001, ANN201
    return spark.createDataFrame([tuple(r[f.name] for f in READ.fields) for r in rows], READ)


def lengths(spark):  # noqa: ANN001, ANN201
    return spark.createDataFrame([("c", len(GENOME))], "contigName string, length long")


def expected(at: int, kind: str) -> tuple[str, str]:
    ref = GENOME[at]
    return {"snv": (ref, other(ref)), "ins": (ref, f"{ref}GAT"), "del": (GENOME[at : at + 3], ref)}[kind]


@pytest.mark.parametrize("bands", ["", "20,60"])
def test_germline_stage_finds_the_truth(spark, tmp_path, bands):
    reads = frame(spark, simulated(random.Random(1), TRUTH, "s"))
    reads.write.parquet(str(tmp_path / "reads" / "sampleId=s"))
    spark.conf.set("helix.assemblyBinSize", "500")
    try:
        stage = stages.CallVariants("s", lengths, callers.germline_caller("s", reference_confidence=bool(bands)), callers.CALLS, alignmentOutput=str(tmp_path / "reads"), callVariantOutput=str(tmp_path / "calls"), callVariantOutputVCF=str(tmp_path / "s.vcf"), exportVCF=True, exportVCFAsSingleFile=True, bands=bands, maxReadStartsPerPosition=0)
        stage.execute(spark)
    finally:
        spark.conf.unset("helix.assemblyBinSize")
    rows = spark.read.parquet(str(tmp_path / "calls")).collect()
    real = {r.start: r for r in rows if r.alternateAlleles[0] != "<NON_REF>"}
    assert set(real) == set(TRUTH)
    for at, (_, kind, copies) in TRUTH.items():
        assert (real[at].referenceAllele, real[at].alternateAlleles[0]) == expected(at, kind), at
        assert real[at].genotypes[0].calls == ([0, 1] if copies == 1 else [1, 1]), at
    if bands:
        blocks = sorted((r.start, r.end) for r in rows if r.alternateAlleles[0] == "<NON_REF>")
        assert 3 < len(blocks) < 600 and all(a[1] <= b[0] for a, b in zip(blocks, blocks[1:], strict=False))
        assert vcf.read_vcf(spark, str(tmp_path / "s.vcf")).count() == len(rows)


def test_somatic_calls_leave_germline_out(spark):
    somatic = {900: ("x", "snv", 1), 2000: ("x", "del", 1)}
    rng = random.Random(5)
    normal = simulated(rng, TRUTH, "n")
    tumor = simulated(rng, TRUTH, "t", 15) + [r | {"readName": r["readName"] + "x"} for r in simulated(rng, TRUTH | somatic, "t", 25, share=0.7)]
    shards = assembly.shards(frame(spark, normal + tumor), lengths(spark), 500)
    got = {r.start: r for r in assembly.call_shards(shards, callers.somatic_caller("t", "n"), callers.SOMATIC).collect()}
    assert set(got) == set(somatic)
    assert all((got[at].referenceAllele, got[at].alternateAlleles[0]) == expected(at, kind) for at, (_, kind, _) in somatic.items())
    flagged = assembly.call_shards(shards, callers.somatic_caller("t", "n", emit_filtered=True), callers.SOMATIC).collect()
    assert {r.start for r in flagged if r.filters == ["germline_risk"]} >= {200, 700, 1700, 2500}
    alone = {r.start for r in assembly.call_shards(shards, callers.somatic_caller("t"), callers.SOMATIC).collect()}
    assert alone >= set(somatic) | {700}
    panel = spark.createDataFrame([("c", 900)], "contigName string, start long")
    kept = vo.panel_of_normals(assembly.call_shards(shards, callers.somatic_caller("t", "n"), callers.SOMATIC), panel)
    assert [r.start for r in kept.collect()] == [2000]


def test_no_reads_and_reads_without_md(spark):
    rows = simulated(random.Random(2), {}, "s", 2)
    for r in rows:
        r["mismatchingPositions"] = None
    shards = assembly.shards(frame(spark, rows), lengths(spark), 500)
    assert assembly.call_shards(shards, callers.germline_caller("s", reference_confidence=True), callers.CALLS).count() == 0
    assert assembly.call_shards(shards.where("false"), callers.somatic_caller("s"), callers.SOMATIC).count() == 0


def two_alternates(rng: random.Random, at: int, sample: str, ref_share: float = 0.0) -> list[dict]:
    """Reads over a place where one copy has one alternate and the other another."""
    rows = []
    for r in simulated(rng, {}, sample, depth=30, errors=0.001):
        if r["start"] <= at < r["start"] + 100 and r["cigar"] == "100M":
            k = at - r["start"]
            base = GENOME[at] if rng.random() < ref_share else rng.choice([b for b in "ACGT" if b != GENOME[at]][:2])
            seq = GENOME[r["start"] : at] + base + GENOME[at + 1 : r["start"] + 100]
            r |= {"sequence": seq, "mismatchingPositions": "100" if base == GENOME[at] else f"{k}{GENOME[at]}{99 - k}"}
        rows.append(r)
    return rows


@pytest.mark.parametrize("confidence", [False, True])
def test_both_alternates_of_a_site_are_called(spark, confidence):
    at = 1500
    shards = assembly.shards(frame(spark, two_alternates(random.Random(3), at, "s")), lengths(spark), 500)
    rows = assembly.call_shards(shards, callers.germline_caller("s", reference_confidence=confidence), callers.CALLS).where("size(filter(alternateAlleles, x -> x <> '<NON_REF>')) > 0").collect()
    assert [r.start for r in rows] == [at]
    alts = [b for b in "ACGT" if b != GENOME[at]][:2]
    assert sorted(rows[0].alternateAlleles) == sorted([*alts, *(["<NON_REF>"] if confidence else [])]) and rows[0].genotypes[0].calls == [1, 2]
    assert len(rows[0].genotypes[0].phredLikelihoods) == (10 if confidence else 6)


def test_each_somatic_alternate_has_a_row(spark):
    at = 1500
    rng = random.Random(4)
    reads = simulated(rng, {}, "n") + two_alternates(rng, at, "t", 0.4)
    got = assembly.call_shards(assembly.shards(frame(spark, reads), lengths(spark), 500), callers.somatic_caller("t", "n"), callers.SOMATIC).collect()
    assert sorted((r.start, r.alternateAlleles[0]) for r in got) == sorted((at, b) for b in [b for b in "ACGT" if b != GENOME[at]][:2])
