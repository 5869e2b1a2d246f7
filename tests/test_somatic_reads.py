"""Palindrome artefacts and piles of reads against brute force; FASTA in parts."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from helixframe.model import READ
from helixframe.operators import somatic
from helixframe.plans import stages
from helixframe.sources import fasta

RNG = random.Random(11)
GENOME = {"c": "".join(RNG.choice("ACGT") for _ in range(3000)), "d": "".join(RNG.choice("ACGT") for _ in range(900))}


def complement(x: str) -> str:
    return x[::-1].translate(str.maketrans("ACGT", "TGCA"))


def write_fasta(path, width: int = 60) -> str:  # noqa: ANN001
    path.write_text("".join(f">{name} some words\n" + "\n".join(bases[k : k + width].lower() if k % 3 else bases[k : k + width] for k in range(0, len(bases), width)) + "\n\n" for name, bases in GENOME.items()) + ">empty\n")
    return str(path)


@pytest.mark.parametrize(("split", "piece"), [(1 << 20, 10_000), (500, 64), (61, 7)])
def test_fasta_in_parts(spark, tmp_path, split, piece):
    path = write_fasta(tmp_path / "g.fa")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = fasta.read_fasta(spark, path, piece).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert all(r.end - r.start == len(r.bases) <= piece for r in rows)
    for name, bases in GENOME.items():
        assert "".join(r.bases for r in sorted(rows, key=lambda r: r.start) if r.contigName == name) == bases
    assert {r.contigName for r in rows} == set(GENOME)


def test_windows(spark, tmp_path):
    pieces = fasta.read_fasta(spark, write_fasta(tmp_path / "g.fa"), 50)
    asked = [("c", 0, 10), ("c", 45, 160), ("d", 890, 900), ("d", 895, 901), ("x", 0, 5), ("c", 45, 160)]
    got = {(r.contigName, r.start, r.end): r.bases for r in fasta.windows_of(pieces, spark.createDataFrame(asked, "contigName string, start long, end long")).collect()}
    assert got == {(c, s, e): GENOME[c][s:e] for c, s, e in asked[:3]}


def read(k: int, rng: random.Random) -> dict:
    """A read of a pair, with or without an artefact at the end where one may be."""
    c, size = rng.choice(["c", "d"]), rng.choice([120, 200, 300])
    at = rng.randrange(20, len(GENOME[c]) - 320)
    up, clip = rng.random() < 0.5, rng.choice([0, 3, 8, 20])
    n = 80
    aligned = GENOME[c][at : at + n - clip] if up else GENOME[c][at + size - (n - clip) : at + size]
    span = clip + 5
    other = complement(GENOME[c][at + size - span : at + size] if up else GENOME[c][at : at + span])
    kind = rng.choice(["artefact", "noise", "near"])
    if up:
        tail = other[:clip] if kind != "noise" else "".join(rng.choice("ACGT") for _ in range(clip))
        seq = tail + (other[clip:] + aligned[5:] if kind != "noise" else aligned)
    else:
        tail = other[5:] if kind != "noise" else "".join(rng.choice("ACGT") for _ in range(clip))
        seq = (aligned[:-5] + other[:5] if kind != "noise" else aligned) + tail
    if kind == "near" and clip:  # too many differences
        where = 0 if up else len(seq) - span
        seq = seq[:where] + "".join("N" if j % 4 == 0 else b for j, b in enumerate(seq[where : where + span])) + seq[where + span :]
    row = {f.name: None for f in READ.fields}
    start = at if up else at + size - (n - clip)
    body = f"{n - clip}M"
    row |= {"referenceName": c, "start": start, "end": start + n - clip, "readName": f"r{k}", "readInFragment": 0 if up else 1, "sequence": seq, "qualityScores": "".join(chr(33 + j % 40) for j in range(len(seq))), "mappingQuality": 60}
    row |= {"cigar": (f"{clip}S{body}" if up else f"{body}{clip}S") if clip else body, "insertSize": size if up else -size, "mateAlignmentStart": at + size - 80 if up else at, "readNegativeStrand": not up, "mateNegativeStrand": up, "readMapped": True, "mateMapped": True, "readPaired": True, "properPair": rng.random() < 0.9}
    return row | dict.fromkeys(("secondaryAlignment", "duplicateRead", "failedVendorQualityChecks", "supplementaryAlignment"), False) | {"primaryAlignment": True}


def brute(r: dict) -> tuple[str, str, str]:
    seq, qual, cigar = r["sequence"], r["qualityScores"], r["cigar"]
    up = r["insertSize"] > 0
    clip = int(cigar.split("S")[0]) if up and "S" in cigar else int(cigar.split("M")[1][:-1]) if "S" in cigar else 0
    if not r["properPair"] or not clip:
        return seq, qual, cigar
    n = min(clip + 5, len(seq))
    lo = r["start"] + r["insertSize"] - n if up else r["mateAlignmentStart"]
    if up and lo < r["start"] or not up and lo + n > r["end"]:
        return seq, qual, cigar
    want = complement(GENOME[r["referenceName"]][lo : lo + n])
    own = seq[:n] if up else seq[-n:]
    if sum(a == b for a, b in zip(own, want, strict=True)) < 0.9 * n:
        return seq, qual, cigar
    return (seq[clip:], qual[clip:], f"{clip}H{cigar.split('S')[1]}") if up else (seq[:-clip], qual[:-clip], f"{cigar.split('M')[0]}M{clip}H")


def frame(spark, rows: list[dict]):  # noqa: ANN001, ANN201
    return spark.createDataFrame([tuple(r[f.name] for f in READ.fields) for r in rows], READ)


def test_palindromes_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [read(k, rng) for k in range(300)]
    rows += [rows[0], {**rows[1], "sequence": None}, {**rows[2], "insertSize": None}, {**rows[3], "cigar": None}, {**rows[4], "start": None, "end": None}]
    out = somatic.clip_palindromes(frame(spark, rows), fasta.read_fasta(spark, write_fasta(tmp_path / "g.fa"), 70))
    got = sorted(((r.readName, r.sequence, r.qualityScores, r.cigar) for r in out.collect()), key=repr)
    plain = lambda r: None in (r["sequence"], r["insertSize"], r["cigar"], r["start"])
    want = sorted(((r["readName"], *((r["sequence"], r["qualityScores"], r["cigar"]) if plain(r) else brute(r))) for r in rows), key=repr)
    assert got == want and sum("H" in (x[3] or "") for x in got) > 30
    assert out.columns == [f.name for f in READ.fields]


@pytest.mark.parametrize(("most", "suspicious", "stride"), [(3, 0, 1), (2, 3, 1), (2, 2, 10), (0, 2, 5), (0, 0, 1)])
def test_piles_against_brute_force(spark, most, suspicious, stride):
    rng = random.Random(most + stride)
    base = {f.name: None for f in READ.fields}
    rows = [base | {"referenceName": rng.choice(["c", "d"]), "start": rng.randrange(60), "readName": f"n{k}", "readInFragment": k % 2, "mappingQuality": rng.choice([None, 10, 50, 51, 60])} for k in range(500)]
    rows += [base | {"readName": "u", "mappingQuality": 0}] * 3
    got = [(r.referenceName, r.start, r.readName) for r in somatic.thin_piles(frame(spark, rows), most, suspicious, stride).collect()]
    piles = defaultdict(list)
    for r in rows:
        if r["start"] is not None:
            piles[r["referenceName"], r["start"] // stride].append(r)
    left = defaultdict(int)
    for c, start, _ in got:
        if start is not None:
            left[c, start // stride] += 1
    for key, own in piles.items():
        bad = suspicious and sum((r["mappingQuality"] or 0) <= 50 for r in own) >= suspicious * stride
        assert left[key] == (0 if bad else min(len(own), most * stride) if most else len(own)), key
    assert sum(c is None for c, *_ in got) == 3 and len({x for x in got if x[0]}) == len([x for x in got if x[0]])


def test_the_stage_clips_and_thins(spark, tmp_path):
    rng = random.Random(8)
    frame(spark, [read(k, rng) for k in range(60)]).write.parquet(str(tmp_path / "reads" / "sampleId=t"))
    seen: list = []
    import pandas as pd

    def caller(contig, lo, hi, reads):  # noqa: ANN001, ANN202
        return pd.DataFrame([(contig, int(s), int(s) + 1, c, len(q)) for s, c, q in zip(reads["start"], reads["cigar"], reads["sequence"], strict=True)], columns=["contigName", "start", "end", "cigar", "bases"])

    stage = stages.CallMutations("p", "t", None, lambda s: s.createDataFrame([(c, len(b)) for c, b in GENOME.items()], "contigName string, length long"), caller, "contigName string, start bigint, end bigint, cigar string, bases int", alignmentOutputTumor=str(tmp_path / "reads"), callVariantOutput=str(tmp_path / "calls"), referenceFasta=write_fasta(tmp_path / "g.fa"), maxReadStartsPerPosition=1, downsamplingStride=1)
    stage.execute(spark)
    seen = spark.read.parquet(str(tmp_path / "calls")).collect()
    assert any("H" in r.cigar for r in seen) and len({(r.contigName, r.start) for r in seen}) == len(seen)
