"""Operators, sources and pipelines on literal fixtures and against small models."""

from __future__ import annotations

import gzip
import random
import struct

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helixframe.functions import genotypes, intervals as fi, sequence
from helixframe.model import READ
from helixframe.operators import assembly, genotyping, kernels, recalibration
from helixframe.operators import intervals as oi
from helixframe.operators import reads as ro
from helixframe.operators import variants as vo
from helixframe.plans import pipeline, stages
from helixframe.plans.params import Param, reference_genome, seconds
from helixframe.sources import alignments, binary, features, manifest, tables, vcf

# ---- intervals


def test_bins_against_a_model(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(300)] + [(None, 5), (5, None), (0, 0)]
    df = spark.createDataFrame(pairs, "start long, `end` long")
    for r in df.select("start", "end", fi.bins("start", "end", 100).alias("b")).collect():
        if r.start is None or r.end is None:
            assert r.b is None
            continue
        lo, hi = int(r.start / 100), int((r.end - 1) / 100)
        assert [(x.binId, x.isLastBin) for x in r.b] == [(k, k == hi) for k in range(lo, hi + 1)]


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_overlap_join_is_the_same_for_every_bin_size(spark, size):
    rng = random.Random(2)
    make = lambda n: [(rng.choice("ab"), s := rng.randrange(200), s + rng.randrange(30), k) for k in range(n)]
    left, right = make(60), make(40)
    a = spark.createDataFrame(left, "contigName string, start long, `end` long, id long")
    b = spark.createDataFrame(right, "c string, s long, e long, rid long")
    got = {(r.id, r.rid) for r in oi.overlap_pairs(a, b, oi.DEFAULT, ("c", "s", "e"), size).select("id", "rid").collect()}
    want = {(x[3], y[3]) for x in left for y in right if x[0] == y[0] and x[1] < y[2] and x[2] > y[1]}
    assert got == want
    assert oi.overlap_pairs(a, b, oi.DEFAULT, ("c", "s", "e"), size).count() == len(want)
    regions = b.withColumnsRenamed({"c": "contigName", "s": "start", "e": "end"})
    semi = sorted(r.id for r in oi.overlap_semi(a.unionAll(a), regions, size=size).collect())
    assert semi == sorted(2 * sorted({x for x, _ in want}))


def test_subtract_and_merge(spark):
    on = "contigName string, start long, `end` long"
    t = spark.createDataFrame([("c", 0, 10), ("c", 8, 20), ("d", 0, 5)], on)
    x = spark.createDataFrame([("c", 3, 5), ("c", 12, 12), ("c", 19, 30), ("d", 0, 5)], on)
    assert sorted(map(tuple, oi.subtract(t, x).collect())) == [("c", 0, 3), ("c", 5, 19)]
    assert sorted((r.start, r.end) for r in oi.merge(t).where("contigName = 'c'").collect()) == [(0, 20)]


def test_region_filter_has_one_schema(spark):
    rows = spark.createDataFrame([("c", 1, 3, "x"), ("c", 9, 12, "y"), ("d", 1, 3, "z")], "contigName string, start long, `end` long, v string")
    few = oi.region_filter(rows, [("c", 2, 4)])
    many = oi.region_filter(rows, [("c", 2, 4)], limit=0)
    assert few.columns == many.columns and few.collect() == many.collect()
    assert oi.region_filter(rows, []).count() == 0


# ---- reads


def test_quality_bins(spark):
    q = "".join(chr(x + 33) for x in (0, 10, 20, 25, 25, 22, 20, 19, 18))
    df = spark.createDataFrame([(q,)], "q string")
    out = df.select(sequence.bin_qualities("q", "0,20,10;20,50,40").alias("b")).first().b
    assert [ord(c) - 33 for c in out] == [10, 10, 40, 40, 40, 40, 40, 10, 10]
    with pytest.raises(ValueError, match="gap"):
        sequence.parse_quality_bins("0,5,1;6,9,2")
    with pytest.raises(ValueError, match="overlap"):
        sequence.parse_quality_bins("0,5,1;4,9,2")
    with pytest.raises(Exception, match="outside all bins"):
        df.select(sequence.bin_qualities("q", "0,20,10")).collect()


def test_read_score_and_strand(spark):
    df = spark.createDataFrame([("5" * 100, "AACG", True)], "q string, s string, neg boolean")
    r = df.select(sequence.read_score("q").alias("score"), sequence.on_strand("s", "neg", True).alias("s")).first()
    assert (r.score, r.s) == (2000, "CGTT")


def read(name: str, number: int = 0, start: int = 0, negative: bool = False, mapped: bool = True, primary: bool = True, quality: int = 20, contig: str = "c", cigar: str = "10M", **more):  # noqa: ANN003, ANN201
    base = dict.fromkeys(READ.names)
    base |= dict(readName=name, readInFragment=number, start=start if mapped else None, end=start + 10 if mapped else None, readMapped=mapped, readNegativeStrand=negative, primaryAlignment=primary and mapped, secondaryAlignment=not primary, supplementaryAlignment=False, qualityScores=chr(quality + 33) * 10, sequence="A" * 10, cigar=cigar if mapped else None, referenceName=contig if mapped else None, readGroupId="g", readGroupSampleId="s")
    return base | more


def duplicates(spark, rows: list[dict], libraries=None) -> dict:  # noqa: ANN001
    frame = spark.createDataFrame([tuple(r[n] for n in READ.names) for r in rows], READ)
    out = ro.to_reads(ro.mark_duplicates(ro.to_fragments(frame), libraries)).collect()
    return {(r.readName, r.readInFragment, r.primaryAlignment): r.duplicateRead for r in out}


def pair(name: str, a: int, b: int, **more):  # noqa: ANN003, ANN201
    return [read(name, 0, a, **more), read(name, 1, b, negative=True, **more)]


def test_duplicates_of_single_reads(spark):
    assert not duplicates(spark, [read("a")])[("a", 0, True)]
    d = duplicates(spark, [read("a", quality=20), read("b", quality=30), read("c", quality=25), read("d", start=100)])
    assert {k[0] for k, v in d.items() if v} == {"a", "c"}
    # forward and reverse reads differ in position even at the same start
    assert not any(duplicates(spark, [read("a"), read("b", negative=True)]).values())
    # clips move the five-prime position: starts differ, positions do not
    d = duplicates(spark, [read("a", start=10, quality=30), read("b", start=12, cigar="2S8M")])
    assert {k[0] for k, v in d.items() if v} == {"b"}


def test_duplicates_of_pairs(spark):
    d = duplicates(spark, [*pair("a", 0, 100), *pair("b", 0, 100, quality=30), *pair("c", 0, 150), read("single")])
    assert {k[0] for k, v in d.items() if v} == {"a", "single"}  # an unpaired read yields to pairs
    d = duplicates(spark, [*pair("a", 0, 100), *pair("b", 0, 100)])
    assert {k[0] for k, v in d.items() if v} == {"b"}  # ties: the first name stays


def test_duplicates_by_library_secondary_and_unmapped(spark):
    lib = spark.createDataFrame([("g", "l1"), ("h", "l2")], "readGroupId string, library string")
    d = duplicates(spark, [read("a"), read("b", readGroupId="h")], lib)
    assert not any(d.values())
    d = duplicates(spark, [read("a", quality=30), read("a", primary=False, start=500), read("u", mapped=False)])
    assert d[("a", 0, False)] and not d[("a", 0, True)] and not d[("u", 0, False)]


def test_pairing_against_the_scan(spark):
    rng = random.Random(3)
    names = {f"r{k}": [(n, i) for i, n in enumerate(sorted(rng.randrange(2) for _ in range(rng.randrange(6))))] for k in range(150)}
    flat = [(n, number, i) for n, own in names.items() for number, i in own]
    got = {(r.readName, r.readInFragment, r.o) for r in ro.pair_reads(spark.createDataFrame(flat, "readName string, readInFragment int, o int"), order="o").collect()}
    want = set()
    for n, own in names.items():
        zeros, ones = [x for x in own if x[0] == 0], [x for x in own if x[0] == 1]
        if len(zeros) % 2 and ones:
            want |= {(n, *zeros[-1]), (n, *ones[0])}
    assert got == want


def test_downsampling(spark):
    df = spark.createDataFrame([("c", s, f"r{k}", 0) for s in (1, 2) for k in range(5)], "referenceName string, start long, readName string, readInFragment int")
    assert ro.downsample(df, 1).count() == 2 and ro.downsample(df, 0).count() == 10


def test_cigars(spark):
    df = spark.createDataFrame([("3H2S10M1S4H", 10, 20, False), ("3H2S10M1S4H", 10, 20, True), ("10M", 1, 11, False), ("9S10M", 4, 14, False)], "c string, s long, e long, n boolean")
    assert [r.p for r in df.select(sequence.five_prime("s", "e", "c", "n").alias("p")).collect()] == [5, 25, 1, 0]
    assert [tuple(r.h) for r in df.select(sequence.hard_clips("c").alias("h")).collect()][0] == (3, 4)


def test_recalibration_counts_outside_known_sites(spark):
    rows = [("g", "c", 0, "ACGT", "IIII", "ACGA"), ("g", "c", 0, "ACGT", "IIII", "ACGA")]
    df = spark.createDataFrame(rows, "readGroupId string, referenceName string, start long, sequence string, qualityScores string, referenceBases string")
    sites = spark.createDataFrame([("c", 3)], "contigName string, start long")
    assert recalibration.recalibrate(df, None).count() == 4 and recalibration.recalibrate(df, sites).count() == 3


# ---- variants


def test_genotype_counts_and_validity(spark):
    df = spark.createDataFrame([(2, 50), (2, 2), (1, 5), (0, 3), (10, 1000)], "p int, n int")
    assert [r.c for r in df.select(genotypes.genotype_count("p", "n").alias("c")).collect()][:4] == [1275, 3, 5, 1]
    assert genotypes.most_alleles(2, 1275) == 50
    cases = [(1, 2, 0, 0, True), (1, 2, 2, 0, False), (1, 2, 3, 0, True), (1, 2, 9, 0, True), (1, 2, 0, 2, False), (1, 2, 0, 3, True), (3, 0, 1, 0, True), (None, 2, None, None, True)]
    rows = spark.createDataFrame(cases, "a int, cn int, pl int, gl int, want boolean")
    assert all(r.v == r.want for r in rows.select("want", genotypes.has_valid_pls("a", "cn", "pl", "gl").alias("v")).collect())


GVCF = """##fileformat=VCFv4.2
##FORMAT=<ID=AD,Number=R,Type=Integer,Description="depths">
##FORMAT=<ID=DP,Number=1,Type=Integer,Description="depth">
##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="quality">
##FORMAT=<ID=GT,Number=1,Type=String,Description="genotype">
##FORMAT=<ID=PL,Number=G,Type=Integer,Description="likelihoods">
##INFO=<ID=END,Number=1,Type=Integer,Description="end">
##INFO=<ID=DB,Number=0,Type=Flag,Description="flag">
##INFO=<ID=AF,Number=A,Type=Float,Description="frequency">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t{}
"""


def gvcf(folder, sample: str, *lines: str) -> str:  # noqa: ANN001
    path = folder / f"{sample}.g.vcf"
    path.write_text(GVCF.format(sample) + "".join(x.replace(" ", "\t") + "\n" for x in lines))
    return str(path)


@pytest.fixture()
def trio(tmp_path):
    return [
        gvcf(tmp_path, "S2", "c 11 . TCAC T,<NON_REF> 50 . DB;AF=0.5,NaN GT:AD:DP:GQ:PL 0/1:5,5,0:10:99:150,0,150,200,200,300"),
        gvcf(tmp_path, "S1", "c 11 . T G,<NON_REF> . PASS . GT:DP:GQ:PL 1|1:8:24:300,24,0,300,24,300", "c 12 . C <NON_REF> . . END=20 GT:DP:GQ:PL 0/0:9:27:0,27,300"),
        gvcf(tmp_path, "S3", "c 13 rs1;rs2 A T,<NON_REF> 9.5 . . GT:DP:GQ:PL 0/1:7:99:120,0,110,150,120,200"),
    ]


def test_vcf_rows(spark, trio):
    head = vcf.header_of(spark, trio)
    assert head.samples == ("S1", "S2", "S3")
    rows = {(r.start, r.genotypes[0].sampleId): r for r in vcf.read_vcf(spark, trio).collect()}
    first = rows[(10, "S2")]
    assert (first.end, first.alternateAlleles, first.INFO_DB, first.INFO_AF[0]) == (14, ["T", "<NON_REF>"], True, 0.5) and first.INFO_AF[1] != first.INFO_AF[1]
    assert first.genotypes[0].calls == [0, 1] and first.genotypes[0].alleleDepths == [5, 5, 0] and not first.genotypes[0].phased
    assert rows[(10, "S1")].genotypes[0].phased and rows[(11, "S1")].end == 20
    assert rows[(12, "S3")].names == ["rs1", "rs2"] and rows[(12, "S3")].INFO_DB is False and rows[(11, "S1")].qual is None
    assert vcf.read_sites(spark, trio).count() == 4


@pytest.mark.parametrize("codec", ["", "gzip", "bgzf"])
def test_vcf_round_trip(spark, trio, tmp_path, codec):
    rows = vcf.read_vcf(spark, trio)
    path = str(tmp_path / f"out.vcf{vcf.extension(codec)}")
    vcf.write_single(rows, path, ["S1", "S2", "S4"], codec=codec)
    text = (gzip.open(path) if codec else open(path, "rb")).read().decode().splitlines()
    body = [x.split("\t") for x in text if not x.startswith("#")]
    assert [int(x[1]) for x in body] == sorted(int(x[1]) for x in body) and len(body) == 4
    assert text[[x.startswith("#CHROM") for x in text].index(True)].endswith("S1\tS2\tS4")
    assert all(x[11].startswith("./.") for x in body)  # a sample that no row has
    vcf.write_sharded(rows.repartition(2), str(tmp_path / "shards"), ["S1"], codec=codec)
    for written, samples in ((path, 3), (str(tmp_path / "shards"), 1)):
        again = vcf.read_vcf(spark, written)
        assert sorted((r.contigName, r.start, r.end, len(r.genotypes)) for r in again.collect()) == sorted((r.contigName, r.start, r.end, samples) for r in rows.collect())


def test_unknown_codec():
    with pytest.raises(ValueError, match="unknown compression"):
        vcf.extension("zip")


def test_validation_and_splitting(spark, tmp_path):
    path = gvcf(tmp_path, "S", "c 1 . A T 1 . . GT:PL 0/1:1,2,3", "c 2 . A T 1 . . GT:PL 0/1:1,2", "c 3 . A T 1 . . GT 0/1")
    rows = vcf.read_vcf(spark, path)
    assert vo.validate_likelihoods(rows, "LENIENT").count() == 2
    with pytest.raises(Exception, match="too few genotype likelihoods at c:1"):
        vo.validate_likelihoods(rows, "STRICT").collect()
    many = rows.withColumn("genotypes", F.concat("genotypes", "genotypes", "genotypes"))
    out = vo.split_samples(many)
    assert out.count() == 9 and out.where("size(genotypes) = 1").count() == 9 and out.columns == many.columns


def test_bands(spark, tmp_path):
    lines = [f"c {p} . A <NON_REF> . . END={p} GT:DP:GQ:PL 0/0:9:{q}:0,{q},{pl}" for p, q, pl in ((10, 9, 99), (11, 15, 208), (12, 15, 203), (13, 15, 207), (14, 15, 214), (16, 15, 200))]
    rows = vcf.read_vcf(spark, gvcf(tmp_path, "S", *lines, "c 15 . A T,<NON_REF> 9 . . GT:DP:GQ:PL 0/1:9:15:9,0,9,9,9,9"))
    out = sorted((r.start, r.end, list(r.pls)[:3], r.sites) for r in vo.gvcf_bands(rows, list(range(1, 60))).collect())
    assert out == [(9, 10, [0, 9, 99], 1), (10, 14, [0, 15, 203], 4), (14, 15, [9, 0, 9], 1), (15, 16, [0, 15, 200], 1)]


def test_site_index(spark):
    sites = spark.createDataFrame([("13", 752790), ("13", 752720), ("2", 19189), ("1", 14521), ("1", 63734), ("1", 14396)], "contigName string, start long")
    assert sorted(map(tuple, vo.snp_index(sites).collect())) == [("1", 0, 2), ("13", 3, 4), ("2", 5, 5)]
    region = spark.createDataFrame([("13", 752700, 752800)], "c string, s long, e long")
    assert {r.start for r in oi.masked_sites(sites, region, ("contigName", "start"), ("c", "s", "e")).collect()} == {752720, 752790}


def test_joint_calls(spark, trio):
    rows = vcf.read_vcf(spark, trio)
    for size in (5000, 1, 2):
        called = {(r.start, r.referenceAllele, tuple(sorted(r.alternateAlleles))): r for r in genotyping.genotype(rows, ["S1", "S2", "S3"], size).collect()}
        assert set(called) == {(10, "TCAC", ("GCAC", "T")), (12, "A", ("*", "T"))}
        r = called[(12, "A", ("*", "T"))]
        named = {g.sampleId: sorted(([r.referenceAllele, *r.alternateAlleles])[c] for c in g.calls) for g in r.genotypes}
        assert named == {"S1": ["A", "A"], "S2": ["*", "A"], "S3": ["A", "T"]}
        assert next(g for g in called[(10, "TCAC", ("GCAC", "T"))].genotypes if g.sampleId == "S3").calls == [-1, -1]
    with pytest.raises(Exception, match="does not contain samples"):
        genotyping.genotype(rows, ["S1", "S2"]).collect()


def test_joint_calls_skip_sites_of_many_alternates():
    rows = {f"s{k}": [{"start": 0, "end": 1, "ref": "A", "alts": ["A" + "C" * (k + 1), "<NON_REF>"], "pls": [300, 30, 0, 300, 30, 300], "depth": 9}] for k in range(21)}
    assert genotyping.call_locus("c", 0, rows, sorted(rows), most_alts=20) is None
    assert genotyping.call_locus("c", 0, rows, sorted(rows), most_alts=21) is not None


# ---- assembly and kernels


def test_padded_shards_call_each_site_once(spark):
    reference = {"c": "ACGT" * 50}
    bases = list(reference["c"])
    bases[99] = "G" if bases[99] != "G" else "A"
    rows = [("c", s, s + 20, f"r{s}", 0, "".join(bases[s : s + 20])) for s in range(80, 115)]
    reads = spark.createDataFrame(rows, "referenceName string, start long, `end` long, readName string, readInFragment int, sequence string")
    lengths = spark.createDataFrame([("c", 200)], "contigName string, length long")
    for size in (10, 100, 1000):
        calls = assembly.call_shards(assembly.shards(reads, lengths, size, 25), kernels.pileup_caller(reference), kernels.PILEUP).collect()
        assert [(r.start, r.depth) for r in calls] == [(99, 20)]


def test_base_batches():
    rows = [("a", "AC"), ("b", "G"), ("c", "GT"), ("d", "A")]
    assert [len(b) for b in kernels.base_batches(iter(rows), 1, 3)] == [2, 2]


def test_pipe_to_a_process(spark):
    raw = spark.createDataFrame([("r1", 0, bytearray(b"AC"), "II"), ("r2", 0, bytearray(b"GT"), "II")], "readName string, readInFragment int, sequence binary, qualityScores string").coalesce(1)
    got = [r.value for r in kernels.piped(raw, ["cat"]).collect()]
    assert len(got) == 6 and "AC" in got and got[2].startswith("+") or "AC" in got
    with pytest.raises(Exception, match="failed"):
        kernels.piped(raw, ["false"]).collect()


# ---- sources


SAM = "@HD\tVN:1.6\n@SQ\tSN:c\tLN:100\n@RG\tID:g\tSM:s\tLB:l\nr1 x\t99\tc\t11\t60\t2S3M1D2M\t=\t31\t30\tACGTACG\tIIIIIII\tRG:Z:g\tNM:i:1\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tACGT\tIIII\n"


def test_sam_rows_and_export(spark, tmp_path):
    path = tmp_path / "a.sam"
    path.write_text(SAM)
    rows = {r.readName: r for r in alignments.read_sam(spark, str(path)).collect()}
    r = rows["r1"]
    assert (r.start, r.end, r.mateReferenceName, r.mateAlignmentStart, r.readGroupId, r.properPair, r.readInFragment) == (10, 16, "c", 30, "g", True, 0)
    assert not rows["r2"].readMapped and rows["r2"].start is None
    assert features.read_dictionary(spark, str(path)).collect() == [("c", 100)]
    assert alignments.read_groups(spark, str(path)).collect() == [("g", "s", "l")]
    reads = alignments.read_sam(spark, str(path))
    alignments.write_sam(reads, str(tmp_path / "one.sam"), ["@HD\tVN:1.6"], single=True, sort=True)
    assert (tmp_path / "one.sam").read_text().splitlines()[1] == "r1\t99\tc\t11\t60\t2S3M1D2M\t=\t31\t30\tACGTACG\tIIIIIII\tRG:Z:g\tNM:i:1"
    alignments.write_bam(reads, str(tmp_path / "one.bam"), ["@HD\tVN:1.6"], [("c", 100)], single=True, sort=True)
    raw = (tmp_path / "one.bam").read_bytes()
    assert raw.endswith(binary.BGZF_END)
    data = gzip.decompress(raw)
    assert data[:4] == b"BAM\1" and data.count(b"r1\0") == 1
    at = 8 + struct.unpack_from("<i", data, 4)[0] + 4 + 4 + 2 + 4
    assert struct.unpack_from("<ii", data, at + 4) == (0, 10)
    alignments.write_bam(reads, str(tmp_path / "many"), ["@HD\tVN:1.6"], [("c", 100)])
    assert (tmp_path / "many" / "_SUCCESS").exists()


def test_fastq(spark, tmp_path):
    path = tmp_path / "a.fq"
    path.write_text("@r1/1 extra\nACGT\n+\nIIII\n@r2/2\nAC\n+\n@@\n")
    assert sorted((r.readName, r.readInFragment, bytes(r.sequence)) for r in alignments.read_fastq(spark, str(path)).collect()) == [("r1", 0, b"ACGT"), ("r2", 1, b"AC")]
    path.write_text("@r1\nACGT\n+\nIII\n")
    with pytest.raises(Exception, match="malformed"):
        alignments.read_fastq(spark, str(path)).collect()
    assert alignments.read_fastq(spark, str(path), stringency="LENIENT").count() == 0


def test_feature_formats(spark, tmp_path):
    files = {
        "a.bed": "track x\nc\t4\t10\tn\t5\t+\n", "a.narrowPeak": "c\t4\t10\tn\t5\t+\t1\t2\t3\t4\n", "a.gtf": '#!x\nc\tsrc\texon\t5\t10\t.\t+\t.\tgene_id "G"; transcript_id "T"; exon_number "1";\n',
        "a.gff3": "##gff\nc\tsrc\texon\t5\t10\t.\t+\t.\tID=e;transcript_id=T;gene_id=G\n", "a.interval_list": "@HD\tVN:1\nc\t5\t10\t+\tn\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
        r = features.read_features(spark, str(tmp_path / name)).first()
        assert (r.referenceName, r.start, r.end) == ("c", 4, 10), name
        if name.endswith(("gtf", "gff3")):
            assert (r.featureType, r.transcriptId, r.geneId) == ("exon", "T", "G")
    with pytest.raises(ValueError, match="unknown feature format"):
        features.read_features(spark, "a.txt")


def test_manifests(spark, tmp_path):
    sheet = "sample_id,file_path,paired_end,read_group_id\ns1,a_1.fq,1,g1\ns1,a_2.fq,2,g1\ns1,/abs/b.fq,,g2\ns2,s3://x/c.bam,,g1\n"
    path = tmp_path / "m.csv"
    path.write_text(sheet)
    got = {r.sample_id: [(g.read_group_id, g.input, g.secondInput) for g in r.read_groups] for r in manifest.load_samples(spark, str(path)).collect()}
    assert got["s1"] == [("g1", f"{tmp_path}/a_1.fq", f"{tmp_path}/a_2.fq"), ("g2", "/abs/b.fq", None)] and got["s2"] == [("g1", "s3://x/c.bam", None)]
    blob = {r.sample_id: r.read_groups[0].input for r in manifest.load_samples(spark, sheet).collect()}
    assert blob["s1"] == "a_1.fq"
    with pytest.raises(Exception, match="cannot be empty"):
        manifest.load_samples(spark, "file_path,sample_id,paired_end,read_group_id\na,s,,\n").collect()
    with pytest.raises(Exception, match="two files"):
        manifest.load_samples(spark, "file_path,sample_id,paired_end,read_group_id\na,s,1,g\n").collect()
    with pytest.raises(ValueError, match="expected columns"):
        manifest.load_samples(spark, "a,b\n1,2\n")
    pairs = "pair_id,file_path,sample_id,label,paired_end,read_group_id\np,a,t,tumor,,g\np,b,n,normal,,g\n"
    r = manifest.load_pairs(spark, pairs).first()
    assert [(s.label, s.sample_id) for s in r.samples] == [("normal", "n"), ("tumor", "t")]
    assert manifest.resolve("/m/x.csv", "../y/*.vcf") == "/y/*.vcf" and manifest.resolve("hdfs://h/m/x.csv", "y") == "hdfs://h/m/y"
    assert manifest.file_list(spark, "a.vcf\nb.vcf\n") == ["a.vcf", "b.vcf"]
    with pytest.raises(ValueError):
        manifest.file_list(spark, "")


def test_partition_replacement(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda ids, v: spark.createDataFrame([(i, v + i) for i in ids], "id int, value int")
    tables.replace_partitions(frame(range(5), 1), path, "id", list(range(5)))
    tables.replace_partitions(frame(range(3), 2), path, "id", [0, 1, 2])
    assert {r.id: r.value for r in spark.read.parquet(path).collect()} == {0: 2, 1: 3, 2: 4, 3: 4, 4: 5}
    tables.replace_partitions(frame([0], 9), path, "id", [0, 1])
    assert {r.id for r in spark.read.parquet(path).collect()} == {0, 2, 3, 4}
    with pytest.raises(Exception, match="outside the replaced"):
        tables.replace_partitions(frame([0, 7], 9), path, "id", [0])
    with pytest.raises(ValueError):
        tables.replace_partitions(frame([0], 9), path, "id", [])
    assert tables.table_exists(spark, path) and tables.table_exists(spark, path, "id", [0, 2]) and not tables.table_exists(spark, path, "id", [1])
    assert not tables.table_exists(spark, str(tmp_path / "none")) and tables.complete(spark, path)
    assert tables.load(spark, f"{path}/id=2").count() == 1
    with pytest.raises(ValueError, match="no rows"):
        tables.load(spark, f"{path}/id=99")


def test_save_modes(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    tables.save(df, path)
    tables.save(df, path)
    tables.save(df, path, "ignore")
    assert spark.read.parquet(path).count() == 6
    tables.save(df, path, "overwrite")
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="(?i)already exists"):
        tables.save(df, path, "errorIfExists")
    with pytest.raises(ValueError, match="unknown save mode"):
        tables.save(df, path, "merge")


# ---- pipelines


class Double(pipeline.Stage):
    name = "Double"
    params = (Param("value", "a number", int), Param("out", "where", str, "x"))
    outputs = ("value",)

    def __init__(self, log: list, exists: bool = False) -> None:
        super().__init__()
        self.log, self.exists = log, exists

    def execute(self, spark) -> None:  # noqa: ANN001
        self.values["value"] *= 2
        self.log.append(self.values["value"])

    def output_exists(self, spark) -> bool:  # noqa: ANN001
        return self.exists


def test_outputs_of_earlier_stages_count(spark):
    log: list = []
    p = pipeline.Pipeline("p", [Double(log), Double(log)]).init({"value": "3"})
    p.execute(spark)
    assert log == [6, 12]
    with pytest.raises(ValueError, match="unrecognized: a, b"):
        p.init({"b": 1, "a": 2, "value": 3})
    assert [(v["name"], v["required"]) for v in p.visible_params()] == [("out", False), ("replayMode", False), ("value", True)]


def test_replay(spark):
    log: list = []
    pipeline.Pipeline("p", [Double(log, exists=True)]).init({"value": 3}).execute(spark)
    assert log == []
    pipeline.Pipeline("p", [Double(log, exists=True)]).init({"value": 3, "replayMode": "overwrite"}).execute(spark)
    assert log == [6]
    with pytest.raises(ValueError, match="replay mode"):
        pipeline.Pipeline("p", [Double(log)]).init({"value": 3, "replayMode": "again"}).execute(spark)


def test_params():
    assert Param("b", kind=bool).coerce("TRUE") is True and Param("i", kind=int).coerce("4") == 4
    with pytest.raises(ValueError):
        Param("b", kind=bool).coerce("yes")
    assert seconds("12h") == 43_200 and seconds("90 seconds") == 90
    with pytest.raises(ValueError, match="unit"):
        seconds("12")
    assert reference_genome("/r/my.fasta")[1] == "my"
    with pytest.raises(ValueError, match="unknown reference genome"):
        reference_genome(None, "none")


def test_many_samples(spark):
    done, log = [], []

    class Work(Double):
        def __init__(self, sample: str) -> None:
            super().__init__(log)
            self.sample = sample

        def execute(self, spark) -> None:  # noqa: ANN001
            if self.sample == "bad":
                raise ValueError("broken")
            if self.sample == "slow":
                spark.range(1).mapInPandas(lambda it: (pd.DataFrame({"id": [__import__("time").sleep(30) or 1]}) for _ in it), "id long").collect()
            done.append(self.sample)

    m = pipeline.MultiSample("m", lambda s, text: [(x, x) for x in text.split()], lambda x: pipeline.Pipeline(x, [Work(x)]))
    m.init({"manifest": "a bad slow b", "perSampleTimeout": "4s", "value": 1})
    with pytest.raises(RuntimeError, match="failed samples: bad, slow"):
        m.execute(spark, concurrent=2)
    assert sorted(done) == ["a", "b"] and isinstance(m.failed["slow"], TimeoutError)
    with pytest.raises(ValueError, match="manifest"):
        m.init({})


def test_stage_mask_and_pairs():
    with pytest.raises(ValueError, match="at least one"):
        pipeline.stages_of(False, False, lambda: None, lambda: None)
    assert stages.split_pair([("normal", "n", []), ("tumor", "t", [])]) == (("t", []), ("n", []))
    with pytest.raises(ValueError, match="exactly one tumor"):
        stages.split_pair([("normal", "n", [])])


def test_joint_pipeline_end_to_end(spark, trio, tmp_path):
    p = stages.joint_pipeline().init({"manifest": "\n".join(trio), "gvcfDeltaOutput": str(tmp_path / "rows"), "callVariantOutput": str(tmp_path / "calls"), "exportVCF": True, "callVariantOutputVCF": str(tmp_path / "out.vcf")})
    p.execute(spark)
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 4
    assert vcf.read_vcf(spark, str(tmp_path / "out.vcf")).count() == spark.read.parquet(str(tmp_path / "calls")).count() == 2
    with pytest.raises(ValueError, match="needs a table"):
        stages.JointlyCallVariants().rows(spark)


def test_germline_pipeline_end_to_end(spark, tmp_path):
    reference = {"c": "ACGT" * 50}
    bases = list(reference["c"])
    bases[99] = "G"
    (tmp_path / "a.fq").write_text("".join(f"@r{s}\n{''.join(bases[s : s + 20])}\n+\n{'I' * 20}\n" for s in range(80, 115)))

    def place(raw):  # noqa: ANN001, ANN202
        """An aligner that reads the start from the name."""
        known = {"start": F.substring("readName", 2, 9).cast("long"), "referenceName": F.lit("c"), "mappingQuality": F.lit(60), "cigar": F.lit("20M"), "readMapped": F.lit(True), "primaryAlignment": F.lit(True), "sequence": F.col("sequence").cast("string"), "readName": F.col("readName"), "qualityScores": F.col("qualityScores"), "readInFragment": F.col("readInFragment")}
        known["end"] = known["start"] + 20
        flags = {"readPaired", "properPair", "mateMapped", "failedVendorQualityChecks", "duplicateRead", "readNegativeStrand", "mateNegativeStrand", "secondaryAlignment", "supplementaryAlignment"}
        return raw.select(*((known[f.name] if f.name in known else F.lit(False) if f.name in flags else F.lit(None)).cast(f.dataType).alias(f.name) for f in READ.fields))

    lengths = lambda s: s.createDataFrame([("c", 200)], "contigName string, length long")
    m = stages.germline_pipeline(place, lengths, kernels.pileup_caller(reference), kernels.PILEUP)
    sheet = f"file_path,sample_id,paired_end,read_group_id\n{tmp_path}/a.fq,s1,,g\n{tmp_path}/a.fq,s2,,g\n"
    m.init({"manifest": sheet, "alignmentOutput": str(tmp_path / "reads"), "callVariantOutput": str(tmp_path / "calls"), "markDuplicates": True})
    m.execute(spark, concurrent=2)
    calls = spark.read.parquet(str(tmp_path / "calls")).collect()
    assert sorted((r.sampleId, r.start) for r in calls) == [("s1", 99), ("s2", 99)]  # one sample never erases another


def test_provenance(spark, tmp_path):
    chain = pipeline.extend(pipeline.extend([], "align", "1", "a"), "mark", "1", "b")
    assert [s.previous_id for s in chain] == [None, "align-0"]
    pipeline.save_chain(spark, chain, str(tmp_path / "x"))
    assert pipeline.load_chain(spark, str(tmp_path / "x")) == chain


def test_fuzzy_and_duration(spark):
    df = spark.createDataFrame([(1.0, 1.0000005, 3725), (1.0, 1.1, 0), (2.0, 1.0, 59)], "a double, b double, s long")
    got = [tuple(r) for r in df.select(genotypes.nearly_equal("a", "b"), genotypes.nearly_less("a", "b"), genotypes.nearly_greater_equal("a", "b"), genotypes.duration("s")).collect()]
    assert got == [(True, False, True, "1h2m5s"), (False, True, False, "0h0m0s"), (False, False, True, "0h0m59s")]


def test_sql_functions(spark):
    from helixframe.functions.sql import register

    register(spark)
    row = spark.sql("select overlaps(0, 5, 4, 9) a, overlaps(0, 4, 4, 9) b, genotype_count(2, 50) c, has_valid_pls(1, 2, 2, 0) d, has_valid_pls(1, 2, 3, 0) e, has_valid_pls(1, 2, 0, 0) f").first()
    assert tuple(row) == (True, False, 1275, False, True, True)
    got = spark.sql("select inline(b) from (select bins(s, e, 10) as b from values (5L, 25L), (-15L, 3L), (4L, 4L), (null, 3L) t(s, e))").collect()
    assert [tuple(r) for r in got] == [(0, False), (1, False), (2, True), (-1, False), (0, True), (0, True)]


def test_recalibrated_reads(spark):
    rows = [("g", "c", 0, "ACGT", "IIII", "ACGA"), ("g", "c", 0, "ACGT", "IIII", "ACGA"), ("h", "c", 0, "", "", "")]
    df = spark.createDataFrame(rows, "readGroupId string, referenceName string, start long, sequence string, qualityScores string, referenceBases string")
    out = recalibration.apply_recalibration(df, recalibration.recalibrate(df, None)).collect()
    changed = [r.qualityScores for r in out if r.readGroupId == "g"]
    assert len(changed) == 2 and all(len(q) == 4 and q[3] < q[0] for q in changed)
    assert next(r for r in out if r.readGroupId == "h").qualityScores == ""


def test_files_behind_paths(spark, trio, tmp_path):
    assert len(tables.list_files(spark, str(tmp_path / "*.g.vcf"))) == 3
    groups = spark.createDataFrame([("g", "t"), ("h", "x")], "readGroupId string, sample string")
    assert [r.readGroupId for r in ro.of_samples(groups, ["t", "n"]).collect()] == ["g"]
