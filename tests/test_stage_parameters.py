"""Parameters and inputs of stages that used to be accepted and not acted on."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helixframe.model import READ
from helixframe.operators import assembly, kernels
from helixframe.operators import reads as ro
from helixframe.operators import variants as vo
from helixframe.plans import pipeline, stages
from helixframe.sources import alignments, vcf

FLAGS = {"readPaired", "properPair", "mateMapped", "failedVendorQualityChecks", "duplicateRead", "readNegativeStrand", "mateNegativeStrand", "secondaryAlignment", "supplementaryAlignment"}


def placed(md):  # noqa: ANN001, ANN201
    """An aligner that puts every read at 10."""

    def run(raw):  # noqa: ANN001, ANN202
        known = {c: F.col(c) for c in ("readName", "qualityScores", "readInFragment")} | {"sequence": F.col("sequence").cast("string"), "start": F.lit(10), "end": F.lit(14), "referenceName": F.lit("c"), "mappingQuality": F.lit(60), "cigar": F.lit("4M"), "readMapped": F.lit(True), "primaryAlignment": F.lit(True), "mismatchingPositions": F.lit(md)}
        return raw.select(*((known[f.name] if f.name in known else F.lit(f.name == "none") if f.name in FLAGS else F.lit(None)).cast(f.dataType).alias(f.name) for f in READ.fields))

    return run


@pytest.mark.parametrize("known", [False, True])
def test_align_recalibrates(spark, tmp_path, known):
    (tmp_path / "a.fq").write_text("".join(f"@r{k}\nACGT\n+\nIIII\n" for k in range(30)))
    (tmp_path / "k.vcf").write_text("##x\nc\t12\t.\tCGT\tC\t.\t.\t.\n")
    values = {"alignmentOutput": str(tmp_path / "out"), "recalibrateBaseQualities": True} | ({"knownSites": str(tmp_path / "k.vcf")} if known else {})
    stage = stages.Align("s", [("g", str(tmp_path / "a.fq"), None)], placed("3A0"), **values)
    stage.execute(spark)
    rows = spark.read.parquet(stage.path).collect()
    assert len(rows) == 30 and {r.originalQualityScores for r in rows} == {"IIII"}
    got = {r.qualityScores for r in rows}
    assert len(got) == 1
    q = got.pop()
    assert (q[3] == "I") if known else (q[3] < q[0])  # the mismatch lies in a known site or lowers its cell
    assert spark.read.parquet(str(tmp_path / "out")).count() == 30 and not list((tmp_path / "out").glob("_unrec*"))


def test_recalibration_without_md_is_an_error(spark, tmp_path):
    (tmp_path / "a.fq").write_text("@r\nACGT\n+\nIIII\n")
    stage = stages.Align("s", [("g", str(tmp_path / "a.fq"), None)], placed(None), alignmentOutput=str(tmp_path / "out"), functionalEquivalence=True)
    with pytest.raises(Exception, match="needs CIGAR and MD"):
        stage.execute(spark)


def test_reference_under_clips_and_gaps():
    assert ro.reference_of("TTACGTGA", 10, "2S2M1I1M2D2M", "1G1^CC2") == ("--AG-TGA", [None, None, 10, 11, None, 12, 15, 16])
    with pytest.raises(ValueError, match="do not fit"):
        ro.reference_of("ACGT", 0, "4M", "3")


HEAD = "##fileformat=VCFv4.2\n" + "".join(f'##FORMAT=<ID={k},Number={n},Type={t},Description="">\n' for k, n, t in (("DP", "1", "Integer"), ("GQ", "1", "Integer"), ("GT", "1", "String"), ("PL", "G", "Integer"))) + '##INFO=<ID=END,Number=1,Type=Integer,Description="">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS\n'


def test_call_stage_bands(spark, tmp_path):
    lines = [f"c\t{p}\t.\tA\t<NON_REF>\t.\t.\tEND={p}\tGT:DP:GQ:PL\t0/0:{p}:{q}:0,{q},{pl}" for p, q, pl in ((10, 9, 99), (11, 15, 208), (12, 16, 203), (14, 15, 200))]
    path = tmp_path / "S.g.vcf"
    path.write_text(HEAD + "\n".join([*lines, "c\t13\tid\tA\tT,<NON_REF>\t9\t.\t.\tGT:DP:GQ:PL\t0/1:9:15:9,0,9,9,9,9"]) + "\n")
    rows = vcf.read_vcf(spark, str(path))
    assert vo.banded(rows, [10]).columns == rows.columns
    stage = stages.CallVariants("S", None, None, "", alignmentOutput="x", callVariantOutput=str(tmp_path / "calls"), bands="10, 20")
    stage.save(spark, rows, "S")
    got = sorted((r.start, r.end, list(r.genotypes[0].phredLikelihoods)[:3], r.genotypes[0].conditionalQuality, r.genotypes[0].depth, list(r.names or [])) for r in spark.read.parquet(str(tmp_path / "calls")).collect())
    assert got == [(9, 10, [0, 9, 99], 9, 10, []), (10, 12, [0, 15, 203], 15, 11, []), (12, 13, [9, 0, 9], 15, 9, ["id"]), (13, 14, [0, 15, 200], 15, 14, [])]


def test_bam_input(spark, tmp_path):
    sam = tmp_path / "a.sam"
    sam.write_text("@SQ\tSN:c\tLN:100\n@SQ\tSN:d\tLN:100\nr1\t99\tc\t11\t60\t2S3M1D2M\td\t31\t30\tACGTACG\tIIIIIII\tRG:Z:g\tNM:i:-1\tMD:Z:3^A2\tXF:f:0.5\tXA:A:q\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tACGT\t*\n")
    reads = alignments.load_reads(spark, str(sam))
    for single in (True, False):
        path = str(tmp_path / f"out{single}.bam")
        alignments.write_bam(reads.repartition(2), path, ["@HD\tVN:1.6"], [("c", 100), ("d", 100)], single=single)
        back = alignments.load_reads(spark, path if single else f"{path}/*.bam")
        assert sorted(map(repr, back.collect())) == sorted(map(repr, reads.collect()))


def test_align_stores_its_provenance(spark, tmp_path):
    (tmp_path / "a.fq").write_text("".join(f"@r{k}\nACGT\n+\nIIII\n" for k in range(30)))
    stage = stages.Align("s", [("g", str(tmp_path / "a.fq"), None)], placed("3A0"), alignmentOutput=str(tmp_path / "out"), functionalEquivalence=True)
    stage.execute(spark)
    chain = pipeline.load_chain(spark, stage.provenance)
    assert [s.program for s in chain] == ["align", "markDuplicates", "recalibrateBaseQualities", "binQualityScores"]
    assert [s.previous_id for s in chain] == [None, *(s.id for s in chain[:-1])] and "a.fq" in chain[0].command
    assert spark.read.parquet(str(tmp_path / "out")).count() == 30


def test_settings_reach_the_stages(spark, tmp_path):
    (tmp_path / "a.fq").write_text("".join(f"@r{k}\nACGT\n+\nIIII\n" for k in range(30)))
    seen = []

    def watching(raw):  # noqa: ANN001, ANN202
        seen.append(raw.rdd.getNumPartitions())
        return placed("3A0")(raw)

    stage = stages.Align("s", [("g", str(tmp_path / "a.fq"), None)], watching, alignmentOutput=str(tmp_path / "out"), pairedEndMode=False)
    for key, value, want in (("alignmentPartitions", "7", 7), ("alignmentMinPartitions", "11", 11)):
        spark.conf.set(f"helix.{key}", value)
        try:
            assert stage.aligned(spark).count() == 30
        finally:
            spark.conf.unset(f"helix.{key}")
        assert seen[-1] == want
    spark.conf.set("helix.concurrentSamples", "3")
    try:
        import threading

        gate = threading.Barrier(3, timeout=60)

        class Meet(pipeline.Stage):
            def execute(self, spark) -> None:  # noqa: ANN001
                gate.wait()

        m = pipeline.MultiSample("m", lambda s, text: [(x, x) for x in text.split()], lambda x: pipeline.Pipeline(x, [Meet()]))
        m.init({"manifest": "a b c"}).execute(spark)  # passes only if three run at a time
    finally:
        spark.conf.unset("helix.concurrentSamples")


def test_kernels_get_batches_of_bases(spark):
    raw = spark.createDataFrame([(f"r{k}", "A" * (k % 5)) for k in range(40)] + [("none", None)], "readName string, sequence string").coalesce(1)
    out = kernels.batched(raw, lambda rows: [{"n": len(rows), "bases": sum(len(r["sequence"] or "") for r in rows)}], "n long, bases long", 20).collect()
    assert sum(r.n for r in out) == 41 and sum(r.bases for r in out) == 80 and all(20 <= r.bases < 25 for r in out[:-1])
    spark.conf.set("helix.alignerBatchBases", "20")
    try:
        aligner = stages.batch_aligner(spark, lambda rows: [{"n": len(rows)}], "n long")
        assert aligner(raw).count() == len(out)
    finally:
        spark.conf.unset("helix.alignerBatchBases")


def test_rows_go_to_the_partition_they_name(spark):
    df = spark.createDataFrame([(k % 4, k) for k in range(40)], "part int, k long")
    got = ro.by_partition(df, "part", 4).withColumn("at", F.spark_partition_id())
    assert got.where("at <> part").count() == 0 and got.count() == 40
    for wrong in (4, -1, None):
        with pytest.raises(Exception, match="no partition of 4"):
            ro.by_partition(spark.createDataFrame([(wrong, 1)], "part int, k long"), "part", 4).collect()


def test_preprocessing_in_order(spark):
    df = spark.createDataFrame([("c", 1, f"r{k}", 0, k) for k in range(10)], "referenceName string, start long, readName string, readInFragment int, q int")
    double = lambda r: r.withColumn("q", F.col("q") * 2)
    got = assembly.preprocessed(df, [double], lambda r: r.where("q >= 4"), [double], 3).collect()
    assert sorted(r.q for r in got) == [8, 12, 16]
