"""Blocked gzip files read in parts."""

from __future__ import annotations

import gzip
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from helixframe.sources import alignments, bgzf, binary, features, tables, vcf


def blocked(pieces: list[bytes], end: bool = True) -> bytes:
    """A block for each piece."""
    out = b""
    for raw in pieces:
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = z.compress(raw) + z.flush()
        out += b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(raw), len(raw))
    return out + (binary.BGZF_END if end else b"")


def cut(data: bytes, rng: random.Random, most: int) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = rng.randrange(1, most)
        out.append(data[at : at + n])
        at += n
    return out


def parts(path: str, length: int, size: int):  # noqa: ANN201
    return [(path, at, min(at + size, length)) for at in range(0, length, size)]


@pytest.mark.parametrize(("most", "size"), [(50, 64), (50, 1000), (900, 500), (4000, 3000), (60_000, 20_000), (60_000, 1 << 20)])
def test_every_line_is_read_once(tmp_path, most, size):
    rng = random.Random(most + size)
    for tail in (b"\n", b""):
        lines = [("x" * rng.choice([0, 1, 5, 40, 3000]) + str(rng.random())).encode() for _ in range(700)]
        data = b"\n".join(lines) + tail
        raw = blocked(cut(data, rng, most))
        assert gzip.decompress(raw) == data
        path = tmp_path / f"x{len(tail)}.bgz"
        path.write_bytes(raw)
        got = [v for p in parts(str(path), len(raw), size) for v in bgzf.lines_of(*p)]
        assert got == lines


def test_lines_of_odd_files(tmp_path):
    for name, raw, want in (("empty", b"", []), ("end", binary.BGZF_END, []), ("blank", blocked([b"\n", b"\n"]), [b"", b""]), ("dos", blocked([b"a\r", b"\nb\r\n"]), [b"a", b"b"]), ("open", blocked([b"a\nb"], end=False), [b"a", b"b"]), ("holes", blocked([b"a", b"", b"b\n", b"", b"c"]), [b"ab", b"c"])):
        path = tmp_path / name
        path.write_bytes(raw)
        for size in (1, 10, 40, 1000):
            assert [v for p in parts(str(path), len(raw), size) for v in bgzf.lines_of(*p)] == want, (name, size)


def test_blocks_that_look_like_heads(tmp_path):
    """Data that holds the marks of a block is not taken for one."""
    inner = blocked([b"not a block"], end=False)
    raw = b""
    rng = random.Random(1)
    lines = []
    for k in range(300):
        line = b"%d " % k + inner.replace(b"\n", b"?") + bytes(rng.randrange(32, 127) for _ in range(30))
        lines.append(line)
        body = b"\1" + struct.pack("<HH", len(line) + 1, 0xFFFF ^ (len(line) + 1)) + line + b"\n"  # stored, not deflated
        raw += b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(line + b"\n"), len(line) + 1)
    path = tmp_path / "x.bgz"
    path.write_bytes(raw)
    for size in (37, 100, 5000):
        assert [v for p in parts(str(path), len(raw), size) for v in bgzf.lines_of(*p)] == lines


def test_damage_is_an_error(tmp_path):
    raw = blocked([b"one line\n" * 40 + bytes([33 + k] * k) for k in range(60)])
    for name, bad in (("short", raw[: len(raw) // 2]), ("wrong", raw[: len(raw) // 2] + bytes([raw[len(raw) // 2] ^ 1]) + raw[len(raw) // 2 + 1 :])):
        path = tmp_path / name
        path.write_bytes(bad)
        with pytest.raises((ValueError, zlib.error)):
            for p in parts(str(path), len(bad), 700):
                list(bgzf.lines_of(*p))


def reads(spark, n: int):  # noqa: ANN201
    rng = random.Random(n)
    lines = []
    for k in range(n):
        size = rng.choice([1, 20, 100, 100, 100, 4000])
        bases = "".join(rng.choice("ACGT") for _ in range(size))
        ref = rng.choice(["c1", "c2", "*"])
        lines.append(f"r{k}\t{rng.choice([0, 16, 99, 1024])}\t{ref}\t{rng.randrange(1, 9000) if ref != '*' else 0}\t{k % 60}\t{f'{size}M' if ref != '*' else '*'}\t*\t0\t0\t{bases}\t{'I' * size}\tRG:Z:g{k % 3}\tNM:i:{k % 5}")
    return alignments.of_lines(spark.createDataFrame([(x,) for x in lines], "value string"))


CONTIGS = [("c1", 10_000), ("c2", 20_000)]


@pytest.mark.parametrize(("block", "size"), [(120, 90), (120, 5000), (3000, 1000), (65_280, 20_000)])
def test_every_record_is_read_once(spark, tmp_path, block, size):
    """Blocks smaller than records, records over many parts, headers over several blocks."""
    want = alignments.sam_lines(reads(spark, 250)).collect()
    numbers = {c: k for k, (c, _) in enumerate(CONTIGS)}
    head = alignments.bam_header(alignments.sam_header(CONTIGS) + [f"@CO\tsome text {k}" for k in range(30)], CONTIGS)
    data = head + b"".join(alignments.bam_record(r.value, numbers) for r in want)
    raw = blocked(cut(data, random.Random(block), block))
    path = tmp_path / "x.bam"
    path.write_bytes(raw)
    got = [v.decode() for p in parts(str(path), len(raw), size) for v in alignments.bam_part(*p)]
    whole = [v.decode() for v in alignments.bam_part(str(path), 0, len(raw))]
    assert got == whole and len(got) == 250
    assert [x.split("\t")[:10] for x in got] == [r.value.split("\t")[:10] for r in want]


def test_bam_without_records_and_no_bam(tmp_path):
    path = tmp_path / "x.bam"
    path.write_bytes(blocked([alignments.bam_header(alignments.sam_header(CONTIGS), CONTIGS)]))
    assert [v for p in parts(str(path), path.stat().st_size, 20) for v in alignments.bam_part(*p)] == []
    path.write_bytes(blocked([b"text\n" * 9]))
    with pytest.raises(ValueError, match="not a BAM"):
        list(alignments.bam_part(str(path), 0, 1000))


def test_one_bam_is_many_tasks(spark, tmp_path):
    rows = reads(spark, 3000).repartition(3)
    path = str(tmp_path / "x.bam")
    alignments.write_bam(rows, path, alignments.sam_header(CONTIGS), CONTIGS, single=True)
    alone = alignments.read_bam(spark, path)
    split = alignments.read_bam(spark, path, size=50_000)
    used = split.withColumn("task", F.spark_partition_id()).groupBy("task").count().where("count > 0").count()
    assert split.rdd.getNumPartitions() >= 5 and used >= 5
    assert sorted(map(repr, split.collect())) == sorted(map(repr, alone.collect())) and alone.count() == 3000


def test_vcf_in_parts(spark, tmp_path):
    """1,500 rows written come back, sharded and single, from the reader and from the table loader; samples, sites and header too."""
    rng = random.Random(2)
    rows = [(f"c{k % 3}", k * 10, k * 10 + 1, "".join(rng.choice("ACGT") for _ in range(rng.choice([1, 1, 200])))) for k in range(1500)]
    g = F.array(F.struct(F.lit("S1").alias("sampleId"), F.array(F.lit(0), F.lit(1)).alias("calls")))
    df = spark.createDataFrame(rows, "contigName string, start long, end long, referenceAllele string").withColumn("end", F.col("start") + F.length("referenceAllele")).withColumn("alternateAlleles", F.array(F.lit("T"))).withColumn("genotypes", g)
    one, many = str(tmp_path / "one.vcf.bgz"), str(tmp_path / "many")
    vcf.write_single(df.repartition(4), one, ["S1"], codec="bgzf")
    vcf.write_sharded(df.repartition(4), many, ["S1"], codec="bgzf")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        for got in (vcf.read_vcf(spark, one), vcf.read_vcf(spark, many), tables.load_variants(spark, one)):
            assert sorted((r.contigName, r.start, r.end, r.referenceAllele, r.genotypes[0].calls) for r in got.collect()) == sorted((c, s, s + len(a), a, [0, 1]) for c, s, _, a in rows)
        assert vcf.read_vcf(spark, one).rdd.getNumPartitions() > 1
        assert vcf.sample_ids(spark, one) == ["S1"] and vcf.read_sites(spark, many).count() == 1500
        plain = str(tmp_path / "plain.vcf")
        vcf.write_single(df, plain, ["S1"])
        assert vcf.read_vcf(spark, [one, plain]).count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_features_of_a_blocked_file(spark, tmp_path):
    path = tmp_path / "a.bed.bgz"
    path.write_bytes(blocked([b"track x\nc1\t1\t", b"5\tn1\nc2\t7\t9\tn2\n"]))
    assert [(r.referenceName, r.start, r.end, r.name) for r in features.read_features(spark, str(path)).orderBy("start").collect()] == [("c1", 1, 5, "n1"), ("c2", 7, 9, "n2")]


def test_small_parts_share_tasks(spark, tmp_path):
    """A part is a few bytes here; tasks are bounded by what they read and by what runs at once, and no part is lost."""
    path = tmp_path / "x.txt.bgz"
    path.write_bytes(b"".join(binary_blocks(b"line %d\n" % k for k in range(400))))
    parts = bgzf.parts_of(spark, [str(path)], 5)
    assert parts.rdd.getNumPartitions() <= bgzf.PER_SLOT * spark.sparkContext.defaultParallelism
    assert parts.count() == -(-path.stat().st_size // 5)


def binary_blocks(lines):  # noqa: ANN001, ANN201
    from helixframe.sources.binary import bgzf as blocks

    return blocks(lines)
