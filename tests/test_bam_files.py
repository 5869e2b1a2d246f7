"""BAM files at their edges: positions beyond the header's lengths, odd fields, what is no record, how often the input is read."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helixframe.model import READ
from helixframe.sources import alignments, bgzf, binary

CONTIGS = [("c1", 10_000), ("c2", 20_000)]
HEADER = alignments.sam_header(CONTIGS)


def reads(spark, lines: list[str]):  # noqa: ANN001, ANN201
    return alignments.of_lines(spark.createDataFrame([(x,) for x in lines], "value string").repartition(3))


def line(k: int, pos: int, size: int = 30, name: str | None = None) -> str:
    return f"{name or f'r{k}'}\t{16 * (k % 2)}\tc{1 + k % 2}\t{pos}\t{k % 60}\t{size}M\t*\t0\t0\t{'ACGT' * (size // 4)}{'ACG'[: size % 4]}\t{'I' * size}\tRG:Z:g{k % 3}"


def test_positions_beyond_the_lengths_in_the_header(spark, tmp_path):
    """Parts that begin among such reads gave none of them."""
    rng = random.Random(5)
    rows = reads(spark, [line(k, rng.randrange(1, 2_000_000_000), rng.randrange(1, 50)) for k in range(4000)])
    path = str(tmp_path / "x.bam")
    alignments.write_bam(rows, path, HEADER, CONTIGS, single=True, sort=True)
    back = alignments.read_bam(spark, path, size=9_000)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.collect()))


def test_a_part_that_finds_no_record_is_an_error(tmp_path):
    """Names of such letters are not taken for records where a part begins, so that part would lose them."""
    numbers = {c: k for k, (c, _) in enumerate(CONTIGS)}
    records = [alignments.bam_record(line(k, 10 + k, 400, name=f"r{k}" if k < 30 else f"r{k}\x01"), numbers) for k in range(200)]
    raw = b"".join(x for r in [alignments.bam_header(HEADER, CONTIGS), *records] for x in binary.bgzf([r], end=False)) + binary.BGZF_END
    path = tmp_path / "x.bam"
    path.write_bytes(raw)
    half = len(raw) // 2
    assert sum(1 for _ in alignments.bam_part(str(path), 0, len(raw))) == 200
    with pytest.raises(ValueError, match="would find none"):
        list(alignments.bam_part(str(path), 0, half))


ODD = [
    line(0, 5, 1).replace("\tI\t", "\t5\t"), "r1\t4\t*\t0\t0\t*\t*\t0\t0\tACGTN\t*", "r2\t4\t*\t0\t0\t*\t*\t0\t0\t*\t*", "r3\t99\tc1\t11\t60\t2S3M1D2M10N1I\t=\t31\t-30\tACGTACGT\tII5IIIII\tRG:Z:g\tNM:i:-1\tMD:Z:3^A2\tXF:f:0.5\tXA:A:q",
    "r4\t147\tc1\t11\t255\t*\tc2\t31\t30\tACG\tIII", "*\t65535\tc2\t2147483647\t1\t4M\t=\t2147483647\t-2147483648\t=MRY\t!!~!", f"{'n' * 254}\t0\tc2\t1\t1\t3M\t*\t0\t0\tACG\t*\tXZ:Z:",
]


def test_odd_reads_come_back(spark, tmp_path, monkeypatch):
    """However many of them are made to records at once."""
    lines = [*ODD, *(line(k, k + 1, size) for k, size in enumerate((1, 2, 3, 5000, 1, 70_000)))]
    rows = reads(spark, lines).coalesce(1)
    kinds = [("flag", pa.int32()), *((n, k) for n, k in alignments.FIELDS.items() if n not in ("flag", "end")), ("readInFragment", pa.int32())]
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in alignments.bam_rows(rows).collect()], schema=pa.schema(kinds))
    whole = alignments.bam_records(batch, ["c1", "c2"])
    for most, least in ((4 << 20, 1), (100, 3), (1, len(lines) - 2)):
        monkeypatch.setattr(alignments, "AT_ONCE", most)
        pieces = [alignments.bam_records(b, ["c1", "c2"]) for b in alignments.few_at_once([batch])]
        assert len(pieces) >= least and np.array_equal(np.concatenate(pieces), whole)
    path = str(tmp_path / "x.bam")
    alignments.write_bam(rows, path, HEADER, CONTIGS, single=True)
    assert sorted(map(repr, alignments.read_bam(spark, path, size=300).collect())) == sorted(map(repr, rows.collect()))


def test_scores_beyond_ascii(spark, tmp_path):
    one = reads(spark, [line(0, 5, 4)]).withColumn("qualityScores", F.lit("!ÿ\u0080~"))
    path = str(tmp_path / "x.bam")
    alignments.write_bam(one, path, HEADER, CONTIGS, single=True)
    assert [r.qualityScores for r in alignments.read_bam(spark, path).collect()] == ["!ÿ\u0080~"]


@pytest.mark.parametrize(("column", "value", "told"), [("start", "shiftleft(1L, 31)", "pos of 2147483648"), ("readName", "repeat('n', 255)", "names of 256"), ("qualityScores", "'II'", "as many qualities"), ("sequence", "cast(null AS string)", "as many qualities")])
def test_what_bam_cannot_hold_is_an_error(spark, tmp_path, column, value, told):
    with pytest.raises(Exception, match=told):
        alignments.write_bam(reads(spark, [line(0, 5)]).withColumn(column, F.expr(value)), str(tmp_path / "x.bam"), HEADER, CONTIGS, single=True)


def test_no_reads(spark, tmp_path):
    path = str(tmp_path / "x.bam")
    alignments.write_bam(spark.createDataFrame([], READ), path, HEADER, CONTIGS, single=True, sort=True)
    assert alignments.read_bam(spark, path).collect() == []


def test_input_is_read_for_ranges_and_once_more(spark, tmp_path):
    """Its number of partitions was asked for before, by which it was sorted one more time."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):  # noqa: ANN001, ANN202
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = reads(spark, [line(k, k + 1) for k in range(300)])
    alignments.write_bam(rows.mapInArrow(run, rows.schema), str(tmp_path / "x.bam"), HEADER, CONTIGS, single=True, sort=True)
    assert seen.value == 600


def test_a_small_file_is_read_by_all_that_can_run(spark, tmp_path, monkeypatch):
    """Parts were of the split size, 128 MB, so that one task read a file below it."""
    monkeypatch.setattr(bgzf, "TASK_BYTES", 20_000)
    monkeypatch.setattr(alignments, "TASK_BYTES", 20_000)
    monkeypatch.setattr(alignments, "LEAST_BYTES", 10_000)
    path = str(tmp_path / "x.bam")
    alignments.write_bam(reads(spark, [line(k, k * 37 + 1) for k in range(6000)]), path, HEADER, CONTIGS, single=True)
    back = alignments.read_bam(spark, path)
    assert back.rdd.getNumPartitions() >= 4 and back.count() == 6000
