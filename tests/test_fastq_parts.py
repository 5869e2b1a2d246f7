"""FASTQ files read in parts of any size, and partitions replaced under failure."""

from __future__ import annotations

import gzip
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helixframe.operators import recalibration
from helixframe.sources import alignments, tables


def fastq(rng: random.Random, n: int) -> tuple[str, list[tuple[str, str, str]]]:
    rows = []
    for k in range(n):
        m = rng.randrange(1, 60)
        rows.append((f"r{k}", "".join(rng.choice("ACGTN") for _ in range(m)), "".join(rng.choice("@+I#!5") for _ in range(m))))
    return "".join(f"@{a} x\n{b}\n+{rng.choice(['', a])}\n{c}\n" for a, b, c in rows), rows


@pytest.mark.parametrize("size", [97, 400, 5000, 1 << 20])
def test_parts_of_any_size(spark, tmp_path, size):
    text, rows = fastq(random.Random(size), 300)
    (tmp_path / "a.fq").write_text(text)
    (tmp_path / "b.fq.gz").write_bytes(gzip.compress(text.replace("@r", "@s").encode()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        df = alignments.read_fastq(spark, [str(tmp_path / "a.fq"), str(tmp_path / "b.fq.gz")])
        got = sorted((r.readName, bytes(r.sequence).decode(), r.qualityScores) for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 2 * len(rows) and [x for x in got if x[0][0] == "r"] == sorted(rows)


@pytest.mark.parametrize("size", [60, 1 << 20])
def test_cut_off_files(spark, tmp_path, size):
    (tmp_path / "a.fq").write_text("".join(f"@r{k}\nACGT\n+\nIIII\n" for k in range(20)) + "@last\nAC\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        with pytest.raises(Exception, match="malformed"):
            alignments.read_fastq(spark, str(tmp_path / "a.fq")).collect()
        assert alignments.read_fastq(spark, str(tmp_path / "a.fq"), stringency="SILENT").count() == 20
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_columns_of_reads_are_those_of_single_records():
    names = ["@a", "@a/1", "@a/2 more", "@a/3", "@", "@ x", "@a\tb /2", "@a/2/1", "@a/2x", "@/2", "@a b/2"]
    for odd in ([], ["@a\u00a0b/2", "@\u00e9\u2003/1", "@a\x0b/2", "@\u00e9/2"]):
        lines = [x for k, n in enumerate(names + odd) for x in (n, "ACGT"[: k % 4 + 1], "+", "@+I\u00e9"[: k % 4 + 1] + "\r" * (k % 2))]
        want = [alignments.fastq_record(lines[k : k + 4], "STRICT") for k in range(0, len(lines), 4)]
        assert list(zip(*(c.to_pylist() for c in alignments.fastq_reads_of(pa.array(lines), "STRICT")), strict=True)) == want
        for wrong in (["a", "A", "+", "I"], ["@a", "A", "-", "I"], ["@a", "A", "+", "II"]):
            got = alignments.fastq_reads_of(pa.array(lines[:4] + wrong + lines[4:]), "SILENT")
            assert list(zip(*(c.to_pylist() for c in got), strict=True)) == want
            with pytest.raises(ValueError, match="malformed"):
                alignments.fastq_reads_of(pa.array(lines + wrong), "STRICT")


def test_ends_of_parts_are_found_without_making_reads(spark, tmp_path):
    text, rows = fastq(random.Random(3), 2000)
    (tmp_path / "a.fq").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = spark.read.text(str(tmp_path / "a.fq")).select("value", F.lit(1).cast("long").alias("file"), F.lit(2).cast("long").alias("other"), F.col("_metadata.file_block_start").alias("block"))
        parts = lines.select("block").distinct().count()
        edges = alignments.fastq_parts(lines, "STRICT", True).collect()
        assert parts > 5 and len(edges) == 2 * parts - 1 and sum(len(e["lines"]) for e in edges) <= 4 * parts
        inside = alignments.fastq_parts(lines, "STRICT", False).count()
        assert len(rows) - parts < inside <= len(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_failed_move_puts_old_partitions_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    frame = lambda v: spark.createDataFrame([(i, v) for i in range(3)], "id int, value int")
    tables.replace_partitions(frame(1), path, "id", [0, 1, 2])
    real, seen = tables.exists, []

    def failing(s, p):  # noqa: ANN001, ANN202
        seen.append(p)
        if len(seen) == 4:
            raise OSError("gone")
        return real(s, p)

    monkeypatch.setattr(tables, "exists", failing)
    with pytest.raises(OSError, match="gone"):
        tables.replace_partitions(frame(2), path, "id", [0, 1, 2])
    assert {(r.id, r.value) for r in spark.read.parquet(path).collect()} == {(0, 1), (1, 1), (2, 1)}
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    with pytest.raises(Exception, match="outside"):
        tables.replace_partitions(frame(3), path, "id", [0])
    assert spark.read.parquet(path).where("value = 1").count() == 3 and [p.name for p in tmp_path.iterdir()] == ["t"]


@pytest.mark.parametrize("most", [4_000_000, 5])
def test_qualities_against_the_model(spark, most):
    rng = random.Random(2)
    rows = []
    for k in range(60):
        n = rng.randrange(0, 12)
        seq = "".join(rng.choice("ACGT") for _ in range(n))
        rows.append((k, rng.choice(["g", "h", None]), "c", 0, seq, "".join(rng.choice("5I") for _ in range(n)), "".join(c if rng.random() < 0.8 else "A" for c in seq), None))
    rows += [(100, "g", "c", 0, "AC", "I", "AC", "old"), (101, "other", "c", 0, "ACGT", "IIII", "ACGT", None), (102, "g", "c", 0, None, None, None, None)]
    df = spark.createDataFrame(rows, "k long, readGroupId string, referenceName string, start long, sequence string, qualityScores string, referenceBases string, originalQualityScores string").repartition(5)
    model = recalibration.recalibrate(df.where("k < 100"), None)
    cells = {(r.readGroupId, r.q, r.cycle, r.context): r.newQuality for r in model.collect()}
    got = {r.k: r for r in recalibration.apply_recalibration(df, model, most).collect()}
    assert len(got) == len(rows)
    for k, g, _, _, seq, qual, _, _ in rows:
        assert got[k].originalQualityScores == qual
        if not seq or len(seq) != len(qual):
            assert got[k].qualityScores == qual
            continue
        want = "".join(chr(33 + cells.get((g, ord(q) - 33, j, seq[max(j - 1, 0) : max(j - 1, 0) + 2]), ord(q) - 33)) for j, q in enumerate(qual))
        assert got[k].qualityScores == want, (g, seq, qual)
