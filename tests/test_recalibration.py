"""Recalibration cells against brute force, and reads that must not be merged or lost."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helixframe.operators import reads as ro
from helixframe.operators import recalibration as rc
from helixframe.plans import stages

SCHEMA = "readGroupId string, referenceName string, start long, sequence string, qualityScores string, referenceBases string, referenceSites array<long>"


def made(n: int, seed: int, sites: bool) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        size = rng.choice([0, 1, 2, 9, 30])
        seq = "".join(rng.choice("ACGT") for _ in range(size))
        start = rng.choice([None, *range(0, 200)])
        at = start
        places: list[int | None] = []
        for _ in range(size):
            if at is not None and rng.random() < 0.1:
                at += rng.choice([1, 60])  # a gap
            insert = at is None or rng.random() < 0.1
            places.append(None if insert else at)
            at = at if insert else at + 1
        ref = "".join("-" if sites and p is None else c if rng.random() < 0.8 else "A" for c, p in zip(seq, places, strict=True))
        out.append((rng.choice(["g", "h", None]), rng.choice(["c", "d", None]) if start is not None else None, start, seq, "".join(rng.choice("#5I") for _ in seq), ref, places if sites else None))
    return out + [("g", "c", 3, "ACG", "II", "ACG", None), ("g", "c", 3, None, None, None, None), ("g", "c", 3, "AC", "II", "A", None)]


def brute(rows: list[tuple], known: set[tuple], least: int = 6) -> dict[tuple, tuple[int, int]]:
    n, errors = Counter(), Counter()
    for group, contig, start, seq, qual, ref, places in rows:
        if not seq or not qual or not ref or not len(seq) == len(qual) == len(ref):
            continue
        for k, (b, q, r) in enumerate(zip(seq, qual, ref, strict=True)):
            place = places[k] if places else None if start is None else start + k
            if ord(q) - 33 < least or r == "-" or (contig, place) in known:
                continue
            cell = (group, ord(q) - 33, k, seq[max(k - 1, 0) : max(k - 1, 0) + 2])
            n[cell] += 1
            errors[cell] += b != r
    return {c: (errors[c], n[c]) for c in n}


def cells(df) -> dict[tuple, tuple[int, int]]:  # noqa: ANN001
    t = df.groupBy("readGroupId", "q", "cycle", "context").agg(F.sum("errors").alias("e"), F.sum("n").alias("k"))
    return {(r.readGroupId, r.q, r.cycle, r.context): (r.e, r.k) for r in t.collect()}


@pytest.mark.parametrize("sites", [False, True])
def test_cells_without_known_sites(spark, sites):
    rows = made(300, 1, sites)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert cells(rc.counts_alone(df, 6)) == brute(rows, set())


@pytest.mark.parametrize(("sites", "size", "most"), [(False, 100_000, 200_000), (True, 100_000, 200_000), (False, 7, 5), (True, 7, 5), (True, 40, 3)])
def test_cells_outside_known_sites(spark, sites, size, most):
    """Reads over many bins, bins with more reads than a part holds, reads without a place, sites that repeat or are null."""
    rows = made(250, size, sites)
    rng = random.Random(size)
    known = {(c, k) for c in "cd" for k in range(260) if rng.random() < 0.2}
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    frame = spark.createDataFrame([*known, *list(known)[:9], ("c", None), (None, 4)], "contigName string, start long").repartition(2)
    assert cells(rc.counts_beside(df, frame, 6, size, most)) == brute(rows, known)


def test_no_base_is_a_row(spark):
    rows = [("g", "c", k % 50, "ACGTACGTAC" * 10, "I" * 100, "ACGTACGTAC" * 10, None) for k in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    frame = spark.createDataFrame([("c", 9)], "contigName string, start long")
    out = rc.counts_beside(df, frame, 6)
    assert out.count() <= 100 * 8 * out.rdd.getNumPartitions()
    assert rc.recalibrate(df, frame).groupBy().agg(F.count("*")).first()[0] == len(brute(rows, {("c", 9)}))


def test_cells_held_are_merged(monkeypatch):
    import numpy as np

    monkeypatch.setattr(rc, "HELD", 3)
    c = rc.Cells()
    c.groups = {"g": 0}
    for k in range(20):
        c.add(np.array([k % 4, k % 4, 9]) + (30 << 40), np.array([True, False, True]))
    got = {(r["cycle"], r["context"], r["errors"], r["n"]) for b in c.rows() for r in b.to_pylist()}
    assert sum(n for *_, n in got) == 60 and sum(e for _, _, e, _ in got) == 40


# ---- reads that must not be merged or lost


def test_read_groups_with_a_common_name_are_fragments_of_their_own(spark):
    row = lambda group, start: ("r1", group, 0, start)
    df = spark.createDataFrame([row("g", 1), row("h", 2), row("g", 3), row(None, 4), row(None, 5)], "readName string, readGroupId string, readInFragment int, start long").withColumn("insertSize", F.lit(None).cast("long"))
    got = {r.readGroupId: [a.start for a in r.alignments] for r in ro.to_fragments(df).collect()}
    assert got == {"g": [1, 3], "h": [2], None: [4, 5]}


def test_exclusions_take_alignments_and_not_reads(spark, tmp_path):
    (tmp_path / "x.bed").write_text("chr1\t0\t100\nchr2\t40\t45\n")
    rows = [("r1", 0, "chr1", 10, 20), ("r1", 0, "chr2", 10, 20), ("r1", 0, "chr2", 39, 44), ("r2", 0, "chr1", 95, 105), ("r3", 0, None, None, None), ("r4", 0, "chr2", 41, 44), ("r4", 0, "chr2", 41, 44)]
    df = spark.createDataFrame(rows, "readName string, readInFragment int, referenceName string, start long, end long")
    got = stages.target_reads(spark, df, None, str(tmp_path / "x.bed"), 1000).select(*df.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(rows[1:5], key=repr)


def test_flags_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(f"n{k}", rng.choice(["g", "h", None]), rng.choice(["x", None]), rng.choice([None, 1, 1, 1, 2]), rng.choice([None, 5, 6]), rng.randrange(4)) for k in range(300)]
    df = spark.createDataFrame(rows, "name string, rg string, library string, l int, right int, score int")
    got = {r.name: (r.primaryDup, r.secondaryDup) for r in ro.duplicate_flags(df.withColumnRenamed("l", "left"), identity=("name", "rg")).collect()}
    for name, _, lib, left, right, score in rows:
        same = [r for r in rows if r[2] == lib and r[3] == left]
        better = [r for r in same if r[4] == right and (-r[5], r[0]) < (-score, name)]
        dup = left is not None and (right is None and any(r[4] is not None for r in same) or bool(better))
        assert got[name] == (dup, left is not None)
    hot = spark.range(20_000).selectExpr("cast(id as string) as name", "'g' as rg", "'x' as library", "1 as left", "2 as right", "cast(id % 7 as int) as score")
    assert ro.duplicate_flags(hot, identity=("name", "rg")).where("not primaryDup").count() == 1


def test_reads_are_counted_once(spark, monkeypatch):
    """The model takes the cells of the reads several times, and applying it twice; the reads are counted in one pass."""
    passes = spark.sparkContext.accumulator(0)
    counted = rc.counts_alone

    def counting(reads, least):  # noqa: ANN001, ANN202
        def seen(batches):  # noqa: ANN001, ANN202
            for b in batches:
                passes.add(b.num_rows)
                yield b

        return counted(reads.mapInArrow(seen, reads.schema), least)

    monkeypatch.setattr(rc, "counts_alone", counting)
    df = spark.createDataFrame([("g", "c", k, "ACGT", "IIII", "ACGA", None) for k in range(40)], SCHEMA).repartition(3)
    out = rc.apply_recalibration(df, rc.recalibrate(df, None)).collect()
    assert len(out) == 40 and passes.value == 40
    assert {r.qualityScores for r in out} != {"IIII"}


def test_positions_of_fragments_are_computed_once(spark):
    """Higher-order functions are evaluated wherever they are written, and each of three reads of a fragment has a position."""
    row = "string(id) as readName, 'g' as readGroupId, int(id % 2) as readInFragment, 'c' as referenceName, id as start, id + 9 as `end`, id % 3 = 0 as readNegativeStrand, '9M' as cigar, repeat('?', 9) as qualityScores, repeat('A', 9) as sequence, true as readMapped, true as primaryAlignment, false as supplementaryAlignment, false as duplicateRead, 1L as insertSize"
    fragments = ro.to_fragments(spark.range(40).selectExpr(*row.split(", ")[:8], "repeat('?', 9) as qualityScores", "repeat('A', 9) as sequence", *row.split(", ")[12:]))
    p = fragments.select(ro.positions_and_score("alignments").alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("INDEPENDENT") <= 4
