"""VCF through Spark's data source interface."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helixframe.sources import vcf, vcf_source


@pytest.fixture(scope="module")
def rows(spark):
    vcf_source.register(spark)
    rng = random.Random(1)
    data = []
    for k in range(900):
        g = [(s, rng.random() < 0.3, [rng.choice([-1, 0, 1]), 1], rng.choice([None, k % 40]), rng.choice([None, [1, 2, 3]])) for s in ("A", "B") if rng.random() < 0.9]
        ref = "".join(rng.choice("ACGT") for _ in range(rng.choice([1, 1, 4])))
        data.append((f"c{k % 3}", k * 5, k * 5 + rng.choice([len(ref), 60]), [f"n{k}"] if k % 2 else [], ref, rng.choice([["T"], ["G", "<NON_REF>"], []]), rng.choice([None, 1.5, 30.0]), ["PASS"] if k % 3 else [], rng.choice([None, k]), k % 4 == 0, rng.choice([None, [0.5, 2.0]]), g))
    kinds = "contigName string, start long, end long, names array<string>, referenceAllele string, alternateAlleles array<string>, qual double, filters array<string>, INFO_DP int, INFO_DB boolean, INFO_AF array<double>, genotypes array<struct<sampleId:string,phased:boolean,calls:array<int>,depth:int,phredLikelihoods:array<int>>>"
    return spark.createDataFrame(data, kinds).repartition(3)


def told(df) -> list[str]:  # noqa: ANN001
    return sorted(repr(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("codec", ["", "bgzf"])
def test_the_source_reads_what_the_reader_reads(spark, rows, tmp_path, codec):
    path = str(tmp_path / "t")
    rows.write.format("vcf").option("samples", "A,B").option("compression", codec).mode("append").save(path)
    mine, want = spark.read.format("vcf").load(path), vcf.read_vcf(spark, path)
    assert mine.dtypes == want.dtypes and told(mine) == told(want) and mine.count() == 900
    split = spark.read.format("vcf").option("splitsize", "500" if codec else "9000").load(path)
    assert told(split) == told(want) and split.rdd.getNumPartitions() > 6
    # what the other writer writes, plain and gzip
    for other in ("", "gzip"):
        vcf.write_sharded(rows, str(tmp_path / f"o{other}"), ["A", "B"], codec=other)
        assert told(spark.read.format("vcf").option("splitsize", "5000").load(str(tmp_path / f"o{other}"))) == told(want)


def test_filters_are_pushed_down(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    rows.write.format("vcf").option("samples", "A,B").mode("append").save(path)
    df = spark.read.format("vcf").load(path).where("contigName = 'c1' and start > 1000 and start <= 3000 and qual > 2")
    want = vcf.read_vcf(spark, path).where("contigName = 'c1' and start > 1000 and start <= 3000 and qual > 2")
    assert told(df) == told(want) and df.count() > 10
    r = vcf_source.Reader(path, 1 << 20, vcf_source.header_of_files(path).schema())
    from pyspark.sql import datasource as ds

    left = list(r.pushFilters([ds.EqualTo(("contigName",), "c1"), ds.GreaterThan(("start",), 1000), ds.GreaterThan(("qual",), 2.0)]))
    assert [f.attribute for f in left] == [("qual",)]
    assert sum(b.num_rows for p in r.partitions() for b in r.read(p)) == vcf.read_vcf(spark, path).where("contigName = 'c1' and start > 1000").count()


def test_overwrite_and_append(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write = lambda df, mode: df.write.format("vcf").option("samples", "A,B").mode(mode).save(path)
    write(rows, "append")
    write(rows.where("start < 100"), "append")
    assert spark.read.format("vcf").load(path).count() == 920
    write(rows.where("start < 50"), "overwrite")
    assert spark.read.format("vcf").load(path).count() == 10 and (tmp_path / "t" / "_SUCCESS").exists()


def test_a_failed_write_leaves_nothing(spark, rows, tmp_path):
    path = tmp_path / "t"
    write = lambda df: df.write.format("vcf").option("samples", "A,B").mode("append").save(str(path))
    write(rows.where("start < 100"))
    before = sorted(p.name for p in path.iterdir())
    bad = rows.withColumn("qual", F.when(F.col("start") == 3000, F.raise_error(F.lit("broken")).cast("double")).otherwise(F.col("qual")))
    with pytest.raises(Exception, match="broken"):
        write(bad)
    assert sorted(p.name for p in path.iterdir()) == before and spark.read.format("vcf").load(str(path)).count() == 20


@pytest.mark.parametrize("size", [1, 2, 5, 100])
def test_plain_parts(tmp_path, size):
    for data in (b"a\nbb\n\nccc\r\nd", b"", b"x", b"\n", b"aaaa\nb\n"):
        path = tmp_path / "x"
        path.write_bytes(data)
        got = [v for at in range(0, len(data), size) for v in vcf_source.plain_lines(str(path), at, min(at + size, len(data)))]
        want = data.split(b"\n")
        assert got == [v.removesuffix(b"\r") for v in (want[:-1] if want[-1] == b"" else want)]
