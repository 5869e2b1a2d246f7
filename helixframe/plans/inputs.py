"""Genomic inputs as deterministic projections of the driver's tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def reads(spark: SparkSession, d: str) -> DataFrame:
    """Aligned reads from lineitem."""
    t = table(spark, d, "lineitem")
    start = F.col("l_orderkey") * 10
    return t.select(
        F.concat(F.lit("chr"), (F.col("l_suppkey") % 5).cast("string")).alias("referenceName"), start.alias("start"), (start + F.floor("l_quantity")).alias("end"),
        (F.col("l_partkey") % 61).cast("int").alias("mappingQuality"), (F.col("l_returnflag") == "R").alias("readNegativeStrand"), (F.col("l_linenumber") == 7).alias("duplicateRead"),
        (F.col("l_partkey") % 11 != 0).alias("readMapped"), (F.col("l_linenumber") == 5).alias("secondaryAlignment"), (F.col("l_partkey") % 17 == 0).alias("failedVendorQualityChecks"),
        F.concat(F.lit("r"), F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_partkey").cast("string"), F.lit("_"), F.col("l_suppkey").cast("string")).alias("readName"),
        F.col("l_linenumber").alias("readInFragment"), F.col("l_linestatus").alias("library"), F.col("l_partkey").alias("part"),
    )


READS = """reads AS (SELECT concat('chr', CAST(l_suppkey % 5 AS VARCHAR)) AS referenceName, l_orderkey * 10 AS s, l_orderkey * 10 + CAST(floor(l_quantity) AS BIGINT) AS e,
  CAST(l_partkey % 61 AS INTEGER) AS mappingQuality, l_returnflag = 'R' AS readNegativeStrand, l_linenumber = 7 AS duplicateRead,
  l_partkey % 11 <> 0 AS readMapped, l_linenumber = 5 AS secondaryAlignment, l_partkey % 17 = 0 AS failedVendorQualityChecks,
  concat('r', CAST(l_orderkey AS VARCHAR), '_', CAST(l_partkey AS VARCHAR), '_', CAST(l_suppkey AS VARCHAR)) AS readName,
  l_linenumber AS readInFragment, l_linestatus AS library, l_partkey AS part FROM lineitem)"""


def regions(spark: SparkSession, d: str) -> DataFrame:
    """A target region for every order."""
    t = table(spark, d, "orders")
    return t.select(F.concat(F.lit("chr"), (F.col("o_custkey") % 5).cast("string")).alias("contigName"), (F.col("o_orderkey") * 10 + 5).alias("start"), (F.col("o_orderkey") * 10 + 30).alias("end"), F.col("o_orderkey").alias("region_id"))


REGIONS = """regions AS (SELECT concat('chr', CAST(o_custkey % 5 AS VARCHAR)) AS contig, o_orderkey * 10 + 5 AS rs, o_orderkey * 10 + 30 AS re, o_orderkey AS region_id FROM orders)"""


def features(spark: SparkSession, d: str) -> DataFrame:
    """A transcript for every order, with two exons each."""
    t = table(spark, d, "orders").select("o_orderkey", "o_custkey").distinct()
    exon = lambda k: F.struct(F.lit("exon").alias("featureType"), (F.col("o_orderkey") * 10 + 15 * k).alias("start"), (F.col("o_orderkey") * 10 + 15 * k + 12).alias("end"))
    whole = F.struct(F.lit("transcript").alias("featureType"), (F.col("o_orderkey") * 10).alias("start"), (F.col("o_orderkey") * 10 + 27).alias("end"))
    return t.select(F.concat(F.lit("chr"), (F.col("o_custkey") % 5).cast("string")).alias("referenceName"), F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("transcriptId"), F.explode(F.array(whole, exon(0), exon(1))).alias("f")).select("referenceName", "transcriptId", "f.*")


FEATURES = """tx AS (SELECT DISTINCT concat('chr', CAST(o_custkey % 5 AS VARCHAR)) AS contig, concat('t', CAST(o_orderkey AS VARCHAR)) AS transcriptId, o_orderkey * 10 AS ts FROM orders),
exons AS (SELECT contig, transcriptId, ts + 15 * k AS fs, ts + 15 * k + 12 AS fe FROM tx, (VALUES (0), (1)) v(k))"""

SAMPLES = 4


def variants(spark: SparkSession, d: str) -> DataFrame:
    """Single-sample variant rows from orders and lineitem keys: contig, start, end, sample, depth, quality, likelihoods."""
    t = table(spark, d, "orders")
    k = F.col("o_orderkey")
    span = F.when(F.col("o_custkey") % 9 == 0, 40).when(F.col("o_custkey") % 4 == 0, 4).otherwise(1)
    return t.select(
        F.concat(F.lit("chr"), (F.call_function("div", k, F.lit(1000).cast("long")) % 3).cast("string")).alias("contigName"), (k % 1000 * 7).alias("start"), (k % 1000 * 7 + span).cast("long").alias("end"),
        F.concat(F.lit("S"), (F.col("o_custkey") % SAMPLES).cast("string")).alias("sampleId"), (F.col("o_custkey") % 5 == 0).alias("polymorphic"),
        (F.col("o_custkey") % 100).cast("int").alias("gq"), (F.col("o_custkey") % 31).cast("int").alias("depth"), (F.col("o_custkey") % 900).cast("int").alias("pl2"), k.alias("key"), F.col("o_custkey").alias("cust"),
    )


VARIANTS = """variants AS (SELECT concat('chr', CAST((o_orderkey // 1000) % 3 AS VARCHAR)) AS contigName, o_orderkey % 1000 * 7 AS s,
  o_orderkey % 1000 * 7 + CASE WHEN o_custkey % 9 = 0 THEN 40 WHEN o_custkey % 4 = 0 THEN 4 ELSE 1 END AS e,
  concat('S', CAST(o_custkey % 4 AS VARCHAR)) AS sampleId, o_custkey % 5 = 0 AS polymorphic, CAST(o_custkey % 100 AS INTEGER) AS gq, CAST(o_custkey % 31 AS INTEGER) AS depth,
  CAST(o_custkey % 900 AS INTEGER) AS pl2, o_orderkey AS key, o_custkey AS cust FROM orders)"""
