"""Shared helpers: reading tables, intermediate tables in the shared folder, joins with hot keys, Arrow plumbing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.session import LOCAL_SHARED, shared_dir
from helixframe.session import scratch_path as fresh_path

__all__ = ["EACH", "LOCAL_SHARED", "Scratch", "fresh_path", "remove_path", "shared_dir", "skewed_join", "slices", "table", "text_or_empty", "written"]
#: A key with more rows than this is dealt over several tasks.
EACH = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system through Hadoop's client."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("parquet.block.size", 32 << 20).parquet(path)  # a writer holds a row group
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """The intermediate tables of one run of an operator; `result` writes what the run is for and deletes them."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name, self.root = spark, name, fresh_path(spark, name)

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.option("parquet.block.size", 32 << 20).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def result(self, df: DataFrame) -> DataFrame:
        out = written(df, f"{self.name}-result")
        remove_path(self.spark, self.root)
        return out


def skewed_join(left: DataFrame, right: DataFrame, on: list[str], by: list[str], how: str = "inner", each: int | None = None) -> DataFrame:
    """left join right on `on`, where a value may hold a large part of `left` and `right` has a row or few for a value.
    Values with more than `each` rows are counted first (at most rows / each of them); their rows are dealt by a hash of
    `by` over as many parts as needed, and right's rows for them are repeated for each part."""
    each = each or EACH
    there = F.lit(True)
    for c in on:
        there = there & F.col(c).isNotNull()
    crowds = left.where(there).groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > each)
    hot = crowds.select(*on, F.ceil(F.col("_n") / each).cast("long").alias("_parts"))
    rows = hot.collect()  # at most the rows of `left` divided by `each`
    if not rows:
        return left.join(right, on, how)
    parts = F.broadcast(left.sparkSession.createDataFrame(rows, hot.schema))
    part = F.coalesce(F.pmod(F.xxhash64(*by), F.col("_parts")), F.lit(0).cast("long"))
    dealt = left.join(parts, on, "left").withColumn("_part", part).drop("_parts")
    every = F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1).cast("long")) - 1)
    repeated = right.join(parts, on, "left").withColumn("_part", F.explode(every)).drop("_parts")
    return dealt.join(repeated, [*on, "_part"], how).drop("_part")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches in pieces of few rows. Spark bounds a batch's bytes (spark.sql.execution.arrow.maxBytesPerBatch); this
    bounds how many texts are Python objects at once, whatever the session's settings."""
    for b in batches:
        for at in range(0, max(b.num_rows, 1), rows):
            yield b.slice(at, rows)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
