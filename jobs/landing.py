"""Landing of raw reads: files of reads are taken in as they come, checked, and written by sample with totals of each read group.

    python jobs/landing.py --input DIR --output DIR --checkpoint DIR [--config FILE]

A read is a row of documents: doc_id is its name, source its read group, lang its sample, and the text its qualities (characters
outside the range of qualities count as the lowest). The library's functions give each read its score and its binned qualities. A file
stream with a checkpoint knows which files it has taken, so a run takes only new ones and ends when there are no more.

The output has two tables in Parquet, both written batch by batch: `reads` (partitioned by batch and sample) and `totals` (by batch: reads,
bases, score and reads that fail, of each lang and source in that batch). A batch that is run again after a failure has the same files and
the same number, and replaces its own partitions, so nothing is counted twice. Totals of a group are the sum over batches; no run reads what
earlier runs have written.

Null or empty texts have no bases and score 0; null names, groups and samples stay null, and null and empty samples share a
partition, as their values stand in the rows; repeated rows are reads of their own; a file that grows after it was taken is not taken again.
Files may have more columns.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from helixframe.functions.sequence import bin_qualities, read_score  # noqa: E402
from jobs.common import configured, log, new_folder, started  # noqa: E402

NAME = "landing"
SCHEMA = "doc_id long, text string, lang string, source string"
READS = "doc_id long, lang string, source string, bases long, score long, passed boolean, qualities string, batch long, sample string"
TOTALS = "lang string, source string, reads long, bases long, score long, failed long, batch long"


def landed(rows: DataFrame, c: dict) -> DataFrame:
    """Reads with score and binned qualities, and the partition that they belong to."""
    quality = F.regexp_replace(F.coalesce("text", F.lit("")), "[^!-~]", "!")
    score = F.when(F.col("q") == "", 0).otherwise(read_score("q")).cast("long")
    scored = rows.withColumn("q", quality).withColumn("score", score)
    sample = F.concat(F.lit("lang-"), F.coalesce(F.nullif("lang", F.lit("")), F.lit("none")))
    return scored.select("doc_id", "lang", "source", F.length("q").cast("long").alias("bases"), "score", (F.col("score") >= c["least_score"]).alias("passed"), bin_qualities("q", c["quality_bins"]).alias("qualities"), sample.alias("sample"))


def take(batch: DataFrame, number: int, output: str, c: dict) -> None:
    """Write one batch of new files: its reads, then its totals from what was written."""
    spark = batch.sparkSession
    rows = landed(batch, c).withColumn("batch", F.lit(number).cast("long"))
    replace = lambda df: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    replace(rows.hint("rebalance", "sample")).partitionBy("batch", "sample").parquet(f"{output}/reads")
    own = spark.read.schema(READS).parquet(f"{output}/reads").where(F.col("batch") == number)
    totals = own.groupBy("batch", "lang", "source").agg(F.count("*").alias("reads"), F.sum("bases").alias("bases"), F.sum("score").alias("score"), F.count_if(~F.col("passed")).alias("failed"))
    replace(totals.coalesce(1)).partitionBy("batch").parquet(f"{output}/totals")  # a row a read group
    told = spark.read.schema(TOTALS).parquet(f"{output}/totals").where(F.col("batch") == number).agg(F.sum("reads").alias("reads"), F.sum("bases").alias("bases")).first()
    log.info("batch %s: took %s reads of %s bases, wrote them to %s/reads", number, told.reads or 0, told.bases or 0, output)


def run(spark: SparkSession, input: str, output: str, checkpoint: str, config: dict | None = None) -> int:
    """Take every file of the folder `input` (or that file) that is new since the last run with this checkpoint. The number
    of batches."""
    c = configured(NAME, known=config or {})
    output = output.rstrip("/")
    path = input.rstrip("/")
    path = f"{path[:-1]}[{path[-1]}]"  # a pattern may name a folder or one file; a plain path of a stream must be a folder
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", c["files_per_batch"]).parquet(path)
    query = source.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, number: take(df, number, output, c)).start()
    query.awaitTermination()
    done = [p for p in query.recentProgress if p.numInputRows]
    log.info("read %s rows in %s batches from %s", sum(p.numInputRows for p in done), len(done), input)
    return len(done)


def reads(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(READS).parquet(f"{output}/reads")


def totals(spark: SparkSession, output: str) -> DataFrame:
    """The totals of each group over all batches."""
    every = spark.read.schema(TOTALS).parquet(f"{output}/totals")
    return every.groupBy("lang", "source").agg(*(F.sum(n).alias(f"group_{n}") for n in ("reads", "bases", "score", "failed")))


JOB2_SQL = f"""
WITH q AS (SELECT doc_id, lang, source, regexp_replace(coalesce(text, ''), '[^!-~]', '!', 'g') AS q FROM documents),
s AS (SELECT *, CAST(length(q) AS BIGINT) AS bases, CAST(coalesce(list_sum(list_filter(list_transform(string_split(nullif(q, ''), ''), lambda c: ord(c) - 33), lambda x: x >= 15)), 0) AS BIGINT) AS score FROM q),
b AS (SELECT *, score >= 1000 AS passed, md5(translate(q, '{"".join(chr(33 + x) for x in range(94)).replace("'", "''")}', '{"".join(chr(33 + (1 if x < 2 else x if x < 7 else 10 if x < 16 else 20 if x < 26 else 30)) for x in range(94)).replace("'", "''")}')) AS qualities_md5 FROM s)
SELECT doc_id, lang, source, bases, score, passed, qualities_md5, count(*) OVER g AS group_reads, CAST(sum(bases) OVER g AS BIGINT) AS group_bases, CAST(sum(score) OVER g AS BIGINT) AS group_score, count(*) FILTER (NOT passed) OVER g AS group_failed
FROM b WINDOW g AS (PARTITION BY lang, source)
"""


def job2_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job run twice over whole documents with one checkpoint; every read that is there then, with its group's totals."""
    folder = new_folder(spark, NAME)
    for _ in range(2):
        run(spark, f"{sf_dir}/documents.parquet", f"{folder}/output", f"{folder}/checkpoint")
    every, groups = reads(spark, f"{folder}/output"), totals(spark, f"{folder}/output")
    same = F.col("r.lang").eqNullSafe(F.col("g.lang")) & F.col("r.source").eqNullSafe(F.col("g.source"))
    names = ("group_reads", "group_bases", "group_score", "group_failed")
    return every.alias("r").join(groups.alias("g"), same).select("doc_id", "r.lang", "r.source", "r.bases", "r.score", "passed", F.md5(F.encode("qualities", "UTF-8")).alias("qualities_md5"), *names)


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Landing of raw reads")
    for name, what in (("input", "folder to which files of reads come"), ("output", "folder of the tables that are written"), ("checkpoint", "folder that keeps what was taken")):
        p.add_argument(f"--{name}", required=True, help=what)
    p.add_argument("--config", help=f"settings, as in {NAME}.json")
    a = p.parse_args(args)
    spark = started(NAME)
    try:
        run(spark, a.input, a.output, a.checkpoint, configured(NAME, a.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
