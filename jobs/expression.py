"""Expression matrix of a cohort: how many good reads of each sample lie in the exons of each transcript.

    python jobs/expression.py --tables DIR --output DIR [--config FILE]

Reads come from lineitem (the sample of a read is the nation of its supplier), transcripts with two exons each from orders.
Reads pass the library's quality filter and are joined to exons by overlap; pairs are counted for each sample and transcript. The output is Parquet,
partitioned by sample: a row for each transcript with a read (count, and count per million reads kept) and the rows __reads,
__kept and __pairs of the sample, so that every sample has rows whatever its reads are. A run replaces the partitions of the samples it has
worked on (`samples` in the configuration; all if empty), so a second run gives the same table, and one of some samples leaves the others.

A null in supplier or nation leaves a read without a sample, and it is dropped; reads without a position overlap nothing.
Repeated orders are one transcript. Without reads nothing is written.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from helixframe.operators.expression import count_reads  # noqa: E402
from helixframe.operators.reads import good_read, quality_filter  # noqa: E402
from jobs.common import configured, log, new_folder, started  # noqa: E402

NAME = "expression"
#: Up to this number of suppliers their samples are sent to the tasks (some 50 MB); more are joined by a shuffle of the reads.
OWNERS_SENT = 1_000_000


def reads_of(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame, samples: list[str]) -> DataFrame:
    """Aligned reads with their sample. Spark cannot tell that suppliers with nations are few, and would shuffle reads each time they are used."""
    start = F.col("l_orderkey") * 10
    owner = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.lower("n_name").alias("sample"))
    owner = owner.where(F.col("sample").isin(samples)) if samples else owner.where("sample is not null")
    owner = F.broadcast(owner) if owner.limit(OWNERS_SENT + 1).count() <= OWNERS_SENT else owner
    rows = lineitem.join(owner, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select(
        "sample", F.concat(F.lit("chr"), (F.col("l_suppkey") % 5).cast("string")).alias("referenceName"), start.alias("start"), (start + F.floor("l_quantity")).alias("end"), (F.col("l_partkey") % 61).cast("int").alias("mappingQuality"),
        (F.col("l_partkey") % 11 != 0).alias("readMapped"), (F.col("l_linenumber") == 5).alias("secondaryAlignment"), (F.col("l_linenumber") == 7).alias("duplicateRead"), (F.col("l_partkey") % 17 == 0).alias("failedVendorQualityChecks"),
    )


def transcripts_of(orders: DataFrame) -> DataFrame:
    """Features: a transcript of every order and its two exons, each with the number of its order."""
    at = F.col("o_orderkey") * 10
    part = lambda kind, start, end: F.struct(F.lit(kind).alias("featureType"), (at + start).alias("start"), (at + end).alias("end"))
    named = orders.select("o_orderkey", "o_custkey").distinct()
    every = F.explode(F.array(part("transcript", 0, 27), part("exon", 0, 12), part("exon", 15, 27)))
    return named.select(F.concat(F.lit("chr"), (F.col("o_custkey") % 5).cast("string")).alias("referenceName"), F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("transcriptId"), "o_orderkey", every.alias("f")).select("referenceName", "transcriptId", "o_orderkey", "f.*")


def run(spark: SparkSession, tables: str, output: str, config: dict | None = None) -> None:
    """One run over the tables in the folder `tables`, into the folder `output`."""
    c = configured(NAME, known=config or {})
    read = lambda name: spark.read.parquet(f"{tables.rstrip('/')}/{name}.parquet")
    reads = reads_of(read("lineitem"), read("supplier"), read("nation"), c["samples"])
    features = transcripts_of(read("orders"))
    kept = quality_filter(reads, c["least_mapping_quality"])
    totals = reads.groupBy("sample").agg(F.count("*").alias("n_reads"), F.count_if(good_read(c["least_mapping_quality"])).alias("n_kept"))
    # order and contig tell a transcript and its place, so nothing is joined by transcript; sums of samples read the same shuffle as the matrix
    counts = count_reads(features, kept, c["bin_size"], by=("sample",), keys=("o_orderkey", "referenceName"))
    pairs = counts.groupBy("sample").agg(F.sum("count").alias("n_pairs"))
    special = totals.join(pairs, "sample", "left").select("sample", F.explode(F.create_map(F.lit("__reads"), F.col("n_reads"), F.lit("__kept"), F.col("n_kept"), F.lit("__pairs"), F.coalesce("n_pairs", F.lit(0).cast("long")))).alias("transcriptId", "count"))
    # rows of a sample meet in few files; a large sample is split
    dealt = counts.unionByName(special, allowMissingColumns=True).hint("rebalance", "sample")
    start = F.col("o_orderkey") * 10
    name, per_million = F.coalesce("transcriptId", F.concat(F.lit("t"), F.col("o_orderkey").cast("string"))), F.when(start.isNotNull(), F.col("count") * 1e6 / F.col("n_kept"))
    out = dealt.join(F.broadcast(totals), "sample")  # a row a sample: small
    out = out.select("sample", name.alias("transcriptId"), "referenceName", start.alias("start_pos"), (start + 27).alias("end_pos"), "count", per_million.alias("per_million"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sample").parquet(output)
    written = result(spark, output)
    written = written.where(F.col("sample").isin(c["samples"])) if c["samples"] else written
    total = lambda name: F.coalesce(F.sum(F.when(F.col("transcriptId") == name, F.col("count"))), F.lit(0))
    told = written.agg(F.count("*").alias("rows"), total("__reads").alias("reads"), total("__kept").alias("kept"), F.count_if(F.col("transcriptId") == "__reads").alias("samples")).first()
    log.info("read %s reads of %s samples from %s, %s of them kept", told.reads, told.samples, tables, told.kept)
    log.info("wrote %s rows to %s", told.rows, output)


def result(spark: SparkSession, output: str) -> DataFrame:
    """The table as it stands."""
    schema = "transcriptId string, referenceName string, start_pos long, end_pos long, count long, per_million double, sample string"
    return spark.read.schema(schema).parquet(output).select("sample", "transcriptId", "referenceName", "start_pos", "end_pos", "count", "per_million")


#: Both engines count pairs of a read and an exon, so a read in two exons counts twice.
JOB1_SQL = """
WITH r AS (SELECT lower(n_name) AS sample, concat('chr', CAST(l_suppkey % 5 AS VARCHAR)) AS c, l_orderkey * 10 AS s, l_orderkey * 10 + CAST(floor(l_quantity) AS BIGINT) AS e,
    l_partkey % 61 >= 20 AND l_partkey % 11 <> 0 AND l_linenumber NOT IN (5, 7) AND l_partkey % 17 <> 0 AS good FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE n_name IS NOT NULL),
t AS (SELECT DISTINCT concat('chr', CAST(o_custkey % 5 AS VARCHAR)) AS c, o_orderkey AS k FROM orders),
x AS (SELECT c, k, k * 10 + 15 * i AS fs, k * 10 + 15 * i + 12 AS fe FROM t, (VALUES (0), (1)) v(i)),
m AS (SELECT sample, x.k, x.c, count(*) AS n FROM r JOIN x ON r.c = x.c AND s < fe AND e > fs WHERE good GROUP BY ALL),
n AS (SELECT sample, count(*) AS n_reads, coalesce(count(*) FILTER (good), 0) AS n_kept FROM r GROUP BY sample),
p AS (SELECT n.*, CAST(coalesce(sum(m.n), 0) AS BIGINT) AS n_pairs FROM n LEFT JOIN m USING (sample) GROUP BY ALL)
SELECT sample, concat('t', CAST(k AS VARCHAR)) AS transcriptId, c AS referenceName, k * 10 AS start_pos, k * 10 + 27 AS end_pos, n AS count, n * 1000000.0::DOUBLE / n_kept AS per_million FROM m JOIN n USING (sample)
UNION ALL SELECT sample, '__reads', NULL, NULL, NULL, n_reads, NULL FROM p UNION ALL SELECT sample, '__kept', NULL, NULL, NULL, n_kept, NULL FROM p UNION ALL SELECT sample, '__pairs', NULL, NULL, NULL, n_pairs, NULL FROM p
"""


def job1_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job run twice into one folder, and what is there then."""
    output = new_folder(spark, NAME)
    for _ in range(2):
        run(spark, sf_dir, output)
    return result(spark, output)


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Expression matrix of a cohort")
    p.add_argument("--tables", required=True, help="folder with lineitem, supplier, nation and orders")
    p.add_argument("--output", required=True, help="folder of the table that is written")
    p.add_argument("--config", help=f"settings, as in {NAME}.json")
    a = p.parse_args(args)
    spark = started(NAME)
    try:
        run(spark, a.tables, a.output, configured(NAME, a.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
