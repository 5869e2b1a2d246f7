"""Read counts per transcript."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators.intervals import overlap_pairs


def count_reads(features: DataFrame, reads: DataFrame, size: int = 1000, by: tuple[str, ...] = (), keys: tuple[str, ...] = ("transcriptId",)) -> DataFrame:
    """(transcriptId, count): overlapping pairs of exon and read, for each value of the reads' columns `by` (first in the
    result). A read that touches two exons of a transcript counts twice. `keys` are the features' columns that tell transcripts apart."""
    own = [k for k in keys if k != "referenceName"]
    exons = features.where("featureType = 'exon'").select(F.col("referenceName").alias("_f_contig"), F.col("start").alias("_f_start"), F.col("end").alias("_f_end"), *own)
    narrow = reads.select(F.col("referenceName").alias("_contig"), F.col("start").alias("_start"), F.col("end").alias("_end"), *by)
    pairs = overlap_pairs(exons, narrow, ("_f_contig", "_f_start", "_f_end"), ("_contig", "_start", "_end"), size)
    return pairs.groupBy(*by, *(k if k in own else F.col("_f_contig").alias(k) for k in keys)).count()


def score_transcripts(features: DataFrame, counts: DataFrame, sample: str) -> DataFrame:
    """All transcripts with their count as score (0.0 without reads) and the sample as source."""
    transcripts = features.where("featureType = 'transcript'").drop("score", "source")
    score = F.coalesce(F.col("count").cast("double"), F.lit(0.0))
    return transcripts.join(counts, "transcriptId", "left").withColumn("score", score).withColumn("source", F.lit(sample)).drop("count")


def quantify(features: DataFrame, reads: DataFrame, size: int = 1000) -> DataFrame:
    """score_transcripts for the one sample that the reads come from; more than one, or none, is an error."""
    samples = [r[0] for r in reads.select("readGroupSampleId").distinct().limit(2).collect()]
    if len(samples) != 1:
        raise ValueError("reads must come from exactly one sample")
    return score_transcripts(features, count_reads(features, reads, size), samples[0])
