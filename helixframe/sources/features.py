"""Interval files: BED, narrowPeak, GTF/GFF2, GFF3, interval lists, sequence dictionaries; and the feature sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.model import FEATURE
from helixframe.sources.bgzf import text_of


def _columns(spark: SparkSession, path: str | list[str], skip: str) -> DataFrame:
    lines = text_of(spark, path).where(~F.col("value").rlike(skip) & (F.trim("value") != ""))
    return lines.select(F.split("value", "\t").alias("c"))


def _at(k: int) -> Column:
    x = F.get("c", F.lit(k))
    return F.when((x != "") & (x != "."), x)


def _features(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(*((columns[f.name] if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in FEATURE.fields))


def read_bed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """BED of 3 to 12 columns; zero-based half-open as it stands."""
    df = _columns(spark, path, r"^(#|track|browser)")
    return _features(df, referenceName=_at(0), start=_at(1), end=_at(2), name=_at(3), score=_at(4).try_cast("double"), strand=_at(5))


def read_narrow_peak(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_bed(spark, path).withColumn("featureType", F.lit("peak"))


def _gene_model(spark: SparkSession, path: str | list[str], value: str, keys: dict[str, str]) -> DataFrame:
    df = _columns(spark, path, "^#")
    attr = lambda k: F.nullif(F.regexp_extract(F.get("c", F.lit(8)), value.replace("KEY", k), 1), F.lit(""))
    return _features(df, referenceName=_at(0), source=_at(1), featureType=_at(2), start=_at(3).cast("long") - 1, end=_at(4), score=_at(5).try_cast("double"), strand=_at(6), **{n: attr(k) for n, k in keys.items()})


def read_gtf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """GTF/GFF2: one-based closed coordinates, attributes as key "value";."""
    return _gene_model(spark, path, '(?:^|;\\s*)KEY "?([^";]*)"?', {"geneId": "gene_id", "transcriptId": "transcript_id", "exonId": "exon_id", "name": "gene_name"})


def read_gff3(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _gene_model(spark, path, "(?:^|;)KEY=([^;]*)", {"geneId": "gene_id", "transcriptId": "transcript_id", "exonId": "exon_id", "name": "Name"})


def read_interval_list(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Interval list: header lines with @, one-based closed coordinates."""
    df = _columns(spark, path, "^@")
    return _features(df, referenceName=_at(0), start=_at(1).cast("long") - 1, end=_at(2), strand=_at(3), name=_at(4))


READERS = {".bed": read_bed, ".narrowpeak": read_narrow_peak, ".gtf": read_gtf, ".gff": read_gtf, ".gff2": read_gtf, ".gff3": read_gff3, ".interval_list": read_interval_list}


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """By extension, before a compression's."""
    name = path.lower().removesuffix(".gz").removesuffix(".bgz").rstrip("/")
    for ending, reader in sorted(READERS.items(), key=lambda x: -len(x[0])):
        if name.endswith(ending):
            return reader(spark, path)
    raise ValueError(f"unknown feature format: {path}; known: {', '.join(READERS)}")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(contigName, length) of a sequence dictionary or SAM header."""
    lines = text_of(spark, path).where(F.col("value").startswith("@SQ"))
    return lines.select(F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("contigName"), F.regexp_extract("value", r"\tLN:([0-9]+)", 1).cast("long").alias("length"))


def save_features(features: DataFrame, path: str) -> None:
    features.orderBy("referenceName", "start", "end").write.mode("overwrite").parquet(path)
