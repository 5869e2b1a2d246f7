"""Tables at rest: Parquet with save modes, partition replacement, existence checks and predicates in paths."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = ("append", "overwrite", "errorifexists", "error", "ignore")
BLOCK_BYTES = 10 << 20


def _path(spark: SparkSession, path: str):  # noqa: ANN202
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a finished write."""
    return exists(spark, f"{path}/_SUCCESS")


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def save(df: DataFrame, path: str, mode: str = "append", codec: str = "snappy") -> None:
    if mode.lower() not in MODES:
        raise ValueError(f"unknown save mode {mode!r}")
    df.write.mode(mode.lower()).option("compression", codec).option("parquet.block.size", BLOCK_BYTES).parquet(path)


def replace_partitions(df: DataFrame, path: str, column: str, values: Sequence, codec: str = "snappy") -> None:
    """Write `df` partitioned by `column` in place of the partitions of `values`; others stay. Rows of other partitions are
    an error, and a listed partition without rows is emptied. Rows are written beside the table; then each partition's old
    folder is moved aside and the new one into place, and old ones are deleted last. Writers of different partitions do not
    disturb each other, a failed write changes nothing, and a failed move puts the old folders back."""
    if not values or any(v is None for v in values):
        raise ValueError("partition values must be given and not null")
    spark = df.sparkSession
    wanted = [str(v) for v in values]
    named = F.col(column).cast("string")
    wrong = F.raise_error(F.concat(F.lit("row outside the replaced partitions: "), F.coalesce(named, F.lit("null")))).cast(df.schema[column].dataType)
    run = uuid.uuid4().hex
    staging, aside = f"{path.rstrip('/')}.staging-{run}", f"{path.rstrip('/')}.replaced-{run}"
    try:
        df.withColumn(column, F.when(named.isin(wanted), F.col(column)).otherwise(wrong)).write.option("compression", codec).partitionBy(column).parquet(staging)
    except BaseException:
        delete(spark, staging)
        raise
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    table, fs = _path(spark, path)
    fs.mkdirs(table)
    fs.mkdirs(_path(spark, aside)[0])

    def move(source: str, target: str) -> None:
        if not fs.rename(_path(spark, source)[0], _path(spark, target)[0]):
            raise OSError(f"cannot move {source} to {target}")

    replaced: list[str] = []
    try:
        for v in wanted:
            folder = f"{escape(column)}={escape(v)}"
            if exists(spark, f"{path}/{folder}"):
                move(f"{path}/{folder}", f"{aside}/{folder}")
                replaced.append(folder)
            if exists(spark, f"{staging}/{folder}"):
                move(f"{staging}/{folder}", f"{path}/{folder}")
    except BaseException:
        for folder in replaced:  # what cannot be put back stays aside
            delete(spark, f"{path}/{folder}")
            move(f"{aside}/{folder}", f"{path}/{folder}")
        delete(spark, staging)
        delete(spark, aside)
        raise
    delete(spark, staging)
    delete(spark, aside)
    marker, fs = _path(spark, f"{path}/_SUCCESS")
    fs.create(marker, True).close()


def table_exists(spark: SparkSession, path: str, column: str | None = None, values: Sequence = ()) -> bool:
    """Whether a table is there with files, and with rows of every given partition."""
    p, fs = _path(spark, path)
    if not fs.exists(p) or not any(not s.getPath().getName().startswith("_") for s in fs.listStatus(p)):
        return False
    if column is None:
        return True
    rows = spark.read.parquet(path)
    return all(not rows.where(F.col(column).cast("string") == str(v)).isEmpty() for v in values)


def load(spark: SparkSession, path: str) -> DataFrame:
    """A table; trailing key=value parts of the path select partitions, which must not be empty."""
    base, tests = path.rstrip("/"), []
    while "=" in base.rsplit("/", 1)[-1]:
        base, last = base.rsplit("/", 1)
        tests.append(last.split("=", 1))
    rows = spark.read.parquet(base)
    for key, value in tests:
        rows = rows.where(F.col(key).cast("string") == value)
    if tests and rows.isEmpty():
        raise ValueError(f"no rows in {path}")
    return rows


def load_variants(spark: SparkSession, path: str) -> DataFrame:
    """A VCF by its extension, else a table."""
    from helixframe.sources.vcf import read_vcf

    return read_vcf(spark, path) if path.rstrip("/").endswith((".vcf", ".vcf.gz", ".vcf.bgz")) else load(spark, path)


def save_and_export(df: DataFrame, path: str, column: str, values: Sequence, samples: list[str], vcf: str | None = None, single: bool = False, codec: str = "") -> None:
    """Replace the partitions of `values` and, if a path is given, export just those rows as VCF from the table. The rest
    of the table is never deleted."""
    from helixframe.sources.vcf import write_sharded, write_single

    replace_partitions(df, path, column, values)
    if vcf:
        rows = df.sparkSession.read.schema(df.schema).parquet(path).where(F.col(column).cast("string").isin([str(v) for v in values])).drop(column)
        (write_single if single else write_sharded)(rows, vcf, samples, codec=codec)


def list_files(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The files behind paths, folders and globs."""
    return sorted(spark.read.text(paths).inputFiles())
