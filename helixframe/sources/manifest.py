"""Sample sheets: CSV by path or inline, path resolution, grouping to samples and tumour/normal pairs."""

from __future__ import annotations

import csv
import io
import posixpath
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.model import PAIR_SHEET, SAMPLE_SHEET


def path_exists(spark: SparkSession, text: str) -> bool:
    """Whether the text is a path that exists; any failure to look means no."""
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(text)
        return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))
    except Exception:  # noqa: BLE001  not a path
        return False


@dataclass(frozen=True)
class Manifest:
    rows: DataFrame
    base: str | None

    def resolve(self, entry: str) -> str:
        return resolve(self.base, entry)


def resolve(base: str | None, entry: str) -> str:
    """An entry relative to the manifest's folder; absolute paths, other file systems and inline manifests as they are."""
    if base is None or re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", entry):
        return entry
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)(.*)", base)
    prefix, folder = (scheme[1], scheme[2]) if scheme else ("", base)
    return prefix + posixpath.normpath(posixpath.join(posixpath.dirname(folder), entry))


def resolved(base: str | None, entry: Column) -> Column:
    """`resolve` as an expression for entries without dot segments."""
    if base is None:
        return entry
    return F.when(entry.rlike("^[A-Za-z][A-Za-z0-9+.-]*:|^/"), entry).otherwise(F.concat(F.lit(posixpath.dirname(base) + "/"), entry))


def load(spark: SparkSession, path_or_text: str, expected: tuple[str, ...]) -> Manifest:
    """The sheet at a path, or the text itself as CSV. Columns must be the expected ones in any order."""
    if path_exists(spark, path_or_text):
        base, rows = path_or_text, spark.read.option("header", True).csv(path_or_text)
    else:
        lines = [x for x in csv.reader(io.StringIO(path_or_text)) if x]
        head, body = (lines[0], lines[1:]) if lines else ([], [])
        base, rows = None, spark.createDataFrame([[v or None for v in (*r, *[""] * len(head))[: len(head)]] for r in body], ", ".join(f"`{c}` string" for c in head) or "none string")
    if sorted(rows.columns) != sorted(expected):
        raise ValueError(f"manifest lacks the expected columns: expected {','.join(expected)}; found {','.join(rows.columns)}")
    return Manifest(rows.na.fill(""), base)


def file_list(spark: SparkSession, path_or_text: str) -> list[str]:
    """A list of files, one a line, at a path or as the text itself; it must not be empty."""
    if not path_or_text:
        raise ValueError("a list of files is needed")
    if path_exists(spark, path_or_text):
        return [resolve(path_or_text, r.value) for r in spark.read.text(path_or_text).collect() if r.value.strip()]
    return [x.strip() for x in path_or_text.splitlines() if x.strip()]


def _read_groups(rows: DataFrame, keys: list[str], base: str | None) -> DataFrame:
    first, second = F.col("paired_end") == "1", F.col("paired_end") != "1"
    path = resolved(base, F.col("file_path"))
    g = rows.groupBy(*keys, "read_group_id").agg(F.count(F.when(first, 1)).alias("n1"), F.count(F.when(second, 1)).alias("n2"), F.min(F.when(first, path)).alias("p1"), F.min(F.when(second, path)).alias("p2"))
    ok = (F.col("n1") == 0) | ((F.col("n1") == 1) & (F.col("n2") == 1))
    wrong = F.when(F.col("read_group_id") == "", "Read group ID cannot be empty.").when(~ok, "a read group needs one unpaired file, or two files, one for each end")
    checked = F.when(wrong.isNotNull(), F.raise_error(wrong).cast("string")).otherwise(F.when(F.col("n1") == 0, F.col("p2")).otherwise(F.col("p1")))
    return g.select(*keys, F.struct("read_group_id", checked.alias("input"), F.when(F.col("n1") > 0, F.col("p2")).alias("secondInput")).alias("g"))


def samples(rows: DataFrame, base: str | None = None) -> DataFrame:
    """(sample_id, read_groups: array<struct<read_group_id, input, secondInput>>) from sheet rows. Rows with paired_end 1
    are first ends, all others second ends or unpaired; of several unpaired files of a group the first by name counts."""
    return _read_groups(rows.na.fill(""), ["sample_id"], base).groupBy("sample_id").agg(F.sort_array(F.collect_list("g")).alias("read_groups"))


def pairs(rows: DataFrame, base: str | None = None) -> DataFrame:
    """(pair_id, samples: array<struct<label, sample_id, read_groups>>); a sample must have one label."""
    rows = rows.na.fill("")
    labels = rows.groupBy("pair_id", "sample_id").agg(F.count_distinct("label").alias("n"), F.min("label").alias("label"))
    label = F.when(F.col("n") != 1, F.raise_error(F.lit("Each label must correspond to exactly one sample_id")).cast("string")).otherwise(F.col("label"))
    groups = _read_groups(rows, ["pair_id", "sample_id"], base).groupBy("pair_id", "sample_id").agg(F.sort_array(F.collect_list("g")).alias("read_groups"))
    both = groups.join(labels, ["pair_id", "sample_id"])
    return both.groupBy("pair_id").agg(F.sort_array(F.collect_list(F.struct(label.alias("label"), "sample_id", "read_groups"))).alias("samples"))


def load_samples(spark: SparkSession, path_or_text: str) -> DataFrame:
    m = load(spark, path_or_text, SAMPLE_SHEET)
    return samples(m.rows, m.base)


def load_pairs(spark: SparkSession, path_or_text: str) -> DataFrame:
    m = load(spark, path_or_text, PAIR_SHEET)
    return pairs(m.rows, m.base)
