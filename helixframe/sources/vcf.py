"""VCF: header-typed reading with built-in expressions, and sorted writing, sharded or as one file.

Lines are read as text and parsed by split and regular expressions, so column pruning and whole-stage code apply; the
schema comes from the header lines of all files. Rows are zero-based half-open: start = POS - 1, end = INFO/END or
start + length of REF.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.sources.bgzf import SUFFIX, text_of

#: Genotype fields that have names of their own in the row model.
GENOTYPE_NAMES = {"DP": "depth", "AD": "alleleDepths", "GQ": "conditionalQuality", "PL": "phredLikelihoods", "GL": "genotypeLikelihoods"}
TYPES = {"Integer": T.IntegerType(), "Float": T.DoubleType(), "String": T.StringType(), "Character": T.StringType(), "Flag": T.BooleanType()}
EXTENSIONS = {"": "", "bgzf": SUFFIX, "gzip": ".gz"}
FIELD = re.compile(r"##(INFO|FORMAT)=<ID=([^,>]+),Number=([^,>]+),Type=([^,>]+)(?:,Description=\"((?:[^\"\\]|\\.)*)\")?")
CALLS = T.ArrayType(T.IntegerType())


@dataclass(frozen=True)
class Field:
    id: str
    number: str
    type: str
    description: str = ""

    @property
    def spark_type(self) -> T.DataType:
        base = TYPES.get(self.type, T.StringType())
        return base if self.number in ("1", "0") or self.type == "Flag" else T.ArrayType(base)


@dataclass(frozen=True)
class Header:
    lines: tuple[str, ...]
    samples: tuple[str, ...]

    def fields(self, kind: str) -> dict[str, Field]:
        out: dict[str, Field] = {}
        for line in self.lines:
            if (m := FIELD.match(line)) and m[1] == kind:
                out.setdefault(m[2], Field(m[2], m[3], m[4], m[5] or ""))
        return out

    def genotype_type(self) -> T.StructType:
        more = [T.StructField(GENOTYPE_NAMES.get(f.id, f.id), f.spark_type) for f in self.fields("FORMAT").values() if f.id != "GT"]
        return T.StructType([T.StructField("sampleId", T.StringType()), T.StructField("phased", T.BooleanType()), T.StructField("calls", CALLS), *more])

    def schema(self) -> T.StructType:
        words = T.ArrayType(T.StringType())
        kinds = {"contigName": T.StringType(), "start": T.LongType(), "end": T.LongType(), "names": words, "referenceAllele": T.StringType(), "alternateAlleles": words, "qual": T.DoubleType(), "filters": words}
        base = T.StructType([T.StructField(n, t) for n, t in kinds.items()])
        info = [T.StructField(f"INFO_{f.id}", f.spark_type) for f in self.fields("INFO").values() if f.id != "END"]
        return T.StructType([*base.fields, *info, T.StructField("genotypes", T.ArrayType(self.genotype_type()))])


def header_of(spark: SparkSession, paths: str | list[str]) -> Header:
    """Distinct header lines of all files (also those that no column comes from) and the sorted union of their samples."""
    lines = text_of(spark, paths, head=True).select("value").distinct()
    meta = [r.value for r in lines.where("value like '##%'").orderBy("value").collect()]  # as large as the distinct header lines
    names = lines.where("value like '#CHROM%'").select(F.explode(F.slice(F.split("value", "\t"), 10, 1 << 30)).alias("s")).distinct().orderBy("s")
    return Header(tuple(sorted(meta, key=lambda x: not x.startswith("##fileformat"))), tuple(r.s for r in names.collect()))


def sample_ids(spark: SparkSession, paths: str | list[str]) -> list[str]:
    return list(header_of(spark, paths).samples)


def _number(x: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DoubleType):
        low = F.lower(x)
        return F.when(low.isin("nan", "+nan", "-nan"), F.lit(float("nan"))).when(low.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf"))).when(low.isin("-inf", "-infinity"), F.lit(float("-inf"))).otherwise(x.try_cast("double"))
    return x.try_cast("int") if isinstance(kind, T.IntegerType) else F.nullif(x, F.lit("."))


def _typed(text: Column, kind: T.DataType) -> Column:
    """A field's text as its type; '.' and empty are null. A scalar field with several values takes the first."""
    present = F.when((text != "") & (text != "."), text)
    if isinstance(kind, T.ArrayType):
        return F.transform(F.split(present, ","), lambda v: _number(v, kind.elementType))
    return _number(F.get(F.split(present, ","), F.lit(0)), kind) if not isinstance(kind, T.StringType) else present


def read_vcf(spark: SparkSession, paths: str | list[str], header: Header | None = None, with_genotypes: bool = True) -> DataFrame:
    """Variant rows of VCF files (plain, gzip or blocked gzip; directories and globs as Spark takes them). A given header saves the pass
    that collects it. Files may have different samples: each row's genotypes follow its own file's #CHROM line."""
    header = header or header_of(spark, paths)
    text = text_of(spark, paths)
    rows = text.where(~F.col("value").startswith("#") & (F.col("value") != "")).withColumn("c", F.split("value", "\t"))
    at = lambda k: F.get("c", F.lit(k))
    optional = lambda x, sep: F.when((x == ".") | (x == ""), F.array().cast("array<string>")).otherwise(F.split(x, sep))
    info = F.concat(F.lit(";"), F.coalesce(at(7), F.lit("")), F.lit(";"))
    value = lambda key: F.regexp_extract(info, rf";{re.escape(key)}=([^;]*);", 1)
    start = at(1).cast("long") - 1
    columns = [
        at(0).alias("contigName"), start.alias("start"), F.coalesce(F.nullif(value("END"), F.lit("")).try_cast("long"), start + F.length(at(3))).alias("end"),
        optional(at(2), ";").alias("names"), at(3).alias("referenceAllele"), optional(at(4), ",").alias("alternateAlleles"), _number(at(5), T.DoubleType()).alias("qual"), optional(at(6), ";").alias("filters"),
    ]
    for f in header.fields("INFO").values():
        if f.id != "END":
            there = F.contains(info, F.lit(f";{f.id};"))
            columns.append((there if f.type == "Flag" else _typed(value(f.id), f.spark_type)).cast(f.spark_type).alias(f"INFO_{f.id}"))
    if not with_genotypes:
        return rows.select(*columns)
    names = text_of(spark, paths, head=True).where(F.col("value").startswith("#CHROM")).select("file", F.slice(F.split("value", "\t"), 10, 1 << 30).alias("ids")).dropDuplicates(["file"])
    rows = rows.join(names, "file", "left")
    keys = F.split(F.coalesce(at(8), F.lit("")), ":")

    def genotype(column: Column, sample: Column) -> Column:
        values = F.split(column, ":")
        of = lambda key: F.get(values, (F.array_position(keys, F.lit(key)) - 1).cast("int"))
        gt = F.when(F.array_position(keys, F.lit("GT")) > 0, of("GT"))
        calls = F.transform(F.split(gt, "[/|]"), lambda v: F.when(v == ".", -1).otherwise(v.try_cast("int")))
        more = [F.when(F.array_position(keys, F.lit(f.id)) > 0, _typed(of(f.id), f.spark_type)).cast(f.spark_type).alias(GENOTYPE_NAMES.get(f.id, f.id)) for f in header.fields("FORMAT").values() if f.id != "GT"]
        return F.struct(sample.alias("sampleId"), F.contains(gt, F.lit("|")).alias("phased"), calls.alias("calls"), *more)

    genotypes = F.zip_with(F.slice("c", 10, 1 << 30), "ids", genotype)
    return rows.select(*columns, F.coalesce(genotypes, F.array().cast(T.ArrayType(header.genotype_type()))).alias("genotypes"))


def read_sites(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(contigName, start) alone."""
    c = F.split("value", "\t")
    return text_of(spark, paths).where(~F.col("value").startswith("#") & (F.col("value") != "")).select(F.get(c, F.lit(0)).alias("contigName"), (F.get(c, F.lit(1)).cast("long") - 1).alias("start"))


def read_spans(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(contigName, start) of every place that a site's reference allele covers."""
    c = F.split("value", "\t")
    rows = text_of(spark, paths).where(~F.col("value").startswith("#") & (F.col("value") != "")).select(F.get(c, F.lit(0)).alias("contigName"), (F.get(c, F.lit(1)).cast("long") - 1).alias("at"), F.length(F.get(c, F.lit(3))).alias("n"))
    return rows.select("contigName", F.explode(F.sequence("at", F.col("at") + F.greatest(F.col("n"), F.lit(1)) - 1)).alias("start")).distinct()


def header_lines(schema: T.StructType) -> list[str]:
    """Header lines that describe a schema's INFO and genotype columns."""

    def line(kind: str, name: str, t: T.DataType) -> str:
        inner = t.elementType if isinstance(t, T.ArrayType) else t
        word = {T.IntegerType: "Integer", T.LongType: "Integer", T.DoubleType: "Float", T.FloatType: "Float", T.BooleanType: "Flag"}.get(type(inner), "String")
        number = "0" if word == "Flag" else "." if isinstance(t, T.ArrayType) else "1"
        return f'##{kind}=<ID={name},Number={number},Type={word},Description="">'

    back = {v: k for k, v in GENOTYPE_NAMES.items()}
    out = ["##fileformat=VCFv4.2"]
    out += [line("INFO", f.name[5:], f.dataType) for f in schema.fields if f.name.startswith("INFO_")]
    if "genotypes" in schema.names:
        out.append('##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">')
        out += [line("FORMAT", back.get(f.name, f.name), f.dataType) for f in schema["genotypes"].dataType.elementType.fields if f.name not in ("sampleId", "phased", "calls")]
    return out


def _text(x: Column, t: T.DataType) -> Column:
    if isinstance(t, T.ArrayType):
        return F.when(F.size(x) > 0, F.array_join(F.transform(x, lambda v: F.coalesce(v.cast("string"), F.lit("."))), ","))
    return x.cast("string")


def vcf_lines(rows: DataFrame, samples: list[str]) -> DataFrame:
    """(contigName, start, value): each row as a line. The given samples decide the columns: those a row lacks are
    no-calls, others are left out."""
    schema = rows.schema
    dot = lambda x: F.coalesce(F.nullif(x, F.lit("")), F.lit("."))
    info = [F.when(F.col(f.name), F.lit(f.name[5:])) if isinstance(f.dataType, T.BooleanType) else F.when(_text(F.col(f.name), f.dataType).isNotNull(), F.concat(F.lit(f"{f.name[5:]}="), _text(F.col(f.name), f.dataType))) for f in schema.fields if f.name.startswith("INFO_")]
    ends = F.when(F.col("end") != F.col("start") + F.length("referenceAllele"), F.concat(F.lit("END="), F.col("end").cast("string")))
    names = {"names": ";", "filters": ";", "alternateAlleles": ","}
    joined = {n: F.array_join(n, s) if n in schema.names else F.lit("") for n, s in names.items()}
    parts = ["contigName", (F.col("start") + 1).cast("string"), dot(joined["names"]), F.col("referenceAllele"), dot(joined["alternateAlleles"]), dot(F.col("qual").cast("string")) if "qual" in schema.names else F.lit("."), dot(joined["filters"]), dot(F.concat_ws(";", ends, *info))]
    if samples and "genotypes" in schema.names:
        back = {v: k for k, v in GENOTYPE_NAMES.items()}
        fields = [f for f in schema["genotypes"].dataType.elementType.fields if f.name not in ("sampleId", "phased", "calls")]
        phased = "phased" in schema["genotypes"].dataType.elementType.names
        parts.append(F.lit(":".join(["GT", *(back.get(f.name, f.name) for f in fields)])))

        def genotype(g: Column) -> Column:
            gt = F.when(F.coalesce(g["phased"], F.lit(False)), _calls(g, "|")).otherwise(_calls(g, "/")) if phased else _calls(g, "/")
            return F.concat_ws(":", gt, *(F.coalesce(_text(g[f.name], f.dataType), F.lit(".")) for f in fields))

        none = F.lit(":".join(["./.", *["."] * len(fields)]))
        of = lambda s: F.get(F.filter("genotypes", lambda g: g["sampleId"] == s), F.lit(0))
        parts.append(F.array_join(F.transform(F.array(*map(F.lit, samples)), lambda s: F.coalesce(F.when(of(s).isNotNull(), genotype(of(s))), none)), "\t"))
    return rows.select("contigName", "start", F.concat_ws("\t", *parts).alias("value"))


def _calls(g: Column, sep: str) -> Column:
    return F.array_join(F.transform(F.coalesce(g["calls"], F.array(F.lit(-1), F.lit(-1))), lambda v: F.when(v < 0, ".").otherwise(v.cast("string"))), sep)


def extension(codec: str) -> str:
    if codec not in EXTENSIONS:
        raise ValueError(f"unknown compression {codec!r}; known: {', '.join(map(repr, EXTENSIONS))}")
    return EXTENSIONS[codec]


def full_header(rows: DataFrame, samples: list[str], lines: list[str] | None = None) -> list[str]:
    columns = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", *(["FORMAT", *samples] if samples else [])]
    return [*(lines or header_lines(rows.schema)), "\t".join(columns)]


def write_sharded(rows: DataFrame, path: str, samples: list[str], lines: list[str] | None = None, codec: str = "", mode: str = "overwrite") -> None:
    """One file per partition, each sorted and with the header. Blocked gzip goes through the binary sink."""
    from helixframe.sources.binary import write_parts

    suffix = extension(codec)
    head = full_header(rows, samples, lines)
    text = vcf_lines(rows, samples).sortWithinPartitions("contigName", "start").select("value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(head, pa.string())], names=["value"])
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0)], names=["value"])

    with_head = text.mapInArrow(run, "value string")
    if codec == "bgzf":
        write_parts(with_head, path, f".vcf{suffix}", mode)
    else:
        with_head.write.mode(mode).option("compression", "gzip" if codec == "gzip" else "none").text(path)


def write_single(rows: DataFrame, path: str, samples: list[str], lines: list[str] | None = None, codec: str = "") -> None:
    """One file in (contigName, start) order: range partitions are sorted and written in parallel, then joined in order."""
    from helixframe.sources.binary import join_parts

    extension(codec)
    text = vcf_lines(rows, samples).repartitionByRange("contigName", "start").sortWithinPartitions("contigName", "start").select("value")
    join_parts(text, path, "\n".join(full_header(rows, samples, lines)) + "\n", codec)
