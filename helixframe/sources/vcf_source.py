"""VCF as a data source of Spark: spark.read.format("vcf") and df.write.format("vcf").

Reading: the schema comes from the header lines of the files; files are read in parts of `splitsize` bytes (plain and
blocked gzip; a gzip file is one part). Tests of contigName, start and end are pushed down: lines that fail them are not parsed.
Writing: a file a partition, each with the header (`samples`, comma-separated, name the columns of genotypes), blocked gzip
with `compression` "bgzf". Files are written to a folder of the job's own and moved into place when all are done; a job
that fails or is aborted leaves nothing. Rows have the columns of read_vcf and write_sharded.

`register(spark)` makes the format known to a session.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from helixframe.sources.bgzf import FETCH, SUFFIX, Blocks, lines_of
from helixframe.sources.binary import bgzf, open_fs
from helixframe.sources.vcf import GENOTYPE_NAMES, Header, full_header

SPLIT = 128 << 20


def files_of(path: str) -> list[tuple[str, int]]:
    """(path, size) of the files of a folder, or of one file; names that begin with _ or . are no data."""
    from pyarrow.fs import FileSelector, FileType

    fs, root = open_fs(path)
    info = fs.get_file_info(root)
    found = [info] if info.type == FileType.File else [f for f in fs.get_file_info(FileSelector(root)) if f.type == FileType.File and f.base_name[0] not in "_."]
    scheme = path.split("://")[0] + "://" + path.split("://")[1].split("/")[0] if "://" in path and not path.startswith("file:") else ""
    return sorted((f"{scheme}{f.path}" if scheme else f.path, f.size) for f in found)


def plain_lines(path: str, start: int, end: int) -> Iterator[bytes]:
    """The lines that begin after `start` and not after `end`, of which the first belongs to the part before unless start is 0."""
    fs, at = open_fs(path)
    with fs.open_input_file(at) as f:
        size, place, held, skip = f.size(), start, b"", start > 0
        while place < size:
            data = f.read_at(FETCH, place)
            held += data
            place += len(data)
            begin = place - len(held)  # of what is held
            *whole, held = held.split(b"\n")
            for line in whole:
                if skip:
                    skip = False
                elif begin > end:
                    return
                else:
                    yield line.removesuffix(b"\r")
                begin += len(line) + 1
            if begin > end and not skip:
                return
        if held and not skip and size - len(held) <= end:
            yield held.removesuffix(b"\r")


def part_lines(path: str, start: int, end: int) -> Iterator[bytes]:
    if path.endswith(SUFFIX):
        yield from lines_of(path, start, end)
    elif path.endswith(".gz"):
        fs, at = open_fs(path)
        with fs.open_input_stream(at, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
            for line in stream:
                yield line.rstrip(b"\r\n")
    else:
        yield from plain_lines(path, start, end)


def head_lines(path: str) -> list[str]:
    out = []
    for line in part_lines(path, 0, Blocks(path).size if path.endswith(SUFFIX) else 1 << 62):
        if not line.startswith(b"#"):
            break
        out.append(line.decode())
    return out


def header_of_files(path: str) -> Header:
    lines: set[str] = set()
    samples: set[str] = set()
    for name, _ in files_of(path):
        own = head_lines(name)
        lines |= {x for x in own if x.startswith("##")}
        samples |= {s for x in own if x.startswith("#CHROM") for s in x.split("\t")[9:]}
    return Header(tuple(sorted(lines, key=lambda x: (not x.startswith("##fileformat"), x))), tuple(sorted(samples)))


def number(text: str, kind: T.DataType) -> object:
    try:
        if isinstance(kind, T.DoubleType):
            return float(text)
        if isinstance(kind, T.IntegerType):
            return int(text)
    except ValueError:
        return None
    return None if text == "." else text


def typed(text: str | None, kind: T.DataType) -> object:
    """A field's text as its type; '.' and empty are null. A scalar field with several values takes the first."""
    if text in (None, "", "."):
        return None
    if isinstance(kind, T.ArrayType):
        return [number(v, kind.elementType) for v in text.split(",")]
    return text if isinstance(kind, T.StringType) else number(text.split(",")[0], kind)


def row_of(c: list[str], ids: list[str], header: Header) -> dict:
    """A line's columns as a row."""
    several = lambda x, sep: [] if x in (".", "") else x.split(sep)
    info = dict(x.partition("=")[::2] for x in c[7].split(";")) if len(c) > 7 else {}
    start = int(c[1]) - 1
    end = number(info.get("END", ""), T.IntegerType())
    out = {"contigName": c[0], "start": start, "end": start + len(c[3]) if end is None else end, "names": several(c[2], ";"), "referenceAllele": c[3], "alternateAlleles": several(c[4], ","), "qual": number(c[5], T.DoubleType()), "filters": several(c[6], ";")}
    for f in header.fields("INFO").values():
        if f.id != "END":
            out[f"INFO_{f.id}"] = f.id in info if f.type == "Flag" else typed(info.get(f.id), f.spark_type)
    keys = c[8].split(":") if len(c) > 8 else []
    kinds = header.fields("FORMAT")
    out["genotypes"] = []
    for sample, text in zip(ids, c[9:], strict=False):
        got = dict(zip(keys, text.split(":"), strict=False))
        gt = got.get("GT")
        calls = None if gt is None else [-1 if v == "." else number(v, T.IntegerType()) for v in gt.replace("|", "/").split("/")]
        out["genotypes"].append({"sampleId": sample, "phased": None if gt is None else "|" in gt, "calls": calls} | {GENOTYPE_NAMES.get(k, k): typed(got.get(k), f.spark_type) for k, f in kinds.items() if k != "GT"})
    return out


@dataclass
class Part(ds.InputPartition):
    path: str
    start: int
    end: int


#: What a pushed-down filter asks of a value.
TESTS: dict[type, Callable] = {ds.EqualTo: lambda v, x: v == x, ds.GreaterThan: lambda v, x: v > x, ds.GreaterThanOrEqual: lambda v, x: v >= x, ds.LessThan: lambda v, x: v < x, ds.LessThanOrEqual: lambda v, x: v <= x, ds.In: lambda v, x: v in x}


class Reader(ds.DataSourceReader):
    def __init__(self, path: str, size: int, schema: T.StructType) -> None:
        self.path, self.size, self.schema = path, size, schema
        self.contig: list[tuple[Callable, object]] = []
        self.place: list[tuple[Callable, object]] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:  # noqa: N802
        """Tests of contigName and start are done on the line's text; others are left to Spark."""
        for f in filters:
            test, column = TESTS.get(type(f)), getattr(f, "attribute", ())
            if test and column == ("contigName",):
                self.contig.append((test, f.value))
            elif test and column == ("start",):
                self.place.append((test, f.value))
            else:
                yield f

    def partitions(self) -> list[Part]:
        out = []
        for name, n in files_of(self.path):
            whole = name.endswith(".gz")
            out += [Part(name, at, n if whole else min(at + self.size, n)) for at in range(0, max(n, 1), max(n, 1) if whole else self.size)]
        return out

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        head = head_lines(part.path)
        own = Header(tuple(x for x in head if x.startswith("##")), ())
        ids = next((x.split("\t")[9:] for x in head if x.startswith("#CHROM")), [])
        arrow, held = to_arrow_schema(self.schema), []
        for line in part_lines(part.path, part.start, part.end):
            if not line or line.startswith(b"#"):
                continue
            c = line.decode().split("\t")
            if all(test(c[0], x) for test, x in self.contig) and all(test(int(c[1]) - 1, x) for test, x in self.place):
                held.append(row_of(c, ids, own))
            if len(held) == 2000:
                yield pa.RecordBatch.from_pylist(held, schema=arrow)
                held = []
        yield pa.RecordBatch.from_pylist(held, schema=arrow)


@dataclass
class Written(ds.WriterCommitMessage):
    name: str


def text(x: object) -> str | None:
    """A value as VCF has it, None if there is none."""
    if isinstance(x, list | tuple):
        return ",".join("." if v is None else str(v) for v in x) if x else None
    return None if x is None else str(x)


def line_of(r: T.Row, samples: list[str], info: list[str], kinds: list[str]) -> str:
    some = lambda x, sep: sep.join(x or []) or "."
    told = [f"END={r['end']}"] * (r["end"] != r["start"] + len(r["referenceAllele"]))
    told += [n[5:] if r[n] is True else f"{n[5:]}={text(r[n])}" for n in info if r[n] is not False and text(r[n]) is not None]
    of = lambda n: r[n] if n in r.__fields__ else None
    c = [r["contigName"], str(r["start"] + 1), some(of("names"), ";"), r["referenceAllele"], some(of("alternateAlleles"), ","), text(of("qual")) or ".", some(of("filters"), ";"), ";".join(told) or "."]
    if samples and "genotypes" in r.__fields__:
        back = {v: k for k, v in GENOTYPE_NAMES.items()}
        c.append(":".join(["GT", *(back.get(k, k) for k in kinds)]))
        known = {g["sampleId"]: g for g in r["genotypes"] or []}
        for s in samples:
            g = known.get(s)
            calls = ("|" if g and "phased" in g.__fields__ and g["phased"] else "/").join("." if v is None or v < 0 else str(v) for v in (g["calls"] if g and g["calls"] else [-1, -1]))
            c.append(":".join([calls, *(text(g[k]) or "." if g else "." for k in kinds)]))
    return "\t".join(c)


class Writer(ds.DataSourceWriter):
    def __init__(self, path: str, samples: list[str], codec: str, schema: T.StructType, overwrite: bool) -> None:
        self.path, self.samples, self.codec, self.overwrite = path, samples, codec, overwrite
        self.draft, self.suffix = f"{path}/_temporary-{uuid.uuid4().hex}", {"": ".vcf", "bgzf": f".vcf{SUFFIX}"}[codec]
        self.info = [n for n in schema.names if n.startswith("INFO_")]
        self.kinds = [f.name for f in schema["genotypes"].dataType.elementType.fields if f.name not in ("sampleId", "phased", "calls")] if "genotypes" in schema.names else []
        rows = type("Rows", (), {"schema": schema})
        self.head = "\n".join(full_header(rows, samples)) + "\n"

    def write(self, rows: Iterator[T.Row]) -> Written:
        task = TaskContext.get()
        fs, folder = open_fs(self.draft)
        fs.create_dir(folder, recursive=True)
        name = f"part-{task.partitionId():05d}-{uuid.uuid4().hex[:12]}{self.suffix}"

        def pieces() -> Iterator[bytes]:
            yield self.head.encode()
            for r in rows:
                yield line_of(r, self.samples, self.info, self.kinds).encode() + b"\n"

        with fs.open_output_stream(f"{folder}/{name}", compression=None) as out:
            for piece in bgzf(pieces()) if self.codec else pieces():
                out.write(piece)
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        """Only files of tasks that were committed come into place; what other attempts have left goes with the job's folder."""
        from pyarrow.fs import FileType

        fs, folder = open_fs(self.path)
        _, draft = open_fs(self.draft)
        old = [name for name, _ in files_of(self.path)] if self.overwrite and fs.get_file_info(folder).type == FileType.Directory else []
        for m in messages:
            if m is not None:
                fs.move(f"{draft}/{m.name}", f"{folder}/{m.name}")
        for name in old:
            f, at = open_fs(name)
            f.delete_file(at)
        self.abort(messages)
        with fs.open_output_stream(f"{folder}/_SUCCESS"):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow.fs import FileType

        fs, draft = open_fs(self.draft)
        if fs.get_file_info(draft).type == FileType.Directory:
            fs.delete_dir(draft)


class VcfSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "vcf"

    def path(self) -> str:
        if not self.options.get("path"):
            raise ValueError("a VCF needs a path")
        return self.options["path"].rstrip("/")

    def schema(self) -> T.StructType:
        return header_of_files(self.path()).schema()

    def reader(self, schema: T.StructType) -> Reader:
        return Reader(self.path(), int(self.options.get("splitsize", SPLIT)), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        codec = self.options.get("compression", "")
        if codec not in ("", "bgzf"):
            raise ValueError(f"unknown compression {codec!r}; known: '', 'bgzf'")
        return Writer(self.path(), [s for s in self.options.get("samples", "").split(",") if s], codec, schema, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(VcfSource)
