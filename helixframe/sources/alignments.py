"""Reads: SAM text, BAM and FASTQ in, SAM text, BAM and Parquet out."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions.sequence import attribute, decode_flags
from helixframe.model import READ, RAW_READ
from helixframe.operators.reads import coordinate_sorted
from helixframe.sources.bgzf import PER_SLOT, TASK_BYTES, parts_of, records_of

BASES = "=ACMGRSVTWYHKDBN"
OPERATIONS = "MIDNSHP=X"
#: Numbers of bases (others as the last), and the two bases of a byte.
CODES = np.array([BASES.find(chr(k).upper()) % 16 if k < 128 else 15 for k in range(256)], np.uint8)
PAIRS = np.array([[ord(BASES[k >> 4]), ord(BASES[k & 15])] for k in range(256)], np.uint8)
RUN = re.compile(r"([0-9]+)([MIDNSHP=X])")
#: The fixed fields of a BAM record, its length first.
FIXED = np.dtype([("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("names", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("ops", "<u2"), ("flag", "<u2"), ("bases", "<i4"), ("mate", "<i4"), ("mate_pos", "<i4"), ("insert", "<i4")])
#: Bytes of text of the reads that are made to records at once, and of a part of a small file.
AT_ONCE, LEAST_BYTES = 4 << 20, 1 << 20


def short_name(name: str = "readName"):  # noqa: ANN201
    """A read's name up to the first space."""
    return F.substring_index(name, " ", 1)


def reference_length(cigar):  # noqa: ANN001, ANN201
    runs = F.regexp_extract_all(cigar, F.lit("([0-9]+)[MDN=X]"), F.lit(1))
    return F.aggregate(runs, F.lit(0).cast("long"), lambda a, n: a + n.cast("long"))


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SAM text to the read model."""
    return of_lines(spark.read.text(path))


def of_lines(lines: DataFrame) -> DataFrame:
    """The read model of SAM lines (`value`)."""
    rows = lines.where(~F.col("value").startswith("@") & (F.col("value") != "")).select(F.split("value", "\t").alias("c"))
    at = lambda k: F.get("c", F.lit(k))
    known = lambda x, none="*": F.when(x != none, x)
    attrs = F.array_join(F.slice("c", 12, 1 << 30), "\t")
    start = F.when(at(3) != "0", at(3).cast("long") - 1)
    return of_fields(rows, {
        "flag": at(1).cast("int"), "referenceName": known(at(2)), "start": start, "end": F.when(start.isNotNull() & (at(5) != "*"), start + reference_length(at(5))), "mappingQuality": at(4).cast("int"), "readName": at(0),
        "sequence": known(at(9)), "qualityScores": known(at(10)), "cigar": known(at(5)), "mateReferenceName": F.when(at(6) == "=", at(2)).otherwise(known(at(6))),
        "mateAlignmentStart": F.when(at(7) != "0", at(7).cast("long") - 1), "insertSize": at(8).cast("long"), "attributes": attrs,
    })


def of_fields(rows: DataFrame, known: dict[str, Column]) -> DataFrame:
    """The read model of rows with the fields of SAM: what follows from flags and attributes is added."""
    attrs = known["attributes"]
    got = {**known, **decode_flags(known["flag"]), "readName": short_name_of(known["readName"]), "readGroupId": attribute(attrs, "RG"), "mismatchingPositions": attribute(attrs, "MD"), "originalQualityScores": attribute(attrs, "OQ")}
    return rows.select(*((got[f.name] if f.name in got else F.lit(None)).cast(f.dataType).alias(f.name) for f in READ.fields))


#: Fixed values of the BAM format: one-letter number types of tags.
NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}


def slices(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all that slices hold, one slice after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def texts(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType, known: np.ndarray | None = None) -> pa.Array:
    """Strings of the given lengths that stand in a row; null where not known."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    out = pa.Array.from_buffers(kind, len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])
    if kind == pa.string() and len(values) and values.max() > 127:
        out.validate(full=True)
    return out if known is None or known.all() else pc.if_else(pa.array(known), out, pa.scalar(None, kind))


def told_cigar(ops: bytes) -> tuple[str | None, int | None]:
    """Text and length on the reference of a BAM record's operations."""
    runs = struct.unpack(f"<{len(ops) // 4}I", ops)
    return ("".join(f"{x >> 4}{OPERATIONS[x & 15]}" for x in runs), sum(x >> 4 for x in runs if OPERATIONS[x & 15] in "MDN=X")) if runs else (None, None)


def told_tags(body: bytes) -> str:
    """A BAM record's tags as SAM has them."""
    at, tags = 0, []
    while at < len(body):
        key, kind = body[at : at + 2].decode(), chr(body[at + 2])
        at += 3
        if kind in "ZH":
            end = body.index(0, at)
            tags.append(f"{key}:{kind}:{body[at:end].decode()}")
            at = end + 1
        elif kind == "A":
            tags.append(f"{key}:A:{chr(body[at])}")
            at += 1
        elif kind == "B":
            sub, n = chr(body[at]), struct.unpack_from("<i", body, at + 1)[0]
            values = struct.unpack_from(f"<{n}{NUMBERS[sub]}", body, at + 5)
            at += 5 + n * struct.calcsize(NUMBERS[sub])
            tags.append(f"{key}:B:{','.join([sub, *(f'{v:g}' if sub == 'f' else str(v) for v in values)])}")
        else:
            v = struct.unpack_from(f"<{NUMBERS[kind]}", body, at)[0]
            at += struct.calcsize(NUMBERS[kind])
            tags.append(f"{key}:f:{v:g}" if kind == "f" else f"{key}:i:{v}")
    return "\t".join(tags)


#: What is read of a BAM record.
FIELDS = {
    "flag": pa.int32(), "referenceName": pa.string(), "start": pa.int64(), "end": pa.int64(), "mappingQuality": pa.int32(), "readName": pa.string(), "sequence": pa.string(), "qualityScores": pa.string(), "cigar": pa.string(),
    "mateReferenceName": pa.string(), "mateAlignmentStart": pa.int64(), "insertSize": pa.int64(), "attributes": pa.string(),
}


def fields_of(data: bytes, places: np.ndarray, contigs: list[str]) -> pa.RecordBatch:
    """The fields of the BAM records at these places (the last is where they end). What is told apart one by one, CIGARs and tags, is so
    once for each that differs."""
    raw, at, end = np.frombuffer(data, np.uint8), places[:-1], places[1:]
    f = raw[at[:, None] + np.arange(FIXED.itemsize)].view(FIXED)[:, 0]
    names, ops, bases = (f[k].astype(np.int64) for k in ("names", "ops", "bases"))
    after = at + FIXED.itemsize + names
    packed = after + 4 * ops
    quality = packed + (bases + 1) // 2
    if (names < 1).any() or (bases < 0).any() or (quality + bases > end).any():
        raise ValueError("a BAM record is shorter than what it should hold")
    take = lambda start, length: raw[slices(start, length)]

    def apart(start: np.ndarray, length: np.ndarray, tell, kinds):  # noqa: ANN001, ANN202
        d = texts(take(start, length), length, pa.binary()).dictionary_encode()
        told = list(zip(*map(tell, d.dictionary.to_pylist()), strict=True))
        return [pa.array(v, k).take(d.indices) for v, k in zip(told, kinds, strict=True)]

    cigar, span = apart(after, 4 * ops, told_cigar, (pa.string(), pa.int64()))
    (tags,) = apart(quality + bases, end - quality - bases, lambda x: (told_tags(x),), (pa.string(),))
    letters = PAIRS[take(packed, (bases + 1) // 2)].reshape(-1)
    if (odd := bases % 2 == 1).any():
        kept = np.ones(len(letters), bool)
        kept[np.cumsum(bases + bases % 2)[odd] - 1] = False
        letters = letters[kept]
    scored = bases > 0
    scored[scored] = raw[quality[scored]] != 255
    shown = np.where(scored, bases, 0)
    scores = take(quality, shown)
    if len(scores) and scores.max() > 94:  # beyond ASCII
        qualities = pa.array(["".join(chr(x + 33) for x in data[q : q + n]) if ok else None for q, n, ok in zip(quality.tolist(), bases.tolist(), scored.tolist(), strict=True)], pa.string())
    else:
        qualities = texts(scores + np.uint8(33), shown, pa.string(), scored)
    known = pa.array(contigs, pa.string())
    name = lambda k: known.take(pa.array(f[k], mask=f[k] < 0))
    place = lambda k: pa.array(f[k].astype(np.int64), mask=f[k] == -1)
    start = place("pos")
    got = {
        "flag": f["flag"], "referenceName": name("ref"), "start": start, "end": pc.add(start, span), "mappingQuality": f["mapq"], "readName": texts(take(at + FIXED.itemsize, names - 1), names - 1, pa.string()),
        "sequence": texts(letters, bases, pa.string(), bases > 0), "qualityScores": qualities, "cigar": cigar, "mateReferenceName": name("mate"), "mateAlignmentStart": place("mate_pos"), "insertSize": f["insert"], "attributes": tags,
    }
    return pa.RecordBatch.from_arrays([got[n] if isinstance(got[n], pa.Array) else pa.array(got[n].astype(k.to_pandas_dtype()), k) for n, k in FIELDS.items()], names=list(FIELDS))


def bam_fields(path: str, start: int, end: int) -> Iterator[pa.RecordBatch]:
    """The fields of the records of a part of a BAM file."""
    for data, places, contigs in records_of(path, start, end):
        yield fields_of(data, places, contigs)


def bam_part(path: str, start: int, end: int) -> Iterator[bytes]:
    """The SAM lines of a part of a BAM file."""
    shown = lambda x, none="*": none if x is None else str(x)
    one = lambda x: "0" if x is None else str(x + 1)
    for batch in bam_fields(path, start, end):
        for r in batch.to_pylist():
            mate = "=" if r["mateReferenceName"] is not None and r["mateReferenceName"] == r["referenceName"] else shown(r["mateReferenceName"])
            line = [r["readName"], str(r["flag"]), shown(r["referenceName"]), one(r["start"]), str(r["mappingQuality"]), shown(r["cigar"]), mate, one(r["mateAlignmentStart"]), str(r["insertSize"]), shown(r["sequence"]), shown(r["qualityScores"])]
            yield "\t".join([*line, *([r["attributes"]] if r["attributes"] else [])]).encode()


def read_bam(spark: SparkSession, path: str | list[str], size: int | None = None) -> DataFrame:
    """BAM files to the read model, in parts of `size` bytes; without it of the session's split size, or less: records take far more time than
    other bytes, so that parts are to be many enough for all that can run at once."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").collect()
    if size is None:
        share = sum(f.length for f in files) // (PER_SLOT * spark.sparkContext.defaultParallelism)
        size = min(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes(), max(LEAST_BYTES, min(TASK_BYTES, share)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield from bam_fields(*part)

    kinds = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string"}
    rows = parts_of(spark, [f.path for f in files], size).mapInArrow(run, ", ".join(f"{n} {kinds[k]}" for n, k in FIELDS.items()))
    return of_fields(rows, {n: F.col(n) for n in FIELDS})


def short_name_of(x):  # noqa: ANN001, ANN201
    return F.substring_index(x, " ", 1)


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """(readGroupId, sample, library) of the @RG lines."""
    lines = spark.read.text(path).where(F.col("value").startswith("@RG"))
    of = lambda k: F.nullif(F.regexp_extract("value", rf"\t{k}:([^\t]+)", 1), F.lit(""))
    return lines.select(of("ID").alias("readGroupId"), of("SM").alias("sample"), of("LB").alias("library"))


def fastq_record(lines: list[str], stringency: str) -> tuple[str, int, bytes, str] | None:
    """The read of four lines; malformed ones are an error, or None unless STRICT."""
    name, bases, plus, quality = (x.rstrip("\r") for x in lines)
    if not name.startswith("@") or not plus.startswith("+") or len(bases) != len(quality):
        if stringency.upper() == "STRICT":
            raise ValueError(f"malformed FASTQ record {name!r}")
        return None
    m = re.match(r"@(\S*?)(?:/([12]))?(?:\s.*)?$", name)
    return m[1], int(m[2] or 1) - 1, bases.encode(), quality


def first_record(lines: list[str]) -> int:
    """How many of the first lines of a part of a file belong to a record of the part before: the first place from which
    the lines seen are records (a quality line may begin with @, but two lines on it has no + then)."""
    told = lambda k: sum(lines[j].startswith("@") and lines[j + 2].startswith("+") and len(lines[j + 1].rstrip("\r")) == len(lines[j + 3].rstrip("\r")) for j in range(k, len(lines) - 3, 4))
    whole = [told(k) - max(0, (len(lines) - k) // 4) for k in range(min(4, len(lines)))]
    return max(range(len(whole)), key=lambda k: (whole[k], -k)) if whole else 0


def fastq_reads_of(lines: pa.Array, stringency: str) -> list[pa.Array]:
    """The columns of the reads of whole records (names, numbers, bases, qualities); malformed ones are an error, or are left out unless STRICT."""
    lines = pc.ascii_rtrim(lines, characters="\r")
    name, bases, plus, quality = (lines.take(pa.array(np.arange(k, len(lines), 4))) for k in range(4))
    right = pc.and_(pc.and_(pc.starts_with(name, "@"), pc.starts_with(plus, "+")), pc.equal(pc.utf8_length(bases), pc.utf8_length(quality)))
    if not pc.all(right).as_py():
        if stringency.upper() == "STRICT":
            raise ValueError(f"malformed FASTQ record {name.filter(pc.invert(right))[0].as_py()!r}")
        name, bases, quality = (c.filter(right) for c in (name, bases, quality))
    if pc.any(pc.match_substring_regex(name, r"[^\t -~]")).as_py():  # what is white space beyond ASCII is told as for single records
        one = [fastq_record([n, "", "+", ""], stringency)[:2] for n in name.to_pylist()]
        return [pa.array([n for n, _ in one], pa.string()), pa.array([k for _, k in one], pa.int32()), bases.cast(pa.binary()), quality]
    told = pc.extract_regex(name, r"^@(?P<name>\S*?)(?:/(?P<number>[12]))?(?:\s.*)?$")
    number = pc.equal(pc.struct_field(told, "number"), "2").cast(pa.int32())
    return [pc.struct_field(told, "name"), number, bases.cast(pa.binary()), quality]


def fastq_parts(lines: DataFrame, stringency: str, edges: bool) -> DataFrame:
    """Reads of FASTQ lines (value, file and other: what tells a file, block: the offset of the part of the file that a task reads), or, with `edges`,
    what parts have of records that cross their ends. Lines stay in Arrow's arrays, but for a part's first ones and its ends."""
    names = ["file", "other", "block", "edge", "lines"] if edges else RAW_READ.names
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string())) if edges else (pa.string(), pa.int32(), pa.binary(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, aligned = None, pa.array([], pa.string()), False
        found: list[pa.RecordBatch] = []

        def edge(kind: str, some: pa.Array) -> None:
            if edges:
                found.append(pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*now, kind, some.to_pylist()), types, strict=True)], names=names))

        def drain(end: bool) -> None:
            nonlocal held, aligned
            if not aligned and end and now[2] and len(held) < 7:  # no record need be whole in so few lines
                edge("middle", held)
                held = held[:0]
                return
            if not aligned and (end or len(held) >= 4096):  # take what belongs to an earlier part off the first lines of this one
                if now[2]:
                    head = first_record(held[:4096].to_pylist())
                    edge("head", held[:head])
                    held = held[head:]
                aligned = True
            if aligned:
                upto = len(held) // 4 * 4
                if upto and not edges:
                    found.append(pa.RecordBatch.from_arrays(fastq_reads_of(held[:upto], stringency), names=names))
                held = held[upto:]
            if end:
                edge("tail", held)
                held = held[:0]

        for b in batches:
            value, *keys = b.columns
            a = np.stack([k.to_numpy() for k in keys])
            starts = [0, *(np.flatnonzero((a[:, 1:] != a[:, :-1]).any(axis=0)) + 1).tolist(), b.num_rows] if b.num_rows else []
            for lo, hi in zip(starts, starts[1:]):
                part = tuple(int(x) for x in a[:, lo])
                if now != part:
                    if now:
                        drain(True)
                    now, aligned = part, False
                more = value[lo:hi].cast(pa.string())
                held = pa.concat_arrays([held, more]) if len(held) else more
                drain(False)
            yield from found
            found.clear()
        if now:
            drain(True)
        yield from found

    return lines.mapInArrow(run, "file long, other long, block long, edge string, lines array<string>" if edges else RAW_READ)


def read_fastq(spark: SparkSession, path: str | list[str], second: str | list[str] | None = None, stringency: str = "STRICT") -> DataFrame:
    """Raw reads of FASTQ files, plain ones in parts of Spark's split size, gzip ones a file a task, all as streams. Names
    end at the first space or /1, /2, which number the read; files given as `second` hold second reads. Records that cross
    the ends of parts are put together from a few lines a part. Malformed and cut-off records are errors, or are dropped
    unless STRICT."""

    def stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for edges in b.column(0).to_pylist():
                lines: list[str] = []
                for e in edges:  # by part, head before tail
                    lines += e["lines"]
                    # a head ends the record that the tail and middles before it began
                    if e["edge"] == "head" or e is edges[-1]:
                        whole = [x for x in lines if x] if len(lines) % 4 and not any(lines[len(lines) // 4 * 4 :]) else lines
                        if len(whole) % 4 and stringency.upper() == "STRICT":
                            raise ValueError(f"malformed FASTQ record {whole[len(whole) // 4 * 4]!r}: cut off")
                        rows += [r for k in range(0, len(whole) // 4 * 4, 4) if (r := fastq_record(whole[k : k + 4], stringency))]
                        lines = []
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.binary(), pa.string()), strict=True)], names=RAW_READ.names)

    def load(p: str | list[str]) -> DataFrame:
        file = F.col("_metadata.file_path")  # told by two hashes, so that no path goes along with each line
        text = spark.read.text(p).select("value", F.xxhash64(file).alias("file"), F.xxhash64(F.lit("other"), file).alias("other"), F.col("_metadata.file_block_start").alias("block"))
        edge = F.struct("block", (F.col("edge") != "head").alias("after"), "edge", "lines")
        edges = fastq_parts(text, stringency, True).groupBy("file", "other").agg(F.sort_array(F.collect_list(edge)).alias("edges"))  # a few lines a part
        return fastq_parts(text, stringency, False).unionByName(edges.select("edges").mapInArrow(stitched, RAW_READ))

    first = load(path)
    if second is None:
        return first
    return first.withColumn("readInFragment", F.lit(0)).unionByName(load(second).withColumn("readInFragment", F.lit(1)))


def load_reads(spark: SparkSession, path: str, second: str | None = None, stringency: str = "STRICT") -> DataFrame:
    """By extension: SAM, BAM, FASTQ (with an optional second file) or Parquet."""
    name = path.lower().removesuffix(".gz")
    if name.endswith((".fq", ".fastq", ".ifq")):
        return read_fastq(spark, path, second, stringency)
    if name.endswith(".bam"):
        return read_bam(spark, path)
    return read_sam(spark, path) if name.endswith(".sam") else spark.read.parquet(path)


def sam_flag():  # noqa: ANN201
    """The flag field of the read model."""
    bits = [("readPaired", 1), ("properPair", 2), ("readNegativeStrand", 16), ("mateNegativeStrand", 32), ("secondaryAlignment", 256), ("failedVendorQualityChecks", 512), ("duplicateRead", 1024), ("supplementaryAlignment", 2048)]
    total = sum((F.when(F.coalesce(F.col(n), F.lit(False)), b).otherwise(0) for n, b in bits), F.lit(0))
    paired = F.coalesce(F.col("readPaired"), F.lit(False))
    total += F.when(F.coalesce(F.col("readMapped"), F.lit(False)), 0).otherwise(4)
    total += F.when(paired & ~F.coalesce(F.col("mateMapped"), F.lit(False)), 8).otherwise(0)
    return total + F.when(paired, F.when(F.col("readInFragment") == 1, 128).otherwise(64)).otherwise(0)


def sam_lines(reads: DataFrame) -> DataFrame:
    dot = lambda x, none="*": F.coalesce(F.col(x).cast("string"), F.lit(none))
    mate = F.when(F.col("mateReferenceName") == F.col("referenceName"), "=").otherwise(dot("mateReferenceName"))
    one = lambda x: F.coalesce((F.col(x) + 1).cast("string"), F.lit("0"))
    fields = [dot("readName"), sam_flag().cast("string"), dot("referenceName"), one("start"), dot("mappingQuality", "0"), dot("cigar"), mate, one("mateAlignmentStart"), dot("insertSize", "0"), dot("sequence"), dot("qualityScores"), F.nullif(F.col("attributes"), F.lit(""))]
    return reads.select(F.concat_ws("\t", *fields).alias("value"))


def sam_header(contigs: list[tuple[str, int]], groups: list[dict[str, str]] = (), sorted_by: str = "unsorted") -> list[str]:
    return [f"@HD\tVN:1.6\tSO:{sorted_by}", *(f"@SQ\tSN:{c}\tLN:{n}" for c, n in contigs), *("@RG\t" + "\t".join(f"{k}:{v}" for k, v in g.items()) for g in groups)]


def write_sam(reads: DataFrame, path: str, header: list[str], single: bool = False, sort: bool = False) -> None:
    """SAM text, sharded with a header in every file, or one file."""
    from helixframe.sources.binary import join_parts

    lines = sam_lines(coordinate_sorted(reads) if sort else reads)
    if single:
        join_parts(lines, path, "\n".join(header) + "\n")
        return

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(header, pa.string())], names=["value"])
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0)], names=["value"])

    lines.mapInArrow(run, "value string").write.mode("overwrite").text(path)


def packed_cigar(cigar: str) -> tuple[bytes, int]:
    """A CIGAR's operations as BAM has them, and its length on the reference."""
    runs = RUN.findall(cigar)
    return b"".join(struct.pack("<I", int(n) << 4 | OPERATIONS.index(o)) for n, o in runs), sum(int(n) for n, o in runs if o in "MDN=X")


def packed_tags(tags: str) -> bytes:
    """Tags of SAM as BAM has them."""
    extra = b""
    for t in tags.split("\t") if tags else ():
        key, kind, value = t.split(":", 2)
        extra += key.encode() + {"i": lambda v: b"i" + struct.pack("<i", int(v)), "f": lambda v: b"f" + struct.pack("<f", float(v)), "A": lambda v: b"A" + v.encode()}.get(kind, lambda v: b"Z" + v.encode() + b"\0")(value)
    return extra


def bytes_in(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings without nulls, one string after the other, and their lengths."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset).astype(np.int64) if len(column) else np.zeros(1, np.int64)
    held = column.buffers()[2]
    return (np.frombuffer(held, np.uint8) if held else np.zeros(0, np.uint8))[offsets[0] : offsets[-1]], np.diff(offsets)


def bam_records(b: pa.RecordBatch, contigs: list[str]) -> np.ndarray:
    """The BAM records, each with its length first, of reads (see `bam_rows`)."""
    column = lambda c, none="": pc.fill_null(b.column(c).cast(pa.string()), none)
    number = lambda c, none: pc.fill_null(b.column(c), none).to_numpy(zero_copy_only=False).astype(np.int64)

    def apart(c: str, tell):  # noqa: ANN001, ANN202
        d = column(c).dictionary_encode()
        told = [tell(x) for x in d.dictionary.to_pylist()]
        return told, d.indices

    told, which = apart("cigar", packed_cigar)
    cigar, ops = bytes_in(pa.array([x for x, _ in told], pa.binary()).take(which))
    span = np.array([n for _, n in told], np.int64)[which.to_numpy()]
    told, which = apart("attributes", packed_tags)
    tags, extra = bytes_in(pa.array(told, pa.binary()).take(which))
    name, names = bytes_in(column("readName", "*"))
    bases = column("sequence")
    bases = pc.if_else(pc.equal(bases, "*"), "", bases)
    codes, n = bytes_in(bases)
    if len(codes) and codes.max() > 127:
        codes, n = bytes_in(pa.array([x.encode("ascii", "replace") for x in bases.to_pylist()], pa.binary()))
    half = (n + 1) // 2
    digits = np.zeros(2 * half.sum(), np.uint8)
    digits[slices(2 * (np.cumsum(half) - half), n)] = CODES[codes]
    qualities = column("qualityScores", "*")
    missing = pc.equal(qualities, "*").to_numpy(zero_copy_only=False) & ((n != 1) | b.column("qualityScores").is_null().to_numpy(zero_copy_only=False))
    scores, scored = bytes_in(qualities)
    if len(scores) and scores.max() > 127:
        scores, scored = bytes_in(pa.array([x.encode("latin-1") for x in qualities.to_pylist()], pa.binary()))
    if (wrong := ~missing & (scored != n)).any():
        raise ValueError(f"read {b.column('readName')[int(wrong.argmax())]}: as many qualities as bases are needed")
    scores = scores - np.uint8(33)
    if missing.any():
        own = slices(np.cumsum(scored) - scored, np.where(missing, 0, scored))
        filled = np.full(n.sum(), 255, np.uint8)
        filled[slices(np.cumsum(n) - n, np.where(missing, 0, n))] = scores[own]
        scores = filled

    of = lambda c: pc.fill_null(pc.index_in(b.column(c), value_set=pa.array(contigs, pa.string())), -1).to_numpy(zero_copy_only=False)
    ref, start = of("referenceName"), number("start", -1)
    same = pc.fill_null(pc.equal(b.column("mateReferenceName"), "="), False).to_numpy(zero_copy_only=False)
    length = FIXED.itemsize + names + 1 + ops + half + n + extra
    values = {"size": length - 4, "ref": ref, "pos": start, "names": names + 1, "mapq": number("mappingQuality", 0), "bin": bin_of(start, start + np.maximum(span, 1)), "ops": ops // 4, "flag": number("flag", 0), "bases": n, "mate": np.where(same, ref, of("mateReferenceName")), "mate_pos": number("mateAlignmentStart", -1), "insert": number("insertSize", 0)}
    f = np.empty(b.num_rows, FIXED)
    for k, v in values.items():
        bound = np.iinfo(FIXED[k])
        if (beyond := (v < bound.min) | (v > bound.max)).any():
            raise ValueError(f"read {b.column('readName')[int(beyond.argmax())]}: {k} of {v[beyond.argmax()]} is more than BAM holds")
        f[k] = v
    at = np.cumsum(length) - length
    out = np.zeros(length.sum(), np.uint8)
    out[at[:, None] + np.arange(FIXED.itemsize)] = f.view(np.uint8).reshape(-1, FIXED.itemsize)
    at = at + FIXED.itemsize
    for piece, size, gap in ((name, names, 1), (cigar, ops, 0), (digits[::2] << 4 | digits[1::2], half, 0), (scores, n, 0), (tags, extra, 0)):
        out[slices(at, size)] = piece
        at = at + size + gap
    return out


def bam_rows(reads: DataFrame) -> DataFrame:
    """What a BAM record holds of reads, and what their order needs."""
    return reads.select(sam_flag().cast("int").alias("flag"), *(n for n in FIELDS if n not in ("flag", "end")), "readInFragment")


def few_at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches whose texts are not much longer than `AT_ONCE`, or of one read."""
    for b in batches:
        size = sum(pc.fill_null(pc.binary_length(b.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("sequence", "qualityScores", "attributes"))
        ends = np.flatnonzero(np.diff(np.cumsum(size) // AT_ONCE)) + 1
        for lo, hi in zip([0, *ends.tolist()], [*ends.tolist(), b.num_rows]):
            if hi > lo:
                yield b.slice(lo, hi - lo)


def bam_record(line: str, contigs: dict[str, int]) -> bytes:
    """One SAM line as a BAM record, length first."""
    name, flag, ref, pos, mapq, cigar, mate, mate_pos, size, bases, quality, *tags = line.split("\t")
    known = {"flag": int(flag), "referenceName": ref, "start": int(pos) - 1, "mappingQuality": int(mapq), "readName": name, "sequence": bases, "qualityScores": None if quality == "*" else quality, "cigar": cigar, "mateReferenceName": mate, "mateAlignmentStart": int(mate_pos) - 1, "insertSize": int(size), "attributes": "\t".join(tags)}
    return bam_records(pa.RecordBatch.from_arrays([pa.array([v], FIELDS[k]) for k, v in known.items()], names=list(known)), list(contigs)).tobytes()


def bin_of(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The smallest index bin that holds each interval: six levels, each eight times as fine."""
    last, out = end - 1, np.zeros_like(start)
    for shift, base in ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)):
        out = np.where(start >> shift == last >> shift, (base + (start >> shift)) & 0xFFFF, out)
    return out


def bam_header(header: list[str], contigs: list[tuple[str, int]]) -> bytes:
    text = ("\n".join(header) + "\n").encode()
    out = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(contigs))
    for name, n in contigs:
        out += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", n)
    return out


def write_bam(reads: DataFrame, path: str, header: list[str], contigs: list[tuple[str, int]], single: bool = False, sort: bool = False) -> None:
    """BAM: each partition's records as blocked gzip. As one file the parts are joined between header and closing block;
    sharded, every file has both."""
    from helixframe.sources.binary import join_blocked, write_parts

    names = [c for c, _ in contigs]
    head = bam_header(header, contigs)
    rows = bam_rows(reads)  # before they are sorted, so that no other columns are shuffled

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        if not single:
            yield head
        for b in few_at_once(batches):
            yield memoryview(bam_records(b, names))

    rows = coordinate_sorted(rows) if sort else rows
    if not single:
        write_parts(rows, path, ".bam", encode=records)
        return
    tmp = f"{path}.parts"
    write_parts(rows, tmp, ".bam", end=False, encode=records)
    join_blocked(tmp, path, head)


def save_reads(reads: DataFrame, path: str) -> None:
    reads.write.mode("overwrite").parquet(path)
