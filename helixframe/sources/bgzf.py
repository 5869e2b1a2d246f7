"""Blocked gzip in parts: text lines and alignment records of one file, read by many tasks.

A blocked gzip file is a row of gzip members of at most 64 KB, each with its length in its header. A task gets a range of bytes of
a file, finds the first block that starts in it, and reads the blocks that do. A line belongs to the part in which the line
break before it lies. A BAM record belongs to the part of the block in which it starts; a part that does not begin with the
file finds its first record by the form that records have, several in a row.

Nothing is lost silently: a part reads on to the first block of the next one, and fails unless the next part will
begin where it has ended. Checksums and lengths of blocks are compared, and a file that breaks off in a block is an error.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.sources.binary import open_fs

SUFFIX = ".bgz"
#: Bytes of the parts of one task, and tasks for each that can run at once, where parts are small.
TASK_BYTES, PER_SLOT = 16 << 20, 3
MAGIC = b"\x1f\x8b\x08\x04"
#: Bytes fetched at once; blocks and records in a row that prove a place.
FETCH, CHAIN, RECORDS = 1 << 20, 3, 6
NUMBER = struct.Struct("<i")


class Blocks:
    """The blocks of one file."""

    def __init__(self, path: str) -> None:
        fs, at = open_fs(path)
        self.path, self.raw = path, fs.open_input_file(at)
        self.size, self.held, self.begin = self.raw.size(), b"", 0

    def get(self, at: int, n: int) -> bytes:
        """The n bytes from `at` on, fewer at the end of the file."""
        if at < self.begin or at + n > self.begin + len(self.held):
            self.begin, self.held = at, self.raw.read_at(max(n, FETCH), at)
        return self.held[at - self.begin : at - self.begin + n]

    def length(self, at: int) -> int | None:
        """The length of the block that starts at `at`, None if none does."""
        head = self.get(at, 12)
        if len(head) < 12 or head[:4] != MAGIC:
            return None
        extra = self.get(at + 12, struct.unpack_from("<H", head, 10)[0])
        k = 0
        while k + 4 <= len(extra):
            n = struct.unpack_from("<H", extra, k + 2)[0]
            if extra[k : k + 2] == b"BC" and n == 2 and k + 6 <= len(extra):
                return struct.unpack_from("<H", extra, k + 4)[0] + 1
            k += 4 + n
        return None

    def first(self, at: int) -> int:
        """Where the first block from `at` on starts: one that others follow, or the end of the file. The file's size if there is none."""
        while at < self.size:
            window = self.get(at, FETCH)
            found = window.find(MAGIC)
            if found < 0:
                at += max(1, len(window) - len(MAGIC) + 1)
                continue
            at += found
            k = at
            for _ in range(CHAIN):
                n = self.length(k)
                k = -1 if n is None else k + n
                if k < 0 or k == self.size:
                    break
            if 0 <= k <= self.size:
                return at
            at += 1
        return self.size

    def block(self, at: int) -> tuple[bytes, int]:
        """The data of the block at `at`, and where the next one starts."""
        n = self.length(at)
        raw = self.get(at, n) if n else b""
        if not n or len(raw) != n:
            raise ValueError(f"{self.path} breaks off in the block at {at}")
        body = 12 + struct.unpack_from("<H", raw, 10)[0]
        data = zlib.decompress(raw[body:-8], -15)
        if struct.unpack("<II", raw[-8:]) != (zlib.crc32(data), len(data)):
            raise ValueError(f"{self.path}: checksum of the block at {at} is wrong")
        return data, at + n

    def met(self, end: int, at: int) -> None:
        """`at` is the first block beyond a part that ends at `end`; the next part must find it too."""
        if (found := self.first(end)) != at:
            raise ValueError(f"{self.path}: the part from {end} on would begin at {found} instead of {at}")


def lines_of(path: str, start: int, end: int) -> Iterator[bytes]:
    """The lines of one part of a file, without their ends."""
    b = Blocks(path)
    at = b.first(start) if start else 0
    held: list[bytes] = []
    skip, within = start > 0, True
    while at < b.size:
        if at >= end and within:
            within = False
            b.met(end, at)
            if skip:  # the part has no line break: what it holds belongs to a line of an earlier one
                return
        data, at = b.block(at)
        if within and skip:
            cut = data.find(b"\n")
            if cut < 0:
                continue
            data, skip = data[cut + 1 :], False
        cut = data.rfind(b"\n") if within else data.find(b"\n")
        if cut < 0:
            held.append(data)
            continue
        for line in b"".join([*held, data[:cut]]).split(b"\n"):
            yield line.removesuffix(b"\r")
        if not within:
            return
        held = [data[cut + 1 :]]
    if not skip and (last := b"".join(held)):
        yield last.removesuffix(b"\r")


class Header:
    """Contigs of a BAM file, and where its first record is: a block and a place in its data."""

    def __init__(self, b: Blocks) -> None:
        self.b, self.data, self.ends, self.at = b, b"", [], 0
        if self.need(0, 8)[:4] != b"BAM\1":
            raise ValueError(f"{b.path} is not a BAM file")
        k = 8 + self.number(4)
        n, k = self.number(k), k + 4
        self.contigs: list[tuple[str, int]] = []
        for _ in range(n):
            size = self.number(k)
            self.contigs.append((self.need(k + 4, size)[:-1].decode(), self.number(k + 4 + size)))
            k += 8 + size
        before = 0
        for begin, total in self.ends:
            if k < total:
                self.block, self.place = begin, k - before
                return
            before = total
        self.block, self.place = self.at, k - before  # it starts with the next block

    def need(self, k: int, n: int) -> bytes:
        while len(self.data) < k + n:
            if self.at >= self.b.size:
                raise ValueError(f"{self.b.path} breaks off in its header")
            begin = self.at
            more, self.at = self.b.block(begin)
            self.data += more
            self.ends.append((begin, len(self.data)))
        return self.data[k : k + n]

    def number(self, k: int) -> int:
        return struct.unpack("<i", self.need(k, 4))[0]


def plausible(data: bytes, k: int, contigs: list[tuple[str, int]]) -> int | None:
    """The length of the record that may stand at place k of `data` (which holds its fixed fields); None if none can. Positions may lie beyond
    the lengths that the header gives its contigs."""
    size, ref, pos, name, _, _, ops, _, bases, mate, mate_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, k)
    ok = size >= 32 and name >= 1 and bases >= 0 and -1 <= ref < len(contigs) and -1 <= mate < len(contigs) and 32 + name + 4 * ops + (bases + 1) // 2 + bases <= size
    if not ok or pos < -1 or mate_pos < -1:
        return None
    read_name = data[k + 36 : k + 36 + name]
    if len(read_name) == name and (read_name[-1] or not all(33 <= c <= 126 for c in read_name[:-1])):
        return None
    if any(x & 15 > 8 for x in data[k + 36 + name : k + 36 + name + 4 * ops : 4]):  # no such operation
        return None
    return size


def first_record(b: Blocks, at: int, contigs: list[tuple[str, int]]) -> int | None:
    """How far into the data from the block at `at` on the first record starts; None if there is none."""
    data, k = b"", 0

    def more() -> bool:
        nonlocal data, at
        if at >= b.size:
            return False
        piece, at = b.block(at)
        data += piece
        return True

    while True:
        while len(data) < k + 36:
            if not more():
                return None
        o, seen = k, 0
        while seen < RECORDS:
            while len(data) < o + 36 and more():
                pass
            if o == len(data) and seen:  # records to the end of the file
                return k
            if len(data) < o + 36 or (size := plausible(data, o, contigs)) is None:
                break
            while len(data) < o + 4 + size and more():
                pass
            if len(data) < o + 4 + size:
                break
            o, seen = o + 4 + size, seen + 1
        if seen == RECORDS:
            return k
        k += 1


def records_of(path: str, start: int, end: int) -> Iterator[tuple[bytes, np.ndarray, list[str]]]:
    """The records of one part of a BAM file in batches: data, the places in it where whole records begin (at their lengths) and a last one where
    they end, and the names of contigs."""
    b = Blocks(path)
    head = Header(b)
    names = [c for c, _ in head.contigs]
    at = b.first(start) if start else 0
    place: int | None = 0
    if at <= head.block:
        at, place = head.block, head.place
    elif at < min(end, b.size):
        place = first_record(b, at, head.contigs)
    if at >= min(end, b.size) or place is None:
        return
    held, own, past = bytearray(), 0, None  # own: bytes of held that are this part's; past: the first block of the next one

    def more() -> bool:
        nonlocal own, at, past
        if at >= b.size:
            return False
        if at >= end and past is None:
            past = at
            b.met(end, at)
        data, at = b.block(at)
        held.extend(data)
        own += len(data) if past is None else 0
        return True

    def need(n: int) -> None:
        while len(held) < n:
            if not more():
                raise ValueError(f"{path} breaks off in a record")

    while len(held) <= place and more():
        pass
    k = place
    while True:
        while own - k < FETCH and past is None and more():
            pass
        if k >= own:
            break
        found = []
        while k < own:
            need(k + 4)
            size = NUMBER.unpack_from(held, k)[0]
            if size < 32:
                raise ValueError(f"{path}: a record of {size} bytes")
            if found and past is None and len(held) < k + 4 + size:  # it is whole in the next batch
                break
            need(k + 4 + size)
            found.append(k)
            k += 4 + size
        yield bytes(memoryview(held)[:k]), np.array([*found, k]), names
        # what is left in held begins with the next record, or lies before it
        gone = min(k, own)
        del held[:gone]
        own, k = own - gone, k - gone
    if past is None:
        return
    found = first_record(b, past, head.contigs)
    if found is None:  # right if the file ends with the last record of this part
        while more():
            pass
        if len(held) != k:
            raise ValueError(f"{path}: the part from {end} on would find none of its records, of which one begins {k - own} into the block at {past}")
    elif found != k - own:
        raise ValueError(f"{path}: the part from {end} on would begin {found} into the block at {past} instead of {k - own}")


def parts_of(spark: SparkSession, files: list[str], size: int | None = None, head: bool = False) -> DataFrame:
    """(path, start, end): the parts of files, of the session's split size; with `head` the first of each file."""
    size = size or spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    found = spark.read.format("binaryFile").load(files).select("path", "length")
    starts = F.array(F.lit(0).cast("long")) if head else F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(size).cast("long"))
    parts = found.select("path", F.explode(starts).alias("start"), "length").select("path", "start", F.least(F.col("start") + size, "length").alias("end"))
    n = found.agg(F.sum(F.greatest(F.ceil(F.col("length") / size), F.lit(1)))).first()[0] if not head else len(files)
    total = found.agg(F.sum("length")).first()[0] or 0
    # a task takes several parts if they are small, but at least as many tasks run as the session runs at once
    tasks = min(n, max(PER_SLOT * spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))) if not head else n
    return parts.repartition(max(1, int(tasks)))


def read_parts(parts: DataFrame, read: Callable[[str, int, int], Iterator[str | bytes]]) -> DataFrame:
    """(value, file): what `read` gives of every part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held, size = [], 0
                out = lambda held=held, path=path: pa.RecordBatch.from_arrays([pa.array(held, pa.binary()).cast(pa.string()), pa.array([path] * len(held), pa.string())], names=["value", "file"])
                for value in read(path, start, end):
                    held.append(value)
                    size += len(value)
                    if size >= 4 * FETCH or len(held) >= 10_000:
                        yield out()
                        held.clear()
                        size = 0
                yield out()

    return parts.mapInArrow(run, "value string, file string")


def until_data(path: str, start: int, end: int) -> Iterator[bytes]:
    """The lines that a file begins with as long as they start with #."""
    for line in lines_of(path, 0, Blocks(path).size):
        if not line.startswith(b"#"):
            return
        yield line


def read_lines(spark: SparkSession, files: list[str], size: int | None = None) -> DataFrame:
    """(value, file) of all lines."""
    return read_parts(parts_of(spark, files, size), lines_of)


def read_heads(spark: SparkSession, files: list[str]) -> DataFrame:
    """(value, file) of the # lines at the beginning of each file; no more of it is read."""
    return read_parts(parts_of(spark, files, head=True), until_data)


def text_of(spark: SparkSession, paths: str | list[str], head: bool = False) -> DataFrame:
    """(value, file): lines of plain, gzip (a file a task) and blocked gzip files (.bgz, in parts). With `head` only # lines,
    for which no more than the beginning of a blocked file is read."""
    plain = spark.read.text(paths)
    files = plain.inputFiles()
    blocked = [f for f in files if f.endswith(SUFFIX)]
    rest = [f for f in files if not f.endswith(SUFFIX)]
    found = (spark.read.text([unquote(f) for f in rest]) if blocked else plain).select("value", F.col("_metadata.file_path").alias("file"))
    if head:
        found = found.where(F.col("value").startswith("#"))
    if not blocked:
        return found
    lines = (read_heads if head else read_lines)(spark, [unquote(f) for f in blocked])
    return found.unionByName(lines) if rest else lines
