"""Reference sequences: FASTA files read in parts, as pieces of contigs, and the bases of windows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators.intervals import overlap_pairs
from helixframe.sources.bgzf import SUFFIX

#: Bases of a piece.
PIECE = 10_000


def read_fasta(spark: SparkSession, path: str | list[str], piece: int = PIECE) -> DataFrame:
    """(contigName, start, end, bases): pieces of at most `piece` bases, upper case. Names end at the first white space. Parts of
    a file are read by different tasks; a first pass measures how much of which contig each has, so that the second one
    knows where in its contig a part begins. Blocked gzip has no places in a file and is not read."""
    text = spark.read.text(path)
    if any(f.endswith(SUFFIX) for f in text.inputFiles()):
        raise ValueError(f"a FASTA file must be plain or gzip: {path}")
    lines = text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        name, held, size, at, segment = None, [], 0, 0, 0
        rows: list[tuple] = []

        def cut(n: int) -> None:
            """A piece of the first n bases that are held."""
            nonlocal held, size, at
            whole = "".join(held)
            rows.append((*now, segment, name, at, whole[:n]))
            held, size, at = [whole[n:]], size - n, at + n

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            types = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["file", "block", "segment", "name", "at", "bases"])

        for b in batches:
            for value, file, block in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now != (file, block):
                    if now and size:
                        cut(size)
                    now, name, held, size, at, segment = (file, block), None, [], 0, 0, 0
                if value.startswith(">"):
                    if size:
                        cut(size)
                    words = value[1:].split()
                    name, held, size, at, segment = words[0] if words else "", [], 0, 0, segment + 1
                    rows.append((*now, segment, name, 0, ""))  # a contig may begin with a part's last line
                    continue
                bases = value.strip().upper()
                held.append(bases)
                size += len(bases)
                while size >= piece:
                    cut(piece)
            if len(rows) > 500:
                yield out()
                rows.clear()
        if now and size:
            cut(size)
        yield out()

    pieces = lines.mapInArrow(run, "file string, block long, segment int, name string, at long, bases string")
    sizes = pieces.groupBy("file", "block", "segment", "name").agg(F.sum(F.length("bases")).alias("n")).orderBy("file", "block", "segment").collect()  # a row a part and contig
    begun, file, name, before = [], None, None, 0
    for r in sizes:
        if r.file != file:
            file, name, before = r.file, None, 0
        if r.name is not None:
            name, before = r.name, 0
        begun.append((r.file, r.block, r.segment, name, before))
        before += r.n
    known = F.broadcast(spark.createDataFrame(begun, "file string, block long, segment int, contigName string, before long"))
    found = pieces.where("bases <> ''").drop("name").join(known, ["file", "block", "segment"]).where("contigName is not null")
    start = F.col("before") + F.col("at")
    return found.select("contigName", start.alias("start"), (start + F.length("bases")).alias("end"), "bases")


def windows_of(pieces: DataFrame, windows: DataFrame) -> DataFrame:
    """(contigName, start, end, bases) of distinct windows, of those that lie in their contig as a whole."""
    w = windows.select(F.col("contigName").alias("_c"), F.col("start").alias("_s"), F.col("end").alias("_e")).distinct()
    both = overlap_pairs(w, pieces, ("_c", "_s", "_e"), ("contigName", "start", "end"), PIECE)
    low = F.greatest("_s", "start")
    part = F.struct(low.alias("at"), F.substr("bases", (low - F.col("start") + 1).cast("int"), (F.least("_e", "end") - low).cast("int")).alias("bases"))
    whole = both.groupBy("_c", "_s", "_e").agg(F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda x: x["bases"]), "").alias("bases"))  # as many as pieces of a window
    return whole.where(F.length("bases") == F.col("_e") - F.col("_s")).select(F.col("_c").alias("contigName"), F.col("_s").alias("start"), F.col("_e").alias("end"), "bases")
