"""Base-quality recalibration: covariate cells counted inside tasks, and new qualities looked up inside rows.

No base becomes a row. A task turns the bases of its reads into numbers of cells, counts them with sorted arrays and emits a
row for each cell it has seen, so what is shuffled grows with cells and tasks. Known sites come to the reads: both are dealt by
bins of the contig, sites first, and a task holds the sites of one bin as a sorted array while the reads of that bin go by.
A bin with very many reads is split, after counting, and its sites are sent to each part. A read that reaches over
several bins is looked at in each of them, and each base is counted in the bin in which it lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.session import scratch_path

#: Places of a bin, reads of a part of a bin, and cells that a task holds before it emits them.
SITE_BIN, PART_ROWS, HELD = 100_000, 200_000, 1_000_000
CELLS = "readGroupId string, q int, cycle int, context string, errors long, n long"


def cell_codes(groups: np.ndarray, n: np.ndarray, bases: np.ndarray, qualities: np.ndarray) -> np.ndarray:
    """One number for every base of some reads, of `n` bases each: its cell (group, reported quality, cycle, dinucleotide)."""
    ends = np.cumsum(n)
    base, q = bases.astype(np.int64), qualities.astype(np.int64) - 33
    cycle = np.arange(len(base)) - np.repeat(ends - n, n)
    # the base before and the base itself; a read's first base counts with its second
    at = np.arange(len(base)) - (cycle > 0)
    second = np.minimum(at + 1, np.repeat(ends, n) - 1)
    pair = base[at] * 256 + np.where(second > at, base[second], 0)
    return ((np.repeat(groups, n) * 128 + q) << 40) + (cycle << 16) + pair


def sizes_of(column: pa.Array) -> np.ndarray:
    """Bytes of each text, 0 for null."""
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def bytes_of(column: pa.Array, rows: np.ndarray) -> np.ndarray:
    """The bytes of the texts of some rows (a mask), one after the other; no text becomes a Python object."""
    some = column.filter(pa.array(rows)).cast(pa.large_binary())
    if not len(some):
        return np.zeros(0, np.uint8)
    at = np.frombuffer(some.buffers()[1], np.int64, len(some) + 1, some.offset * 8)
    return np.frombuffer(some.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]


def plain_reads(columns: list[pa.Array]) -> np.ndarray:
    """Which reads have all of these texts, not empty, in ASCII and of one length."""
    n = sizes_of(columns[0])
    ok = n > 0
    for c in columns:
        ok &= (sizes_of(c) == n) & pc.fill_null(pc.string_is_ascii(c), False).to_numpy(zero_copy_only=False)
    return ok


def numbers_of(names: pa.Array, known: dict[str | None, int], grow: bool = False) -> np.ndarray:
    """The number of each row's read group; with `grow` new groups get the next one."""
    told = pc.unique(names)
    if grow:
        for g in told.to_pylist():
            known.setdefault(g, len(known))
    found = [known.get(g, -1) for g in told.to_pylist()]
    return np.array(found, np.int64)[pc.index_in(names, value_set=told).to_numpy(zero_copy_only=False).astype(np.int64)]


class Cells:
    """Counts of cells, merged whenever many are held."""

    def __init__(self) -> None:
        self.groups: dict[str | None, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, codes: np.ndarray, wrong: np.ndarray) -> None:
        found, inverse = np.unique(codes, return_inverse=True)
        self.parts.append((found, np.bincount(inverse, weights=wrong, minlength=len(found)).astype(np.int64), np.bincount(inverse, minlength=len(found))))
        self.size += len(found)
        if self.size > HELD:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])

    def merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, errors, n = (np.concatenate([p[k] for p in self.parts]) if self.parts else np.zeros(0, np.int64) for k in range(3))
        found, inverse = np.unique(codes, return_inverse=True)
        out = np.zeros((2, len(found)), np.int64)
        np.add.at(out[0], inverse, errors)
        np.add.at(out[1], inverse, n)
        return found, out[0], out[1]

    def rows(self) -> Iterator[pa.RecordBatch]:
        codes, errors, n = self.merged()
        self.parts, self.size = [], 0
        names = pa.array(list(self.groups), pa.string())
        for at in range(0, len(codes), 50_000):
            c = codes[at : at + 50_000]
            first, second = c >> 8 & 255, c & 255
            context = [chr(a) + (chr(b) if b else "") for a, b in zip(first.tolist(), second.tolist(), strict=True)]
            columns = [names.take(pa.array(c >> 47)), pa.array((c >> 40 & 127).astype(np.int32)), pa.array((c >> 16 & 0xFFFFFF).astype(np.int32)), pa.array(context, pa.string()), pa.array(errors[at : at + 50_000]), pa.array(n[at : at + 50_000])]
            yield pa.RecordBatch.from_arrays(columns, names=["readGroupId", "q", "cycle", "context", "errors", "n"])


def counted(cells: Cells, batch: pa.RecordBatch, least: int, known: np.ndarray | None = None, inside: tuple[int, int] | None = None) -> None:
    """Count the bases of a batch of reads. With `known` sites those at them are left out; with `inside` only bases at these
    places count, and of bases without a place those of reads that start there."""
    of = lambda c: batch.column(batch.schema.get_field_index(c))
    texts = [of(c) for c in ("sequence", "qualityScores", "referenceBases")]
    ok = plain_reads(texts)
    if not ok.any():
        return
    b, qual, r = (bytes_of(c, ok) for c in texts)
    n = sizes_of(texts[0])[ok]
    codes = cell_codes(numbers_of(of("readGroupId").filter(pa.array(ok)), cells.groups, grow=True), n, b, qual)
    keep = (qual >= least + 33) & (r != ord("-"))
    if inside is not None:
        site = sites_of(batch, ok, n)
        starts = np.repeat(starts_of(batch, ok), n)
        low, high = inside
        where = np.where(site < 0, starts, site)
        keep &= (where >= low) & (where < high) if low >= 0 else True
        if known is not None and len(known):
            at = np.minimum(np.searchsorted(known, site), len(known) - 1)
            keep &= known[at] != site
    cells.add(codes[keep], (b != r)[keep])


def starts_of(batch: pa.RecordBatch, rows: np.ndarray) -> np.ndarray:
    return pc.fill_null(batch.column(batch.schema.get_field_index("start")), -1).to_numpy(zero_copy_only=False).astype(np.int64)[rows]


def sites_of(batch: pa.RecordBatch, rows: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The place of every base of some reads (a mask), of `n` bases each, -1 where it has none."""
    names = batch.schema.names
    if "referenceSites" in names:
        lists = batch.column(names.index("referenceSites")).filter(pa.array(rows))
        if pc.list_value_length(lists).to_pylist() == n.tolist():
            return pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    nowhere = np.repeat(batch.column(names.index("start")).is_null().to_numpy(zero_copy_only=False)[rows], n)
    starts = np.repeat(starts_of(batch, rows), n)
    return np.where(nowhere, -1, starts + np.arange(len(starts)) - np.repeat(np.cumsum(n) - n, n))


def counts_alone(reads: DataFrame, least: int) -> DataFrame:
    """Partial counts of cells, where no sites are known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = Cells()
        for b in batches:
            counted(cells, b, least)
        yield from cells.rows()

    return reads.select("readGroupId", "sequence", "qualityScores", "referenceBases").mapInArrow(run, CELLS)


def counts_beside(reads: DataFrame, sites: DataFrame, least: int, size: int | None = None, most: int | None = None) -> DataFrame:
    """Partial counts of cells outside known sites (contigName, start)."""
    size, most = size or SITE_BIN, most or PART_ROWS
    told = "referenceSites" in reads.columns
    whole = F.col("start") + F.length("sequence") - 1
    last = F.coalesce(F.array_max("referenceSites"), whole) if told else whole
    first = F.coalesce(F.array_min("referenceSites"), F.col("start")) if told else F.col("start")
    into = lambda x: F.floor(x / size).cast("long")
    used = ["readGroupId", "referenceName", "start", "sequence", "qualityScores", "referenceBases", *(["referenceSites"] if told else [])]
    named = ["readName"] if "readName" in reads.columns else []
    placed = reads.select(*used, *named).where(F.length("sequence") > 0)
    # reads without a place are in a bin of their own, which has no sites
    bins = F.when(F.col("start").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(F.sequence(into(F.least("start", first)), into(F.greatest("start", last))))
    binned = placed.withColumn("_bin", F.explode(bins)).withColumn("_contig", F.coalesce("referenceName", F.lit("")))
    parts = binned.groupBy("_contig", "_bin").agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    hot = parts.select("_contig", "_bin", F.ceil(F.col("_n") / most).cast("int").alias("_parts"))  # at most reads / most rows
    deal = F.pmod(F.xxhash64("start", "sequence", "qualityScores", *named), F.coalesce("_parts", F.lit(1))).cast("int")
    binned = binned.join(hot, ["_contig", "_bin"], "left").withColumn("_part", deal).drop("_parts", *named)
    known = sites.select(F.col("contigName").alias("_contig"), F.col("start").cast("long").alias("_site")).where("_contig is not null and _site is not null").distinct()
    known = known.withColumn("_bin", into(F.col("_site"))).join(hot, ["_contig", "_bin"], "left")
    known = known.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    # one table: the sites of a bin in order, then its reads
    every = known.unionByName(binned, allowMissingColumns=True)
    keys = ["_contig", "_bin", "_part"]
    sorted_ = every.repartition(*keys).sortWithinPartitions(*keys, F.asc_nulls_last("_site"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, now, held = Cells(), None, [np.zeros(0, np.int64)]
        for b in batches:
            names = b.schema.names
            site, changed = b.column(names.index("_site")), np.arange(b.num_rows) == 0
            for c in keys:
                column = b.column(names.index(c))
                changed[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            begins = np.flatnonzero(changed).tolist()
            for at, to in zip(begins, [*begins[1:], b.num_rows], strict=True):
                own = tuple(b.column(names.index(c))[at].as_py() for c in keys)
                if own != now:
                    now, held = own, [np.zeros(0, np.int64)]
                mine = site[at:to]
                n = len(mine) - mine.null_count
                if n:
                    held.append(mine[:n].to_numpy(zero_copy_only=False).astype(np.int64))
                if n < len(mine):
                    if len(held) > 1:
                        held = [np.concatenate(held)]
                    low = now[1] * size
                    counted(cells, b.slice(at + n, to - at - n), least, held[0], (low, low + size) if now[1] != -1 else (-1, -1))
        yield from cells.rows()

    return sorted_.mapInArrow(run, CELLS)


def recalibrate(reads: DataFrame, known_sites: DataFrame | None, least_quality: int = 6) -> DataFrame:
    """A model of base qualities. Every base of at least `least_quality` outside known sites falls into a covariate cell
    (read group, reported quality, cycle, dinucleotide); mismatches against the read's `referenceBases` give each cell an
    empirical quality, relative to the group's and quality's own. Reads need referenceBases, with '-' where a base has none;
    referenceSites, if there, tells their places where clips and gaps move them. Reads whose bases, qualities and reference bases differ in
    length are not counted."""
    counts = counts_alone(reads, least_quality) if known_sites is None else counts_beside(reads, known_sites, least_quality)
    phred = lambda errors, n: F.round(-10 * F.log10((errors + 1) / (n + 2))).cast("int")
    # cells are stored: the model takes them four times, and reads are counted in one pass
    spark, path = reads.sparkSession, scratch_path(reads.sparkSession, "cells")
    table = counts.groupBy("readGroupId", "q", "cycle", "context").agg(F.sum("errors").alias("errors"), F.sum("n").alias("n"))
    table.write.parquet(path)
    table = spark.read.schema(table.schema).parquet(path)
    same = lambda a, b, on: a.alias("a").join(b.alias("b"), on_all(on)).select("a.*", *(F.col(f"b.{c}") for c in b.columns if c not in on))
    by_quality = table.groupBy("readGroupId", "q").agg(phred(F.sum("errors"), F.sum("n")).alias("global"))
    cycle = table.groupBy("readGroupId", "q", "cycle").agg(phred(F.sum("errors"), F.sum("n")).alias("of_cycle"))
    context = table.groupBy("readGroupId", "q", "context").agg(phred(F.sum("errors"), F.sum("n")).alias("of_context"))
    model = table.select("readGroupId", "q", "cycle", "context")
    for other, on in ((by_quality, ["readGroupId", "q"]), (cycle, ["readGroupId", "q", "cycle"]), (context, ["readGroupId", "q", "context"])):
        model = same(model, other, on)
    return model.withColumn("newQuality", F.least(F.greatest(F.col("of_cycle") + F.col("of_context") - F.col("global"), F.lit(1)), F.lit(60)))


def on_all(names: list[str]):  # noqa: ANN201
    """Equal in all columns; a null read group is one."""
    out = F.lit(True)
    for c in names:
        out = out & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return out


def apply_recalibration(reads: DataFrame, model: DataFrame, most: int = 4_000_000) -> DataFrame:
    """Reads with the model's quality for every base whose cell it has; other bases keep theirs. Old qualities go to
    originalQualityScores. Qualities are looked up inside each row: nothing is exploded, shuffled or joined. The model is sent
    to the tasks as arrays, for some read groups at a time, of `most` cells together (a group alone has as many as its reads are
    long, times qualities and dinucleotides); reads of groups without a model pass as they are. Reads whose qualities and bases
    differ in length keep their qualities."""
    spark, schema = reads.sparkSession, reads.schema
    sizes = model.groupBy("readGroupId").agg(F.count("*").alias("n")).orderBy("readGroupId").collect()  # a row a read group
    chunks: list[list[str | None]] = []
    held = most + 1
    for r in sizes:
        if held + r.n > most:
            chunks.append([])
            held = 0
        chunks[-1].append(r.readGroupId)
        held += r.n
    names = schema.names
    at = {c: names.index(c) for c in ("readGroupId", "sequence", "qualityScores")}
    old = names.index("originalQualityScores") if "originalQualityScores" in names else None
    within = lambda df, ids: df.where(F.col("readGroupId").isin([i for i in ids if i is not None]) | (F.col("readGroupId").isNull() if None in ids else F.lit(False)))
    # the lower bits of a cell's number, as cell_codes has them
    pair = F.coalesce(F.ascii("context"), F.lit(0)) * 256 + F.ascii(F.substring("context", 2, 1))
    lower = (F.shiftleft(F.col("q").cast("long"), 40) + F.shiftleft(F.col("cycle").cast("long"), 16) + pair).alias("lower")
    out: DataFrame | None = None
    for ids in chunks:
        cells = within(model, ids).select("readGroupId", lower, F.col("newQuality").cast("tinyint").alias("new")).toArrow()  # arrays of at most `most` cells
        number = {g: k for k, g in enumerate(ids)}
        group = np.array([number[g] for g in pc.unique(cells["readGroupId"]).to_pylist()], np.int64)[pc.index_in(cells["readGroupId"], value_set=pc.unique(cells["readGroupId"])).to_numpy()] if cells.num_rows else np.zeros(0, np.int64)
        codes = (group * 128 << 40) + cells["lower"].to_numpy()
        order = np.argsort(codes)
        sent = spark.sparkContext.broadcast((number, codes[order], cells["new"].to_numpy()[order].astype(np.int16)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            known, codes, new = sent.value
            for b in batches:
                cols = list(b.columns)
                groups, bases, quals = (b.column(at[c]) for c in ("readGroupId", "sequence", "qualityScores"))
                ok = plain_reads([bases, quals])
                text = quals
                if ok.any():
                    was, n = bytes_of(quals, ok), sizes_of(quals)[ok]
                    mine = cell_codes(numbers_of(groups.filter(pa.array(ok)), known), n, bytes_of(bases, ok), was)
                    place = np.minimum(np.searchsorted(codes, mine), len(codes) - 1)
                    whole = np.where(codes[place] == mine, new[place] + 33, was).astype(np.uint8)
                    ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
                    told = pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(ends), pa.py_buffer(whole)).cast(pa.string())
                    text = pc.replace_with_mask(quals.cast(pa.string()), pa.array(ok), told)
                if old is not None:
                    cols[old] = quals
                cols[at["qualityScores"]] = text
                yield pa.RecordBatch.from_arrays(cols, names=names)

        part = within(reads, ids).mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    every = [i for ids in chunks for i in ids]
    rest = reads.where(~F.coalesce(F.col("readGroupId").isin([i for i in every if i is not None]), F.lit(None in every)))
    rest = rest.withColumn("originalQualityScores", F.col("qualityScores")) if old is not None else rest
    return rest if out is None else out.unionByName(rest)
