"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

Lengths are whole numbers up to the size of a sequence, so packing needs only how many pieces have each length: at most
`size` counts, whatever the corpus. `plan` packs that histogram. A bin is filled greedily, each time with the longest
length that fits; then its smallest piece is replaced by the two unpacked pieces that together fill the expanded gap more
tightly, if there are such. The same bin is repeated as often as the counts allow, so every step uses up at least one
length and the plan has a few thousand lines at most: it is broadcast, its size bounded by `size` alone.

Pieces are then numbered inside their length, equal ones (of repeated rows) counted first, so no group meets in one task, and
look up their sequence and offset in the plan.

Documents longer than a sequence are cut into full pieces; the remainder comes first. Defined cases: null and empty
texts are one end token; repeated rows are packed each, as are rows without a doc_id; very long texts are cut like others;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import Scratch, slices, table
from helixframe.llm.sharding import numbered, row_key
from helixframe.llm.tokens import ByteEncoder

SIZE = 1024
END = 2


def best_two(counts: np.ndarray, gap: int, least: int) -> tuple[int, int] | None:
    """Lengths a >= b that are left with the largest sum in (least, gap]."""
    have = np.flatnonzero(counts[: gap + 1])
    if not len(have):
        return None
    partner = np.searchsorted(have, np.minimum(gap - have, have), side="right") - 1
    ok = partner >= 0
    a, b = have[ok], have[partner[ok]]
    single = (a == b) & (counts[a] < 2)  # two of a length that is left once: take the next shorter partner
    p = partner[ok] - single
    a, b = a[p >= 0], have[p[p >= 0]]
    if not len(a):
        return None
    k = int((a + b).argmax())
    return (int(a[k]), int(b[k])) if a[k] + b[k] > least else None


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Lines (length, first rank, ranks, first sequence, pieces per sequence, first offset): the piece of rank r of that
    length lies in sequence first + (r - first rank) // per, at offset + ((r - first rank) % per) * length."""
    counts = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    rank, lines, sequence = np.zeros(size + 1, np.int64), [], 0
    while (left := np.flatnonzero(counts)).size:
        own: list[int] = []
        gap = size
        while True:
            fits = left[: np.searchsorted(left, gap, side="right")]
            fits = fits[counts[fits] > 0]
            if not fits.size:
                break
            n = int(fits[-1])
            own.append(n)
            counts[n] -= 1
            gap -= n
        if gap and len(own) > 1 and (two := best_two(counts, gap + own[-1], own[-1])):
            counts[own[-1]] += 1
            own[-1:] = two
            counts[two[0]] -= 1
            counts[two[1]] -= 1
        kinds, per = np.unique(own, return_counts=True)
        more = int((counts[kinds] // per).min())
        counts[kinds] -= more * per
        offset = 0
        for n, c in zip(kinds.tolist(), per.tolist(), strict=True):
            lines.append((n, int(rank[n]), c * (more + 1), sequence, c, offset))
            rank[n] += c * (more + 1)
            offset += n * c
        sequence += more + 1
    return lines


def token_pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = END, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, the ids (little-endian 32-bit) of every document's pieces."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteEncoder(tokenizer)
        for b in slices(batches):
            rows = []
            for doc, ids in zip(b.column(0).to_pylist(), encoder.encode([t or "" for t in b.column(1).to_pylist()]), strict=True):
                ids += tail
                n, at, piece = len(ids) // 4, 0, 0
                while at < n:
                    upto = at + (n % size or size) if not at else at + size
                    part = ids[4 * at : 4 * upto]
                    rows.append((doc, piece, at, upto - at, zlib.crc32(part), *([part] * with_ids)))
                    at, piece = upto, piece + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(types), types, strict=True)], names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def pack(groups: DataFrame, size: int = SIZE) -> DataFrame:
    """A row for each copy of a piece, with sequence_id and offset. `groups` (written): doc_id, piece, start, length,
    ids_crc32 and copies."""
    names = [c for c in groups.columns if c != "copies"]
    # at most `size` rows
    histogram = {r.length: r.n for r in groups.groupBy("length").agg(F.sum("copies").alias("n")).collect()}
    lines: dict[int, list[tuple]] = {}
    for n, *rest in plan(histogram, size):
        lines.setdefault(n, []).append(tuple(rest))
    starts = {n: [x[0] for x in own] for n, own in lines.items()}
    ranked = numbered(groups, row_key("doc_id", "piece", "ids_crc32"), names, within=("length",))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place = []
            for n, r in zip(b.column("length").to_pylist(), b.column("row").to_pylist(), strict=True):
                first, _, sequence, per, offset = lines[n][bisect_right(starts[n], r) - 1]
                place.append((sequence + (r - first) // per, offset + (r - first) % per * n))
            cols = [pa.array([x[k] for x in place], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *cols], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"{c} {t}" for c, t in groups.dtypes if c != "copies") + ", sequence_id long, offset long"
    return ranked.select(*names, "row").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = END) -> DataFrame:
    pieces = token_pieces(docs, tokenizer, size, end)
    return pack(Scratch(docs.sparkSession, "packing").written(pieces.groupBy(*pieces.columns).agg(F.count("*").alias("copies")), "pieces"), size)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
