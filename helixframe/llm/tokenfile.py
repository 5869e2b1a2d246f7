"""Token files: ids under a canonical, length-limited Huffman code.

Documents are taken in ascending doc_id order (range partitions, sorted inside), tokenised once and written as blocks of
plain ids, whole documents of about `BLOCK` tokens together. Global counts of the ids give code lengths of at most `limit`
bits by package-merge; the code is canonical, so lengths alone are the code book. Each block is then encoded. It stands
alone: a header, the bit offset of every `STRIDE`-th id (checkpoints), and the bit stream. Decoding walks all checkpoint
intervals of many blocks in step, one table look-up a code, so it costs a few vector operations per id.

The container is Parquet written by Spark (rows: part, seq, doc_ids, doc_tokens, n_tokens, block), beside a code book of
(id, bits); any store that Spark writes to can hold it.

Defined cases: null and empty texts are the end id alone; null doc_ids come first; rows that share a doc_id stand together,
those of one file part in order of their text (a doc_id of very many rows takes several parts); very long texts are one
block; an empty table gives empty files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm.common import fresh_path, remove_path, slices, table, text_or_empty
from helixframe.llm.tokens import WordEncoder

END = 1
LIMIT = 18
BLOCK = 1 << 17
STRIDE = 256
HEAD = struct.Struct("<4sBIQQ")
MAGIC = b"HFT1"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits of each symbol (0 where its count is 0) of the best code of at most `limit` bits, by package-merge: level by
    level, pairs of the level below are merged with the symbols; what the cheapest 2n - 2 items hold is counted back."""
    used = np.flatnonzero(counts)
    bits = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n < 2:
        bits[used] = 1
        return bits
    limit = max(limit, int(np.ceil(np.log2(n))))
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(limit):
        both = np.concatenate([weights, packages])
        by = np.argsort(both, kind="stable")
        levels.append(by < n)
        both = both[by]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(1)
    take, depth = 2 * n - 2, np.zeros(n, np.int64)
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:take].sum())
        depth[:symbols] += 1
        take = 2 * (take - symbols)
    bits[order] = depth
    return bits


class Code:
    """The canonical code of given lengths: codes ascend with (length, symbol)."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits.astype(np.int64)
        self.width = int(self.bits.max(initial=1))
        order = np.lexsort((np.arange(len(bits)), self.bits))
        self.order = order[self.bits[order] > 0]
        lengths = self.bits[self.order]
        spans = np.int64(1) << (self.width - lengths)  # slots of the full-width table that a code covers
        starts = np.cumsum(spans) - spans
        self.codes = np.zeros(len(bits), np.uint64)
        self.codes[self.order] = (starts >> (self.width - lengths)).astype(np.uint64)
        self.spans, self.lengths, self._tables = spans, lengths, None

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        if self._tables is None:
            size = 1 << self.width
            symbol, length = np.zeros(size, np.uint32), np.ones(size, np.uint8)
            filled = int(self.spans.sum())
            symbol[:filled] = np.repeat(self.order, self.spans)
            length[:filled] = np.repeat(self.lengths, self.spans)
            self._tables = symbol, length
        return self._tables

    def encode(self, ids: np.ndarray, stride: int = STRIDE) -> bytes:
        bits = self.bits[ids]
        ends = np.cumsum(bits)
        at = ends - bits
        total = int(ends[-1]) if len(ids) else 0
        marks = at[::stride].astype("<u8")
        words = np.zeros(total // 32 + 3, np.uint32)
        if len(ids):
            wide = self.codes[ids] << (64 - (at & 31) - bits).astype(np.uint64)
            word = at >> 5
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            joined = np.bitwise_or.reduceat(wide, first)
            words[word[first]] |= (joined >> np.uint64(32)).astype(np.uint32)
            words[word[first] + 1] |= (joined & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return HEAD.pack(MAGIC, self.width, stride, len(ids), len(marks)) + marks.tobytes() + words.astype(">u4").tobytes()

    def decode(self, blocks: list[bytes]) -> list[np.ndarray]:
        """The ids of each block; all checkpoint intervals of all blocks advance together."""
        streams, at, counts, sizes, base = [], [], [], [], 0
        stride = 1
        for b in blocks:
            magic, width, stride, n, marks = HEAD.unpack_from(b)
            if magic != MAGIC or width != self.width:
                raise ValueError("not a block of this code")
            body = np.frombuffer(b, np.uint8, offset=HEAD.size + 8 * marks)
            at.append(np.frombuffer(b, "<u8", marks, HEAD.size).astype(np.int64) + 8 * base)
            counts.append(np.minimum(stride, n - stride * np.arange(marks)))
            sizes.append(n)
            streams.append(body)
            base += len(body)
        if not base:
            return []
        data = np.concatenate([*streams, np.zeros(4, np.uint8)]).astype(np.uint32)
        peek = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        pos, left = np.concatenate(at), np.concatenate(counts)
        symbol, length = self.tables()
        out = np.zeros((len(pos), stride), np.uint32)
        live, shift, mask = np.arange(len(pos)), 32 - self.width, (1 << self.width) - 1
        for k in range(int(left.max(initial=0))):
            if (left[live] <= k).any():
                live = live[left[live] > k]
            p = pos[live]
            key = (peek[p >> 3] >> (shift - (p & 7)).astype(np.uint32)) & np.uint32(mask)
            out[live, k] = symbol[key]
            pos[live] = p + length[key]
        cuts = np.cumsum([0, *(len(x) for x in at)])
        return [out[cuts[k] : cuts[k + 1]].reshape(-1)[: sizes[k]] for k in range(len(blocks))]


BLOCKS = "part int, seq long, inside long, doc_ids array<long>, doc_tokens array<long>, n_tokens long, block binary"
NAMES = ("part", "seq", "inside", "doc_ids", "doc_tokens", "n_tokens", "block")


def raw_blocks(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """Blocks of plain ids, little-endian and 16 bits wide where they fit (each in a row of its own, so a block's length over
    its tokens tells), else 32: documents in ascending doc_id order, each with its end id. `inside`: ids of the part before
    the block."""
    # the second key lets a doc_id of very many rows take several partitions
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("_at", F.monotonically_increasing_id())
    ordered = numbered.repartitionByRange("doc_id", "_at").sortWithinPartitions("doc_id", "text").select("doc_id", "text")
    tail = np.array([end], "<u4").tobytes()
    types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq, inside = WordEncoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        ids, own, sizes, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            data = np.frombuffer(b"".join(ids), "<u4")
            data = data.astype("<u2") if data.max() < 1 << 16 else data
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((part, seq, inside, own, sizes, held, data.tobytes()), types, strict=True)], names=NAMES)

        for b in slices(batches):
            for doc, one in zip(b.column(0).to_pylist(), encoder.encode(b.column(1).to_pylist()), strict=True):
                ids.append(one + tail)
                own.append(doc)
                sizes.append(len(one) // 4 + 1)
                held += sizes[-1]
                if held >= BLOCK:
                    yield block()
                    ids, own, sizes, held, seq, inside = [], [], [], 0, seq + 1, inside + held
        if own:
            yield block()

    return ordered.mapInArrow(run, BLOCKS)


def plain_ids(block: pa.Scalar, n: int) -> np.ndarray:
    data = block.as_buffer()
    return np.frombuffer(data, "<u2" if data.size == 2 * n else "<u4")


def id_counts(blocks: DataFrame) -> DataFrame:
    """(id, n) over all blocks: each task adds up an array as long as the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1, np.int64)
        for b in slices(batches):
            for one, n in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                more = np.bincount(plain_ids(one, n), minlength=len(counts))
                more[: len(counts)] += counts
                counts = more
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], names=["id", "n"])

    return blocks.select("block", "n_tokens").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int = END, limit: int = LIMIT) -> None:
    """Write `path`/codebook and `path`/blocks. Plain blocks are written beside them for the second pass, then removed."""
    spark = docs.sparkSession
    raw_blocks(docs, tokenizer, end).write.option("compression", "zstd").parquet(f"{path}/plain")
    plain = spark.read.schema(BLOCKS).parquet(f"{path}/plain")
    found = id_counts(plain).collect()  # at most one row per id of the vocabulary
    counts = np.zeros(max((r.id for r in found), default=end) + 1, np.int64)
    for r in found:
        counts[r.id] = r.n
    bits = code_lengths(counts, limit)
    book = [(int(k), int(bits[k])) for k in np.flatnonzero(bits)]
    spark.createDataFrame(book, "id long, bits int").coalesce(1).write.parquet(f"{path}/codebook")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(bits)
        for b in slices(batches):
            for k in range(b.num_rows):
                one = b.slice(k, 1)
                data = code.encode(plain_ids(one.column(6)[0], one.column(5)[0].as_py()))
                yield pa.RecordBatch.from_arrays([*one.columns[:6], pa.array([data], pa.binary())], names=NAMES)

    plain.mapInArrow(run, BLOCKS).write.parquet(f"{path}/blocks")
    remove_path(spark, f"{path}/plain")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, ids of every document of the files, decoded."""
    book = spark.read.parquet(f"{path}/codebook").collect()  # as large as the vocabulary at most
    bits = np.zeros(max((r.id for r in book), default=0) + 1, np.uint8)
    for r in book:
        bits[r.id] = r.bits
    blocks = spark.read.parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # a row for each part, of which there are no more than the writer had tasks
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    rows = blocks.join(F.broadcast(before), "part").select((F.col("before") + F.col("inside")).alias("start"), "doc_ids", "doc_tokens", "n_tokens", "block")
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(bits)

        def told(some: list[dict]) -> pa.RecordBatch:
            out = []
            for r, ids in zip(some, code.decode([r["block"] for r in some]), strict=True):
                at = 0
                for doc, n in zip(r["doc_ids"], r["doc_tokens"], strict=True):
                    own = ids[at : at + n].astype("<u4")
                    out.append((doc, r["start"] + at, n, zlib.crc32(own.tobytes()), *([own.tolist()] * with_ids)))
                    at += n
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

        for b in slices(batches):
            some, held = [], 0
            for k in range(b.num_rows):
                some.append({c: b.column(c)[k].as_py() for c in b.schema.names})
                held += some[-1]["n_tokens"]
                if held > 8 * BLOCK:
                    yield told(some)
                    some, held = [], 0
            if some:
                yield told(some)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return rows.mapInArrow(run, schema)


def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = fresh_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, path)
