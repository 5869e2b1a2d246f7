"""Approximate nearest neighbours by multi-index hashing: the largest inner products of a set of queries with all vectors.

A vector's code is 64 bits: its signs after a rotation learned on a bounded sample (at most `FIT_ROWS` distinct vectors, those of
the smallest hash; principal axes, then the rotation that keeps signs nearest to values). Before that a coordinate is added
that makes all vectors as long as the longest, so that the largest inner product is the smallest angle. Codes are
cut into four substrings, each with a table of its own. Codes within Hamming distance r = 4 a + b of a query agree with it in one
of the first b + 1 substrings up to a bits, or in one of the others up to a - 1, so opening just those buckets finds every
code within r; its vector is then compared in double precision. A pair that several tables find is taken from the first.

r is measured, not guessed: the exact neighbours of at most `TUNE_QUERIES` queries among all vectors are found first, and r is
the smallest radius that holds a share `RECALL` of them. Queries that find fewer than k others are searched again with all buckets open.

Tables are dealt in cells, which are prefixes of substrings; a query goes to the cells whose prefix can hold a bucket for it.
Cells of more than `CELL_ROWS` vectors or `QUERY_ROWS` queries are split, after counting, and each part of one side
meets each part of the other. Equal vectors are one class: only the k + 1 smallest ids of a class can be among
anyone's k nearest, so the rest are searched for but never compared, and equal queries are searched for once.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do those whose length
is not the most frequent one (of two, the larger). Each row is a row: rows that repeat a vec_id are candidates of each other
and, if queries, give lists of their own. Ties go to the smaller vec_id, null ids last; a null id is no query. An inner product beyond double precision
is infinite. An empty table or no queries give an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm.common import Scratch, skewed_join, table

BITS, TABLES = 64, 4
WIDTH = BITS // TABLES
FIT_ROWS, TUNE_QUERIES, RECALL = 8192, 128, 0.97
CELL_ROWS, QUERY_ROWS, LEAST_CELLS = 16_384, 2048, 8
#: Queries compared at once; what single-precision products of vectors of length 1 may be off by.
AT_ONCE, SLACK = 64, 1e-5
LAST = (1 << 63) - 1
OUT = "query_id long, rank int, vec_id long, score double"


@dataclass(frozen=True)
class Codes:
    """A learned code: vectors are scaled by the longest, lengthened to 1, centred and rotated."""

    longest: float
    centre: np.ndarray
    rotation: np.ndarray

    def of(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Codes as unsigned 64-bit numbers. A query's length does not matter, and it has nothing in the added coordinate."""
        y = (lengthened(unit(x), 1.0, query) if query else lengthened(x, self.longest)) - self.centre
        bits = (y @ self.rotation > 0).astype(np.uint8)
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def lengths(x: np.ndarray) -> np.ndarray:
    most = np.abs(x).max(axis=1, initial=0)
    with np.errstate(over="ignore"):
        return np.minimum(most * np.sqrt(((x / np.where(most > 0, most, 1)[:, None]) ** 2).sum(axis=1)), np.finfo(np.float64).max)


def unit(x: np.ndarray) -> np.ndarray:
    most = np.abs(x).max(axis=1, keepdims=True, initial=0)
    y = x / np.where(most > 0, most, 1)
    return y / np.maximum(np.sqrt((y * y).sum(axis=1, keepdims=True)), 1e-300)


def lengthened(x: np.ndarray, longest: float, query: bool = False) -> np.ndarray:
    y = x / longest
    more = np.zeros(len(y)) if query else np.sqrt(np.maximum(0, 1 - (y * y).sum(axis=1)))
    return np.concatenate([y, more[:, None]], axis=1)


def learned(sample: np.ndarray, longest: float, rounds: int = 30, seed: int = 7) -> Codes:
    """Principal axes of the sample, and a rotation of them that brings signs and values together."""
    y = lengthened(sample, longest)
    centre = y.mean(axis=0)
    y = y - centre
    _, axes = np.linalg.eigh(y.T @ y)
    axes = axes[:, ::-1][:, :BITS]
    p = y @ axes
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(BITS, BITS)))[0][: p.shape[1]]
    for _ in range(rounds):
        u, _, vt = np.linalg.svd(p.T @ np.where(p @ rotation > 0, 1.0, -1.0), full_matrices=False)
        rotation = u @ vt
    return Codes(longest, centre, axes @ rotation)


def radii(r: int) -> list[int]:
    """The radius in each table that finds every code within r; -1 leaves a table out."""
    if r >= BITS:
        return [WIDTH, *[-1] * (TABLES - 1)]
    a, b = divmod(r, TABLES)
    return [a if s <= b else a - 1 for s in range(TABLES)]


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, with a compensated sum: the same for equal rows wherever they stand."""
    total, lost = np.zeros(len(x)), np.zeros(len(x))
    with np.errstate(over="ignore", invalid="ignore"):
        for k in range(x.shape[1]):
            p = x[:, k] * y[:, k]
            t = total + p
            lost += np.where(np.abs(total) >= np.abs(p), (total - t) + p, (p - t) + total)
            total = t
        return np.where(np.isfinite(lost), total + lost, total)


def matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Vectors kept as bytes."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(len(column), -1).astype(np.float64) if len(column) else np.zeros((0, 1))


def best_of(score: np.ndarray, exact, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:  # noqa: ANN001
    """The places of the k best by exact score, then order, and their scores. `score` is within SLACK of it, both scaled to 1."""
    at = np.arange(len(score))
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k] - 2 * SLACK)
    got = exact(at)
    first = np.lexsort((order[at], -got))[:k]
    return at[first], got[first]


def matched(entries: pa.Table, queries: pa.Table, s: int, within: list[int], r: int, k: int, kind: str, longest: float) -> pa.Table:
    """The k best entries of a cell of table s for each query, among the codes within r."""
    codes, asked = (t["code"].to_numpy().astype(np.int64).view(np.uint64) for t in (entries, queries))
    x, y = (matrix(t["vector"].combine_chunks(), kind) for t in (entries, queries))
    small, direction = (x / longest).astype(np.float32), unit(y).astype(np.float32)
    order = entries["first"].to_numpy()
    part = lambda c, j: c >> np.uint64(WIDTH * j) & np.uint64((1 << WIDTH) - 1)
    values, bucket_of = np.unique(part(codes, s), return_inverse=True)
    by_bucket = np.argsort(bucket_of, kind="stable")
    sizes = np.bincount(bucket_of, minlength=len(values))
    begins = np.cumsum(sizes) - sizes
    q_out, e_out, scores = [], [], []
    for at in range(0, len(asked), AT_ONCE):
        own = asked[at : at + AT_ONCE]
        q, bucket = np.nonzero(np.bitwise_count(values[None, :] ^ part(own, s)[:, None]) <= within[s])
        n = sizes[bucket]
        e = by_bucket[np.repeat(begins[bucket] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        q = np.repeat(q, n)
        differ = own[q] ^ codes[e]
        keep = np.bitwise_count(differ) <= r
        q, e, differ = q[keep], e[keep], differ[keep]
        for j in range(s):  # an earlier table has found it
            if within[j] >= 0:
                keep = np.bitwise_count(part(differ, j)) > within[j]
                q, e, differ = q[keep], e[keep], differ[keep]
        if not len(q):
            continue
        if len(q) * 20 > len(own) * len(codes):
            score = (direction[at : at + AT_ONCE] @ small.T)[q, e]
        else:
            score = np.einsum("ij,ij->i", direction[at + q], small[e])
        ends = np.searchsorted(q, np.arange(len(own) + 1))
        for j in np.flatnonzero(np.diff(ends)):
            mine = e[ends[j] : ends[j + 1]]
            exact = lambda w, mine=mine, j=j: products(x[mine[w]], np.broadcast_to(y[at + j], (len(w), y.shape[1])))
            found, got = best_of(score[ends[j] : ends[j + 1]], exact, order[mine], k)
            q_out.append(np.full(len(found), at + j))
            e_out.append(mine[found])
            scores.append(got)
    flat = lambda a, t: np.concatenate(a) if a else np.zeros(0, t)
    q, e = pa.array(flat(q_out, np.int64)), pa.array(flat(e_out, np.int64))
    return pa.table({"query": queries["key"].take(q), "key": entries["key"].take(e), "first": entries["first"].take(e), "score": flat(scores, np.float64)})


def usable(v: Column) -> Column:
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)


def prepared(vectors: DataFrame, column: str, scratch: Scratch) -> tuple[DataFrame, str] | None:
    """Rows that take part: row (a number of its own), vec_id, key (a 128-bit hash of the vector), length, vector (bytes)."""
    kind = "<f4" if vectors.schema[column].dataType.elementType.typeName() == "float" else "<f8"
    v = F.col(column) if kind == "<f4" else F.col(column).cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(usable(F.col("v")))
    size = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if size is None:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(kind) + np.array(0, kind)  # no negative zero
            data = [row.tobytes() for row in x]
            key = [hashlib.blake2b(d, digest_size=16).digest() for d in data]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(key, pa.binary()), pa.array(lengths(x.astype(np.float64))), pa.array(data, pa.binary())], names=["row", "vec_id", "key", "length", "vector"])

    numbered = rows.where(F.size("v") == size.d).select(F.monotonically_increasing_id().alias("row"), "vec_id", "v")
    return scratch.written(numbered.mapInArrow(run, "row long, vec_id long, key binary, length double, vector binary"), "rows"), kind


def coded(rows: DataFrame, codes: Codes, kind: str, query: bool) -> DataFrame:
    """key, first, vector and code of rows with key, first and vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = codes.of(matrix(b.column(2), kind), query).view(np.int64) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(code)], names=["key", "first", "vector", "code"])

    return rows.select("key", "first", "vector").mapInArrow(run, "key binary, first long, vector binary, code long")


def radius(index: DataFrame, asked: DataFrame, k: int, recall: float, kind: str, longest: float) -> int:
    """The smallest radius that holds a share `recall` of the exact k nearest of a bounded sample of queries."""
    sample = asked.orderBy("key").limit(TUNE_QUERIES).collect()
    if not sample:
        return 0
    y = np.stack([np.frombuffer(r.vector, kind).astype(np.float64) for r in sample])
    own, keys = np.array([r.code for r in sample], np.int64).view(np.uint64), np.array([bytes(r.key) for r in sample], object)
    direction = unit(y)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, far = np.zeros((len(y), 0)), np.zeros((len(y), 0), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            score = direction @ (matrix(b.column(2), kind) / longest).T
            score[keys[:, None] == np.array(b.column(0).to_pylist(), object)[None, :]] = -np.inf  # itself
            apart = np.bitwise_count(own[:, None] ^ b.column(3).to_numpy().astype(np.int64).view(np.uint64)[None, :])
            best, far = np.concatenate([best, score], axis=1), np.concatenate([far, apart], axis=1)
            first = np.argsort(-best, axis=1, kind="stable")[:, :k]
            best, far = np.take_along_axis(best, first, 1), np.take_along_axis(far, first, 1)
        q, at = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(best[q, at]), pa.array(far[q, at], pa.int32())], names=["q", "score", "far"])

    near = index.mapInArrow(run, "q int, score double, far int")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "far"))
    shares = near.withColumn("rank", rank).where(F.col("rank") <= k).groupBy("far").agg(F.count("*").alias("n")).collect()  # a row a distance
    held, total = 0, sum(r.n for r in shares)
    for r in sorted(shares, key=lambda r: r.far):
        held += r.n
        if held >= recall * total:
            return r.far
    return 0


def probed(index: DataFrame, asked: DataFrame, rows: int, r: int, k: int, kind: str, longest: float) -> DataFrame:
    """The k best (query, key, first, score) of each query and part of a cell."""
    within = radii(r)
    tables = [s for s in range(TABLES) if within[s] >= 0]
    prefix = min(WIDTH, max(LEAST_CELLS, -(-rows // CELL_ROWS)).bit_length() - 1)
    cell_of = lambda s: F.shiftrightunsigned("code", WIDTH * s + WIDTH - prefix).bitwiseAND(F.lit((1 << prefix) - 1)).cast("int")
    cells = F.sequence(F.lit(0), F.lit((1 << prefix) - 1))
    entries = index.withColumn("c", F.explode(F.array(*(F.struct(F.lit(s).alias("s"), cell_of(s).alias("cell")) for s in tables)))).select("key", "first", "vector", "code", "c.s", "c.cell")

    def visited(s: int) -> Column:
        return F.filter(cells, lambda c: F.bit_count(c.bitwiseXOR(cell_of(s))) <= within[s])

    visits = F.array(*(F.struct(F.lit(s).alias("s"), visited(s).alias("cells")) for s in tables))
    visitors = asked.withColumn("c", F.explode(visits)).select("key", "vector", "code", "c.s", F.explode("c.cells").alias("cell"))
    count = lambda df, most, name: df.groupBy("s", "cell").agg(F.ceil(F.count("*") / most).cast("int").alias(name))
    parts = count(entries.select("s", "cell"), CELL_ROWS, "pe").join(count(visitors.select("s", "cell"), QUERY_ROWS, "pq"), ["s", "cell"])
    parts = F.broadcast(parts)  # at most TABLES * 2^prefix rows
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    entries = entries.join(parts, ["s", "cell"]).withColumn("e", part("pe")).withColumn("q", each("pq")).drop("pe", "pq")
    visitors = visitors.join(parts, ["s", "cell"]).withColumn("q", part("pq")).withColumn("e", each("pe")).drop("pe", "pq")
    on = ["s", "cell", "e", "q"]

    def run(at: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query": pa.array([], pa.binary()), "key": pa.array([], pa.binary()), "first": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return matched(left, right, at[0].as_py(), within, r, k, kind, longest)

    return entries.groupBy(*on).cogroup(visitors.groupBy(*on)).applyInArrow(run, "query binary, key binary, first long, score double")


def search(vectors: DataFrame, asks: Column | str, k: int = 20, column: str = "embedding", recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows of every row that `asks` (over vec_id) takes as a query."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "hamming")
    got = prepared(vectors, column, scratch)
    if got is None:
        return spark.createDataFrame([], OUT)
    rows, kind = got
    order = F.coalesce("vec_id", F.lit(LAST))
    nth = F.row_number().over(Window.partitionBy("key").orderBy(order, "row"))
    members = scratch.written(rows.withColumn("nth", nth).where(F.col("nth") <= k + 1), "members")
    classes = members.where("nth = 1").select("key", order.alias("first"), "vector")
    total = members.where("nth = 1").agg(F.count("*").alias("n"), F.max("length").alias("longest")).first()
    sample = classes.orderBy("key").limit(FIT_ROWS).collect()
    codes = learned(np.stack([np.frombuffer(r.vector, kind).astype(np.float64) for r in sample]), total.longest)
    index = scratch.written(coded(classes, codes, kind, False), "index")
    queries = rows.where(asks)
    once = queries.select("key", F.lit(0).cast("long").alias("first"), "vector").withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("first"))).where("n = 1")
    asked = scratch.written(coded(once, codes, kind, True), "asked")
    r = radius(index, asked, k, recall, kind, total.longest)
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "first", "key"))
    near = lambda some, radius_: scratch.written(probed(index, some, total.n, radius_, k + 1, kind, total.longest).withColumn("n", best).where(F.col("n") <= k + 1).drop("n"), "near")
    found = near(asked, r)
    if r < BITS:
        enough = found.groupBy(F.col("query").alias("key")).agg(F.count("*").alias("n")).where(F.col("n") >= min(k + 1, total.n)).select("key")
        few = scratch.written(asked.join(enough, "key", "left_anti"), "few")
        if not few.isEmpty():
            again = near(few, BITS)
            found = found.join(few.select(F.col("key").alias("query")), "query", "left_anti").unionByName(again)
    pairs = found.select("query", "key", "score").join(members.select("key", "vec_id", "row"), "key")
    ranked = pairs.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), order, "row"))).where(F.col("n") <= k + 1)
    lists = ranked.groupBy(F.col("query").alias("key")).agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "row", "score"))).alias("near"))  # k + 1 at most
    every = skewed_join(queries.select("key", F.col("vec_id").alias("query_id"), F.col("row").alias("own")), lists, ["key"], ["own"])
    others = F.slice(F.filter("near", lambda x: x["row"] != F.col("own")), 1, k)
    out = every.select("query_id", F.posexplode(others).alias("at", "x"))
    return scratch.result(out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")
