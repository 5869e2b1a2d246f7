"""Sharding: a Feistel permutation with cycle walking over global row numbers.

Rows are numbered in the order of the MD5 of (doc_id, size, crc); the permutation of [0, rows) that a key selects gives each
row a place, and place modulo and over the number of shards are its shard and slot. Nothing but the row number, the
number of rows and the key is needed to compute either, and counts of shards differ by one at most (law `rows`).

Equal rows (doc_id, size, crc) are counted first, in every task, and only their numbers are told apart in the end, so a doc_id or
a text that a large part of all rows shares is no load. The leading digits of the MD5 deal rows into buckets of equal
size, whose counts give every bucket its first number (summed in two steps); inside a bucket, rows (no texts) are ranked. There is no global sort.

Defined cases: a null text has size 1 and the CRC of no bytes; null doc_ids are numbered like others; repeated rows get
different places; an empty table gives an empty result; very long texts are measured whole; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm import common
from helixframe.llm.common import Scratch, table, text_or_empty

SHARDS = 16
KEY = 20_240_229
ROUNDS = 6


def mixed(x: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit finaliser of x with the round constant k."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def permute(rows: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Places of row numbers under a permutation of [0, n). The Feistel network permutes [0, a * b) with a = ceil(sqrt n)
    and a * b >= n, less than a beyond n; a value outside [0, n) walks on along its cycle, which must come back inside."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))
    out = rows.astype(np.int64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right, la, lb = out[todo] // b, out[todo] % b, a, b
        for k in range(ROUNDS):
            left, right = right, (left + (mixed(right, key + k) % np.uint64(la)).astype(np.int64)) % la
            la, lb = lb, la
        out[todo] = left * lb + right
        todo = todo[out[todo] >= n]
    return out


def numbered(groups: DataFrame, key: Column, order: list[str], within: tuple[str, ...] = ()) -> DataFrame:
    """A row for each of the `copies` rows of every group, with its number `row` (from 0, in each value of `within`).
    `groups` (written) are distinct rows with `copies`; they are numbered in the order of `key` (32 hexadecimal digits,
    evenly spread), then `order`. Buckets are the first digits of the key, one for about 50,000 groups."""
    total = groups.agg(F.count("*").alias("n"), F.max("copies").alias("most")).first()
    width = max(2, math.ceil(math.log(max(total.n, 1) / 50_000 + 1, 16)))
    keyed = groups.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, width))
    counts = keyed.groupBy(*within, "_bucket").agg(F.sum("copies").alias("_n"))
    # sums of earlier buckets in two steps, by the first half of the digits and inside it, so no task sees all buckets
    halves = counts.withColumn("_half", F.substring("_bucket", 1, width // 2))
    over = lambda c, *part: F.sum(c).over(Window.partitionBy(*within, *part).orderBy("_bucket" if part else "_half")) - F.col(c)
    earlier = halves.groupBy(*within, "_half").agg(F.sum("_n").alias("_m"))
    earlier = earlier.select(*within, "_half", over("_m").alias("_earlier"))
    before = halves.withColumn("_own", over("_n", "_half")).join(earlier, [*within, "_half"]).select(*within, "_bucket", (F.col("_earlier") + F.col("_own")).alias("_before"))
    inside = F.sum("copies").over(Window.partitionBy(*within, "_bucket").orderBy("_key", *order)) - F.col("copies")
    rows = keyed.withColumn("_inside", inside).join(before, [*within, "_bucket"]).withColumn("row", F.col("_before") + F.col("_inside"))
    if (total.most or 1) > common.EACH:  # parts of a large group go to different tasks
        part = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {common.EACH}")))
        rows = rows.withColumn("_part", part).withColumn("row", F.expr(f"row + _part * {common.EACH}")).withColumn("copies", F.expr(f"least(copies - _part * {common.EACH}, {common.EACH}L)")).drop("_part")
        rows = rows.repartition("row")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    return rows.drop("_key", "_bucket", "_before", "_inside").withColumn("_k", each).withColumn("row", F.col("row") + F.col("_k")).drop("_k", "copies")


def row_key(*columns: str) -> Column:
    return F.md5(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns)))


def shard_rows(docs: DataFrame, shards: int = SHARDS, key: int = KEY) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null under this law) of every row."""
    names = ["doc_id", "size", "text_crc32"]
    scratch = Scratch(docs.sparkSession, "sharding")
    text = F.encode(text_or_empty(), "UTF-8")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    groups = scratch.written(narrow.groupBy(*names).agg(F.count("*").alias("copies")), "groups")
    total = groups.agg(F.sum("copies").alias("n")).first().n or 0
    rows = numbered(groups, row_key(*names), names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place = permute(b.column(3).to_numpy(), total, key)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(place % shards, pa.int32()), pa.array(place // shards, pa.int64())], names=["doc_id", "size", "text_crc32", "shard", "slot"])

    placed = rows.select(*names, "row").mapInArrow(run, "doc_id long, size long, text_crc32 long, shard int, slot long")
    return placed.select(*names, F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def feistel_sql(source: str, key: int = KEY) -> str:
    """The permutation of (left_, right_) of `source`, which has columns row, n, a and b, as nested queries."""
    two64 = "18446744073709551616::UHUGEINT"
    times = lambda x, c: f"((({x})::UHUGEINT * {c}::UHUGEINT) % {two64})::UBIGINT"
    for k in range(ROUNDS):
        add = (key + k) * 0x9E3779B97F4A7C15 % (1 << 64)
        m = "ab"[k % 2]
        source = f"(SELECT *, ((right_::UHUGEINT + {add}::UHUGEINT) % {two64})::UBIGINT AS z0 FROM {source})"
        source = f"(SELECT *, {times('xor(z0, z0 >> 30)', 0xBF58476D1CE4E5B9)} AS z1 FROM {source})"
        source = f"(SELECT *, {times('xor(z1, z1 >> 27)', 0x94D049BB133111EB)} AS z2 FROM {source})"
        source = f"(SELECT id, n, a, b, right_ AS left_, (left_ + CAST(xor(z2, z2 >> 31) % {m}::UBIGINT AS BIGINT)) % {m} AS right_ FROM {source})"
    return source


#: CRC-32 by its table, which the polynomial gives; rows in the order of their MD5; the permutation walked until it is inside.
OP10_SQL = f"""
WITH RECURSIVE bits AS (SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) r(i) UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS crcs FROM bits WHERE k = 8),
d AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, xor(list_reduce(list_prepend(4294967295::BIGINT,
  list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda x: ('0x' || x)::BIGINT)),
  lambda c, x: xor(c >> 8, crcs[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS text_crc32 FROM documents, tab),
o AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), 'null'), size, text_crc32)), doc_id, size, text_crc32) - 1 AS id, count(*) OVER () AS n FROM d),
r AS (SELECT o.*, root AS a, (n + root - 1) // root AS b FROM o, (SELECT max(x) + 1 AS root FROM (SELECT count(*) AS rows_ FROM documents) c, range(0, 4000000) s(x) WHERE x * x <= greatest(rows_ - 1, 0))),
w AS (SELECT id, n, a, b, left_ * b + right_ AS place FROM {feistel_sql('(SELECT id, n, a, b, id // b AS left_, id % b AS right_ FROM r)')}
  UNION ALL SELECT id, n, a, b, left_ * b + right_ FROM {feistel_sql('(SELECT id, n, a, b, place // b AS left_, place % b AS right_ FROM w WHERE place >= n)')})
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place % {SHARDS} AS INTEGER) AS shard, place // {SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM r JOIN w USING (id) WHERE place < w.n
"""


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))
