"""Benchmark decontamination by greedy string tiling.

Words (runs of word characters, lower case; in scripts that put no spaces between words each character) of a document
and of a test item are compared. Seeds are the item's runs of
`least` words under a Karp-Rabin rolling hash; a document is looked at further only if its seeds could cover the required
share of an item. Then, round by round, the longest match between words that are still free in both is marked, until no
match of `least` words is left: only the document's words under seeds are looked at, the length of the longest match is
found by bisection over Karp-Rabin hashes of runs of equal length, and all matches of that length are marked in one sweep,
so texts that repeat themselves cost little more than others. Hashes propose, words decide. Coverage is the share of the
item's words that lie in marked tiles, wherever the tiles are in the document, so reordered passages count like straight ones.

An item of fewer than `least` words is found as a whole: its words in a row anywhere in the document, or, for an item
of a single word, a document of no other word.

The benchmark is a set of queries, taken in blocks of about `most_bytes` of text. The driver holds one block at a time, a
task holds one block, and there is no join: each row is judged by its text alone, in the same way for any size. Benchmarks
of up to `most_bytes` cost one pass over the documents, larger ones a pass for each block.

Defined cases: null and empty texts match nothing, nor do texts without a word; repeated rows each give their
rows, and so do items of equal text; ids may be null; empty tables give an empty result; very long texts are tiled whole;
columns other than doc_id, item_id and text are ignored, and `clean` keeps all columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import slices, table, text_or_empty, written

LEAST = 5
SHARE = 0.5
MOST_BYTES = 32 << 20
#: Scripts without spaces between words: Thai, Lao, Myanmar, Khmer, kana, and ideographs.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
WORD = re.compile(rf"[{UNSPACED}](?<=\w)|[^\W_{UNSPACED}]+")
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
MIX = np.uint64(0xBF58476D1CE4E5B9)
MATCHES = "doc_id long, item_id long, item_words int, covered int, n_tiles int, longest int, coverage double"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def rolling(ids: np.ndarray, least: int) -> np.ndarray:
    """Karp-Rabin hash, modulo 2 ** 64, of every run of `least` ids."""
    n = len(ids) - least + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(least):
            out = out * BASE + (ids[k : k + n].astype(np.uint64) + np.uint64(1)) * MIX
    return out


class Runs:
    """Karp-Rabin hashes of the runs of any length of a sequence, from the hashes of its prefixes."""

    def __init__(self, ids: np.ndarray) -> None:
        n = len(ids)
        self.power = np.ones(n + 1, np.uint64)
        self.inverse = np.ones(n + 1, np.uint64)
        back = np.uint64(pow(int(BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            self.power[1:] = np.cumprod(np.full(n, BASE))
            self.inverse[1:] = np.cumprod(np.full(n, back))
            # sum of id * base ** -place; a run's hash is its part of the sum, shifted to the run's start
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((ids.astype(np.uint64) + np.uint64(1)) * MIX * self.inverse[:-1])])

    def at(self, places: np.ndarray, length: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[places + length] - self.sums[places]) * self.power[places]


def runs_of(free: np.ndarray, least: int) -> np.ndarray:
    """Whether the `least` places from each place on are all free."""
    n = len(free) - least + 1
    total = np.concatenate([[0], np.cumsum(free)])
    return total[least:] - total[:n] == least


def under_seeds(doc: np.ndarray, item: np.ndarray, least: int) -> np.ndarray:
    """Places of `doc` that lie in a run of `least` ids that the item has too, by hash."""
    n = len(doc) - least + 1
    hit = np.flatnonzero(runs_of(doc >= 0, least) & np.isin(rolling(doc, least), rolling(item, least)))
    edge = np.zeros(len(doc) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + least, -1)
    return np.flatnonzero(np.cumsum(edge[:-1]) > 0) if n > 0 else hit


def tile(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (place in doc, place in item, words), longest first; of one length by place in doc, then in item. Ids below 0
    in `doc` match nothing."""
    tiles: list[tuple[int, int, int]] = []
    if min(len(doc), len(item)) < least:
        return tiles
    back = under_seeds(doc, item, least)  # only words under seeds can be in a tile
    if not len(back):
        return tiles
    gaps = np.flatnonzero(np.diff(back) > 1) + 1
    back = np.insert(back, gaps, -1)  # a place of no word between words that are not neighbours
    own = np.where(back >= 0, doc[back], -1)
    runs_d, runs_i = Runs(own), Runs(item)
    free_d, free_i = own >= 0, np.ones(len(item), bool)
    most = min(len(own), len(item))

    def hashes(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        p, q = np.flatnonzero(runs_of(free_d, length)), np.flatnonzero(runs_of(free_i, length))
        return p, q, runs_d.at(p, length), runs_i.at(q, length)

    while True:
        lo, hi = least - 1, most + 1  # some match of lo is left, none of hi
        while hi - lo > 1:
            mid = (lo + hi) // 2
            _, _, hp, hq = hashes(mid)
            if len(hp) and len(hq) and np.isin(hq, hp).any():
                lo = mid
            else:
                hi = mid
        if lo < least:
            return tiles
        p, q, hp, hq = hashes(lo)
        waiting: dict[int, list[int]] = {}
        for h, place in zip(hq[::-1].tolist(), q[::-1].tolist(), strict=True):
            waiting.setdefault(h, []).append(place)  # the smallest place last
        end = -1
        for h, a in zip(hp.tolist(), p.tolist(), strict=True):
            if a < end:
                continue
            left = waiting.get(h, [])
            refused: list[int] = []
            while left:
                b = left.pop()
                if not free_i[b : b + lo].all():
                    continue
                if (own[a : a + lo] == item[b : b + lo]).all():
                    free_d[a : a + lo] = False
                    free_i[b : b + lo] = False
                    tiles.append((int(back[a]), b, lo))
                    end = a + lo
                    break
                refused.append(b)  # equal hash, other words
            left.extend(reversed(refused))
        most = lo - 1


class Benchmark:
    """A block of items as ids of their own vocabulary, and their seeds in order."""

    def __init__(self, items: list[tuple[int | None, str]], least: int) -> None:
        self.vocabulary: dict[str, int] = {}
        self.ids, self.least = [i for i, _ in items], least
        self.items = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(t)], np.int64) for _, t in items]
        self.short: dict[int, dict[tuple[int, ...], list[int]]] = {}  # items below `least` by their words
        for k, x in enumerate(self.items):
            if 0 < len(x) < least:
                self.short.setdefault(len(x), {}).setdefault(tuple(x.tolist()), []).append(k)
        hashes = [rolling(x, least) for x in self.items]
        seeds = np.concatenate([np.zeros(0, np.uint64), *hashes])
        owner = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(h)) for h in hashes)])
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.owner, self.place = seeds[order], owner[order], place[order]

    def whole(self, doc: np.ndarray) -> Iterator[int]:
        """The items of fewer than `least` words that `doc` has as a whole."""
        for n, known in self.short.items():
            if n > len(doc) or n == 1 and len(doc) > 1:
                continue
            first = np.isin(doc, [x[0] for x in known])  # an item may begin here
            at = np.flatnonzero(first[: len(doc) - n + 1] & runs_of(doc >= 0, n))
            found = {tuple(x) for x in doc[at[:, None] + np.arange(n)].tolist()}
            for words in found & known.keys() if len(found) < len(known) else known.keys() & found:
                yield from known[words]

    def matches(self, text: str | None, share: float) -> Iterator[tuple[int | None, int, int, int, int, float]]:
        """item_id, words, covered, tiles, longest, coverage of each item covered by `share` at least."""
        get = self.vocabulary.get
        doc = np.array([get(w, -1) for w in words_of(text)], np.int64)
        for k in self.whole(doc):
            yield self.ids[k], len(self.items[k]), len(self.items[k]), 1, len(self.items[k]), 1.0
        if len(doc) < self.least or not len(self.seeds):
            return
        at = np.flatnonzero(runs_of(doc >= 0, self.least))
        hashes = np.unique(rolling(doc, self.least)[at])
        lo, hi = np.searchsorted(self.seeds, hashes, "left"), np.searchsorted(self.seeds, hashes, "right")
        n = hi - lo
        hit = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        if not len(hit):
            return
        hit = hit[np.argsort(self.owner[hit], kind="stable")]
        owners, first = np.unique(self.owner[hit], return_index=True)
        for k, places in zip(owners.tolist(), np.split(self.place[hit], first[1:]), strict=True):
            item = self.items[k]
            reach = np.zeros(len(item) + 1, np.int64)
            np.add.at(reach, places, 1)
            np.add.at(reach, places + self.least, -1)
            if (np.cumsum(reach[:-1]) > 0).sum() < share * len(item):
                continue  # tiles cover no more than the seeds do
            tiles = tile(doc, item, self.least)
            covered = sum(x[2] for x in tiles)
            if tiles and covered >= share * len(item):
                yield self.ids[k], len(item), covered, len(tiles), tiles[0][2], covered / len(item)


def rows_of(found: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
    names = ["doc_id", "item_id", "item_words", "covered", "n_tiles", "longest", "coverage"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True) if found else [[]] * len(types), types, strict=True)], names=names)


def blocks_of(bench: DataFrame, least: int, most_bytes: int) -> Iterator[Benchmark]:
    """The items in blocks of at most `most_bytes` of text (a larger item is a block of its own), read one after another."""
    held: list[tuple[int | None, str]] = []
    size = 0
    rows = bench.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text")).orderBy("item_id", "text")
    for r in rows.toLocalIterator():
        n = len(r.text.encode("utf-8", "surrogatepass"))
        if held and size + n > most_bytes:
            yield Benchmark(held, least)
            held, size = [], 0
        held.append((r.item_id, r.text))
        size += n
    if held:
        yield Benchmark(held, least)


def contaminated(docs: DataFrame, bench: DataFrame, least: int = LEAST, share: float = SHARE, most_bytes: int = MOST_BYTES) -> DataFrame:
    """One row per document and item of which the document covers `share` at least."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    out = None
    for block in blocks_of(bench, least, most_bytes):
        sent = spark.sparkContext.broadcast(block)  # of at most `most_bytes` of text

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            known = sent.value
            for b in slices(batches):
                yield rows_of([(doc_id, *x) for doc_id, text in zip(*(c.to_pylist() for c in b.columns), strict=True) for x in known.matches(text, share)])

        found = texts.mapInArrow(run, MATCHES)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], MATCHES)


def clean(docs: DataFrame, bench: DataFrame, least: int = LEAST, share: float = SHARE, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The rows of `docs`, with all columns, that cover `share` of no item. No text is shuffled. Between blocks of the
    benchmark the rows that are left are written, so a task holds one block."""
    spark, at, out, passes = docs.sparkSession, docs.columns.index("text"), docs, 0
    for block in blocks_of(bench, least, most_bytes):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            known = sent.value
            for b in slices(batches):
                yield b.filter(pa.array([next(known.matches(t, share), None) is None for t in b.column(at).to_pylist()], pa.bool_()))

        out = (written(out, "decontaminated") if passes else out).mapInArrow(run, docs.schema)
        passes += 1
    return out


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
