"""Source divergence audit: how far the words of each source of a language lie from every other source, and which terms
set a source apart from its language.

Sort-based streaming. Map tasks combine the rows of a chunk of documents (term, documents, occurrences), so a word that
every document has is a row for each chunk and source, not one for each document. Rows are dealt by (lang, term), chunks of a
source are merged there (documents are in one chunk each, so their numbers add up), and what is left is sorted by (lang, term,
source, document); a scan of the runs adds documents and occurrences up and writes each term that the language keeps as one
row with its sources. A row has an entry for each source of a language at most, of which the result
has the square. A second scan over these rows emits, for each task, partial sums of pairs of sources and the best terms of
each group; what is left to add and rank is small.

Most terms occur in few sources. A source without the term has the same share for all of them, so the sum over all kept
terms is that of a term that neither has, times the number of terms, with a correction for terms of one of the two and a
second one for terms of both. All numbers are integers.

Sources and their totals are sent to tasks in blocks of `GROUPS`; with more groups than that, each pair of blocks is a pass.

Defined cases: null text, lang and source are ''; each row is a document, so repeated rows and repeated or null doc_ids count
as often as they stand there; texts without terms only make their group occur; very long texts are cut in pieces at
characters that no term has; ties go to the smaller item in UTF-8; an empty table gives an empty result; other columns
are ignored. Counts may reach 9 * 10^15.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm.common import Scratch, slices, table

LEAST_DOCUMENTS = 3
BEST_TERMS = 200
SCALE = 1_000_000_000
#: Distinct (source, term) of a chunk of documents, bytes of a piece of text, groups of a pass, pairs at once.
CHUNK, PIECE, GROUPS, PAIRS = 600_000, 1 << 20, 1000, 1_000_000
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a list for each piece of it: letters of ASCII and all characters beyond, A-Z in lower case."""
    at = 0
    while at < len(text):
        piece = text[at : at + PIECE].translate(FOLD)
        if at + PIECE < len(text) and piece[-1] != 32:  # the piece goes on to the end of its last term
            rest, end = [], at + PIECE
            while end < len(text) and (more := text[end : end + 4096].translate(FOLD)):
                cut = more.find(b" ")
                rest.append(more if cut < 0 else more[:cut])
                end += len(rest[-1])
                if cut >= 0:
                    break
            piece, at = b"".join([piece, *rest]), end
        else:
            at += PIECE
        yield piece.split()


def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (lang, source, document, text) to rows of chunks: lang, term, source, document (the first one), docs, count."""
    held: dict[tuple[bytes, bytes], tuple[int | None, Counter, Counter]] = {}

    def drain() -> Iterator[pa.RecordBatch]:
        for (lang, source), (first, docs, counts) in held.items():
            n = len(docs)
            if n:
                columns = [pa.array([lang] * n, pa.binary()), pa.array(list(docs), pa.binary()), pa.array([source] * n, pa.binary()), pa.array([first] * n, pa.int64()), pa.array(list(docs.values()), pa.int64()), pa.array([counts[t] for t in docs], pa.int64())]
                yield from pa.Table.from_arrays(columns, names=["lang", "term", "source", "document", "docs", "count"]).to_batches(max_chunksize=20_000)
        held.clear()

    size = 0
    for batch in slices(batches):
        for lang, source, document, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            _, docs, counts = held.setdefault((lang, source), (document, Counter(), Counter()))
            before, seen = len(docs), set()
            for words in words_of(text):
                counts.update(words)
                seen.update(words)
            docs.update(seen)
            size += len(docs) - before
            if size >= CHUNK:
                yield from drain()
                size = 0
    yield from drain()


def starts(t: pa.Table, columns: list[str]) -> np.ndarray:
    """Where rows begin that differ from the one before."""
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for c in columns:
        x = t[c].combine_chunks()
        new[1:] |= pc.not_equal(x[1:], x[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def scanned(batches: Iterator[pa.RecordBatch], least: int = LEAST_DOCUMENTS) -> Iterator[pa.RecordBatch]:
    """Runs of rows sorted by (lang, term, source, document): kept terms with their sources and occurrences there. The last run of
    a batch may go on in the next: its rows, one a source, are held."""
    held: pa.Table | None = None

    def runs(t: pa.Table, end: bool) -> tuple[pa.RecordBatch | None, pa.Table]:
        at = starts(t, ["lang", "term", "source"])
        one = t.take(pa.array(at))  # a row for each (lang, term, source)
        docs, counts = (np.add.reduceat(t[c].to_numpy(), at) if len(at) else np.zeros(0, np.int64) for c in ("docs", "count"))
        one = pa.table({"lang": one["lang"], "term": one["term"], "source": one["source"], "docs": docs, "count": counts})
        first = starts(one, ["lang", "term"])
        whole = one.num_rows if end or not len(first) else first[-1]
        first = first[first < whole]
        rest = one.slice(whole)
        if not len(first):
            return None, rest
        sizes = np.diff(np.append(first, whole))
        kept = np.add.reduceat(docs[:whole], first) >= least
        inside = pa.array(np.repeat(kept, sizes))
        done = one.slice(0, whole)
        flat, offsets = done.filter(inside), np.append(0, np.cumsum(sizes[kept])).astype(np.int32)
        heads = done.take(pa.array(first[kept]))
        lists = (pa.ListArray.from_arrays(pa.array(offsets), flat[c].combine_chunks()) for c in ("source", "count"))
        return pa.RecordBatch.from_arrays([heads["lang"].combine_chunks(), heads["term"].combine_chunks(), *lists], names=["lang", "term", "sources", "counts"]), rest

    for b in batches:
        t = pa.Table.from_batches([b]).select(["lang", "term", "source", "docs", "count"])
        out, held = runs(pa.concat_tables([held, t]) if held is not None else t, False)
        if out is not None and out.num_rows:
            yield out
    if held is not None and held.num_rows:
        out, _ = runs(held, True)
        if out is not None and out.num_rows:
            yield out


def share(count: np.ndarray | int, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), three digits at a time, so that nothing exceeds 64 bits."""
    rest, out = np.asarray(count, np.int64) + 1, np.int64(0)
    for _ in range(3):
        digit = rest * 1000 // total
        rest, out = rest * 1000 - digit * total, out * 1000 + digit
    return out + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); shares are at most 10^9 + 1."""
    return (p - q) * (p - q) // q


def group_table(docs: DataFrame, runs: DataFrame, scratch: Scratch) -> DataFrame:
    """(lang, source, n, lang_n, v) of every group that occurs: occurrences of kept terms, those of the language, kept terms."""
    entries = runs.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    inside = entries.groupBy("lang", F.col("e.sources").alias("source")).agg(F.sum("e.counts").alias("n"))
    inside = docs.select("lang", "source").distinct().join(inside, ["lang", "source"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    of_lang = inside.groupBy("lang").agg(F.sum("n").alias("lang_n"))
    terms = runs.groupBy("lang").agg(F.count("*").alias("v"))
    return scratch.written(inside.join(of_lang, "lang").join(terms, "lang", "left").withColumn("v", F.coalesce("v", F.lit(0).cast("long"))), "groups")


class Sources:
    """The sources of one language that a pass is about: names, occurrences, and which block each belongs to."""

    def __init__(self, rows: list) -> None:
        rows = sorted(rows, key=lambda r: bytes(r.source))
        self.names = pa.array([bytes(r.source) for r in rows], pa.binary())
        self.n, self.block = np.array([r.n for r in rows], np.int64), np.array([r.block for r in rows])
        self.lang_n, self.v = rows[0].lang_n, rows[0].v
        self.total = self.n + self.v
        self.zero = share(0, np.maximum(self.total, 1))  # the share of a term that is not there


def emitted(lang: bytes, source: np.ndarray, part: str, item: pa.Array, value: np.ndarray, names: pa.Array) -> pa.RecordBatch:
    n = len(value)
    return pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.binary()), names.take(pa.array(source)), pa.array([part] * n, pa.string()), item, pa.array(value, pa.int64())], names=["lang", "source", "part", "item", "value"])


OUT = "lang binary, source binary, part string, item binary, value long"


def one_pass(groups: DataFrame, runs: DataFrame, a: int, b: int, best: int) -> DataFrame:
    """Partial rows of the pairs of sources of blocks a and b and, where both are one block, of the terms of its sources."""
    rows = groups.where(F.col("block").isin(a, b)).collect()  # about twice GROUPS
    by_lang: dict[bytes, list] = {}
    for r in rows:
        by_lang.setdefault(bytes(r.lang), []).append(r)
    known = {lang: Sources(own) for lang, own in by_lang.items()}

    def wanted(x: Sources, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return (g != h) & ((x.block[g] != x.block[h]) if a != b else True)

    def base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each pair: what it would be if neither had any of the kept terms."""
        for batch in batches:
            for lang, source in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = known[lang]
                g = x.names.index(source).as_py()
                h = np.arange(len(x.names))
                h = h[wanted(x, np.full(len(h), g), h)]
                value = x.v * apart(x.zero[g], x.zero[h])
                yield emitted(lang, np.full(len(h), g), "pair", x.names.take(pa.array(h)), value, x.names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {lang: np.zeros((len(x.names), len(x.names)), np.int64) for lang, x in known.items()}
        tops: dict[bytes, list[tuple[np.ndarray, np.ndarray, pa.Array]]] = {}
        for batch in batches:
            langs = batch.column(0)
            for lang in pc.unique(langs).to_pylist():
                if (x := known.get(lang)) is None:
                    continue
                t = batch.filter(pc.equal(langs, pa.scalar(lang, pa.binary()))) if len(pc.unique(langs)) > 1 else batch
                sizes = pc.list_value_length(t.column(2)).to_numpy().astype(np.int64)
                every, counts = t.column(2).flatten(), t.column(3).flatten().to_numpy()
                run = np.repeat(np.arange(len(sizes)), sizes)
                found = pc.index_in(every, value_set=x.names)
                here = pc.is_valid(found).to_numpy(zero_copy_only=False)
                g, c, run_of = pc.fill_null(found, 0).to_numpy()[here].astype(np.int64), counts[here], run[here]
                p = share(c, x.total[g])
                if a == b:
                    terms(lang, x, t.column(1), np.bincount(run, minlength=len(sizes)), counts, g, p, run_of, tops)
                alone(x, g, c, sums[lang])
                together(x, g, p, run_of, sums[lang])
        for lang, m in sums.items():
            x = known[lang]
            g, h = np.nonzero(m)
            keep = wanted(x, g, h)
            g, h = g[keep], h[keep]
            for at in range(0, len(g), 50_000):
                part = slice(at, at + 50_000)
                yield emitted(lang, g[part], "pair", x.names.take(pa.array(h[part])), m[g[part], h[part]], x.names)
        for lang, parts in tops.items():
            for g, f, item in pruned(parts):
                yield emitted(lang, g, "term", item, f, known[lang].names)

    def alone(x: Sources, g: np.ndarray, c: np.ndarray, m: np.ndarray) -> None:
        """Terms of one source against the share of terms that another lacks."""
        order = np.lexsort((c, g))
        g, c = g[order], c[order]
        new = np.flatnonzero(np.append(True, (np.diff(g) != 0) | (np.diff(c) != 0))[: len(g)])
        times = np.diff(np.append(new, len(g)))
        g, p = g[new], share(c[new], x.total[g[new]])
        for at in range(0, len(g), max(1, PAIRS // max(1, len(x.zero)))):
            part = slice(at, at + max(1, PAIRS // max(1, len(x.zero))))
            own, p1, n = g[part], p[part][:, None], times[part][:, None]
            z, zg = x.zero[None, :], x.zero[own][:, None]
            np.add.at(m, own, n * (apart(p1, z) - apart(zg, z)))
            np.add.at(m.T, own, n * (apart(z, p1) - apart(z, zg)))

    def together(x: Sources, g: np.ndarray, p: np.ndarray, run: np.ndarray, m: np.ndarray) -> None:
        """Terms of two sources: what is left beyond the corrections for each of them."""
        if not len(g):
            return
        first = np.flatnonzero(np.append(True, np.diff(run) != 0))
        size = np.diff(np.append(first, len(g)))
        head, width = np.repeat(first, size), np.repeat(size, size)
        ends = np.cumsum(width)
        at = 0
        while at < len(g):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
            w = width[at:to]
            i = np.repeat(np.arange(at, to), w)
            j = np.repeat(head[at:to] - (np.cumsum(w) - w), w) + np.arange(w.sum())
            keep = wanted(x, g[i], g[j])
            i, j = i[keep], j[keep]
            zi, zj = x.zero[g[i]], x.zero[g[j]]
            np.add.at(m, (g[i], g[j]), apart(p[i], p[j]) - apart(p[i], zj) - apart(zi, p[j]) + apart(zi, zj))
            at = to

    def terms(lang: bytes, x: Sources, names: pa.Array, sizes: np.ndarray, counts: np.ndarray, g: np.ndarray, p: np.ndarray, run: np.ndarray, tops: dict) -> None:
        total = np.add.reduceat(counts, np.cumsum(sizes) - sizes) if len(sizes) else counts
        q = share(total, x.lang_n + x.v)[run]
        above = p > q
        tops.setdefault(lang, []).append((g[above], apart(p[above], q[above]), names.take(pa.array(run[above]))))
        if sum(len(f) for _, f, _ in tops[lang]) > 4 * best * max(1000, len(x.names)):
            tops[lang] = pruned(tops[lang])

    def pruned(parts: list) -> list:
        """The best terms of each group, ties to the smaller term."""
        g, f = (np.concatenate([x[k] for x in parts]) for k in (0, 1))
        item = pa.concat_arrays([x[2] for x in parts])
        t = pa.table({"g": g, "f": f, "item": item})
        order = pc.sort_indices(t, sort_keys=[("g", "ascending"), ("f", "descending"), ("item", "ascending")]).to_numpy()
        g = g[order]
        rank = np.arange(len(g)) - np.searchsorted(g, g)
        order = order[rank < best]
        return [(t["g"].to_numpy()[order], f[order], item.take(pa.array(order)))]

    own = groups.where(F.col("block").isin(a, b)).select("lang", "source").mapInArrow(base, OUT)
    return own.unionByName(runs.select("lang", "term", "sources", "counts").mapInArrow(scan, OUT))


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, best: int = BEST_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank, as the module says."""
    scratch = Scratch(docs.sparkSession, "divergence")
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary").alias(c)
    narrow = docs.select(plain("lang"), plain("source"), F.col("doc_id").cast("long").alias("document"), plain("text"))
    rows = narrow.mapInArrow(combined, "lang binary, term binary, source binary, document long, docs long, count long")
    dealt = rows.repartition("lang", "term").groupBy("lang", "term", "source")  # chunks of a source meet where they are
    merged = dealt.agg(F.min("document").alias("document"), F.sum("docs").alias("docs"), F.sum("count").alias("count"))
    # the hash comes first in the order: numbers of 64 bits are compared faster than the first letters of a language
    in_order = merged.withColumn("hash", F.xxhash64("lang", "term")).sortWithinPartitions("hash", "lang", "term", "source", "document").drop("hash")
    runs = scratch.written(in_order.mapInArrow(lambda b: scanned(b, least), "lang binary, term binary, sources array<binary>, counts array<long>"), "runs")
    groups = group_table(narrow, runs, scratch)
    blocks = max(1, -(-groups.count() // GROUPS))
    groups = groups.withColumn("block", F.pmod(F.xxhash64("lang", "source"), F.lit(blocks)).cast("int"))
    found: DataFrame | None = None
    for a in range(blocks):
        for b in range(a, blocks):
            now = one_pass(groups, runs, a, b, best)
            found = now if found is None else found.unionByName(now)
    found = scratch.written(found, "found")
    text = lambda c: F.col(c).cast("string").alias(c)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).withColumn("rank", rank)
    terms = found.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= best)  # each task keeps that many
    return pairs.unionByName(terms).select(text("lang"), text("source"), "part", text("item"), "value", "rank")


OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
t AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, count(*) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {LEAST_DOCUMENTS}),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY lang),
c AS (SELECT t.lang, t.source, t.term, count(*) AS c FROM t JOIN k ON t.lang = k.lang AND t.term = k.term GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT g.lang, g.source, coalesce(sum(c.c), 0) AS n FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
p AS (SELECT n.lang, n.source, k.term, coalesce(c.c, 0) AS c, k.c AS lc, 1 + ({SCALE}::HUGEINT * (coalesce(c.c, 0) + 1)) // (n.n + v.v) AS p, 1 + ({SCALE}::HUGEINT * (k.c + 1)) // (v.n + v.v) AS q
  FROM n JOIN v ON n.lang = v.lang JOIN k ON n.lang = k.lang LEFT JOIN c ON n.lang = c.lang AND n.source = c.source AND k.term = c.term),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM f QUALIFY part = 'pair' OR rank <= {BEST_TERMS}
"""


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))
