"""Quality rules: document statistics and gradient-boosted trees flattened into node arrays.

`document_stats` makes one pass over the whole texts. `train` fits boosted trees with monotonic constraints on
a bounded sample of labelled rows; `FlatTrees.score` walks all trees for a whole batch at once over flat numpy arrays.

Defined cases: a null or empty text has no words (all statistics 0, `base_failed`); repeated rows each give a row; of rows
that share a labelled doc_id the one of the smallest features counts in training, and of several labels the larger, so a
fit depends on the tables alone; rows without a doc_id are judged but never learnt from; an empty table gives an empty
result; without labels of both classes the trees accept everything and the base rules decide alone; very long texts are
measured whole; columns other than doc_id and text are ignored, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import slices, table, written

WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features of the trees and the sign of the constraint on the score (+1: may only rise with it, -1: only fall, 0: free).
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_word_share": -1, "distinct_share": 0,
    "line_words": 0, "digit_share": 0, "stop_end_share": 0, "bang_share": -1, "separator_share": -1,
}


def repeated_window_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """How many words lie in a `window`-word run that occurs twice or more. Exact: runs are compared by doubled ranks."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    mix = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(window):
            mix = mix * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + n].astype(np.uint64) + np.uint64(1)
    ordered = np.sort(mix)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0  # equal runs have equal hashes, so none repeats
    rank, span = ids.astype(np.int64), 1
    while span < window:
        step = min(span, window - span)
        _, rank = np.unique(rank[: len(rank) - step] * (rank.max() + 1) + rank[step:], return_inverse=True)
        span += step
    again = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure(text: str | None) -> tuple[list[int], list[float]]:
    """The base statistics and the features of one whole text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes.split() parts at exactly x20 and x09-x0D
    n = len(words)
    if not n:
        return [0, 0, sum(text.count(c) for c in SYMBOLS), 0, 0], [0.0] * len(FEATURES)
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    dup = len(lines) - len(set(lines))
    repeat = repeated_window_words(ids)
    weight = np.bincount(ids)
    upper = stops = bangs = bars = 0
    for w, k in seen.items():
        c = int(weight[k])
        if w.isupper() and len(w) > 1:
            upper += c
        last = w[-1:]
        stops += c if last in b".,;:?" else 0
        bangs += c if last == b"!" else 0
        bars += c if w in (b"|", b"-", b"*", b"/", b"\\", b"&gt;") else 0
    digits = sum(text.count(c) for c in "0123456789")
    features = [
        float(np.log1p(n)), chars / n, symbols / chars, dup / len(lines), repeat / n, upper / n, len(seen) / n,
        n / len(lines), digits / chars, stops / n, bangs / n, bars / n,
    ]
    return [n, chars, symbols, dup, repeat], features


def document_stats(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics and `features` (array of double in the order of FEATURES) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = [measure(t) for t in b.column(1).to_pylist()]
            cols = [pa.array([x[0][k] for x in got], pa.int64()) for k in range(len(BASE))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols, pa.array([x[1] for x in got], pa.list_(pa.float64()))], names=["doc_id", *BASE, "features"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", features array<double>")


@dataclass
class FlatTrees:
    """All trees in parallel arrays: node k tests feature[k] <= threshold[k] and goes to left[k] or right[k]; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row: every step moves all rows of all trees one level down."""
        if not len(self.roots):
            return np.full(len(x), self.bias)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.bias + self.value[at].sum(1)


def train(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, least: int = 10, l2: float = 1.0) -> FlatTrees:
    """Histogram boosting on log-loss. A split on a constrained feature needs child values in order, and both sides
    inherit the midpoint as a bound, so the sum of trees is monotonic in that feature."""
    none = FlatTrees(*(np.zeros(0, t) for t in (int, float, int, int, float, int)), 0, 1.0)
    if not len(y) or y.min() == y.max():
        return none
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    coded = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    bias = float(np.log(y.mean() / (1 - y.mean())))
    raw = np.full(len(y), bias)
    nodes: list[list[float]] = []
    roots = []

    def leaf(g: float, h: float, lo: float, hi: float) -> float:
        return float(np.clip(-g / (h + l2), lo, hi))

    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, p * (1 - p)

        def grow(rows: np.ndarray, level: int, lo: float, hi: float, grad: np.ndarray = grad, hess: np.ndarray = hess) -> int:
            k = len(nodes)
            g, h = grad[rows].sum(), hess[rows].sum()
            nodes.append([0, np.inf, k, k, rate * leaf(g, h, lo, hi)])
            if level == depth or len(rows) < 2 * least:
                raw[rows] += nodes[k][4]
                return k
            best = (1e-9, -1, -1, 0.0, 0.0)
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                m = len(c) + 1
                gs, hs, ns = (np.cumsum(np.bincount(coded[rows, j], w, m))[:-1] for w in (grad[rows], hess[rows], None))
                vl, vr = (np.clip(-a / (b + l2), lo, hi) for a, b in ((gs, hs), (g - gs, h - hs)))
                gain = -(gs * vl + (hs + l2) * vl**2 / 2) - ((g - gs) * vr + (h - hs + l2) * vr**2 / 2)
                v = leaf(g, h, lo, hi)
                gain += g * v + (h + l2) * v * v / 2
                ok = (ns >= least) & (len(rows) - ns >= least) & (signs[j] * (vr - vl) >= 0)
                gain = np.where(ok, gain, -np.inf)
                s = int(gain.argmax())
                if gain[s] > best[0]:
                    best = (float(gain[s]), j, s, float(vl[s]), float(vr[s]))
            _, j, s, vl, vr = best
            if j < 0:
                raw[rows] += nodes[k][4]
                return k
            mid, goes = (vl + vr) / 2, coded[rows, j] <= s
            a, b = ((lo, mid), (mid, hi)) if signs[j] > 0 else ((mid, hi), (lo, mid)) if signs[j] < 0 else ((lo, hi), (lo, hi))
            nodes[k][:4] = [j, cuts[j][s], grow(rows[goes], level + 1, *a), grow(rows[~goes], level + 1, *b)]
            return k

        roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
    f, t, le, ri, v = (np.array(c) for c in zip(*nodes, strict=True))
    return FlatTrees(f.astype(int), t, le.astype(int), ri.astype(int), v, np.array(roots), depth, bias)


def fit(stats: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> FlatTrees:
    """Trees from at most `max_rows` labelled rows, those of the smallest hash of doc_id (the documented bound of the
    training sample). Rows with a null label are ignored; of repeated labels the larger counts."""
    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    one = stats.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("features").alias("features"), F.max("quality").alias("quality"))
    rows = sorted(one.collect(), key=lambda r: r.doc_id)  # at most `max_rows`
    x = np.array([r.features for r in rows]).reshape(-1, len(FEATURES))
    return train(x, np.array([float(r.quality > 0) for r in rows]), list(FEATURES.values()))


def judge(stats: DataFrame, model: FlatTrees, cut: float = 0.0, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """stats with base_failed, score (log-odds of good quality) and kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 8192):
            x = np.array(b.column("features").to_pylist(), float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", *BASE)), pa.array(model.score(x), pa.float64())], names=["doc_id", *BASE, "score"])

    scored = stats.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", score double")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= cut))


def quality_rules(docs: DataFrame, labels: DataFrame, cut: float = 0.0) -> DataFrame:
    stats = written(document_stats(docs), "quality-stats")
    return judge(stats, fit(stats, labels), cut)


def keep(docs: DataFrame, labels: DataFrame, cut: float = 0.0, max_rows: int = 20_000, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """The rows of `docs` that the rules keep, with all columns. The trees come from a first look at labelled rows alone
    (a bounded sample); one pass then measures and filters, so no text is shuffled."""
    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    model = fit(document_stats(docs.join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")), labels, max_rows)
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = [measure(t) for t in b.column(at).to_pylist()]
            score = model.score(np.array([x[1] for x in got], float).reshape(-1, len(FEATURES)))
            ok = [x[0][0] >= min_words and 100 * x[0][4] <= max_repeat_percent * x[0][0] and bool(s >= cut) for x, s in zip(got, score, strict=True)]
            yield b.filter(pa.array(ok, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
