"""Multi-index hashing against brute force."""

from __future__ import annotations

import math
import os
import random

import numpy as np
import pytest

from helixframe.llm import hamming

SCHEMA = "vec_id long, embedding array<float>"
ASKS = "vec_id % 20 = 0"


def vectors(n: int, d: int = 16, seed: int = 0, clusters: int = 0, lengths: bool = False) -> list[tuple]:
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    if clusters:
        x = rng.normal(size=(clusters, d))[rng.integers(clusters, size=n)] * 3 + 0.3 * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if lengths:
        x *= rng.lognormal(size=(n, 1))
    return [(k, [float(v) for v in row.astype(np.float32)]) for k, row in enumerate(x)]


def taken(rows: list[tuple]) -> list[tuple]:
    there = [r for r in rows if r[1] and all(v is not None and math.isfinite(v) for v in r[1]) and any(r[1])]
    sizes = [len(r[1]) for r in there]
    most = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    return [r for r in there if len(r[1]) == most]


def brute(rows: list[tuple], k: int = 20) -> list[list[tuple]]:
    """A sorted list of (vec_id, score) for each query row, and its vec_id first."""
    own = taken(rows)
    out = []
    for i, (q, x) in enumerate(own):
        if q is None or q % 20:
            continue
        near = [(-math.fsum(a * b for a, b in zip(x, y, strict=True)), v is None, v or 0, j, v) for j, (v, y) in enumerate(own) if j != i]
        out.append([q, *((v, -s) for s, _, _, _, v in sorted(near)[:k])])
    return sorted(out, key=repr)


def found(spark, rows: list[tuple], k: int = 20, schema: str = SCHEMA, parts: int = 4):
    got = hamming.search(spark.createDataFrame(rows, schema).repartition(parts), ASKS, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return got.collect()


def lists(rows) -> dict[int, list[tuple]]:  # noqa: ANN001
    out: dict[int, list[tuple]] = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def recall(rows: list[tuple], got, k: int = 20) -> float:  # noqa: ANN001
    mine, want = lists(got), {x[0]: x[1:] for x in brute(rows, k)}
    assert set(mine) == {q for q, w in want.items() if w}
    for q, near in mine.items():
        assert len(near) == len(want[q]) and len({v for v, _ in near}) == len(near) and q not in {v for v, _ in near}
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
    return float(np.mean([len({v for v, _ in mine[q]} & {v for v, _ in w}) / len(w) for q, w in want.items() if w]))


@pytest.mark.parametrize(("d", "clusters", "lengths"), [(16, 0, False), (64, 0, False), (16, 12, False), (16, 0, True), (3, 0, False)])
def test_recall(spark, d, clusters, lengths):
    rows = vectors(2000, d, seed=d, clusters=clusters, lengths=lengths)
    assert recall(rows, found(spark, rows)) >= 0.9


def test_few_vectors_are_all_compared(spark):
    for n in (1, 2, 5, 21):
        rows = vectors(n, 8, seed=n)
        assert [[q, *near] for q, near in sorted(lists(found(spark, rows)).items())] == [x for x in brute(rows) if len(x) > 1]


def test_ties_copies_and_repeated_ids(spark):
    """A third of all rows are one vector; ids repeat; some vectors are one apart in sign."""
    same = [1.0, 2.0, -0.0, 0.5]
    rows = [(k, same) for k in range(300)] + [(k, [-1.0, 0.0, 0.0, 1.0]) for k in range(300, 330)] + [(None, same)] * 30 + [(20, same), (20, [0.5, 0.5, 0.5, 0.5]), (7, same)] + [(400 + k, [1.0, 0.0, 0.0, 0.0]) for k in range(40)]
    rows_of = found(spark, rows)
    per_query: dict[int, int] = {}
    for r in rows_of:
        per_query[r["query_id"]] = per_query.get(r["query_id"], 0) + 1
    want = brute(rows)
    assert per_query == {q: 20 * sum(x[0] == q for x in want) for q in {x[0] for x in want}}
    once = {q for q in per_query if per_query[q] == 20}
    mine = lists(rows_of)
    assert {q: mine[q] for q in once} == {x[0]: x[1:] for x in want if x[0] in once}
    assert sorted(mine[20]) == sorted(p for x in want if x[0] == 20 for p in x[1:])


def test_vectors_that_take_no_part(spark):
    odd = [(0, None), (20, []), (40, [0.0] * 8), (60, [1.0] * 7 + [None]), (80, [float("nan")] + [1.0] * 7), (100, [float("inf")] + [1.0] * 7), (120, [1.0] * 3), (None, [1.0] * 8)]
    rows = odd + [(k + 1000, v) for k, v in vectors(17, 8)]
    want = {x[0]: x[1:] for x in brute(rows)}
    assert lists(found(spark, rows)) == want and set(want) == {1000}
    assert found(spark, odd[:6]) == [] and found(spark, []) == []


def test_doubles_of_any_size_and_clashing_columns(spark):
    rng = random.Random(3)
    rows = [(k, [rng.uniform(-1, 1) * 10.0 ** rng.choice([-200, 0, 2]) for _ in range(6)]) for k in range(80)] + [(80, [1e250] * 6), (81, [1e250] * 6)]
    frame = spark.createDataFrame([(*r, 1, "x", b"k", 2.0) for r in rows], "vec_id long, embedding array<double>, row int, key string, vector binary, score double")
    got = lists(hamming.search(frame, ASKS, 20).collect())
    want = {}
    for q, x in rows:
        if q % 20 == 0:
            near = [(v, float(hamming.products(np.array([x]), np.array([y]))[0])) for v, y in rows if v != q]
            want[q] = sorted(near, key=lambda p: (-p[1], p[0]))[:20]
    assert {q: len(n) for q, n in got.items()} == {q: 20 for q in want}
    assert got[80][0] == (81, math.inf)
    assert sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want) >= 0.9 * 20 * len(want)


def test_every_code_within_the_radius_is_opened():
    """Pigeonhole: some table that is opened has the pair, and only the first one gives it."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 63, size=400, dtype=np.int64)
    y = x.copy()
    for k in range(400):
        for bit in rng.choice(63, size=k % 40, replace=False):
            y[k] ^= np.int64(1) << np.int64(bit)
    import pyarrow as pa

    v = [np.float32([1, k]).tobytes() for k in range(400)]
    side = lambda c: pa.table({"key": [str(k).encode() for k in range(400)], "first": np.arange(400), "vector": v, "code": c})
    for r in (0, 3, 5, 17, 39, 64):
        within = hamming.radii(r)
        pairs: list[tuple] = []
        for s in range(hamming.TABLES):
            if within[s] >= 0:
                t = hamming.matched(side(x), side(y), s, within, r, 10_000, "<f4", 400.0)
                pairs += zip(t["query"].to_pylist(), t["key"].to_pylist(), strict=True)
        apart = np.bitwise_count(x.view(np.uint64)[None, :] ^ y.view(np.uint64)[:, None])
        assert len(pairs) == len(set(pairs)) == int((apart <= r).sum())


def test_split_cells_give_the_same(spark, monkeypatch):
    rows = vectors(700, 8, seed=9, clusters=3)
    plain = lists(found(spark, rows))
    for name, value in (("CELL_ROWS", 20), ("QUERY_ROWS", 4)):
        monkeypatch.setattr(hamming, name, value)
    assert lists(found(spark, rows)) == plain


def test_compensated_products_are_exact_for_floats():
    rng = np.random.default_rng(1)
    x, y = (rng.normal(size=(200, 64)).astype(np.float32).astype(np.float64) for _ in range(2))
    assert hamming.products(x, y).tolist() == [math.fsum((a * b).tolist()) for a, b in zip(x, y, strict=True)]


def test_recall_on_the_driver_table(spark):
    path = "/root/testdata/sf0.001/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip("no driver tables here")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(path).collect()]
    assert recall(rows, hamming.op11_nearest_neighbours(spark, "/root/testdata/sf0.001").collect()) >= 0.9
