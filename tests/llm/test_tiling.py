"""Tiling of texts that repeat themselves, and blocks of a benchmark."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from helixframe.llm import decontaminate
from tests.llm.test_operators import brute_tiles, docs_of, prose


def test_one_repeated_word_costs_little():
    began = time.time()
    assert decontaminate.tile(np.zeros(20_000, np.int64), np.zeros(2_000, np.int64), 5) == [(0, 0, 2_000)]
    assert time.time() - began < 1


def test_repetitive_texts_against_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        motif = [rng.randrange(3) for _ in range(rng.randrange(1, 5))]
        item = (motif * 12)[: rng.randrange(5, 26)] + [9] + motif * 2
        doc = (motif * 20)[: rng.randrange(40)] + [rng.randrange(-1, 4) for _ in range(9)] + item[3:]
        tiles = decontaminate.tile(np.array(doc, np.int64), np.array(item, np.int64), 3)
        assert sum(t[2] for t in tiles) == brute_tiles([x if x >= 0 else None for x in doc], item, 3)
        assert [t[2] for t in tiles] == sorted((t[2] for t in tiles), reverse=True)


def test_hashes_of_runs():
    ids = np.array([3, 1, 4, 1, 5, 9, 2, 6, 3, 1, 4, 1, 5], np.int64)
    runs = decontaminate.Runs(ids)
    for n in (1, 2, 5):
        h = runs.at(np.arange(len(ids) - n + 1), n)
        for a in range(len(h)):
            for b in range(len(h)):
                assert (h[a] == h[b]) == (ids[a : a + n].tolist() == ids[b : b + n].tolist())


def test_blocks_hold_every_item_once(spark):
    items = [(k if k % 4 else None, "x" * n) for k, n in enumerate([5, 0, 30, 7, 7, 7, 100, 1])]
    bench = spark.createDataFrame([*items, (9, None)], "item_id long, text string")
    blocks = list(decontaminate.blocks_of(bench, 5, 20))
    assert sorted((i for b in blocks for i in b.ids), key=str) == sorted([i for i, _ in items] + [9], key=str)
    assert len(blocks) > 3


def brute_covered(doc: list[str], item: list[str]) -> int:
    """Words of an item that a document covers; one of fewer than five words is found as a whole."""
    n = len(item)
    if n >= 5 or not n:
        return brute_tiles(doc, item, 5) if n else 0
    return n if (doc == item if n == 1 else any(doc[k : k + n] == item for k in range(len(doc)))) else 0


@pytest.mark.parametrize("most", [1 << 20, 300, 0])
def test_any_number_of_blocks_against_brute_force(spark, most):
    rng = random.Random(12)
    items = [(k, prose(rng, rng.choice([3, 8, 20, 40]))) for k in range(8)] + [(None, "word " * 30), (3, None), (3, "")]
    texts = [(k, f"{prose(rng, 10)} {items[k % 8][1] if k % 2 else ''} {prose(rng, 10)}") for k in range(24)] + [(None, "word " * 300), (5, "word " * 14), (5, None)]
    want = []
    for i, t in texts:
        for j, x in items:
            a, b = decontaminate.words_of(t), decontaminate.words_of(x)
            covered = brute_covered(a, b)
            if covered and covered >= 0.5 * len(b):
                want.append((i, j, len(b), covered))
    docs, bench = docs_of(spark, texts), spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, doc_id string")
    got = [(r.doc_id, r.item_id, r.item_words, r.covered) for r in decontaminate.contaminated(docs, bench, most_bytes=most).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = decontaminate.clean(docs, bench, most_bytes=most)
    assert kept.columns == docs.columns
    leaked = [(i, t) for i, t in texts if any(c and c >= 0.5 * len(decontaminate.words_of(x)) for _, x in items for c in [brute_covered(decontaminate.words_of(t), decontaminate.words_of(x))])]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted((x for x in texts if x not in leaked), key=str)


def test_short_items_and_scripts_without_spaces(spark):
    """Recall and precision by class of item: each is planted in prose of its kind, and looked for in prose without it."""
    rng = random.Random(8)
    signs = [chr(0x4E00 + k) for k in range(400)]
    kana, thai = [chr(0x3042 + k) for k in range(60)], [chr(0x0E01 + k) for k in range(40)]
    joined = lambda pool, n: "".join(rng.choice(pool) for _ in range(n))
    kinds = {
        "words": (lambda: prose(rng, 20), lambda: prose(rng, 60)), "two": (lambda: f"zq{rng.randrange(999)} vx{rng.randrange(999)}", lambda: prose(rng, 60)), "four": (lambda: " ".join(f"qz{rng.randrange(99)}" for _ in range(4)), lambda: prose(rng, 60)),
        "ideographs": (lambda: joined(signs, 24), lambda: joined(signs, 200)), "kana": (lambda: joined(kana, 12) + joined(signs, 12), lambda: joined(kana, 150)), "thai": (lambda: joined(thai, 30), lambda: joined(thai, 150)),
    }
    items, texts, leaks = [], [], set()
    for kind, (item, filler) in kinds.items():
        for _ in range(12):
            items.append((len(items), item()))
            texts += [(len(texts), f"{filler()} {items[-1][1]}{' ' if kind in ('two', 'four', 'words') else ''}{filler()}"), (len(texts) + 1, filler())]
            leaks.add((len(texts) - 2, items[-1][0]))
    docs, bench = docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == leaks
    assert {r.doc_id for r in decontaminate.clean(docs, bench).collect()} == {d for d, _ in texts} - {d for d, _ in leaks}


def test_words_of_mixed_scripts():
    assert decontaminate.words_of("The 中文题目 test_1 ラーメン, ก็ 한국어 단어") == ["the", "中", "文", "题", "目", "test", "1", "ラ", "ー", "メ", "ン", "ก", "한국어", "단어"]
    one = decontaminate.Benchmark([(1, "yes"), (2, "yes no")], 5)
    found = lambda text: sorted(x[0] for x in one.matches(text, 0.5))
    assert (found("Yes!"), found("yes it is"), found("oh yes, no"), found("no yes"), found(None), found("")) == ([1], [], [2], [], [], [])
