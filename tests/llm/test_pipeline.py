"""The pipeline's stages, each on edge cases and on its predecessor's output."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from helixframe.llm import registry
from tests.llm.test_operators import DOCS, EDGES, docs_of, prose


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    rng = random.Random(0)
    base = prose(rng, 80)
    item = " ".join(f"q{k}" for k in range(25))
    texts = [(k, f"{prose(rng, 80)} unique{k} word{k}.") for k in range(60)]
    texts += [(100, base), (101, base), (102, base + " tail"), (110, prose(rng, 40) + " " + item), (120, prose(rng, 60) + " token = 0123456789abcdef0123456789abcdef"), (130, " ".join(f"{w}###" for w in base.split())), (140, None), (141, "short")]
    texts += [(150 + k, " ".join(f"{rng.choice('abcdefgh')}###$$" for _ in range(60))) for k in range(60)]
    docs_of(spark, texts).select(*cp.DOCUMENT).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i < 130), 0) for i, _ in texts], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_names_and_order():
    assert [n for n, _ in cp.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "best-fit packing"]


def test_decisions_take_effect(spark, sf_dir, tmp_path):
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen[name] = docs
        if k < 4:
            assert tuple(docs.columns) == cp.DOCUMENT
    ids = lambda n: {r.doc_id for r in seen[n].select("doc_id").collect()}
    assert ids("quality rules").isdisjoint({130, 140, 141, *range(150, 210)}) and set(range(60)) <= ids("quality rules")
    assert {101, 102}.isdisjoint(ids("n-gram Jaccard join")) and {100, *range(60)} <= ids("n-gram Jaccard join")
    assert 110 not in ids("benchmark decontamination") and set(range(60)) <= ids("benchmark decontamination")
    text = seen["secret scans"].where("doc_id = 120").first()
    assert "[SECRET]" in text.text and text.n_chars == len(text.text)
    assert ids("best-fit packing") == ids("secret scans")
    assert seen["best-fit packing"].groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_stages_take_edges_and_empty_tables(spark, sf_dir):
    for rows in (EDGES, []):
        docs = docs_of(spark, rows)
        for name, stage in cp.STAGES:
            out = stage(spark, docs, sf_dir)
            n = out.count()
            assert n == 0 if not rows else n >= 0, name
    kept = cp.jaccard_stage(spark, docs_of(spark, EDGES), sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert DOCS.startswith("doc_id")


def test_run(spark, sf_dir):
    assert cp.run(spark, sf_dir).where("length > 1024").count() == 0


def test_registry_names_every_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in registry.QUERIES) == list(range(1, 13))
    assert set(registry.ORACLES) <= set(registry.QUERIES)


def brute_kept(texts: list[tuple[int | None, str | None]]) -> list[tuple[int | None, str | None]]:
    """Of each group of the n-gram join the document of the smallest doc_id, of a doc_id the smallest text."""
    from tests.llm.test_operators import brute_components

    component = brute_components([x for x in texts if x[0] is not None], 5, 80)
    kept = [x for x in texts if x[0] is None or not component[x[0]][0] or component[x[0]][1] == x[0]]
    ids = sorted({i for i, _ in kept if i is not None})
    return [x for x in kept if x[0] is None] + [(i, min((t for j, t in kept if j == i), key=lambda t: (t is not None, t or ""))) for i in ids]


def test_the_jaccard_stage_against_brute_force(spark, sf_dir):
    rng = random.Random(21)
    texts: list[tuple[int | None, str | None]] = []
    for k in range(40):
        words = prose(rng, 60).split()
        for j in range(rng.choice([1, 1, 2, 4])):
            copy = words[:]
            for _ in range(rng.choice([0, 0, 1, 3])):
                copy[rng.randrange(60)] = f"w{rng.randrange(99)}"
            texts.append((1000 - 7 * k - j, " ".join(copy)))
    texts += [(2000, None), (2001, ""), (2002, "a b"), (2003, "A B"), (2004, None), (2004, None), (2005, prose(rng, 30)), (2005, prose(rng, 31)), (None, "a b"), (None, None)]
    got = cp.jaccard_stage(spark, docs_of(spark, texts), sf_dir)
    assert tuple(got.columns) == cp.DOCUMENT
    order = lambda x: (x[0] is not None, x[0] or 0, x[1] or "")
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=order) == sorted(brute_kept(texts), key=order)
