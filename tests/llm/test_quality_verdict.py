"""The verdict of the quality rules against trees walked node by node, and scores that equal the cut."""

from __future__ import annotations

import random

import numpy as np
import pytest

from helixframe.llm import quality
from tests.llm.test_operators import docs_of, prose


def walked(model: quality.FlatTrees, x: list[float]) -> float:
    total = []
    for k in model.roots.tolist():
        while model.left[k] != k or model.right[k] != k:
            k = int(model.left[k] if x[int(model.feature[k])] <= model.threshold[k] else model.right[k])
        total.append(model.value[k])
    return float(model.bias + np.sum(np.array(total)))


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(5)
    texts: list[tuple] = []
    for k in range(240):
        good = k % 2
        text = prose(rng, rng.randrange(25, 120)) if good else " ".join(rng.choice(["BUY", "now!!", "###", "$$$", "click", "w|w", "7" * 5]) + str(rng.randrange(99)) for _ in range(rng.randrange(22, 90)))
        texts.append((k, text))
    texts += [(900, None), (901, ""), (902, "too short"), (903, "same words " * 60), (904, texts[1][1]), (None, texts[3][1])]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(0, 240)] + [(None, 1, 0), (905, None, 0)], "doc_id long, quality int, toxic int")
    return texts, labels


@pytest.mark.parametrize("tie", [None, 7, 31, 100])
def test_kept_against_trees_walked_by_hand(spark, made, tie):
    texts, labels = made
    docs = docs_of(spark, texts)
    model = quality.fit(quality.document_stats(docs), labels)
    score = {i: walked(model, quality.measure(t)[1]) for i, (_, t) in enumerate(texts)}
    cut = 0.0 if tie is None else score[tie]  # a score that equals the cut is kept
    got = sorted(((r.doc_id, r.n_words, r.base_failed, r.kept) for r in quality.quality_rules(docs, labels, cut).collect()), key=repr)
    want = []
    for i, (doc, text) in enumerate(texts):
        base = quality.measure(text)[0]
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        want.append((doc, base[0], failed, not failed and score[i] >= cut - 1e-12))
    assert got == sorted(want, key=repr)
    kept = quality.keep(docs, labels, cut)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(((d, t) for (d, t), w in zip(texts, want, strict=True) if w[3]), key=repr)
    if tie is not None:
        assert next(w for w, (d, _) in zip(want, texts, strict=True) if d == tie)[3]
