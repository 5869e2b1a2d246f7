"""Hot keys: results are the same however rows are dealt."""

from __future__ import annotations

import random

import pytest

from helixframe.llm import common, components, jaccard
from tests.llm.test_operators import brute_components, docs_of


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skewed_join_is_a_join(spark, how):
    left = spark.createDataFrame([(1 if k % 3 else k % 7 or None, k) for k in range(500)], "key long, own long")
    right = spark.createDataFrame([(k, f"r{k}") for k in (1, 2, 3)] + [(1, "again")], "key long, told string")
    plain = left.join(right, ["key"], how)
    got = common.skewed_join(left, right, ["key"], ["own"], how, each=20)
    assert got.columns == plain.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


def test_components_of_a_hub_and_a_long_chain(spark, monkeypatch):
    monkeypatch.setattr(common, "EACH", 50)
    hub = [(5, 1000 + k) for k in range(400)]
    chain = [(k, k + 1) for k in range(5000, 5600)]
    got = dict(map(tuple, components.components(spark.createDataFrame(hub + chain + [(7, 7)], "a long, b long")).collect()))
    assert got == {5: 5, **{1000 + k: 5 for k in range(400)}, **{k: 5000 for k in range(5000, 5601)}}


def test_jaccard_with_a_token_in_every_document_and_one_giant_component(spark, monkeypatch):
    for name, value in (("BLOCK", 6), ("UNIT", 5), ("CROWD", 4), ("CHUNK", 3), ("TEXTS", 3)):
        monkeypatch.setattr(jaccard, name, value)
    monkeypatch.setattr(common, "EACH", 40)
    rng = random.Random(11)
    common_words = "every page here ends with these words"
    texts = []
    words = [f"u{k}" for k in range(50)]
    for i in range(120):  # a chain of near copies: neighbours link, the ends share nothing
        words[i % 50] = f"c{i}"
        texts.append((i, " ".join(words) + " " + common_words))
    texts += [(200 + k, " ".join(f"z{rng.randrange(9)}" for _ in range(rng.choice([3, 6, 9]))) + " " + common_words) for k in range(150)]
    texts += [(400 + k % 3, common_words) for k in range(30)] + [(500, common_words), (500, common_words + " now")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs_of(spark, texts), 3, 90, each=10).collect()}
    want = brute_components(texts, 3, 90)
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}
    assert all(got[k] == want[k] for k in got if k != 500)
