"""Rows are judged by their text, whatever their ids, with small and large benchmarks alike."""

from __future__ import annotations

from collections import Counter

import pytest

from helixframe.llm import decontaminate

LEAK, OTHER = " ".join(f"q{k}" for k in range(20)), " ".join(f"z{k}" for k in range(20))
DOCS = [(None, f"a b c {LEAK}"), (None, "nothing here at all to see"), (7, f"{LEAK} end"), (7, "a clean row of the same id"), (8, OTHER), (9, LEAK), (9, LEAK), (10, None)]
ITEMS = [(None, OTHER), (1, LEAK), (1, OTHER), (2, LEAK)]


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_rows_without_or_with_shared_ids(spark, most):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench, most_bytes=most).collect())
    assert got == Counter({(None, 1): 1, (None, 2): 1, (7, 1): 1, (7, 2): 1, (8, None): 1, (8, 1): 1, (9, 1): 2, (9, 2): 2})
    kept = decontaminate.clean(docs, bench, most_bytes=most)
    assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} == {DOCS[1], DOCS[3], DOCS[7]}
