"""Catalogue queries over every row of their tables and every character of their texts."""

from __future__ import annotations

import re

import pytest

from helixframe.plans import catalogue, inputs


def test_read_score_of_whole_texts(spark, tmp_path):
    texts = ["plain words\nand more", "Straße été\ttab", "x" * 5000, "\U0001f600z\r\x00", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = dict(map(tuple, catalogue.read_score(spark, str(tmp_path)).collect()))
    assert got == {k: sum(ord(c) - 33 for c in t or "" if "0" <= c <= "~") for k, t in enumerate(texts)}


@pytest.mark.parametrize("name", ["regions", "features"])
def test_every_order_is_an_input(spark, tmp_path, name):
    orders = [(k, k % 7) for k in range(1, 400)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    rows = getattr(inputs, name)(spark, str(tmp_path))
    assert rows.count() == len(orders) * (3 if name == "features" else 1)


def test_no_sql_cuts_its_tables():
    whole = "mark_duplicates read_score overlap_join_count overlap_semi_distinct overlap_left_semi region_broadcast_join masked_sites interval_trim transcript_counts interval_subtract"
    for name in whole.split():
        assert not re.search(r"% (2|3|4|5|50) = 0\)", catalogue.ORACLES[name]), name
        assert "substr" not in catalogue.ORACLES[name], name
