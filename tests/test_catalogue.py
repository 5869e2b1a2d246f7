"""Every catalogue query against its SQL on small driver tables, where they are there."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from helixframe.plans import catalogue

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(DATA):
        pytest.skip("no driver tables here")
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.sql(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")
    return c


def plain(v):  # noqa: ANN001, ANN202
    return None if v is None or isinstance(v, float) and math.isnan(v) else v


def rows(names: list[str], columns: list[str], data) -> list[str]:  # noqa: ANN001
    at = [columns.index(n) for n in names]
    return sorted(repr(tuple(plain(r[k]) for k in at)) for r in data)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_against_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA)
    want = duck.sql(catalogue.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    names = sorted(got.columns)
    assert rows(names, got.columns, got.collect()) == rows(names, want.columns, want.fetchall())


def test_region_filter_reaches_the_scan(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no driver tables here")
    rows_ = spark.read.parquet(f"{DATA}/lineitem.parquet").selectExpr("l_returnflag as contigName", "l_orderkey as start", "l_partkey as `end`")
    from helixframe.operators.intervals import region_filter

    plan = region_filter(rows_, [("R", 1, 5), ("N", 3, 9)])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "LessThan(l_orderkey,5)" in plan


def test_differences_of_reads_are_one_count(spark):
    """Rows are scanned and shuffled once for both sides, as one number a row."""
    if not os.path.isdir(DATA):
        pytest.skip("no driver tables here")
    plan = catalogue.QUERIES["diff_reads"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1 and plan.count("Aggregate") == 1
