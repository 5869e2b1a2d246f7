"""The two jobs: reruns, growing input, failures in between, settings and command lines."""

from __future__ import annotations

import json
import logging
import math
import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import jobs
from jobs import expression, landing
from jobs.common import configured

DATA = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent.parent
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables here")


def rows(df, names: list[str] | None = None) -> list[str]:  # noqa: ANN001
    names = names or sorted(df.columns)
    plain = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted(repr(tuple(plain(r[n]) for n in names)) for r in df.collect())


@needs_data
@pytest.mark.parametrize("name", sorted(jobs.QUERIES))
def test_against_sql(spark, name):
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.sql(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")
    got, want = jobs.QUERIES[name](spark, DATA), c.sql(jobs.ORACLES[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    at = [want.columns.index(n) for n in names]
    assert rows(got, names) == sorted(repr(tuple(r[k] for k in at)) for r in want.fetchall())


# ---- expression


def tables(spark, folder: str, lines: list[tuple], orders: list[tuple]) -> str:
    """lines: (order, part, supplier, line number, quantity)."""
    write = lambda data, schema, name: spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    write(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double", "lineitem")
    write(orders, "o_orderkey long, o_custkey long", "orders")
    write([(1, 10), (2, 20), (6, 10), (7, None), (None, 10)], "s_suppkey long, s_nationkey long", "supplier")
    write([(10, "PERU"), (20, "Chad"), (30, None)], "n_nationkey long, n_name string", "nation")
    return folder


def brute(lines: list[tuple], orders: list[tuple], least: int = 20) -> dict[tuple, int]:
    owner = {1: "peru", 2: "chad", 6: "peru"}
    out: Counter = Counter()
    for order, part, supplier, number, quantity in lines:
        if supplier not in owner:
            continue
        good = part % 61 >= least and part % 11 and number not in (5, 7) and part % 17
        out[owner[supplier], "__reads"] += 1
        out[owner[supplier], "__kept"] += bool(good)
        out[owner[supplier], "__pairs"] += 0
        start, end = order * 10, order * 10 + math.floor(quantity)
        for k, customer in set(orders):
            hits = sum(start < k * 10 + 15 * e + 12 and end > k * 10 + 15 * e for e in (0, 1))
            if good and customer % 5 == supplier % 5 and hits:
                out[owner[supplier], f"t{k}"] += hits
                out[owner[supplier], "__pairs"] += hits
    return dict(out)


LINES = [(k % 9, 20 + k, [1, 2, 6, 7, None, 3][k % 6], k % 8, float(k % 40)) for k in range(200)]
ORDERS = [(k, 1 + k % 2) for k in range(12)] + [(3, 2)]


def counted(df) -> dict[tuple, int]:  # noqa: ANN001
    got = df.collect()
    assert len({(r["sample"], r["transcriptId"]) for r in got}) == len(got)
    return {(r["sample"], r["transcriptId"]): r["count"] for r in got}


def test_expression_is_right_and_reruns(spark, tmp_path, caplog):
    d, out = tables(spark, str(tmp_path / "in"), LINES, ORDERS), str(tmp_path / "out")
    with caplog.at_level(logging.INFO, "jobs"):
        expression.run(spark, d, out)
    assert any("read 133 reads of 2 samples" in m or "reads of 2 samples" in m for m in caplog.messages) and any("wrote" in m for m in caplog.messages)
    first = rows(expression.result(spark, out))
    assert counted(expression.result(spark, out)) == brute(LINES, ORDERS)
    kept = counted(expression.result(spark, out))
    for r in expression.result(spark, out).where("referenceName is not null").collect():
        assert r["per_million"] == r["count"] * 1e6 / kept[r["sample"], "__kept"]
    expression.run(spark, d, out)
    assert rows(expression.result(spark, out)) == first
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_an_order_on_two_contigs_is_counted_on_each(spark, tmp_path):
    d, out = tables(spark, str(tmp_path / "in"), [(3, 20, 1, 1, 9.0), (3, 20, 6, 1, 9.0), (3, 20, 2, 1, 9.0)], [(3, 1), (3, 2)]), str(tmp_path / "out")
    expression.run(spark, d, out)
    got = expression.result(spark, out).where("referenceName is not null").collect()
    assert sorted((r["sample"], r["transcriptId"], r["referenceName"], r["start_pos"], r["end_pos"], r["count"]) for r in got) == [("chad", "t3", "chr2", 30, 57, 1), ("peru", "t3", "chr1", 30, 57, 2)]


def test_reads_are_not_shuffled_for_their_samples(spark, tmp_path, monkeypatch):
    d = tables(spark, str(tmp_path / "in"), LINES, ORDERS)
    read = lambda name: spark.read.parquet(f"{d}/{name}.parquet")
    reads = lambda: expression.reads_of(read("lineitem"), read("supplier"), read("nation"), [])
    plan = lambda: reads()._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "BroadcastHashJoin [l_suppkey" in plan()
        n = reads().count()
        monkeypatch.setattr(expression, "OWNERS_SENT", 2)
        assert "SortMergeJoin [l_suppkey" in plan() and reads().count() == n == sum(k for (_, t), k in brute(LINES, ORDERS).items() if t == "__reads")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_expression_of_some_samples_leaves_the_others(spark, tmp_path):
    d, out = tables(spark, str(tmp_path / "in"), LINES, ORDERS), str(tmp_path / "out")
    expression.run(spark, d, out)
    before = counted(expression.result(spark, out))
    bad = [(*x[:1], 11, *x[2:]) for x in LINES]  # no read of any sample is mapped now
    d = tables(spark, str(tmp_path / "in2"), bad, ORDERS)
    expression.run(spark, d, out, {"samples": ["chad"]})
    after = counted(expression.result(spark, out))
    assert {k: n for k, n in after.items() if k[0] == "peru"} == {k: n for k, n in before.items() if k[0] == "peru"}
    assert {k: n for k, n in after.items() if k[0] == "chad"} == {("chad", "__reads"): before["chad", "__reads"], ("chad", "__kept"): 0, ("chad", "__pairs"): 0}


def test_expression_of_empty_tables(spark, tmp_path):
    d, out = tables(spark, str(tmp_path / "in"), [], []), str(tmp_path / "out")
    expression.run(spark, d, out)
    assert expression.result(spark, out).isEmpty() if os.path.isdir(out) else True


# ---- landing


def reads_file(spark, folder: Path, data: list[tuple]) -> None:
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.mode("append").parquet(str(folder))


FIRST = [(1, "IIII", "en", "a"), (2, "!!", "en", "a"), (3, None, None, None), (None, "", "", "b"), (3, "~" * 50, "de", "a")]
SECOND = [(4, "I I\nü", "en", "a"), (1, "IIII", "en", "a"), (5, "5" * 3000, "fr", "c")]


def wanted(data: list[tuple], bins: str = configured("landing")["quality_bins"]) -> list[tuple]:
    base = {q: b for low, high, b in (map(int, x.split(",")) for x in bins.split(";")) for q in range(low, high)}
    out = []
    for doc, text, lang, source in data:
        q = [ord(c) - 33 if "!" <= c <= "~" else 0 for c in text or ""]
        score = sum(x for x in q if x >= 15)
        out.append((doc, lang, source, len(q), score, score >= 1000, "".join(chr(33 + base[x]) for x in q)))
    return sorted(out, key=repr)


def landed(spark, out: str) -> list[tuple]:
    names = ["doc_id", "lang", "source", "bases", "score", "passed", "qualities"]
    return sorted((tuple(r[n] for n in names) for r in landing.reads(spark, out).collect()), key=repr)


def totals_are_right(spark, out: str, data: list[tuple]) -> None:
    want: dict[tuple, list[int]] = {}
    for _, lang, source, bases, score, passed, _ in wanted(data):
        t = want.setdefault((lang, source), [0, 0, 0, 0])
        for k, v in enumerate((1, bases, score, not passed)):
            t[k] += v
    got = {(r["lang"], r["source"]): [r["group_reads"], r["group_bases"], r["group_score"], r["group_failed"]] for r in landing.totals(spark, out).collect()}
    assert got == want


def with_counts(data: list[tuple]) -> list[tuple]:
    return [(*x, 7) for x in data]


def test_landing_takes_only_what_is_new(spark, tmp_path, caplog):
    folder, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    reads_file(spark, folder, with_counts(FIRST))
    with caplog.at_level(logging.INFO, "jobs"):
        assert landing.run(spark, str(folder), out, mark) == 1
        assert landed(spark, out) == wanted(FIRST)
        assert landing.run(spark, str(folder), out, mark) == 0
        assert landed(spark, out) == wanted(FIRST)
        reads_file(spark, folder, with_counts(SECOND))
        written = {p: p.stat().st_mtime_ns for p in Path(out).rglob("*.parquet")}
        assert landing.run(spark, str(folder), out, mark) == 1
    assert all(p.stat().st_mtime_ns == t for p, t in written.items())  # what was there is as it was
    assert landed(spark, out) == wanted(FIRST + SECOND)
    totals_are_right(spark, out, FIRST + SECOND)
    assert [m for m in caplog.messages if m.startswith("read ")] == [f"read {n} rows in {b} batches from {folder}" for n, b in ((5, 1), (0, 0), (3, 1))]


def test_landing_after_a_failure(spark, tmp_path, monkeypatch):
    """A batch that fails after its reads were written is taken again, once."""
    folder, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    reads_file(spark, folder, with_counts(FIRST))
    take = landing.take

    def half(batch, number, output, c):  # noqa: ANN001, ANN202
        take(batch, number, output, c)
        raise RuntimeError("lost")

    monkeypatch.setattr(landing, "take", half)
    with pytest.raises(Exception, match="lost"):
        landing.run(spark, str(folder), out, mark)
    monkeypatch.setattr(landing, "take", take)
    reads_file(spark, folder, with_counts(SECOND))
    assert landing.run(spark, str(folder), out, mark) == 2
    assert landed(spark, out) == wanted(FIRST + SECOND)
    totals_are_right(spark, out, FIRST + SECOND)


def test_landing_in_many_batches_and_of_one_file(spark, tmp_path):
    folder, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    for x in FIRST:
        reads_file(spark, folder, with_counts([x]))
    assert landing.run(spark, str(folder), out, mark, {"files_per_batch": 2}) == 3
    assert landed(spark, out) == wanted(FIRST)
    one = next(folder.glob("*.parquet"))
    assert landing.run(spark, str(one), str(tmp_path / "out2"), str(tmp_path / "mark2")) == 1


def test_settings():
    assert configured("landing", known={"least_score": 5})["least_score"] == 5
    for name, bad in (("landing", {"least": 1}), ("landing", {"least_score": "5"}), ("expression", {"samples": "peru"})):
        with pytest.raises(ValueError):
            configured(name, known=bad)


@needs_data
def test_command_lines(tmp_path):
    settings = tmp_path / "settings.json"
    settings.write_text(json.dumps({"least_score": 1}))
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] pyspark-shell"}
    run = lambda *a: subprocess.run([sys.executable, *map(str, a)], capture_output=True, text=True, env=env, timeout=300)
    got = run(ROOT / "jobs/landing.py", "--input", f"{DATA}/documents.parquet", "--output", tmp_path / "out", "--checkpoint", tmp_path / "mark", "--config", settings)
    assert got.returncode == 0, got.stderr[-2000:]
    assert "read 200 rows in 1 batches" in got.stderr
    got = run(ROOT / "jobs/expression.py", "--tables", DATA, "--output", tmp_path / "matrix")
    assert got.returncode == 0, got.stderr[-2000:]
    assert "samples" in got.stderr and "wrote" in got.stderr


def test_jobs_import_nothing_of_the_training_data_part():
    for p in [*(ROOT / "jobs").glob("*.py"), *(ROOT / "tests/jobs").glob("*.py")]:
        lines = [x for x in p.read_text().splitlines() if x.lstrip().startswith(("import ", "from "))]
        assert not [x for x in lines if "llm" in x or "corpus_pipeline" in x], p
