"""A sample that is over its time goes no further, and samples do not see each other's settings."""

from __future__ import annotations

import threading
import time

import pytest

from helixframe.plans import pipeline

KEY = "spark.sql.shuffle.partitions"


def stage_of(work):  # noqa: ANN001, ANN201
    class Work(pipeline.Stage):
        name = "work"

        def execute(self, spark) -> None:  # noqa: ANN001
            work(spark)

    return Work()


def test_no_job_or_stage_begins_after_the_limit(spark):
    done, jobs = [], []
    ended = threading.Event()

    def slow(session) -> None:  # noqa: ANN001
        try:
            for _ in range(200):
                jobs.append(time.time())
                time.sleep(0.05)
                session.range(10).selectExpr("sum(id)").collect()
        finally:
            ended.set()

    m = pipeline.MultiSample("m", lambda s, text: [("slow", 1), ("fast", 2)], lambda x: pipeline.Pipeline("p", [stage_of(slow), stage_of(lambda s: done.append(x))] if x == 1 else [stage_of(lambda s: done.append(s.range(5).count()))]))
    m.init({"manifest": "x", "perSampleTimeout": "2s"})
    with pytest.raises(RuntimeError, match="slow"):
        m.execute(spark, concurrent=2)
    assert isinstance(m.failed["slow"], TimeoutError)
    stopped = time.time()
    assert ended.wait(20)  # the next job of that thread fails, so its loop ends
    assert len(jobs) < 200 and all(t < stopped + 1 for t in jobs)
    time.sleep(0.5)
    assert done == [5]  # the slow sample's second stage did not begin
    assert spark.range(7).count() == 7


def test_samples_have_settings_of_their_own(spark):
    gate, seen = threading.Barrier(2, timeout=60), {}

    def work(n: int):  # noqa: ANN202
        def run(session) -> None:  # noqa: ANN001
            session.conf.set(KEY, str(n))
            gate.wait()
            seen[n] = (session.conf.get(KEY), session.conf.get("helix.jointBinSize"))

        return run

    before = spark.conf.get(KEY)
    spark.conf.set("helix.jointBinSize", "77")
    try:
        m = pipeline.MultiSample("m", lambda s, text: [("a", 3), ("b", 5)], lambda n: pipeline.Pipeline("p", [stage_of(work(n))]))
        m.init({"manifest": "x"}).execute(spark, concurrent=2)
    finally:
        spark.conf.unset("helix.jointBinSize")
    assert seen == {3: ("3", "77"), 5: ("5", "77")} and spark.conf.get(KEY) == before
