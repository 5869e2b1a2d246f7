"""Stages and pipelines: parameter resolution, replay, chaining of outputs, many samples at a time."""

from __future__ import annotations

import gc
import json
import logging
import threading
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import InheritableThread
from pyspark.sql import SparkSession

from helixframe.plans.params import REPLAY, Param, Settings, seconds
from helixframe.session import own_session

log = logging.getLogger("helixframe")
REPLAY_MODE = Param("replayMode", "skip a stage whose output exists, or overwrite it", str, "skip")


class Stage:
    """A step. Subclasses name their params and outputs and implement execute and output_exists."""

    name = "stage"
    params: tuple[Param, ...] = ()
    outputs: tuple[str, ...] = ()

    def __init__(self, **values: Any) -> None:
        self.values: dict[str, Any] = {}
        for k, v in values.items():
            self.set(k, v)

    def all_params(self) -> tuple[Param, ...]:
        return (*self.params, REPLAY_MODE)

    def param(self, name: str) -> Param:
        return next(p for p in self.all_params() if p.name == name)

    def set(self, name: str, value: Any) -> None:
        self.values[name] = self.param(name).coerce(value)

    def get(self, name: str) -> Any:
        p = self.param(name)
        if name in self.values and self.values[name] is not None:
            return self.values[name]
        if p.required:
            raise ValueError(f"parameter {name} is not set")
        return p.default

    def init(self) -> None: ...

    def execute(self, spark: SparkSession) -> None:
        raise NotImplementedError

    def output_exists(self, spark: SparkSession) -> bool:
        return False

    def output_values(self) -> dict[str, Any]:
        found = {k: self.values.get(k, self.param(k).default if any(p.name == k for p in self.all_params()) else None) for k in self.outputs}
        for k, v in found.items():
            if v is None:
                raise ValueError(f"stage {self.name} did not define its output {k}")
        return found

    def cleanup(self, spark: SparkSession) -> None:
        spark.catalog.clearCache()


class Pipeline:
    def __init__(self, name: str, stages: Iterable[Stage]) -> None:
        self.name, self.stages, self.given = name, list(stages), {}

    def init(self, params: dict[str, Any]) -> Pipeline:
        known = {p.name for s in self.stages for p in s.all_params()}
        if unknown := sorted(set(params) - known):
            raise ValueError(f"The following parameters are unrecognized: {', '.join(unknown)}.")
        self.given = dict(params)
        return self

    def visible_params(self) -> list[dict[str, Any]]:
        """One entry a name, by name; a parameter is required if it has no default."""
        found: dict[str, Param] = {}
        for s in self.stages:
            for p in s.all_params():
                if p.visible:
                    found.setdefault(p.name, p)
        return [{"name": n, "description": p.doc, "type": p.kind.__name__, "default": None if p.default is None else str(p.default), "required": p.required} for n, p in sorted(found.items())]

    def execute(self, spark: SparkSession, stop: threading.Event | None = None) -> None:
        """Run the stages in order. Once `stop` is set, no further stage begins."""
        produced: dict[str, Any] = {}
        for stage in self.stages:
            if stop is not None and stop.is_set():
                raise InterruptedError(f"{self.name} was stopped before {stage.name}")
            values = {**self.given, **produced}  # what earlier stages produced counts over what was given
            for p in stage.all_params():
                if p.name in values:
                    stage.set(p.name, values[p.name])
            self.run_stage(stage, spark)
            produced.update(stage.output_values())

    def run_stage(self, stage: Stage, spark: SparkSession) -> None:
        mode = stage.get("replayMode").lower()
        if mode not in REPLAY:
            raise ValueError(f"unknown replay mode {mode!r}; known: {', '.join(REPLAY)}")
        stage.init()
        try:
            if mode == "skip" and stage.output_exists(spark):
                log.info("skipping %s: its output exists", stage.name)
            else:
                began = time.time()
                stage.execute(spark)
                log.info("%s took %.1f s", stage.name, time.time() - began)
        finally:
            stage.cleanup(spark)


def stages_of(align: bool, call: bool, make_align: Callable[[], Stage], make_call: Callable[[], Stage]) -> list[Stage]:
    """The stages that a mask selects; at least one."""
    if not (align or call):
        raise ValueError("at least one stage must be selected")
    return [*([make_align()] if align else []), *([make_call()] if call else [])]


class MultiSample:
    """Runs a delegate pipeline per sample on a bounded pool, each with a time limit. All samples are tried; one error
    at the end tells those that failed."""

    def __init__(self, name: str, samples: Callable[[SparkSession, str], list[tuple[str, Any]]], delegate: Callable[[Any], Pipeline]) -> None:
        self.name, self.samples, self.delegate = name, samples, delegate
        self.manifest = Param("manifest", "path or text of the sample sheet")
        self.timeout = Param("perSampleTimeout", "time limit of a sample, with unit", str, "12h")
        self.own: dict[str, Any] = {}
        self.given: dict[str, Any] = {}
        self.failed: dict[str, BaseException] = {}

    def init(self, params: dict[str, Any]) -> MultiSample:
        self.own = {p.name: p.coerce(params.get(p.name, p.default)) for p in (self.manifest, self.timeout)}
        if not self.own["manifest"]:
            raise ValueError("parameter manifest is not set")
        self.own["seconds"] = seconds(self.own["perSampleTimeout"])
        self.given = {k: v for k, v in params.items() if k not in self.own}
        return self

    def run_sample(self, spark: SparkSession, sample: str, info: Any) -> None:
        group, problem = f"{self.name}-{sample}-{uuid.uuid4().hex[:8]}", []

        stop = threading.Event()

        def work() -> None:
            try:
                spark.sparkContext.setJobGroup(group, f"{self.name}: {sample}", interruptOnCancel=True)
                gc.collect()
                # a session of its own: settings that a stage changes are not seen by other samples
                self.delegate(info).init(self.given).execute(own_session(spark), stop)
            except BaseException as e:  # noqa: BLE001  told to the waiting thread
                problem.append(e)

        t = InheritableThread(target=work, daemon=True)
        t.start()
        t.join(self.own["seconds"])
        if t.is_alive():
            # the sample's thread cannot be killed, but it gets no further: no stage begins, and no job of its stage runs or begins
            stop.set()
            spark.sparkContext._jsc.sc().cancelJobGroupAndFutureJobs(group)
            raise TimeoutError(f"{sample}: over its limit of {self.own['perSampleTimeout']}")
        if problem:
            raise problem[0]

    def execute(self, spark: SparkSession, concurrent: int | None = None) -> None:
        """`concurrent` samples at a time, as the session's settings say by default."""
        concurrent = concurrent or Settings.of(spark).concurrentSamples
        todo = self.samples(spark, self.own["manifest"])
        self.failed = {}
        lock = threading.Lock()

        def one(item: tuple[str, Any]) -> None:
            try:
                self.run_sample(spark, *item)
            except BaseException as e:  # noqa: BLE001  the others go on
                log.warning("sample %s failed: %s", item[0], e)
                with lock:
                    self.failed[item[0]] = e

        with ThreadPoolExecutor(max(1, concurrent)) as pool:
            list(pool.map(one, todo))
        if self.failed:
            raise RuntimeError(f"failed samples: {', '.join(sorted(self.failed))}") from next(iter(self.failed.values()))


@dataclass(frozen=True)
class Step:
    """One entry of a data set's provenance."""

    id: str
    program: str
    version: str
    command: str
    previous_id: str | None = None


def extend(chain: list[Step], program: str, version: str, command: str) -> list[Step]:
    """The chain with a further step that names the last one as its predecessor."""
    return [*chain, Step(f"{program}-{len(chain)}", program, version, command, chain[-1].id if chain else None)]


def save_chain(spark: SparkSession, chain: list[Step], path: str) -> None:
    spark.createDataFrame([(k, json.dumps(s.__dict__)) for k, s in enumerate(chain)], "ordinal int, step string").coalesce(1).write.mode("overwrite").parquet(f"{path}.provenance")


def load_chain(spark: SparkSession, path: str) -> list[Step]:
    return [Step(**json.loads(r.step)) for r in spark.read.parquet(f"{path}.provenance").orderBy("ordinal").collect()]
