"""Pluggable kernels: running external programs over reads, batching by bases, and a simple caller for tests and examples.

Alignment, local assembly and somatic models are programs of their own; an adapter turns rows into their input and their
output back into rows, a partition at a time.
"""

from __future__ import annotations

import subprocess
import threading
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame


def base_batches(rows: Iterator[tuple], length: int, most: int) -> Iterator[list[tuple]]:
    """Batches that end once they have `most` bases; `length` is the column of the bases."""
    batch, bases = [], 0
    for r in rows:
        batch.append(r)
        bases += len(r[length] or "")
        if bases >= most:
            yield batch
            batch, bases = [], 0
    if batch:
        yield batch


def batched(raw: DataFrame, kernel: Callable[[list[dict]], list[dict]], schema: str, most: int, bases: str = "sequence") -> DataFrame:
    """Rows that `kernel` makes of batches of reads, each ended once it has `most` bases. The kernel gets and gives rows as
    dictionaries; a batch is all that a task holds."""
    target = raw.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, names = to_arrow_schema(target), raw.columns
    at = names.index(bases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (tuple(r) for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for batch in base_batches(rows, at, most):
            out = kernel([dict(zip(names, r, strict=True)) for r in batch])
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return raw.mapInArrow(run, target)


def piped(raw: DataFrame, command: list[str]) -> DataFrame:
    """SAM lines from an aligner that reads interleaved FASTQ on its input: one process a partition, fed by a thread, so
    neither side is held as a whole. A process that fails fails the task."""
    ordered = raw.select("readName", "readInFragment", "sequence", "qualityScores")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = subprocess.Popen(command, stdin=subprocess.PIPE, stdout=subprocess.PIPE, text=True)
        problem: list[BaseException] = []

        def feed() -> None:
            try:
                for b in batches:
                    for name, _, bases, quality in zip(*(c.to_pylist() for c in b.columns), strict=True):
                        seq = bases.decode() if isinstance(bases, bytes) else bases
                        p.stdin.write(f"@{name}\n{seq}\n+\n{quality}\n")
                p.stdin.close()
            except BaseException as e:  # noqa: BLE001  told below
                problem.append(e)
                p.kill()

        t = threading.Thread(target=feed, daemon=True)
        t.start()
        lines: list[str] = []
        for line in p.stdout:
            if not line.startswith("@"):
                lines.append(line.rstrip("\n"))
            if len(lines) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
                lines = []
        t.join()
        if problem or p.wait():
            raise RuntimeError(f"{command[0]} failed with {p.returncode}") from (problem[0] if problem else None)
        if lines:
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])

    return ordered.mapInArrow(run, "value string")


PILEUP = "contigName string, start long, end long, referenceAllele string, alternateAlleles array<string>, depth int, qual double"


def pileup_caller(reference: dict[str, str], least_depth: int = 4, least_share: float = 0.2):  # noqa: ANN201
    """A caller that counts bases of ungapped reads against a reference: sites where another base has the share."""

    def call(contig: str, lo: int, hi: int, reads: pd.DataFrame) -> pd.DataFrame:
        seen: dict[int, dict[str, int]] = {}
        for start, bases in zip(reads["start"], reads["sequence"], strict=True):
            for k, b in enumerate(bases):
                at = int(start) + k
                seen.setdefault(at, {}).setdefault(b, 0)
                seen[at][b] += 1
        rows = []
        for at, counts in sorted(seen.items()):
            depth, ref = sum(counts.values()), reference[contig][at]
            alts = sorted(b for b, n in counts.items() if b != ref and n >= least_share * depth)
            if depth >= least_depth and alts:
                rows.append((contig, at, at + 1, ref, alts, depth, 10.0 * sum(counts[b] for b in alts)))
        return pd.DataFrame(rows, columns=[c.strip().split(" ")[0] for c in PILEUP.split(",")])

    return call
