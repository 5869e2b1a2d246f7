"""Joint genotyping of gVCF rows, a bin at a time.

Rows of a (contig, bin) are read in order of start. Each sample keeps the rows of its latest start while they reach the
locus: a heap of ends tells which samples to forget, and a set which have an alternate allele, so a locus that no alternate
reaches costs nothing, and others what reaches them, however many samples there are. At the end of a locus what reaches it is merged: the longest reference is the locus's, shorter ones are extended by its tail, a row
that begins before the locus and deletes it gives '*'. Genotype likelihoods are carried over by allele, the general
<NON_REF> allele standing in for what a sample has not seen. Allele frequencies come from expectation-maximisation over
the likelihoods under Hardy-Weinberg proportions, the site's quality from the posterior that all samples are reference.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from helixframe.operators import annotations
from helixframe.operators.variants import NON_REF, SPANNING, bin_variants

CALLED = "contigName string, start bigint, end bigint, referenceAllele string, alternateAlleles array<string>, qual double, " + annotations.COLUMNS + ", genotypes array<struct<sampleId:string,calls:array<int>,phredLikelihoods:array<int>,depth:int,conditionalQuality:int>>"
SYMBOLS = (NON_REF, "<*>")


def place(a: int, b: int) -> int:
    """Index of genotype a/b, a <= b, among diploid genotypes."""
    return b * (b + 1) // 2 + a


def diploid(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The lower and the higher allele of each diploid genotype of n alleles, in order."""
    b = np.repeat(np.arange(n), np.arange(1, n + 1))
    return np.arange(len(b)) - b * (b + 1) // 2, b


def extended(row: dict, reference: str) -> list[str]:
    """A row's alternates against a longer reference."""
    tail = reference[len(row["ref"]) :]
    return [a if a.startswith("<") or a == SPANNING else a + tail for a in row["alts"]]


def alleles_at(row: dict, start: int, reference: str) -> list[str]:
    """The row's alleles, its reference first, as alleles of the locus."""
    if row["start"] < start:
        return [reference, *(a if a in SYMBOLS else SPANNING if len(a) < len(row["ref"]) or a == SPANNING else reference for a in row["alts"])]
    return [reference, *extended(row, reference)]


def is_real(allele: str) -> bool:
    return not allele.startswith("<") and allele not in (SPANNING, ".")


def merged_likelihoods(rows: list[dict], start: int, reference: str, alleles: list[str]) -> np.ndarray | None:
    """Phred likelihoods of a sample over the locus's alleles; rows of one sample are added. None: nothing is known."""
    total = None
    for row in rows:
        own = alleles_at(row, start, reference)
        pls = row["pls"]
        if pls is None or len(pls) < len(own) * (len(own) + 1) // 2:
            continue
        index = {}
        for k, a in enumerate(own):
            index.setdefault(a, k)
        other = next((k for k, a in enumerate(own) if a in SYMBOLS), None)
        found = [index.get(a, other) for a in alleles]
        at = np.array([-1 if k is None else k for k in found])
        a, b = diploid(len(alleles))
        x, y = np.minimum(at[a], at[b]), np.maximum(at[a], at[b])
        known = np.asarray(pls, float)
        out = np.where(x < 0, known.max(), known[np.where(x < 0, 0, y * (y + 1) // 2 + x)])
        total = out if total is None else total + out
    return None if total is None else total - total.min()


def frequencies(likelihoods: list[np.ndarray], n: int, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Allele frequencies by expectation-maximisation, and the genotype prior they give."""
    f = np.full(n, 0.1 / max(n - 1, 1))
    f[0] = 0.9 if n > 1 else 1.0
    a, b = diploid(n)
    ways = np.where(a == b, 1, 2)
    copies = (a[:, None] == np.arange(n)).astype(float) + (b[:, None] == np.arange(n))
    rows = np.array(likelihoods)
    for _ in range(rounds):
        prior = f[a] * f[b] * ways
        p = rows * prior
        total = p.sum(1, keepdims=True)
        p = np.where(total > 0, p / np.where(total > 0, total, 1), prior)
        counts = 1e-3 + p.sum(0) @ copies
        new = counts / counts.sum()
        if np.abs(new - f).max() < 1e-6:
            break
        f = new
    return f, f[a] * f[b] * ways


def call_locus(contig: str, start: int, state: dict[str, list[dict]], samples: list[str], most_alts: int = 49, least_quality: float = 10.0) -> dict | None:
    """The site's row, or None: no real alternate allele reaches it, there are too many, or no sample is called variant."""
    relevant = {s: [r for r in state[s] if r["end"] > start] for s in sorted(state)}  # alternates in the order of samples
    here = [r for rows in relevant.values() for r in rows]
    if not any(is_real(a) for r in here for a in r["alts"]):
        return None
    starting = [r for r in here if r["start"] == start]
    if not starting:
        return None
    reference = max((r["ref"] for r in starting), key=len)
    alts: list[str] = []
    for r in here:
        alts += [a for a in alleles_at(r, start, reference)[1:] if a not in alts and a != reference and (is_real(a) or a == SPANNING)]
    if len(alts) > most_alts or not any(map(is_real, alts)):
        return None
    alleles = [reference, *alts]
    pls = {s: merged_likelihoods(rows, start, reference, alleles) for s, rows in relevant.items() if rows}
    known = {s: 10 ** (-p / 10) for s, p in pls.items() if p is not None}
    if not known:
        return None
    f, prior = frequencies(list(known.values()), len(alleles))
    log_null = sum(math.log10(max(g[0], 1e-300)) for g in known.values())
    log_alt = sum(math.log10(max(float((g * prior).sum()), 1e-300)) for g in known.values())
    top = max(log_null, log_alt)
    qual = -10 * (log_null - top - math.log10(10 ** (log_null - top) + 10 ** (log_alt - top)))
    if qual < least_quality:
        return None
    pairs = [(a, b) for b in range(len(alleles)) for a in range(b + 1)]
    weighed = np.array(list(known.values())) * prior
    p = weighed / np.maximum(weighed.sum(1, keepdims=True), 1e-300)
    without = np.array([[k not in ab for k in range(len(alleles))] for ab in pairs], float)
    absent = np.log10(np.maximum(p @ without, 1e-300)).sum(0)
    # an alternate stays if it is unlikely that no sample has it
    likely = {k for k in range(1, len(alleles)) if -10 * absent[k] >= least_quality} | {0}
    allowed = np.array([a in likely and b in likely for a, b in pairs])
    genotypes, used = {}, set()
    for s, g in known.items():
        genotypes[s] = pairs[int(np.argmax(np.where(allowed, g, -1.0)))]
        used |= set(genotypes[s])
    keep = [0, *(k for k in range(1, len(alleles)) if k in used)]
    if not any(is_real(alleles[k]) for k in keep[1:]):
        return None
    # alleles common to all at the end are cut: the shortest form of the site
    named = [alleles[k] for k in keep]
    while min(len(a) for a in named if a != SPANNING) > 1 and len({a[-1] for a in named if a != SPANNING}) == 1:
        named = [a if a == SPANNING else a[:-1] for a in named]
    renumber = {k: i for i, k in enumerate(keep)}
    rows = []
    for s in samples:
        if s not in genotypes:
            rows.append({"sampleId": s, "calls": [-1, -1], "phredLikelihoods": None, "depth": None, "conditionalQuality": None})
            continue
        out = [int(round(pls[s][place(keep[a], keep[b])])) for b in range(len(keep)) for a in range(b + 1)]
        low = min(out)
        out = [x - low for x in out]
        gq = sorted(out)[1] if len(out) > 1 else 99
        depth = next((r["depth"] for r in relevant[s] if r["depth"] is not None), None)
        rows.append({"sampleId": s, "calls": [renumber[x] for x in genotypes[s]], "phredLikelihoods": out, "depth": depth, "conditionalQuality": min(99, gq)})
    # reads of the samples that have a row with an alternate here; blocks of reference keep none
    raw = annotations.combined(r["raw"] for r in starting if r.get("raw") and any(map(is_real, r["alts"])))
    told = dict(zip([f"INFO_{n}" for n in (*annotations.RAW, *annotations.VALUES)], annotations.columns_of(raw), strict=True))
    return {"contigName": contig, "start": start, "end": start + len(named[0]), "referenceAllele": named[0], "alternateAlleles": named[1:], "qual": float(qual), **told, "genotypes": rows}


class Active:
    """The rows of each sample's latest start, as long as one of them reaches the locus."""

    def __init__(self) -> None:
        self.rows: dict[str, list[dict]] = {}
        self.real: set[str] = set()  # samples with an alternate allele
        self.ends: list[tuple[int, str]] = []  # when to look at a sample again

    def add(self, r: dict) -> None:
        s = r["sample"]
        held = self.rows.get(s)
        if held and held[0]["start"] == r["start"]:
            held.append(r)
        else:
            self.rows[s] = [r]
            self.real.discard(s)
        if any(map(is_real, r["alts"])):
            self.real.add(s)
        heapq.heappush(self.ends, (r["end"], s))

    def upto(self, start: int) -> None:
        """Forget samples of which no row reaches `start`."""
        while self.ends and self.ends[0][0] <= start:
            _, s = heapq.heappop(self.ends)
            if s in self.rows and all(r["end"] <= start for r in self.rows[s]):
                del self.rows[s]
                self.real.discard(s)


def call_bin(rows: Iterator[dict], samples: list[str], **options: float) -> Iterator[dict]:
    """Calls of one (contig, bin)'s rows in order of start. Loci that an earlier bin has (duplicates) feed the state alone."""
    known = set(samples)
    active = Active()
    locus: tuple[str, int, bool] | None = None

    def done() -> dict | None:
        if locus is None:
            return None
        active.upto(locus[1])
        return None if locus[2] or not active.real else call_locus(locus[0], locus[1], active.rows, samples, **options)

    for r in rows:
        if r["sample"] not in known:
            raise ValueError(f"the header does not contain samples provided in manifest: {r['sample']}")
        if locus is None or r["start"] != locus[1]:
            if out := done():
                yield out
            locus = (r["contig"], r["start"], bool(r["duplicate"]))
        active.add(r)
    if out := done():
        yield out


def genotype(variants: DataFrame, samples: list[str], size: int = 5000, partitions: int | None = None, most_alts: int = 49) -> DataFrame:
    """Joint calls of single-sample gVCF rows. Bins are sorted in their partitions and streamed; a task holds one row a
    sample, not a bin."""
    fields = variants.schema["genotypes"].dataType.elementType.fieldNames()
    g = F.get("genotypes", F.lit(0))
    depth = g["depth"] if "depth" in fields else F.lit(None)
    flat = bin_variants(variants, size, partitions).select("contigName", "binId", "isDuplicate", "start", "end", "referenceAllele", "alternateAlleles", "sampleId", g["phredLikelihoods"].cast("array<int>").alias("pls"), depth.cast("int").alias("depth"), *((F.col(f"INFO_{n}") if f"INFO_{n}" in variants.columns else F.lit(None)).cast("array<int>").alias(n) for n in annotations.RAW))
    names = ("contig", "bin", "duplicate", "start", "end", "ref", "alts", "sample", "pls", "depth", *annotations.RAW)
    target = variants.sparkSession.createDataFrame([], CALLED).schema
    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (dict(zip(names, r, strict=True)) for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        rows = ({**r, "raw": {n: r[n] for n in annotations.RAW}} for r in rows)
        for _, own in groupby(rows, key=lambda r: (r["contig"], r["bin"])):
            calls = call_bin(own, samples, most_alts=most_alts)
            while held := list(islice(calls, 256)):
                yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return flat.mapInArrow(run, target)
