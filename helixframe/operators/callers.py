"""Callers of one shard: diploid germline calls with reference confidence, and somatic calls of a tumour against a normal.

Both look at columns of aligned bases and at the insertions and deletions of CIGAR; there is no local assembly. Reference
bases come from the reads' MD, so no genome is needed. A shard is a pandas frame of reads (start, cigar, sequence,
qualityScores, mappingQuality, mismatchingPositions, readGroupSampleId), as `assembly.call_shards` hands them over.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable

import pandas as pd

from helixframe.operators import annotations
from helixframe.operators.assembly import column_names
from helixframe.operators.reads import reference_of
from helixframe.operators.variants import NON_REF

GENOTYPE = "struct<sampleId:string,phased:boolean,calls:array<int>,depth:int,alleleDepths:array<int>,conditionalQuality:int,phredLikelihoods:array<int>>"
CALLS = f"contigName string, start bigint, end bigint, names array<string>, referenceAllele string, alternateAlleles array<string>, qual double, filters array<string>, INFO_DP int, {annotations.COLUMNS}, genotypes array<{GENOTYPE}>"
SOMATIC = "contigName string, start bigint, end bigint, names array<string>, referenceAllele string, alternateAlleles array<string>, qual double, filters array<string>, INFO_TLOD double, INFO_NLOD double, genotypes array<struct<sampleId:string,phased:boolean,calls:array<int>,depth:int,alleleDepths:array<int>>>"
#: The chance that an insertion or deletion in a read is an artefact.
GAP_ERROR = 10**-4.0

Seen = tuple[str, float, str | None]  # allele, its error, sample


def columns(reads: pd.DataFrame, lo: int, hi: int) -> tuple[dict[int, str], dict[int, list[Seen]], dict[int, list[tuple[str, str, str | None]]], dict[int, list[annotations.Note]]]:
    """Of places in [lo, hi): reference bases, observed bases, gaps (reference allele, alternate, sample) anchored at
    the base before them, and a note for each observed base. Reads without CIGAR, MD or qualities are left out."""
    notes: dict[int, list[annotations.Note]] = defaultdict(list)
    reference: dict[int, Counter] = defaultdict(Counter)
    bases: dict[int, list[Seen]] = defaultdict(list)
    gaps: dict[int, list[tuple[str, str, str | None]]] = defaultdict(list)
    samples, strands = (reads[c] if c in reads else [None] * len(reads) for c in ("readGroupSampleId", "readNegativeStrand"))
    for start, cigar, seq, quality, mapping, md, sample, reverse in zip(reads["start"], reads["cigar"], reads["sequence"], reads["qualityScores"], reads["mappingQuality"], reads["mismatchingPositions"], samples, strands, strict=True):
        if not (cigar and seq and quality and md) or len(seq) != len(quality):
            continue
        letters, sites = reference_of(seq, int(start), cigar, md)
        mapped = int(mapping) if mapping is not None and not pd.isna(mapping) else 60
        worst = 10 ** (-mapped / 10)
        for k, at in enumerate(sites):
            if at is not None and lo <= at < hi:
                reference[at][letters[k]] += 1
                bases[at].append((seq[k], max(10 ** (-(ord(quality[k]) - 33) / 10), worst, 1e-6), sample))
                notes[at].append((bool(reverse), ord(quality[k]) - 33, mapped, min(k, len(seq) - 1 - k)))
        gone = iter(re.findall(r"\^([A-Za-z]+)", md))
        on, at = 0, int(start)
        for n, kind in ((int(n), kind) for n, kind in re.findall("([0-9]+)([MIDNSHP=X])", cigar)):
            deleted = next(gone, "") if kind == "D" else ""
            if kind in "ID" and on and lo <= at - 1 < hi and letters[on - 1] != "-":
                anchor = letters[on - 1]
                gaps[at - 1].append((anchor, anchor + seq[on : on + n], sample) if kind == "I" else (anchor + deleted, anchor, sample))
            on += n * (kind in "MIS=X")
            at += n * (kind in "MDN=X")
    return {at: c.most_common(1)[0][0] for at, c in reference.items()}, bases, gaps, notes


def diploid(errors: list[tuple[bool, bool, float]]) -> list[float]:
    """log10 likelihoods of 0/0, 0/1 and 1/1 from (supports the reference, supports the alternate, error) of each read."""
    out = [0.0, 0.0, 0.0]
    for ref, alt, e in errors:
        a, b = 1 - e if ref else e / 3, 1 - e if alt else e / 3
        for k, p in enumerate((a, (a + b) / 2, b)):
            out[k] += math.log10(p)
    return out


def phred(ll: list[float]) -> list[int]:
    best = max(ll)
    return [int(round(min(-10 * (x - best), 32_000))) for x in ll]


def genotypes_of(seen: list[Seen], alleles: list[str]) -> list[float]:
    """log10 likelihoods of the diploid genotypes of `alleles`, in order; <NON_REF> is what no read supports."""
    chance = [[1 - e if b == a else e / 3 for a in alleles] for b, e, _ in seen]
    return [sum(math.log10((p[x] + p[y]) / 2) for p in chance) for y in range(len(alleles)) for x in range(y + 1)]


def with_other(ll: list[float], other: list[float]) -> list[float]:
    """Likelihoods of 0/0, 0/1, 1/1, 0/2, 1/2, 2/2 where allele 2 stands for anything unseen, which no read supports."""
    return [*ll, other[1], (ll[2] + other[2]) / 2, other[2]]


def variant_quality(ll: list[float], heterozygosity: float) -> float:
    """Phred-scaled probability that there is no variant."""
    prior = [1 - 1.5 * heterozygosity, heterozygosity, heterozygosity / 2]
    best = max(ll)
    p = [10 ** (x - best) * w for x, w in zip(ll, prior, strict=True)]
    return min(-10 * math.log10(max(p[0] / sum(p), 1e-300)), 3000.0)


def germline_caller(sample: str, least_quality: float = 10.0, heterozygosity: float = 1e-3, reference_confidence: bool = False) -> Callable[[str, int, int, pd.DataFrame], pd.DataFrame]:
    """A caller of CALLS rows. With `reference_confidence` every covered place has a row, and <NON_REF> stands last among
    the alternates, as gVCF banding and joint genotyping need it."""
    names = column_names(CALLS)

    def row(contig: str, at: int, ref: str, alts: list[str], ll: list[float], depth: int, counts: list[int], qual: float | None, raw: dict | None = None) -> tuple:
        pl = phred(ll)
        order = sorted(pl)
        place = pl.index(0)
        b = 0
        while (b + 1) * (b + 2) // 2 <= place:
            b += 1
        call = [place - b * (b + 1) // 2, b]
        g = {"sampleId": sample, "phased": False, "calls": call, "depth": depth, "alleleDepths": counts, "conditionalQuality": min(99, order[1]), "phredLikelihoods": pl}
        return (contig, at, at + len(ref), [], ref, alts, qual, [], depth, *annotations.columns_of(raw), [g])

    def call(contig: str, lo: int, hi: int, reads: pd.DataFrame) -> pd.DataFrame:
        reference, bases, gaps, notes = columns(reads, lo, hi)
        more = [NON_REF] if reference_confidence else []
        out = []
        for at in sorted(bases):
            ref, seen = reference[at], bases[at]
            counts = Counter(b for b, _, _ in seen)
            found = False
            alt = max((b for b in counts if b not in (ref, "N")), key=lambda b: (counts[b], b), default=None)
            if alt is not None:
                alts, ll = [alt], diploid([(b == ref, b == alt, e) for b, e, _ in seen])
                qual = variant_quality(ll, heterozygosity)
                if qual >= least_quality:
                    for b in sorted((b for b in counts if b not in (ref, alt, "N")), key=lambda b: (-counts[b], b)):
                        # a further alternate must explain the reads so much better that it is worth another variant
                        further = genotypes_of(seen, [ref, *alts, b])
                        if 10 * (max(further) - max(ll) + math.log10(heterozygosity)) >= least_quality:
                            alts, ll = [*alts, b], further
                    ll = genotypes_of(seen, [ref, *alts, *more])
                    raw = annotations.raw_of((b == ref, b in alts, x) for (b, _, _), x in zip(seen, notes[at], strict=True))
                    out.append(row(contig, at, ref, [*alts, *more], ll, len(seen), [counts[ref], *(counts[a] for a in alts), *([0] * len(more))], qual, raw))
                    found = True
            if own := Counter((r, a) for r, a, _ in gaps.get(at, [])):
                (long, short), n = max(own.items(), key=lambda x: (x[1], x[0]))
                support = [(False, True, GAP_ERROR)] * n + [(True, False, GAP_ERROR)] * max(0, len(seen) - n)
                ll = diploid(support)
                qual = variant_quality(ll, heterozygosity)
                if qual >= least_quality:
                    other = diploid([(r, False, e) for r, _, e in support])
                    out.append(row(contig, at, long, [short, *more], with_other(ll, other) if more else ll, len(seen), [max(0, len(seen) - n), n, *([0] * len(more))], qual))
                    found = True
            if reference_confidence and not found:
                ll = diploid([(b == ref, b != ref, e) for b, e, _ in seen])
                out.append(row(contig, at, ref, [NON_REF], ll, len(seen), [counts[ref], len(seen) - counts[ref]], None))
        return pd.DataFrame(out, columns=names)

    return call


def fraction_likelihood(seen: list[tuple[bool, bool, float]], f: float) -> float:
    """log10 likelihood of bases of which a share `f` comes from the alternate."""
    return sum(math.log10(max((1 - f) * (1 - e if ref else e / 3) + f * (1 - e if alt else e / 3), 1e-300)) for ref, alt, e in seen)


def somatic_caller(tumor: str, normal: str | None = None, least_tumor: float = 6.3, least_normal: float = 2.3, emit_filtered: bool = False) -> Callable[[str, int, int, pd.DataFrame], pd.DataFrame]:
    """A caller of SOMATIC rows. TLOD compares the alternate at its own share with none in the tumour, NLOD none with a
    germline heterozygote in the normal. Sites below `least_normal` are germline_risk: left out, or kept with the filter."""
    names = column_names(SOMATIC)

    def judged(contig: str, at: int, ref: str, alt: str, of: dict[str | None, list[tuple[bool, bool, float]]]) -> tuple | None:
        t, n = of.get(tumor, []), of.get(normal, []) if normal else []
        share = sum(a for _, a, _ in t) / len(t) if t else 0.0
        if not share:
            return None
        tlod = fraction_likelihood(t, share) - fraction_likelihood(t, 0.0)
        nlod = fraction_likelihood(n, 0.0) - fraction_likelihood(n, 0.5) if n else None
        if tlod < least_tumor:
            return None
        filters = ["germline_risk"] if nlod is not None and nlod < least_normal else []
        if filters and not emit_filtered:
            return None
        genotypes = [{"sampleId": s, "phased": False, "calls": [0, 1] if s == tumor else [0, 0], "depth": len(x), "alleleDepths": [sum(r for r, _, _ in x), sum(a for _, a, _ in x)]} for s, x in ((tumor, t), *(((normal, n),) if normal else ()))]
        return (contig, at, at + len(ref), [], ref, [alt], 10 * tlod, filters, tlod, nlod, genotypes)

    def call(contig: str, lo: int, hi: int, reads: pd.DataFrame) -> pd.DataFrame:
        reference, bases, gaps, _ = columns(reads, lo, hi)
        out = []
        for at in sorted(bases):
            ref, seen = reference[at], bases[at]
            alts = Counter(b for b, _, s in seen if s == tumor and b not in (ref, "N"))
            for alt in sorted(alts, key=lambda b: (-alts[b], b)):
                of: dict[str | None, list] = defaultdict(list)
                for b, e, s in seen:
                    of[s].append((b == ref, b == alt, e))
                out.append(judged(contig, at, ref, alt, of))
            own = Counter((r, a) for r, a, s in gaps.get(at, []) if s == tumor)
            for long, short in sorted(own, key=lambda x: (-own[x], x)):
                have = Counter(s for r, a, s in gaps[at] if (r, a) == (long, short))
                depth = Counter(s for _, _, s in seen)
                of = {s: [(False, True, GAP_ERROR)] * have[s] + [(True, False, GAP_ERROR)] * max(0, depth[s] - have[s]) for s in depth}
                out.append(judged(contig, at, long, short, of))
        return pd.DataFrame([x for x in out if x], columns=names)

    return call
