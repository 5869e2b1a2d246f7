"""Annotations of calls in two forms: raw ones, which add up over samples, and the values that follow from them.

Raw: reads by strand (reference and alternate allele, forward and reverse), and for base quality, mapping quality and place in
the read a histogram by allele, as triples value, reads of the reference, reads of the alternate. The raw form of several samples is the
sum of theirs, so what joint calling derives from it is what the pooled reads would give, and no read is looked at again.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

#: INFO columns: raw ones, then what follows from them.
RAW = ("SB", "RAW_BQ", "RAW_MQ", "RAW_POS")
VALUES = ("FS", "SOR", "BaseQRankSum", "MQRankSum", "ReadPosRankSum")
COLUMNS = ", ".join([*(f"INFO_{n} array<int>" for n in RAW), *(f"INFO_{n} double" for n in VALUES)])
#: reverse strand, base quality, mapping quality, place in the read
Note = tuple[bool, int, int, int]


def raw_of(seen: Iterable[tuple[bool, bool, Note]]) -> dict[str, list[int]]:
    """The raw form of (supports the reference, supports the alternate, note) of each read; others count for neither."""
    strands, hist = [0, 0, 0, 0], [{}, {}, {}]
    for ref, alt, (reverse, *values) in seen:
        if ref == alt:
            continue
        strands[2 * alt + reverse] += 1
        for h, v in zip(hist, values, strict=True):
            h.setdefault(v, [0, 0])[alt] += 1
    return dict(zip(RAW, [strands, *([x for v in sorted(h) for x in (v, *h[v])] for h in hist)], strict=True))


def combined(raws: Iterable[dict[str, Sequence[int] | None]]) -> dict[str, list[int]] | None:
    """The sum of raw forms; None if none is known."""
    strands, hist, known = [0, 0, 0, 0], [{}, {}, {}], False
    for raw in raws:
        if any(raw.get(n) is None for n in RAW):
            continue
        known = True
        strands = [a + b for a, b in zip(strands, raw["SB"], strict=True)]
        for h, n in zip(hist, RAW[1:], strict=True):
            for k in range(0, len(raw[n]), 3):
                v, ref, alt = raw[n][k : k + 3]
                own = h.setdefault(v, [0, 0])
                own[0], own[1] = own[0] + ref, own[1] + alt
    return dict(zip(RAW, [strands, *([x for v in sorted(h) for x in (v, *h[v])] for h in hist)], strict=True)) if known else None


def fisher(table: Sequence[int]) -> float:
    """Two-sided probability of a two by two table whose rows are alleles and columns strands."""
    a, b, c, d = table
    choose = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    n, row, column = a + b + c + d, a + b, a + c
    of = lambda x: choose(row, x) + choose(n - row, column - x) - choose(n, column)
    here = of(a)
    return min(1.0, sum(math.exp(p) for x in range(max(0, column - (n - row)), min(row, column) + 1) if (p := of(x)) <= here + 1e-7))


def strand_odds(table: Sequence[int]) -> float:
    """Symmetric odds ratio of strands, scaled by how uneven each allele's strands are; one is added to each cell."""
    a, b, c, d = (x + 1.0 for x in table)
    odds = a * d / (b * c)
    return math.log(odds + 1 / odds) + math.log(min(a, b) / max(a, b)) - math.log(min(c, d) / max(c, d))


def rank_sum(triples: Sequence[int]) -> float | None:
    """Z of the rank-sum test of alternate against reference values, ties sharing their ranks; None without reads of both."""
    rows = sorted(zip(triples[::3], triples[1::3], triples[2::3], strict=True))
    ref, alt = sum(r for _, r, _ in rows), sum(a for *_, a in rows)
    n = ref + alt
    if not ref or not alt:
        return None
    before, ranks, ties = 0, 0.0, 0
    for _, r, a in rows:
        t = r + a
        ranks += a * (before + (t + 1) / 2)
        ties += t**3 - t
        before += t
    spread = ref * alt / 12 * (n + 1 - ties / (n * (n - 1)) if n > 1 else 0)
    return (ranks - alt * (n + 1) / 2) / math.sqrt(spread) if spread > 0 else 0.0


def values_of(raw: dict[str, Sequence[int]] | None) -> list[float | None]:
    """The values of a raw form, in the order of VALUES."""
    if raw is None:
        return [None] * len(VALUES)
    fs = abs(-10 * math.log10(max(fisher(raw["SB"]), 1e-320)))
    return [fs, strand_odds(raw["SB"]), *(rank_sum(raw[n]) for n in RAW[1:])]


def columns_of(raw: dict[str, Sequence[int]] | None) -> list:
    """Raw columns and values of a call."""
    return [*([raw[n] for n in RAW] if raw else [None] * len(RAW)), *values_of(raw)]
