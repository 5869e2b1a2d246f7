"""What a locus costs in joint genotyping, and that nothing is forgotten too early."""

from __future__ import annotations

import random

from helixframe.operators import genotyping


def row(sample: str, start: int, end: int, alts: list[str], ref: str = "A") -> dict:
    n = len(alts) + 1
    pls = [0 if k == (1 if any(map(genotyping.is_real, alts)) else 0) else 200 for k in range(n * (n + 1) // 2)]
    return {"contig": "c", "bin": 0, "duplicate": False, "start": start, "end": end, "ref": ref, "alts": alts, "sample": sample, "pls": pls, "depth": 9}


def whole(rows: list[dict], samples: list[str]):  # noqa: ANN201
    """Calls with every sample's latest rows at hand at every locus."""
    out, state = [], {}
    for start in sorted({r["start"] for r in rows}):
        for r in rows:
            if r["start"] == start:
                held = state.get(r["sample"])
                state[r["sample"]] = [*held, r] if held and held[0]["start"] == start else [r]
        if found := genotyping.call_locus("c", start, state, samples):
            out.append(found)
    return out


def test_calls_are_those_of_all_samples_at_hand():
    rng = random.Random(6)
    samples = [f"s{k}" for k in range(6)]
    for _ in range(30):
        rows = []
        for s in samples:
            at = 0
            while at < 60:
                size = rng.choice([1, 1, 3, 12])
                real = rng.random() < 0.3
                ref = "ACGTACGTACGT"[:size] if real else "A"
                rows.append(row(s, at, at + size, [rng.choice(["T", "C"]) if size == 1 else "A", "<NON_REF>"] if real else ["<NON_REF>"], ref))
                if rng.random() < 0.1:
                    rows.append(row(s, at, at + 1, ["G", "<NON_REF>"]))
                at += rng.choice([size, size + 2, 1])  # rows may overlap
        rows.sort(key=lambda r: (r["start"], r["sample"]))
        assert list(genotyping.call_bin(iter(rows), samples)) == whole(rows, samples)


def test_idle_samples_cost_nothing(monkeypatch):
    """A thousand samples with a row each at the beginning; later loci see the two samples that reach them."""
    seen = []
    call = genotyping.call_locus
    monkeypatch.setattr(genotyping, "call_locus", lambda contig, start, state, samples, **o: seen.append(len(state)) or call(contig, start, state, samples, **o))
    rows = [row(f"s{k}", 0, 5, ["<NON_REF>"]) for k in range(1000)]
    for at in range(10, 200):
        rows += [row("s1", at, at + 1, ["T", "<NON_REF>"] if at % 10 == 0 else ["<NON_REF>"]), row("s2", at, at + 1, ["<NON_REF>"])]
    found = list(genotyping.call_bin(iter(rows), [f"s{k}" for k in range(1000)]))
    assert len(found) == len(seen) == 19 and set(seen) == {2}
