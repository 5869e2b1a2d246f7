"""Column functions on reads: qualities, CIGARs, flags, attributes. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The default quality bins low,high,base with low inclusive and high exclusive.
DEFAULT_QUALITY_BINS = "0,2,1;2,3,2;3,4,3;4,5,4;5,6,5;6,7,6;7,16,10;16,26,20;26,254,30"
PHRED_OFFSET = 33
#: Fixed values of the SAM specification: bits of the flag field.
SAM_FLAGS = {
    "readPaired": 0x1, "properPair": 0x2, "readUnmapped": 0x4, "mateUnmapped": 0x8, "readNegativeStrand": 0x10, "mateNegativeStrand": 0x20,
    "firstOfPair": 0x40, "secondOfPair": 0x80, "secondaryAlignment": 0x100, "failedVendorQualityChecks": 0x200, "duplicateRead": 0x400,
    "supplementaryAlignment": 0x800,
}


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def map_characters(x: Column | str, mapping: dict[str, str]) -> Column:
    """Every character replaced by its image; characters without one stay."""
    kept = {a: b for a, b in mapping.items() if a != b}
    return F.translate(_c(x), "".join(kept), "".join(kept.values())) if kept else _c(x)


def parse_quality_bins(spec: str) -> list[tuple[int, int, int]]:
    """Bins in order; they must adjoin without gap or overlap."""
    found = sorted(tuple(int(v) for v in part.split(",")) for part in spec.split(";") if part.strip())
    if not found or any(len(b) != 3 or b[0] >= b[1] for b in found):
        raise ValueError(f"quality bins need low,high,base with low < high: {spec!r}")
    for (_, high, _), (low, _, _) in zip(found, found[1:], strict=False):
        if high != low:
            raise ValueError(f"quality bins {'overlap' if low < high else 'leave a gap'} at {low}")
    return found


def bin_qualities(qualities: Column | str, spec: str = DEFAULT_QUALITY_BINS) -> Column:
    """Quality string with every score replaced by its bin's base; a score outside all bins is an error."""
    found = parse_quality_bins(spec)
    mapping = {chr(q + PHRED_OFFSET): chr(base + PHRED_OFFSET) for low, high, base in found for q in range(low, high)}
    covered = "".join(mapping)
    outside = F.translate(_c(qualities), covered, "")
    return F.when(outside != "", F.raise_error(F.concat(F.lit("quality score outside all bins: "), outside)).cast("string")).otherwise(map_characters(qualities, mapping))


def read_score(qualities: Column | str, least: int = 15) -> Column:
    """Sum of the scores of at least `least`."""
    scores = F.transform(F.split(_c(qualities), ""), lambda ch: F.ascii(ch) - PHRED_OFFSET)
    return F.aggregate(F.filter(scores, lambda q: q >= least), F.lit(0), lambda a, q: a + q)


def reverse_complement(bases: Column | str) -> Column:
    return F.reverse(F.translate(_c(bases), "ACGTacgt", "TGCAtgca"))


def on_strand(value: Column | str, negative: Column | str, complement: bool = False) -> Column:
    """A read's bases or qualities as sequenced: reversed (and complemented) where it aligns to the negative strand."""
    return F.when(_c(negative), reverse_complement(value) if complement else F.reverse(_c(value))).otherwise(_c(value))


def clipped(cigar: Column | str, end: str, kinds: str = "HS") -> Column:
    """Total length of the clips (H and S) at one end of a CIGAR: 'leading' or 'trailing'."""
    run = F.regexp_extract(_c(cigar), rf"^((?:[0-9]+[{kinds}])*)" if end == "leading" else rf"((?:[0-9]+[{kinds}])*)$", 1)
    return F.aggregate(F.regexp_extract_all(run, F.lit("([0-9]+)"), F.lit(1)), F.lit(0).cast("long"), lambda a, n: a + n.cast("long"))


def five_prime(start: Column | str, end: Column | str, cigar: Column | str, negative: Column | str) -> Column:
    """Unclipped 5' position: the start less leading clips, or for the negative strand the end plus trailing clips."""
    low = F.greatest(_c(start).cast("long") - F.coalesce(clipped(cigar, "leading"), F.lit(0)), F.lit(0).cast("long"))
    return F.when(_c(negative), _c(end).cast("long") + F.coalesce(clipped(cigar, "trailing"), F.lit(0))).otherwise(low)


def hard_clips(cigar: Column | str) -> Column:
    """struct<fromStart, fromEnd>: bases that hard clips removed."""
    take = lambda p: F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(_c(cigar), p, 1), F.lit("")), F.lit("999999999")).cast("int"), F.lit(0))
    return F.struct(take("^([0-9]+)H").alias("fromStart"), take("([0-9]+)H$").alias("fromEnd"))


def trim_supplementary(bases: Column | str, cigar: Column | str) -> Column:
    """A supplementary record's bases or qualities without its soft clips."""
    lead, tail = clipped(cigar, "leading", "S").cast("int"), clipped(cigar, "trailing", "S").cast("int")
    return F.substr(_c(bases), lead + 1, F.length(_c(bases)) - lead - tail)


def soft_to_hard(cigar: Column | str) -> Column:
    return F.translate(_c(cigar), "S", "H")


def flag(flags: Column | str, name: str) -> Column:
    return _c(flags).bitwiseAND(SAM_FLAGS[name]) != 0


def decode_flags(flags: Column | str) -> dict[str, Column]:
    """The read model's boolean columns and readInFragment from a SAM flag."""
    out = {n: flag(flags, n) for n in SAM_FLAGS if n not in ("readUnmapped", "mateUnmapped", "firstOfPair", "secondOfPair")}
    out["readMapped"] = ~flag(flags, "readUnmapped")
    out["mateMapped"] = flag(flags, "readPaired") & ~flag(flags, "mateUnmapped")
    out["primaryAlignment"] = ~flag(flags, "secondaryAlignment") & ~flag(flags, "supplementaryAlignment")
    out["readInFragment"] = F.when(flag(flags, "secondOfPair"), 1).otherwise(0)
    return out


def attributes(mapped: Column | str, suboptimal: Column | str, score: Column | str, mismatches: Column | str, group: Column | str, alternates: Column | str | None = None, supplementary: Column | str | None = None) -> Column:
    """The tab-joined attribute string of a record; an unaligned one has zero scores and its read group alone."""
    tag = lambda name, kind, v: F.when(_c(v).isNotNull(), F.concat(F.lit(f"{name}:{kind}:"), _c(v).cast("string")))
    more = [tag(n, "Z", v) for n, v in (("XA", alternates), ("SA", supplementary)) if v is not None]
    full = F.concat_ws("\t", tag("XS", "i", suboptimal), tag("AS", "i", score), tag("NM", "i", mismatches), tag("RG", "Z", group), *more)
    return F.when(_c(mapped), full).otherwise(F.concat_ws("\t", F.lit("XS:i:0"), F.lit("AS:i:0"), tag("RG", "Z", group)))


def attribute(attrs: Column | str, name: str) -> Column:
    """The value of one tag of an attribute string, null if it isn't there."""
    return F.nullif(F.regexp_extract(_c(attrs), rf"(?:^|\t){name}:[A-Za-z]:([^\t]*)", 1), F.lit(""))
