"""What reads go through before somatic calling: artefacts of palindromes clipped, and piles of reads thinned out.

Damage of a fragment's end can fold it back on itself; repair then copies one end of the fragment onto the other. Such a
read has a clipped (or inserted) end that is the reverse complement of the reference at the fragment's other end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.sequence import reverse_complement
from helixframe.sources.fasta import windows_of

#: Bases beyond the clip that must match too, the share of matching bases, and the quality that mapping must exceed.
PALINDROME, MATCHING, SUSPICIOUS = 5, 0.9, 50


def _end_of(upstream: Column) -> tuple[Column, Column]:
    """Length and kind of the first or last operation of a CIGAR."""
    first, last = F.regexp_extract("cigar", "^([0-9]+)[SI]", 1), F.regexp_extract("cigar", "([0-9]+)[SI]$", 1)
    n = F.when(upstream, first).otherwise(last)
    return F.when(n != "", n.cast("int")), F.when(upstream, F.regexp_replace("cigar", "^[0-9]+[SI]", "")).otherwise(F.regexp_replace("cigar", "[0-9]+[SI]$", ""))


def clip_palindromes(reads: DataFrame, reference: DataFrame, least: int = PALINDROME) -> DataFrame:
    """Reads whose end is an artefact of a palindrome lose it: bases and qualities go, its CIGAR operation becomes a hard clip.
    Looked at are properly paired reads on opposite strands with a known fragment size, the upstream one at its beginning, the other
    at its end; the end and `least` more bases are held against the reverse complement of as many reference bases at the fragment's
    other end, of which nine in ten must match. `reference` has pieces of contigs, as read_fasta gives them; only windows that
    some read asks for are fetched, once each."""
    upstream = F.col("insertSize") > 0
    clipped, rest = _end_of(upstream)
    paired = F.coalesce(F.col("properPair") & F.col("readMapped") & F.col("mateMapped") & (F.col("insertSize") != 0) & (F.col("readNegativeStrand") != F.col("mateNegativeStrand")), F.lit(False))
    n = F.least(clipped + least, F.length("sequence")).cast("long")
    far = F.when(upstream, F.col("start") + F.col("insertSize") - n).otherwise(F.col("mateAlignmentStart"))
    apart = F.when(upstream, far >= F.col("start")).otherwise(far + n <= F.col("end"))  # the other end lies within what the read may reach
    sided = F.when(upstream, ~F.col("readNegativeStrand")).otherwise(F.col("readNegativeStrand") & (F.col("end") > F.col("mateAlignmentStart")))
    asks = F.coalesce(paired & sided & clipped.isNotNull() & (F.length("sequence") == F.length("qualityScores")) & apart & (far >= 0), F.lit(False))
    asked = reads.where(asks).select("*", clipped.alias("_clip"), rest.alias("_rest"), n.alias("_n"), far.alias("_from"), upstream.alias("_up"))
    known = windows_of(reference, asked.select(F.col("referenceName").alias("contigName"), F.col("_from").alias("start"), (F.col("_from") + F.col("_n")).alias("end")))
    known = known.select(F.col("contigName").alias("_c"), F.col("start").alias("_s"), F.col("end").alias("_e"), F.col("bases").alias("_bases"))
    held = asked.join(known, (F.col("referenceName") == F.col("_c")) & (F.col("_from") == F.col("_s")) & (F.col("_from") + F.col("_n") == F.col("_e")), "left")
    size, n = F.length("sequence"), F.col("_n").cast("int")
    own = F.upper(F.when(F.col("_up"), F.substr("sequence", F.lit(1), n)).otherwise(F.substr("sequence", size - n + 1, n)))
    same = F.size(F.filter(F.arrays_zip(F.split(own, "").alias("a"), F.split(reverse_complement("_bases"), "").alias("b")), lambda x: x["a"] == x["b"]))
    artefact = F.coalesce(same >= MATCHING * n, F.lit(False))
    kept = lambda c: F.when(F.col("_up"), F.substr(c, F.col("_clip") + 1, size)).otherwise(F.substr(c, F.lit(1), size - F.col("_clip")))
    hard = F.concat(F.col("_clip").cast("string"), F.lit("H"))
    new = {"sequence": kept("sequence"), "qualityScores": kept("qualityScores"), "cigar": F.when(F.col("_up"), F.concat(hard, "_rest")).otherwise(F.concat("_rest", hard))}
    mended = held.select(*(F.when(artefact, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in reads.columns))
    return reads.where(~asks).unionByName(mended)


def thin_piles(reads: DataFrame, most: int, most_suspicious: int = 0, stride: int = 1) -> DataFrame:
    """At most `most` reads for each place of a stride of `stride` alignment starts, chosen by a hash of their name; 0 or less keeps
    all. A stride with `most_suspicious` or more poorly mapped reads a place is a pile that belongs elsewhere and goes as a
    whole; 0 keeps it. Reads without a place stay."""
    place = [F.col("referenceName").alias("_c"), F.floor(F.col("start") / stride).alias("_stride")]
    placed = reads.where("start is not null and referenceName is not null")
    out = placed
    same = lambda a, b: (F.col(f"{a}.referenceName") == F.col(f"{b}._c")) & (F.floor(F.col(f"{a}.start") / stride) == F.col(f"{b}._stride"))
    if most_suspicious > 0:
        poor = F.count_if(F.coalesce(F.col("mappingQuality"), F.lit(0)) <= SUSPICIOUS)
        piles = placed.groupBy(*place).agg(poor.alias("_poor")).where(F.col("_poor") >= most_suspicious * stride).drop("_poor")  # a row a pile
        out = placed.alias("r").join(piles.alias("p"), same("r", "p"), "left_anti")
    if most > 0:
        w = Window.partitionBy("referenceName", F.floor(F.col("start") / stride)).orderBy(F.xxhash64("readName", "readInFragment"), "readName", "readInFragment", "start")
        out = out.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= most * stride).drop("_rn")
    return out.unionByName(reads.where("start is null or referenceName is null"))
