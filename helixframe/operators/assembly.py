"""Sharding of reads for local assembly, and calling per shard with a pluggable caller."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions.intervals import callable_point
from helixframe.operators.intervals import trim_bins, with_bins
from helixframe.operators.reads import downsample

#: The largest assembly region and the padding around it.
MAX_REGION, REGION_PADDING = 300, 100


def column_names(schema: str) -> list[str]:
    """The columns of a schema in text, whatever types they nest."""
    flat, depth = "", 0
    for x in schema:
        depth += (x == "<") - (x == ">")
        flat += "" if depth or x == ">" else x
    return [x.strip().split(" ")[0] for x in flat.split(",")]


def shards(reads: DataFrame, lengths: DataFrame, size: int = 5000, padding: int = MAX_REGION + REGION_PADDING, contig: str = "referenceName") -> DataFrame:
    """Reads dealt to bins of `size`: padded by `padding` on both sides, so a bin holds every read that a region near its
    border needs. Bins beyond the contig's end go; binEnd is cut to it."""
    padded = reads.withColumn("_ps", F.col("start") - padding).withColumn("_pe", F.col("end") + padding)
    binned = with_bins(padded, size, (contig, "_ps", "_pe")).withColumn("binStart", F.col("binId") * size).drop("_ps", "_pe")
    known = lengths.select(F.col("contigName").alias("_c"), F.col("length").alias("_len"))
    kept = trim_bins(binned, lengths, "binStart", contig).join(known, F.col(contig) == F.col("_c"))
    return kept.withColumn("binEnd", F.least(F.col("binStart") + size, F.col("_len"))).drop("_c", "_len")


def preprocessed(reads: DataFrame, before: Sequence[Callable[[DataFrame], DataFrame]] = (), keep: Callable[[DataFrame], DataFrame] | None = None, after: Sequence[Callable[[DataFrame], DataFrame]] = (), most: int = 0, thin: Callable[[DataFrame, int], DataFrame] = downsample) -> DataFrame:
    """What a caller's reads go through, in this order: transforms, a filter, transforms, downsampling (`thin`, per start)."""
    for f in (*before, *([keep] if keep else []), *after):
        reads = f(reads)
    return thin(reads, most)


def sorted_shards(sharded: DataFrame, partitions: int | None = None, contig: str = "referenceName") -> DataFrame:
    """Shards together in partitions, their reads in order, without a global sort."""
    dealt = sharded.repartition(partitions, contig, "binId") if partitions else sharded.repartition(contig, "binId")
    return dealt.sortWithinPartitions(contig, "binId", "start", "readName", "readInFragment")


def call_shards(sharded: DataFrame, caller: Callable[[str, int, int, pd.DataFrame], pd.DataFrame], schema: str, contig: str = "referenceName", partitions: int | None = None) -> DataFrame:
    """Run `caller(contig, binStart, binEnd, reads)` on every shard; of its calls (with `start`, zero-based) those that
    begin in the shard stay, so padded copies are called once. A task holds one shard at a time."""
    rows = sorted_shards(sharded, partitions, contig)
    names = column_names(schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        now = None

        def calls() -> pd.DataFrame:
            shard = pd.concat(held, ignore_index=True)
            lo, hi = int(shard["binStart"].iloc[0]), int(shard["binEnd"].iloc[0])
            out = caller(str(shard[contig].iloc[0]), lo, hi, shard)
            return out[(out["start"] >= lo) & (out["start"] < hi)][names]

        for batch in batches:
            for key, part in batch.groupby([contig, "binId"], sort=False):
                if key != now and held:
                    yield calls()
                    held = []
                now = key
                held.append(part)
        if held:
            yield calls()

    return rows.mapInPandas(run, schema)


def keep_callable(calls: DataFrame) -> DataFrame:
    """Calls whose one-based start lies in their shard."""
    return calls.where(callable_point(F.col("start") + 1, F.col("binStart") + 1, F.col("binEnd")))
