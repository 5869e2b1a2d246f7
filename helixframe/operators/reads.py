"""Operators on reads and fragments."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.functions.sequence import five_prime, on_strand, read_score
from helixframe.session import scratch_path


def good_read(least: int = 20) -> Column:
    """Whether a read is mapped, no secondary line, no duplicate, passed vendor checks and has at least the mapping quality; null
    where one of these is unknown."""
    return (F.col("mappingQuality") >= least) & F.col("readMapped") & ~F.col("secondaryAlignment") & ~F.col("duplicateRead") & ~F.col("failedVendorQualityChecks")


def quality_filter(reads: DataFrame, least: int = 20) -> DataFrame:
    """Mapped, primary-line, non-duplicate reads that passed vendor checks, of at least the mapping quality; null drops."""
    return reads.where(good_read(least))


def to_fragments(reads: DataFrame) -> DataFrame:
    """One row per read group and read name: name, readGroupId, insertSize, alignments (in read order)."""
    row = F.struct(*reads.columns)
    grouped = reads.groupBy(F.col("readName").alias("name"), "readGroupId").agg(F.max("insertSize").cast("int").alias("insertSize"), F.sort_array(F.collect_list(F.struct(F.col("readInFragment").alias("_k"), F.col("start").alias("_s"), row.alias("_r")))).alias("_all"))
    return grouped.withColumn("alignments", F.transform("_all", lambda x: x["_r"])).drop("_all")


def to_reads(fragments: DataFrame) -> DataFrame:
    return fragments.select(F.explode("alignments").alias("a")).select("a.*")


def _position(r: Column) -> Column:
    mapped = F.struct(r["referenceName"].alias("referenceName"), five_prime(r["start"], r["end"], r["cigar"], r["readNegativeStrand"]).alias("pos"), F.when(r["readNegativeStrand"], "REVERSE").otherwise("FORWARD").alias("orientation"))
    unmapped = F.struct(r["sequence"].cast("string").alias("referenceName"), F.lit(0).cast("long").alias("pos"), F.lit("INDEPENDENT").alias("orientation"))
    return F.when(r["readMapped"], mapped).otherwise(unmapped)


def positions_and_score(alignments: Column | str) -> Column:
    """struct<left, right, score> of a fragment. Left is the forward one of the first and second read of the pair, else the
    first; right is the reverse one of the second and first, else the second. A single reverse read is both. Without reads
    numbered 0 or 1 left is the first primary or unmapped alignment."""
    a = F.col(alignments) if isinstance(alignments, str) else alignments
    # each step is bound to a lambda's variable: higher-order functions are evaluated wherever they are written
    bound = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))
    prefer = lambda a, b, strand: F.when(a["orientation"] == strand, a).when(b["orientation"] == strand, b).otherwise(a)

    def numbered(usable: Column, k: int) -> Column:
        return F.get(F.transform(F.slice(F.filter(usable, lambda r: r["readInFragment"] == k), 1, 1), _position), F.lit(0))

    def placed(p: Column) -> Column:
        usable = p["usable"]
        score = F.aggregate(F.filter(p["primary"], lambda r: ~F.coalesce(r["supplementaryAlignment"], F.lit(False))), F.lit(0), lambda s, r: s + F.coalesce(read_score(r["qualityScores"]), F.lit(0)))
        return bound(F.struct(numbered(usable, 0).alias("first"), numbered(usable, 1).alias("second")), lambda n: sides(usable, n["first"], n["second"], score))

    def sides(usable: Column, first: Column, second: Column, score: Column) -> Column:
        either = first.isNotNull() | second.isNotNull()
        left = F.when(either, prefer(first, second, "FORWARD")).otherwise(F.get(F.transform(F.slice(usable, 1, 1), _position), F.lit(0)))
        right = F.when(either, prefer(second, first, "REVERSE"))
        return F.struct(left.alias("left"), right.alias("right"), score.alias("score"))

    primary = F.filter(a, lambda r: F.coalesce(r["readMapped"], F.lit(False)) & F.coalesce(r["primaryAlignment"], F.lit(False)))
    unmapped = F.filter(a, lambda r: ~F.coalesce(r["readMapped"], F.lit(False)))
    return bound(bound(primary, lambda p: F.struct(p.alias("primary"), F.concat(p, unmapped).alias("usable"))), placed)


def not_duplicates(keyed: DataFrame, library: str, left: str, right: str, score: str, identity: Sequence[str]) -> DataFrame:
    """The `identity` of fragments that have a left position and are no duplicates: of each library, left and right position the one
    of the best score (ties: smallest identity), unless it is unpaired and a pair has the same left position. Both steps are
    aggregates that tasks begin before anything is shuffled, so a position that many fragments share is a row for each task."""
    best = F.min(F.struct((-F.col(score)).alias("_worse"), *(F.col(c).alias(f"_{k}") for k, c in enumerate(identity))))
    # a test of the left position itself would be pushed down to the reads, and positions be computed again for it
    there = F.max(F.col(left).isNotNull()).alias("_there")
    one = keyed.groupBy(F.col(library).alias("_library"), F.col(left).alias("_left"), F.col(right).alias("_right")).agg(best.alias("_best"), there)
    # taken from the same groups with the same columns, so they are shuffled once for both
    pairs = one.groupBy(F.col("_library").alias("_l"), F.col("_left").alias("_p")).agg(F.max(F.col("_right").isNotNull()).alias("_pair"), F.count("_best").alias("_n"), F.max("_there").alias("_t")).where("_pair and _t and _n > 0").select("_l", "_p")
    one = one.where("_there")
    beaten = F.col("_library").eqNullSafe(F.col("_l")) & F.col("_left").eqNullSafe(F.col("_p")) & F.col("_right").isNull()
    return one.join(pairs, beaten, "left_anti").select(*(F.col(f"_best._{k}").alias(c) for k, c in enumerate(identity)))


def duplicate_flags(keyed: DataFrame, library: str = "library", left: str = "left", right: str = "right", score: str = "score", identity: Sequence[str] = ("name",)) -> DataFrame:
    """Adds primaryDup and secondaryDup. Fragments of one library and left position: unpaired ones are duplicates if a pair
    is there; of those that share the right position too, all but the best score (ties: smallest `identity`, which no two
    rows may share) are. Fragments without a left position are none. Flags come back by identity, never by position."""
    first = not_duplicates(keyed, library, left, right, score, identity).select(*(F.col(c).alias(f"_id{k}") for k, c in enumerate(identity)), F.lit(True).alias("_first"))
    same = F.lit(True)
    for k, c in enumerate(identity):
        same = same & F.col(c).eqNullSafe(F.col(f"_id{k}"))
    marked = keyed.join(first, same, "left").withColumn("primaryDup", F.col(left).isNotNull() & F.col("_first").isNull())
    return marked.withColumn("secondaryDup", F.col(left).isNotNull()).drop("_first", *(f"_id{k}" for k in range(len(identity))))


def mark_duplicates(fragments: DataFrame, libraries: DataFrame | None = None) -> DataFrame:
    """Fragments with duplicateRead set on every alignment: mapped primary ones by the fragment's own flag, mapped
    secondary ones wherever the fragment has a position, unmapped ones never. `libraries` maps readGroupId to library;
    groups without a library count as one. Only names and positions are compared; the fragments that are no duplicates join
    back by read group and name."""
    told = fragments.withColumn("_p", positions_and_score("alignments"))
    if libraries is not None:
        told = told.join(libraries.select("readGroupId", "library"), "readGroupId", "left")
    else:
        told = told.withColumn("library", F.lit(None).cast("string"))
    told = told.select("*", F.col("_p.left").alias("_left"), F.col("_p.right").alias("_right"), F.col("_p.score").alias("_score"))
    joined = duplicate_flags(told, "library", "_left", "_right", "_score", ("name", "readGroupId")).drop("_p", "_left", "_right", "_score", "library")

    def flagged(r: Column) -> Column:
        mapped, primary = F.coalesce(r["readMapped"], F.lit(False)), F.coalesce(r["primaryAlignment"], F.lit(False))
        return r.withField("duplicateRead", mapped & F.when(primary, F.col("primaryDup")).otherwise(F.col("secondaryDup")))

    return joined.withColumn("alignments", F.transform("alignments", flagged)).drop("primaryDup", "secondaryDup")


def pair_reads(raw: DataFrame, name: str = "readName", number: str = "readInFragment", order: str | None = None) -> DataFrame:
    """The rows that form pairs: of each name with an odd number of first reads and a second one, the last first read and
    the first second read. `order` breaks ties among reads of a number."""
    w = Window.partitionBy(name)
    by = [F.col(order)] if order else [F.lit(0)]
    up = Window.partitionBy(name, number).orderBy(*by)
    down = Window.partitionBy(name, number).orderBy(*(c.desc() for c in by))
    zeros, ones = F.count(F.when(F.col(number) == 0, 1)).over(w), F.count(F.when(F.col(number) == 1, 1)).over(w)
    marked = raw.withColumn("_ok", (zeros % 2 == 1) & (ones >= 1)).withColumn("_up", F.row_number().over(up)).withColumn("_down", F.row_number().over(down))
    return marked.where("_ok").where(((F.col(number) == 0) & (F.col("_down") == 1)) | ((F.col(number) == 1) & (F.col("_up") == 1))).drop("_ok", "_up", "_down")


def downsample(reads: DataFrame, most: int, contig: str = "referenceName", start: str = "start", order: tuple[str, ...] = ("readName", "readInFragment")) -> DataFrame:
    """At most `most` reads for each alignment start; 0 or less keeps all."""
    if most <= 0:
        return reads
    w = Window.partitionBy(contig, start).orderBy(*order)
    return reads.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= most).drop("_rn")


def infer_insert_size(reads: DataFrame, name: str = "readName") -> DataFrame:
    """Properly paired records get the fragment's insert size: the end less the mate's start of its first primary,
    properly paired record that starts after its mate; positive for the upstream record, negative for the other."""
    w = Window.partitionBy(name).orderBy("readInFragment", "start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    is_source = F.col("properPair") & F.col("primaryAlignment") & (F.col("start") > F.col("mateAlignmentStart"))
    size = F.first(F.when(is_source, F.col("end") - F.col("mateAlignmentStart")), ignorenulls=True).over(w)
    signed = F.when(F.col("start") > F.col("mateAlignmentStart"), -size).otherwise(size)
    return reads.withColumn("insertSize", F.when(F.col("properPair"), signed).cast("long"))


def as_sequenced(reads: DataFrame) -> DataFrame:
    """Bases and qualities turned back to the sequencer's strand."""
    return reads.withColumn("sequence", on_strand("sequence", "readNegativeStrand", complement=True)).withColumn("qualityScores", on_strand("qualityScores", "readNegativeStrand"))


def coordinate_sorted(reads: DataFrame) -> DataFrame:
    """Global coordinate order, unplaced reads last."""
    return reads.orderBy(F.asc_nulls_last("referenceName"), F.asc_nulls_last("start"), "readName", "readInFragment")


def with_ordinals(rows: DataFrame, order: Sequence[Column | str], within: str | None = None, name: str = "ordinal", path: str | None = None) -> DataFrame:
    """Rows with their place, from 1, in a global order, or in that of each value of `within`, by which the order must begin. Ranges of
    the order are sorted in parallel and stored, each row with its range and place there; the rows of each range are counted,
    and the sums of earlier ranges added. No task holds more than a range, whatever the values of `within` are."""
    spark = rows.sparkSession
    path = path or scratch_path(spark, "ordinals")
    inside = F.monotonically_increasing_id()
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_.withColumn("_range", F.shiftright(inside, 33)).withColumn("_place", inside.bitwiseAND((1 << 33) - 1)).write.parquet(path)
    stored = spark.read.schema(sorted_.schema.add("_range", "long").add("_place", "long")).parquet(path)
    counts = stored.groupBy("_range").agg(F.count("*").alias("n")).orderBy("_range").collect()  # a row a range
    before, sums = 0, []
    for r in counts:
        sums.append((r["_range"], before))
        before += r.n
    found = stored.join(F.broadcast(spark.createDataFrame(sums, "_range long, _before long")), "_range").withColumn(name, F.col("_before") + F.col("_place") + 1)
    found = found.drop("_range", "_place", "_before")
    if within is None:
        return found
    # stored, so that its size is known before the join: while values are few, rows are not shuffled by them, else a value would be a task
    firsts = scratch_path(spark, "firsts")
    found.groupBy(F.col(within).alias("_within")).agg(F.min(name).alias("_first")).write.parquet(firsts)
    first = spark.read.schema(T.StructType([T.StructField("_within", rows.schema[within].dataType), T.StructField("_first", T.LongType())])).parquet(firsts)
    return found.join(first, F.col(within).eqNullSafe(F.col("_within"))).withColumn(name, F.col(name) - F.col("_first") + 1).drop("_within", "_first")


def by_name(reads: DataFrame, partitions: int | None = None) -> DataFrame:
    """Reads of one name together and in read order, without a global sort."""
    dealt = reads.repartition(partitions, "readName") if partitions else reads.repartition("readName")
    return dealt.sortWithinPartitions("readName", "readInFragment")


def alignment_partitions(configured: int | None, scanned: int, least: int) -> int:
    """How many partitions alignment runs on: as configured, or three times the scan's, `least` at least."""
    return configured if configured else max(3 * scanned, least)


def for_alignment(reads: DataFrame, configured: int = 0, least: int = 0) -> DataFrame:
    """Reads by name on as many partitions as alignment wants; without a number or a least one the session decides."""
    if not configured and not least:
        return by_name(reads)
    return by_name(reads, alignment_partitions(configured, reads.rdd.getNumPartitions(), least))


def by_partition(df: DataFrame, number: str, partitions: int) -> DataFrame:
    """Every row in the partition that its column `number` names, from 0; a null or a number out of range is an error."""
    n = F.col(number)
    wrong = F.raise_error(F.concat(F.lit(f"no partition of {partitions}: "), F.coalesce(n.cast("string"), F.lit("null")))).cast("int")
    return df.repartitionById(partitions, F.when((n >= 0) & (n < partitions), n.cast("int")).otherwise(wrong))


def spread(df: DataFrame, least: int) -> DataFrame:
    """Repartition only where the scan has fewer splits than `least`."""
    return df.repartition(least) if df.rdd.getNumPartitions() < least else df


def reference_of(bases: str, start: int, cigar: str, md: str) -> tuple[str, list[int | None]]:
    """The reference base and place under every base of a read, from CIGAR and MD: '-' and null where it has none."""
    letters, sites = ["-"] * len(bases), [None] * len(bases)
    on, at, aligned = 0, start, []
    for n, kind in re.findall("([0-9]+)([MIDNSHP=X])", cigar):
        if kind in "M=X":
            aligned += range(on, on + int(n))
            sites[on : on + int(n)] = range(at, at + int(n))
        on += int(n) * (kind in "MIS=X")
        at += int(n) * (kind in "MDN=X")
    told = 0
    for n, gone, other in re.findall(r"([0-9]+)|\^([A-Za-z]+)|([A-Za-z])", md):
        if gone:
            continue
        for k in aligned[told : told + int(n or 1)]:
            letters[k] = other or bases[k]
        told += int(n or 1)
    if on != len(bases) or told != len(aligned):
        raise ValueError(f"CIGAR {cigar} and MD {md} do not fit {len(bases)} bases")
    return "".join(letters), sites


def with_reference(reads: DataFrame) -> DataFrame:
    """Adds referenceBases and referenceSites. A mapped read that has bases but no CIGAR or MD is an error."""
    used = ["readName", "readMapped", "sequence", "start", "cigar", "mismatchingPositions"]
    schema = T.StructType([*reads.schema.fields, T.StructField("referenceBases", T.StringType()), T.StructField("referenceSites", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            letters, sites = [], []
            for name, mapped, bases, start, cigar, md in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in used), strict=True):
                if mapped and bases and (start is None or not cigar or not md):
                    raise ValueError(f"recalibration needs CIGAR and MD (mismatchingPositions): read {name} has none")
                one = reference_of(bases, start, cigar, md) if mapped and bases else (None, None)
                letters.append(one[0])
                sites.append(one[1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(letters, pa.string()), pa.array(sites, pa.list_(pa.int64()))], names=schema.names)

    return reads.mapInArrow(run, schema)


def of_samples(groups: DataFrame, samples: list[str]) -> DataFrame:
    """The read groups (with `sample`) that belong to one of the samples."""
    return groups.where(F.col("sample").isin(samples))
